"""Two streams joined under watermarks equal the batch dataset; the state is bounded."""

import datetime as dt
import os
import random

from wattspark.plans import datasets
from wattspark.streaming import energy_stream, telemetry_stream

K8S = ("_time timestamp, container_name string, namespace string, pod_name string, cpu_usage_nanocores double, "
       "memory_usage_bytes double, logsfs_used_bytes double, logsfs_capacity_bytes double")
KEPLER = ("_time timestamp, container_id string, container_name string, namespace string, pod_name string, "
          "kepler_container_joules_total double")
T0 = dt.datetime(2025, 8, 1)


def batches(seed, minutes, row):
    """Rows in arrival order, up to six minutes late, in files of ten minutes of arrivals, and
    a last file far ahead that closes all windows."""
    rng = random.Random(seed)
    rows = []
    for m in range(minutes):
        for _ in range(4):
            rows.append((m + rng.uniform(0, 6), row(rng, T0 + dt.timedelta(minutes=m, seconds=rng.randint(0, 59)))))
    rows.sort(key=lambda r: r[0])
    files = [[r for a, r in rows if 10 * k <= a < 10 * (k + 1)] for k in range((minutes + 6) // 10 + 1)]
    far = [row(rng, T0 + dt.timedelta(days=1, minutes=k)) for k in range(2)]
    return [f for f in files if f], far


def test_streams_equal_the_batch_dataset(spark, tmp_dir):
    def k8s_row(rng, t):
        return (t, f"c{rng.randint(0, 2)}", "n", f"p{rng.randint(0, 1)}", float(rng.randint(1, 9)) if rng.random() < 0.9
                else None, 2.0, 3.0, float(rng.randint(0, 4)))

    def kepler_row(rng, t):
        return (t, f"id{rng.randint(0, 9)}", f"c{rng.randint(0, 2)}", "n" if rng.random() < 0.9 else None,
                f"p{rng.randint(0, 1)}", float(rng.randint(1, 9)) if rng.random() < 0.9 else None)

    streams, tables = [], []
    for name, schema, row, seed in (("k8s", K8S, k8s_row, 1), ("kepler", KEPLER, kepler_row, 2)):
        files, far = batches(seed, 60, row)
        folder = f"{tmp_dir}/{name}"
        for k, rows in enumerate([*files, far[:1], far[1:]]):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/f{k:02d}")
            part = [f for f in os.listdir(f"{folder}/f{k:02d}") if f.endswith(".parquet")][0]
            os.makedirs(f"{folder}-in", exist_ok=True)
            os.link(f"{folder}/f{k:02d}/{part}", f"{folder}-in/{k:02d}.parquet")
            os.utime(f"{folder}-in/{k:02d}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
        df = spark.createDataFrame([r for f in files for r in f], schema)
        tables.append(df)
        streams.append(telemetry_stream.read_long_stream(spark, f"{folder}-in", df.schema, max_files_per_trigger=1))
    out = energy_stream.stream_energy_dataset(*streams, interval="5 minutes", watermark="10 minutes")
    telemetry_stream.run_to_table(out, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    got = spark.read.parquet(f"{tmp_dir}/out").drop("batch_id")
    want = datasets.energy_dataset(*tables, "5min")
    assert want.count() > 50
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))

    # the state of a finished run holds the open windows only
    query = (out.writeStream.format("noop").option("checkpointLocation", f"{tmp_dir}/ckpt2")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    held = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress]
    seen = sum(p["numInputRows"] for p in query.recentProgress)
    assert held[-1] <= 6 and max(held) < seen / 2, (held, seen)
