"""Registered queries of stored layouts, the regex index, sketches, resumed runs and joined streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wattspark.catalog import queries as base
from wattspark.catalog.queries import register
from wattspark.operators import sketches
from wattspark.operators.joins import regex_match_join
from wattspark.plans import resume, stored
from wattspark.session import scratch_path
from wattspark.sources import sinks, telemetry
from wattspark.streaming import energy_stream, telemetry_stream


@register("theta_join_indexed")
def q_theta_join_indexed(spark, sf_dir):
    """J5 by the trigram index: host rows per inventory id found in their URL."""
    t = base.tel(spark, sf_dir)
    host = t.where((F.col("plugin") == "scaphandre") & (F.col("_field") == "scaph_host_power_microwatts"))
    ids = base.inventory(spark, sf_dir).withColumnRenamed("inventory-server-id", "inventory_id")
    df = regex_match_join(host, ids, "url", "inventory_id", max_pairs=0)
    return base.numeric_value(df, ["_time", "url", "inventory_id"])


@register("energy_dataset_bucketed")
def q_energy_dataset_bucketed(spark, sf_dir):
    """J1/W6 over processed tables bucketed by their entities: no exchange."""
    name, folder = f"energy_{uuid.uuid4().hex[:12]}", scratch_path(spark, "bucketed-energy")
    stored.store_tables("energy", base.wide(spark, sf_dir, "k8s"), base.wide(spark, sf_dir, "kepler"),
                        folder, name, 16)
    return base.ntz(stored.stored_dataset(spark, "energy", name, f"{folder}/out", base.DATASET_INTERVAL))


@register("vm_power_dataset_bucketed")
def q_vm_power_dataset_bucketed(spark, sf_dir):
    """J2/W7 over processed tables bucketed by VM: no exchange."""
    name, folder = f"vm_{uuid.uuid4().hex[:12]}", scratch_path(spark, "bucketed-vm")
    stored.store_tables("vm_power", base.wide(spark, sf_dir, "proxmox"),
                        base.wide(spark, sf_dir, "scaphandre_vm"), folder, name, 16)
    return base.ntz(stored.stored_dataset(spark, "vm_power", name, f"{folder}/out", base.DATASET_INTERVAL))


@register("processed_clustered")
def q_processed_clustered(spark, sf_dir):
    """The processed k8s table clustered by time and entity, and read back."""
    path = scratch_path(spark, "clustered-k8s")
    sinks.write_clustered(base.wide(spark, sf_dir, "k8s"), path, ["container_name", "pod_name"])
    return base.ntz(sinks.read_table(spark, path))


@register("profile_range_sketched")
def q_profile_range_sketched(spark, sf_dir):
    """The profile of nine days of one plugin from daily sketches: row and missing counts,
    ends, and whether the distinct count is within five per cent of the exact one."""
    path = scratch_path(spark, "sketches")
    cols = ["_value", "_field", "vm_id", "vm_name", "url"]
    rows = telemetry.normalize_values(base.long(spark, sf_dir, "scaphandre_vm")).select(
        F.lit("scaphandre").alias("plugin"), "_time", *cols)
    sketches.write_sketches(rows, path)
    out = sketches.range_profile(spark, path, "scaphandre", "2024-01-05", "2024-01-13")
    days = rows.where(F.col("_time").cast("date").between("2024-01-05", "2024-01-13"))
    exact = days.agg(*[F.count_distinct(F.col(c).cast("string")).alias(c) for c in cols]).first()
    exact = spark.createDataFrame([(c, exact[c]) for c in cols], "column string, exact long")
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact")
    return out.join(exact, "column").select("column", "n_rows", "n_missing", "low", "high",
                                            near.alias("near"))


@register("energy_run_resumed")
def q_energy_run_resumed(spark, sf_dir):
    """W9 in committed stages, called twice: test rows, and stages executed and reused."""
    store, folder = scratch_path(spark, "resume-store"), scratch_path(spark, "resume-run")
    telemetry.write_telemetry(base.tel(spark, sf_dir, dealt=True), store)
    executed = reused = 0
    for _ in range(2):
        tel = telemetry.read_telemetry(spark, store)
        m, run = resume.energy_run(tel, base.START, base.STOP, folder, vm_name_filter=base.VM_FILTER,
                                   interval=base.DATASET_INTERVAL, num_trees=4, split_key=base.SPLIT_KEY)
        executed, reused = executed + len(run.executed), reused + len(run.reused)
    return m.select("n", F.lit(executed).alias("executed"), F.lit(reused).alias("reused"))


@register("stream_energy_join")
def q_stream_energy_join(spark, sf_dir):
    """J1/W6 as a stream-stream join: processed k8s and Kepler rows arrive as files; late-come
    scrapes far ahead close the windows, and the joined rows are read back."""
    folder, streams = scratch_path(spark, "stream-energy"), []
    for source in ("k8s", "kepler"):
        rows, path = base.wide(spark, sf_dir, source), f"{folder}/{source}"
        rows.repartitionByRange(4, "_time").write.parquet(path)
        for days in (400, 401):
            ahead = rows.limit(1).withColumn("_time", F.col("_time") + F.expr(f"interval {days} days"))
            ahead.write.mode("append").parquet(path)
        streams.append(telemetry_stream.read_long_stream(spark, path, rows.schema, max_files_per_trigger=2))
    out = energy_stream.stream_energy_dataset(*streams, interval="1 day", watermark="40 days")
    telemetry_stream.run_to_table(out, f"{folder}/out", f"{folder}/ckpt")
    return base.ntz(spark.read.parquet(f"{folder}/out").drop("batch_id"))
