"""Registered queries of stores that are kept up to date: exactly-once ingest, exports with
changing headers, and incremental datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattspark.catalog import queries as base
from wattspark.catalog.queries import register
from wattspark.plans import incremental
from wattspark.schemas import SOURCES, raw_schema
from wattspark.session import scratch_path
from wattspark.sources import exports, ledger

#: Rows of one file of mixed headers, which one task sorts and writes.
ROWS_PER_FILE = 262_144


@register("ingest_exactly_once")
def q_ingest_exactly_once(spark, sf_dir):
    """A folder of Kepler exports, one run written twice, ingested three times, the last
    time with an export more: the store's rows are those of the exports."""
    path, store = scratch_path(spark, "exports-ledger"), scratch_path(spark, "store-ledger")
    rows = base.long(spark, sf_dir, "kepler")
    early = F.dayofmonth("_time") < 16
    for _ in range(2):
        exports.write_exports(rows.where(early), path, "kepler", run_id="early")
    ledger.ingest_once(spark, store, "kepler", path)
    exports.write_exports(rows.where(~early), path, "kepler", run_id="late")
    for _ in range(2):
        ledger.ingest_once(spark, store, "kepler", path)
    keep = [c for c in raw_schema(SOURCES["kepler"]).names if c not in ("_start", "_stop")]
    return base.ntz(ledger.read_ingested(spark, store).select(*[F.col(f"`{c}`") for c in keep]))


@register("scan_changing_headers")
def q_scan_changing_headers(spark, sf_dir):
    """Concatenated Kepler exports whose column order changes inside every file, read back
    split by split."""
    path = scratch_path(spark, "exports-mixed")
    names = [f.name for f in raw_schema(SOURCES["kepler"]).fields]
    rows = base.long(spark, sf_dir, "kepler").withColumn("odd", F.col("table") % 2)
    lines, orders = None, (names, names[::-1])
    parts = max(8, -(-rows.count() // ROWS_PER_FILE))
    for odd, order in enumerate(orders):
        cells = [exports._text(n, rows.schema[n].dataType).alias(n) if n in rows.columns
                 else F.lit(None).cast("string").alias(n) for n in order]
        own = rows.where(F.col("odd") == odd).select(
            "table", F.pmod(F.xxhash64("pod_name"), F.lit(parts)).alias("part"), F.lit(1).alias("kind"),
            F.to_csv(F.struct(*cells)).alias("value"))
        top = own.select("table", "part").distinct().select(
            "table", "part", F.lit(0).alias("kind"), F.lit(",".join(order)).alias("value"))
        both = own.unionByName(top)
        lines = both if lines is None else lines.unionByName(both)
    (lines.withColumn("export", F.lit("kepler_mixed")).repartition(parts, "part")
     .sortWithinPartitions("export", "part", "table", "kind").select("export", "value")
     .write.partitionBy("export").text(path))
    df = exports.read_exports(spark, path, "kepler")
    return base.ntz(df.drop("_file", "_start", "_stop"))


def _increments(spark, sf_dir, sources, name):
    """Three increments: the first ten days, the next ten, and the rest together with rows of
    all earlier days that come late; the second is applied twice."""
    state = scratch_path(spark, f"state-{name}")
    day = F.dayofmonth("_time")
    late = F.pmod(F.xxhash64("_time", "_field", "table"), F.lit(9)) == 0
    parts = ((day < 11) & ~late, day.between(11, 20) & ~late, (day > 20) | late)
    rows = {s: base.long(spark, sf_dir, s, dealt=True) for s in sources}
    for k in (0, 1, 1, 2):
        incremental.apply_increment(spark, state, f"part-{k}",
                                    {s: df.where(parts[k]) for s, df in rows.items()},
                                    base.DATASET_INTERVAL)
    return base.ntz(incremental.read_dataset(spark, state, name))


@register("incremental_energy")
def q_incremental_energy(spark, sf_dir):
    """The energy dataset kept up by three increments, with late rows and a repeat."""
    return _increments(spark, sf_dir, ("k8s", "kepler"), "energy")


@register("incremental_vm_power")
def q_incremental_vm_power(spark, sf_dir):
    """The VM power dataset kept up by three increments, with late rows and a repeat."""
    return _increments(spark, sf_dir, ("proxmox", "scaphandre_vm"), "vm_power")
