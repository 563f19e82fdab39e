"""Incremental upkeep of the processed tables and datasets.

A state folder holds, per source, mergeable cells: for every index key and metric the sum and
the number of its values, by day.  An increment of raw rows is reduced to cells, merged into
the stored cells of the days it touches (late rows touch old days), and the datasets of
those days are rebuilt from their cells.  Other days are neither read nor written.

Every increment writes its days anew in its own folder (``cells/<source>/seq=<n>/date=<d>``)
and commits them by one append to ``manifest``; readers take each day from its newest committed
increment.  An increment is named by its caller: one that is committed already is skipped, a
half-written one is written again.

The result equals one run over all raw rows with files merged (a cell is the mean of all its
values).  Differences to the one-shot processing: PDU rows carry no second URL
(``meta='none'``), and scaphandre tables always have all declared metrics (a row lacking one is
dropped), since both follow from the whole history.  Dataset intervals must divide a day.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspark.functions.timeops import interval_micros
from wattspark.operators.pivot import _value_expr
from wattspark.operators.select import col
from wattspark.plans import datasets, preprocess
from wattspark.schemas import SOURCES
from wattspark.session import glob_paths, path_exists, scratch_path

MANIFEST = "increment string, seq long, kind string, date string"
#: Datasets and the two sources each is built from.
DATASETS = {"energy": ("k8s", "kepler"), "vm_power": ("proxmox", "scaphandre_vm")}
DAY_MICROS = 86_400_000_000


def cells(long: DataFrame, source: str) -> DataFrame:
    """Index keys, ``date``, and per metric ``s_<k>`` (sum) and ``n_<k>`` (number of values)."""
    src = SOURCES[source]
    value = _value_expr(long, "_value")
    keep = F.col("_field").isin(src.fields)
    for k in dict.fromkeys([*src.index, *src.require_not_null]):
        keep = keep & col(k).isNotNull()
    base = (long.where(keep).select(*[col(k) for k in src.index], "_field", value.alias("_value"))
            .withColumn("date", F.date_format(F.col("_time").cast(T.TimestampType()), "yyyy-MM-dd")))
    aggs = []
    for k, f in enumerate(src.fields):
        own = F.when(F.col("_field") == f, F.col("_value"))
        aggs += [F.sum(own).alias(f"s_{k}"), F.count(own).alias(f"n_{k}")]
    return base.groupBy("date", *[col(k) for k in src.index]).agg(*aggs)


def merged(parts: DataFrame, source: str) -> DataFrame:
    """Cells of equal keys added up."""
    src = SOURCES[source]
    aggs = [F.sum(f"{a}_{k}").alias(f"{a}_{k}") for k in range(len(src.fields)) for a in "sn"]
    return parts.groupBy("date", *[col(k) for k in src.index]).agg(*aggs)


def wide(cell: DataFrame, source: str) -> DataFrame:
    """The processed table of a source from its cells."""
    src = SOURCES[source]
    means = [F.when(F.col(f"n_{k}") > 0, F.col(f"s_{k}") / F.col(f"n_{k}")).alias(f)
             for k, f in enumerate(src.fields)]
    out = cell.select(*[col(c) for c in src.index], *means)
    out = out.where(F.coalesce(*[col(f) for f in src.fields]).isNotNull())
    if source == "proxmox":
        return preprocess.add_disk_columns(out)
    return out.na.drop("any") if source.startswith("scaphandre") else out


def read_manifest(spark: SparkSession, state: str) -> DataFrame:
    path = f"{state.rstrip('/')}/manifest"
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path)


def current_paths(spark: SparkSession, state: str, kind: str, dates=None) -> list[str]:
    """Folder of the newest committed version of each day (of ``dates``)."""
    rows = read_manifest(spark, state).filter((F.col("kind") == kind) & F.col("date").isNotNull())
    newest = rows.groupBy("date").agg(F.max("seq").alias("seq")).collect()     # one row per day
    return [f"{state.rstrip('/')}/{kind}/seq={r['seq']}/date={r['date']}" for r in newest
            if dates is None or r["date"] in dates]


def _read_paths(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    """Day folders below ``base`` in one scan, with ``date`` as text."""
    conf = "spark.sql.sources.partitionColumnTypeInference.enabled"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        return spark.read.option("basePath", base).parquet(*paths).drop("seq")
    finally:
        spark.conf.set(conf, old)


def _read(spark: SparkSession, state: str, kind: str, dates=None) -> DataFrame | None:
    paths = current_paths(spark, state, kind, dates)
    return _read_paths(spark, f"{state.rstrip('/')}/{kind}", paths) if paths else None


def apply_increment(spark: SparkSession, state: str, increment: str,
                    sources: Mapping[str, DataFrame], interval: str = "1min") -> dict[str, list[str]]:
    """Merge raw long rows per source into the state and rebuild the touched days' datasets.

    Returns the touched days per source and dataset (empty when ``increment`` is committed
    already)."""
    state = state.rstrip("/")
    if DAY_MICROS % interval_micros(interval):
        raise ValueError("the interval must divide a day")
    manifest = read_manifest(spark, state)
    if not manifest.filter(F.col("increment") == increment).isEmpty():
        return {}
    seq = (manifest.agg(F.max("seq")).first()[0] or 0) + 1
    touched: dict[str, list[str]] = {}
    fresh: dict[str, str] = {}

    def store(df: DataFrame, kind: str) -> list[str]:
        """Write ``df`` by day as this increment's version; returns its days."""
        path = f"{state}/{kind}/seq={seq}"
        df.write.mode("overwrite").partitionBy("date").parquet(path)
        fresh[kind] = path
        return [p.rsplit("date=", 1)[1] for p in glob_paths(spark, f"{path}/date=*")]

    for source, long in sources.items():
        part = scratch_path(spark, f"cells-{source}")
        cells(long, source).write.parquet(part)
        new = spark.read.parquet(part)
        days = {r[0] for r in new.select("date").distinct().collect()}    # days, not rows
        old = _read(spark, state, f"cells/{source}", days) if days else None
        both = new if old is None else merged(new.unionByName(old), source)
        touched[source] = store(both, f"cells/{source}") if days else []
    for name, pair in DATASETS.items():
        days = sorted({d for s in pair for d in touched.get(s, [])})
        if not days:
            continue
        sides = []
        for source in pair:
            own = [d for d in days if d in touched.get(source, [])]
            paths = [f"{fresh[f'cells/{source}']}/date={d}" for d in own]
            paths += current_paths(spark, state, f"cells/{source}", set(days) - set(own))
            if not paths:
                break
            cell = _read_paths(spark, f"{state}/cells/{source}", paths)
            sides.append(wide(cell, source))
        if len(sides) < 2:
            continue
        build = datasets.energy_dataset if name == "energy" else datasets.vm_power_dataset
        out = build(*sides, interval).withColumn(
            "date", F.date_format(F.col("_time").cast(T.TimestampType()), "yyyy-MM-dd"))
        touched[name] = store(out, f"datasets/{name}")     # merging never takes a row away
    rows = [(increment, seq, f"cells/{k}" if k in SOURCES else f"datasets/{k}", d)
            for k, days in touched.items() for d in days]
    rows = rows or [(increment, seq, "none", None)]
    # the commit: all of the increment's days appear together
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{state}/manifest")
    return touched


def read_processed(spark: SparkSession, state: str, source: str, dates=None) -> DataFrame:
    """The processed table of a source (of some days)."""
    cell = _read(spark, state, f"cells/{source}", dates)
    if cell is None:
        raise FileNotFoundError(f"no committed cells of {source} in {state}")
    return wide(cell, source)


def read_dataset(spark: SparkSession, state: str, name: str, dates=None) -> DataFrame:
    """A dataset (``energy`` or ``vm_power``) as of the last committed increment."""
    out = _read(spark, state, f"datasets/{name}", dates)
    if out is None:
        raise FileNotFoundError(f"no committed rows of {name} in {state}")
    return out.drop("date")
