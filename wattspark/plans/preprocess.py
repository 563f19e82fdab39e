"""Per-source processing: raw long telemetry -> cleaned wide table.

Each function takes the long DataFrame of one source (as returned by
:mod:`wattspark.sources.exports` or a telemetry selection) and returns the
wide table.  Nothing is collected; the result is one lazy plan with a single
aggregation exchange (plus the small metadata join for PDU).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspark.functions import units
from wattspark.operators.aggregate import distinct_rows
from wattspark.operators.pivot import FILE_COL, pivot_mean, present_fields
from wattspark.operators.select import drop_columns, not_null
from wattspark.schemas import SOURCES


def _sorted(df: DataFrame, sort: bool, keys=None) -> DataFrame:
    """Order by time, ties broken by the remaining index keys: the range
    partitioner can then split a timestamp shared by many rows."""
    if not sort:
        return df
    keys = [k for k in (keys or []) if k in df.columns and k != "_time"]
    return df.orderBy("_time", *[F.col(f"`{k}`") for k in keys])


FIELD_MODES = ("declared", "present", "discover")


def pivot_fields(long: DataFrame, declared, mode: str = "declared"):
    """The wide columns to build.

    * ``'declared'``: the source's declared metrics, a static schema (a metric
      that never occurs is an all-missing column);
    * ``'present'``: the declared metrics that have a value (one small job);
    * ``'discover'``: every metric that has a value, declared or not, which
      is exactly the column set of a dynamic pivot (one small job).
    """
    if mode == "declared":
        return list(declared)
    if mode == "present":
        return present_fields(long, declared)
    if mode == "discover":
        return "discover"
    raise ValueError(f"fields must be one of {FIELD_MODES}")


def prep_k8s(long: DataFrame, *, sort: bool = False, per_file: bool | None = None,
             fields: str = "declared") -> DataFrame:
    """Drop bookkeeping and inventory tags, require container and pod, pivot."""
    src = SOURCES["k8s"]
    df = drop_columns(long, src.drop)
    df = not_null(df, src.require_not_null)
    wide = pivot_mean(df, src.index, pivot_fields(df, src.fields, fields), per_file=per_file)
    return _sorted(wide, sort, src.index)


def prep_kepler(long: DataFrame, *, sort: bool = False, per_file: bool | None = None,
                fields: str = "declared") -> DataFrame:
    src = SOURCES["kepler"]
    wide = pivot_mean(long, src.index, pivot_fields(long, src.fields, fields), per_file=per_file)
    return _sorted(wide, sort, src.index)


def prep_pdu(long: DataFrame, *, meta: str = "faithful", sort: bool = False,
             per_file: bool | None = None, fields: str = "declared") -> DataFrame:
    """Pivot PDU telemetry; ``meta='faithful'`` re-attaches server URLs.

    The faithful form left-joins the distinct (server, url) pairs of the same
    export on the server only, so both sides keep a ``url`` (``url_x`` from
    the wide row, ``url_y`` from the metadata) and a server with k URLs
    multiplies its wide rows by k.  ``meta='none'`` skips the join, since
    ``url`` is already part of the index.
    """
    src = SOURCES["pdu"]
    if per_file is None:
        per_file = FILE_COL in long.columns
    cols = pivot_fields(long, src.fields, fields)
    if per_file:
        # the file stays a key through the metadata join, dropped afterwards
        keyed = long.withColumnRenamed(FILE_COL, "__file")
        wide = pivot_mean(keyed, ["__file"] + src.index, cols, per_file=False)
    else:
        wide = pivot_mean(long, src.index, cols, per_file=False)
    if meta == "none":
        out = wide.drop("__file") if per_file else wide
        return _sorted(out, sort, src.index)
    if meta != "faithful":
        raise ValueError("meta must be 'faithful' or 'none'")
    from wattspark.operators.joins import left_meta_join

    meta_keys = ["__file", "inventory-server-id"] if per_file else ["inventory-server-id"]
    src_meta = long.withColumnRenamed(FILE_COL, "__file") if per_file else long
    meta_df = src_meta.select(*meta_keys, "url").distinct()
    out = left_meta_join(wide, meta_df, meta_keys, "url")
    if per_file:
        out = out.drop("__file")
    return _sorted(out, sort, ["inventory-server-id", "placement", "url_x", "url_y"])


def prep_proxmox(long: DataFrame, *, sort: bool = False, per_file: bool | None = None,
                 fields: str = "declared") -> DataFrame:
    """Coerce text values to numbers, pivot, derive disk GiB and usage columns."""
    src = SOURCES["proxmox"]
    # the pivot coerces a text value itself, once
    wide = pivot_mean(long, src.index, pivot_fields(long, src.fields, fields), per_file=per_file)
    wide = add_disk_columns(wide)
    return _sorted(wide, sort, src.index)


def add_disk_columns(wide: DataFrame) -> DataFrame:
    """disk_free_gb / disk_total_gb / disk_used_gb / disk_usage_percent.

    Each column is added only when its inputs exist (decided at plan time).
    """
    cols = set(wide.columns)
    new = {}
    if "disk_free" in cols:
        new["disk_free_gb"] = units.bytes_to_gib("disk_free")
    if "disk_total" in cols:
        new["disk_total_gb"] = units.bytes_to_gib("disk_total")
    if {"disk_free", "disk_total"} <= cols:
        new["disk_used_gb"] = units.used_gib("disk_total", "disk_free")
        new["disk_usage_percent"] = units.usage_percent_from_free("disk_free", "disk_total")
    return wide.withColumns(new) if new else wide


def _prep_scaphandre(long: DataFrame, name: str, sort: bool, per_file: bool | None,
                     present_only: bool, fields: str | None = None) -> DataFrame:
    src = SOURCES[name]
    if per_file is None:
        per_file = FILE_COL in long.columns
    mode = fields or ("present" if present_only else "declared")
    if mode == "present":
        # a metric that never occurs is no column at all (rather than an
        # all-missing column, which would make the row-wise drop remove every
        # row): pivot all declared metrics, look which columns have a value
        wide = pivot_mean(long, src.index, src.fields, per_file=per_file).checkpoint(eager=True)
        seen = wide.agg(*[F.count(F.col(f"`{f}`")).alias(f) for f in src.fields]).first()
        wide = wide.drop(*[f for f in src.fields if not seen[f]])
    else:
        wide = pivot_mean(long, src.index, pivot_fields(long, src.fields, mode), per_file=per_file)
    wide = _sorted(wide, sort, src.index)
    # rows with any missing cell go, then exact duplicates (e.g. from
    # overlapping exports) collapse to one.  Without per-file pivots every
    # row is unique by its index key already, so the distinct (a shuffle)
    # would be a no-op and is skipped.
    clean = wide.na.drop("any")
    return distinct_rows(clean) if per_file else clean


def prep_scaphandre_host(long: DataFrame, *, sort: bool = False, per_file: bool | None = None,
                         present_only: bool = True, fields: str | None = None) -> DataFrame:
    """Pivot host power; drop rows with a missing cell, then exact duplicates."""
    return _prep_scaphandre(long, "scaphandre_host", sort, per_file, present_only, fields)


def prep_scaphandre_vm(long: DataFrame, *, sort: bool = False, per_file: bool | None = None,
                       present_only: bool = True, fields: str | None = None) -> DataFrame:
    """Pivot VM process metrics; drop rows with a missing cell, then exact
    duplicates.  ``present_only`` (default) leaves out metrics that never
    occur, as a dynamic pivot would."""
    return _prep_scaphandre(long, "scaphandre_vm", sort, per_file, present_only, fields)


def prep_scaphandre(host_long: DataFrame, vm_long: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """Both scaphandre outputs (host, VM)."""
    return prep_scaphandre_host(host_long, **kw), prep_scaphandre_vm(vm_long, **kw)
