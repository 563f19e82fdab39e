"""Raw export files: per-source CSV scans, routed scans, concatenated exports.

Columns are taken by the names in each file's header, wherever they stand.
One pass over the text finds the headers (repeated ones included); files with
one header are scanned together with an explicit schema, files that hold
several different headers are parsed line by line under the header above.
Where all files are known to share one header, ``one_header`` reads the text
once and fails on a line that contradicts it.
The file name is kept in ``_file`` so the per-file semantics of the processing
step can be reproduced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspark.functions.missing import clean_tag, clean_value
from wattspark.schemas import SOURCES, Source, raw_schema

FILE_COL = "_file"


def _globs(directory: str, prefix: str) -> list[str]:
    d = directory.rstrip("/")
    return [f"{d}/{prefix}*.csv", f"{d}/export={prefix}*/part-*"]


def export_globs(directory: str, source: str) -> list[str]:
    """Where the exports of a source lie in a folder."""
    return _globs(directory, SOURCES[source].prefix)


def existing(spark: SparkSession, globs: list[str]) -> list[str]:
    """Globs that match at least one file (checked through Hadoop FS)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for g in globs:
        p = jvm.org.apache.hadoop.fs.Path(g)
        st = p.getFileSystem(conf).globStatus(p)
        if st is not None and len(st) > 0:
            out.append(g)
    return out


#: Path of the file a row came from, when asked for.
PATH_COL = "_path"


def _typed_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(FILE_COL, T.StringType(), True),
                         T.StructField(PATH_COL, T.StringType(), True)])


def _typed_columns(schema: T.StructType, have: set[str], of: Callable[[str], Column]) -> list[Column]:
    cols = []
    for f in schema.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = clean_tag(of(f.name))
        if isinstance(f.dataType, T.TimestampType):
            c = F.try_to_timestamp(c)
        elif isinstance(f.dataType, T.DoubleType):
            c = clean_value(c.try_cast("double"))
        elif not isinstance(f.dataType, T.StringType):
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return cols


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns by name, cast from text; an absent column and
    unparseable text are missing, an undeclared column is left out."""
    cols = _typed_columns(schema, set(df.columns), lambda name: F.col(f"`{name}`"))
    return df.select(*cols, F.col(FILE_COL), F.col(PATH_COL))


#: Columns every export has; a line that names them is a header.
_HEADER_NAMES = ("_time", "_field", "_value")


def _is_header(line: Column) -> Column:
    cells = F.split(line, ",")
    out = line.contains(_HEADER_NAMES[0])  # cheap test first: most lines are data
    for name in _HEADER_NAMES:
        out = out & F.array_contains(cells, name)
    return out


def _export_name() -> Column:
    """The export a row came from: the export directory, else the file name."""
    in_dir = F.regexp_extract(F.col("_metadata.file_path"), r"/export=([^/]+)/[^/]+$", 1)
    return F.when(in_dir != "", in_dir).otherwise(F.col("_metadata.file_name"))


def _header_schema(header: str) -> T.StructType:
    """All columns of a header as text; unnamed and repeated names get a place number."""
    names: list[str] = []
    for k, name in enumerate(x.strip().strip('"') for x in header.split(",")):
        names.append(name if name and name not in names else f"_c{k}")
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def distinct_headers(line: Column) -> Column:
    """Aggregate: the distinct headers among the lines."""
    return F.collect_set(F.when(_is_header(line), line))


def _cells(rows: DataFrame, header: str, schema: T.StructType) -> DataFrame:
    """Lines (``value``) parsed under a header."""
    cells = F.from_csv(F.col("value"), _header_schema(header).toDDL())
    return _typed(rows.select(cells.alias("c"), FILE_COL, PATH_COL)
                  .select("c.*", FILE_COL, PATH_COL), schema)


def _cells_by_header(rows: DataFrame, headers: list[str], schema: T.StructType) -> DataFrame:
    """Lines (``value``) parsed in one pass, each under its own ``header``, one of ``headers``."""
    own = [F.when(F.col("header") == h, F.from_csv(F.col("value"), _header_schema(h).toDDL()))
           .alias(f"__c{k}") for k, h in enumerate(headers)]
    cells = rows.select(*own, "header", FILE_COL, PATH_COL)
    typed = [_typed_columns(schema, set(_header_schema(h).names),
                            lambda name, k=k: F.col(f"__c{k}").getField(name))
             for k, h in enumerate(headers)]
    cols = []
    for place, f in enumerate(schema.fields):
        c = F.lit(None).cast(f.dataType)
        for k, h in enumerate(headers):
            c = F.when(F.col("header") == h, typed[k][place]).otherwise(c)
        cols.append(c.alias(f.name))
    return cells.select(*cols, FILE_COL, PATH_COL)


def _under_one_header(spark: SparkSession, paths: list[str], schema: T.StructType) -> list[DataFrame]:
    value = F.col("value")
    first = spark.read.text(paths).where(_is_header(value)).first()
    if first is None:
        return []
    header = first["value"]
    lines = spark.read.text(paths).select("value", _export_name().alias(FILE_COL),
                                          F.col("_metadata.file_path").alias(PATH_COL))
    other = F.raise_error(F.concat(F.lit("another header than the first file's in "), F.col(PATH_COL),
                                   F.lit("; read the exports without one_header")))
    data = (F.when(value == header, F.lit(False)).when(_is_header(value), other.cast("boolean"))
            .otherwise(F.trim(value) != ""))
    return [_cells(lines.where(data), header, schema)]


def _by_header(spark: SparkSession, paths: list[str], schema: T.StructType,
               headers: dict[str, list[str]] | None = None) -> list[DataFrame]:
    if headers is None:
        lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
        found = (lines.where(_is_header(F.col("value"))).groupBy("path")
                 .agg(distinct_headers(F.col("value")).alias("headers")))
        headers = {r["path"]: r["headers"] for r in found.collect()}      # a row per file
    files: dict[str, list[str]] = {}
    mixed: dict[str, list[str]] = {}
    for path, own in headers.items():
        if len(own) == 1:
            files.setdefault(own[0], []).append(path)
        elif own:
            mixed[path] = own
    parts = []
    for header, own in sorted(files.items()):
        raw = (spark.read.schema(_header_schema(header)).option("header", False)
               .option("mode", "PERMISSIVE").csv(sorted(own)))
        raw = raw.withColumns({FILE_COL: _export_name(), PATH_COL: F.col("_metadata.file_path")})
        parts.append(_typed(raw.where(F.col("_field").isNull() | (F.col("_field") != "_field")),
                            schema))
    if mixed:
        text = lines_under_headers(spark, sorted(mixed))
        data = text.where((F.col("value") != F.col("header")) & (F.trim("value") != ""))
        parts.append(_cells_by_header(data, sorted({h for own in mixed.values() for h in own}), schema))
    return parts


def _carry_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``own`` (a header or null) filled forward inside each split, in the order of the scan."""
    at, last = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        own, path, split = (batch.column(c) for c in ("own", PATH_COL, "split"))
        code, start = path.dictionary_encode().indices.to_numpy(), split.to_numpy()
        ends = np.flatnonzero((code[1:] != code[:-1]) | (start[1:] != start[:-1])) + 1
        filled = []
        for first, end in zip([0, *ends], [*ends, len(code)], strict=True):
            here = (path[int(first)].as_py(), int(start[first]))
            if here != at:
                at, last = here, None
            part = pc.fill_null_forward(own.slice(first, end - first))
            if last is not None:
                part = pc.fill_null(part, last)
            filled.append(part)
            last = part[-1].as_py()
        columns = [pa.concat_arrays(filled) if name == "own" else batch.column(name)
                   for name in batch.schema.names]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def lines_under_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``value`` (a line), ``header`` (the last header above it), ``_file`` and ``_path``.

    A segmented scan over the splits in which the files are read: each split's last
    header is found and carried on to the following splits of its file (a table of one
    row per split).  Lines are not exchanged or sorted: within a split they stream by in
    their order, and the last header above a line wins over the one carried in.
    """
    text = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias(PATH_COL), _export_name().alias(FILE_COL),
        F.col("_metadata.file_block_start").alias("split"))
    text = text.withColumn("own", F.when(_is_header(F.col("value")), F.col("value")))
    keys = [PATH_COL, "split"]
    heads = text.withColumn("nth", F.monotonically_increasing_id()).where("own is not null")
    below = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("nth")))
    last = heads.withColumn("below", below).where("below = 1").select(*keys, F.col("own").alias("last"))
    splits = text.select(*keys).distinct().join(last, keys, "left")
    # per file: its splits in order, each with the last header of those before it
    ordered = F.array_sort(F.collect_list(F.struct("split", "last")))
    start = F.struct(F.lit(None).cast("string").alias("header"),
                     F.array().cast("array<struct<split:bigint,carried:string>>").alias("done"))
    scan = F.aggregate(ordered, start, lambda acc, x: F.struct(
        F.coalesce(x["last"], acc["header"]).alias("header"),
        F.concat(acc["done"], F.array(F.struct(x["split"].alias("split"),
                                               acc["header"].alias("carried")))).alias("done")))
    carried = (splits.groupBy(PATH_COL).agg(scan["done"].alias("s"))
               .select(PATH_COL, F.explode("s").alias("s")).select(PATH_COL, "s.split", "s.carried"))
    rows = text.mapInArrow(_carry_headers, text.schema)
    return rows.join(F.broadcast(carried), keys).select(     # one row per split of the text
        "value", F.coalesce("own", "carried").alias("header"), FILE_COL, PATH_COL)


def read_exports(spark: SparkSession, directory: str, source: str | Source, *,
                 prefix: str | None = None, paths: list[str] | None = None,
                 with_path: bool = False, one_header: bool = False,
                 headers: dict[str, list[str]] | None = None) -> DataFrame:
    """Scan all ``<prefix>*.csv`` exports of a source in ``directory``.

    Returns the long telemetry with declared types, missing-value tokens in
    text mapped to null, NaN values mapped to null, and ``_file`` (the file
    name).  Columns are matched by header name in any order: undeclared
    columns (an empty first one too) are left out, absent ones are missing.
    Headers repeated inside a file (concatenated exports), also with other
    columns than the first, and blank lines are dropped.  A file without a
    header has no columns and no rows.  ``paths`` scans an explicit list of
    files instead of the prefix glob; ``with_path`` adds each row's file path
    as ``_path``.

    The headers are found by a pass over the text of its own.  Two ways without
    it: ``one_header`` says that every file starts with the same header (the
    first one met is taken; it may be repeated, and any other header line makes
    the scan fail); ``headers`` names the distinct headers of each file path.
    """
    if one_header and headers is not None:
        raise ValueError("one_header and headers exclude each other")
    src = SOURCES[source] if isinstance(source, str) else source
    schema = raw_schema(src)
    if paths is None:
        paths = existing(spark, _globs(directory, prefix or src.prefix))
    parts = []
    if paths:
        parts = (_under_one_header(spark, paths, schema) if one_header
                 else _by_header(spark, paths, schema, headers))
    out = parts[0] if parts else spark.createDataFrame([], _typed_schema(schema))
    for p in parts[1:]:
        out = out.unionByName(p)
    return out if with_path else out.drop(PATH_COL)


def read_routed(spark: SparkSession, directory: str, *,
                host_prefix: str = SOURCES["scaphandre_host"].prefix,
                vm_prefix: str = SOURCES["scaphandre_vm"].prefix,
                one_header: bool = False) -> tuple[DataFrame, DataFrame]:
    """Two-way routing by file-name prefix: (host exports, VM exports)."""
    return (read_exports(spark, directory, "scaphandre_host", prefix=host_prefix, one_header=one_header),
            read_exports(spark, directory, "scaphandre_vm", prefix=vm_prefix, one_header=one_header))


def read_multi_table_csv(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Read concatenated multi-table exports (repeated headers, blank lines,
    an empty first column), as produced by appending query results."""
    return read_exports(spark, path, source, paths=[path])


def new_run_id() -> str:
    """Name of one export run: its UTC time and a random suffix."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"


def _text(c: str, dtype: T.DataType):
    e = F.col(f"`{c}`")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        e = F.date_format(e, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return e.cast("string")


def write_exports(df: DataFrame, directory: str, source: str | Source, *,
                  name_col: str | None = None, leading_blank: bool = False,
                  header_per: str | None = None, run_id: str | None = None,
                  max_records_per_file: int = 1_000_000, rows_per_part: int = 1_000_000,
                  compression: str = "gzip") -> None:
    """Write long telemetry as exports ``<dir>/export=<prefix>_<name>_<run>/part-*``.

    One export (query result) per name and run is a directory of part files,
    so a second run never adds to an export of the first; ``run_id`` is
    :func:`new_run_id` unless given.  The exports are staged and put in place
    when all are written, replacing those of the same name and run, so a
    repeated or retried run leaves the same rows.  Each
    task writes its own part files (no repartition, so a hot export name is
    not funnelled into one task) with the raw export column order and a
    header line at the top of every file.  The files are compressed (long telemetry
    repeats its tags on every line); one is read by one task, which
    ``max_records_per_file`` bounds.  With ``leading_blank`` every line
    starts with an empty column, as appended exports do.  An empty input
    writes nothing.

    ``header_per`` writes the concatenated layout instead, as plain text that is read
    split by split: the header is
    repeated once per distinct value of that column (one per appended query
    result) inside the export's files, above that result's rows and after a
    blank line.  Results are spread over files by a hash of the column, those of
    more than ``rows_per_part`` rows in several parts with a header each.
    """
    src = SOURCES[source] if isinstance(source, str) else source
    names = [f.name for f in raw_schema(src).fields]
    name = F.col(name_col).cast("string") if name_col else F.lit("export")
    export = F.concat(F.lit(src.prefix + "_"), name, F.lit(f"_{run_id or new_run_id()}")).alias("export")
    fields = [(_text(n, df.schema[n].dataType) if n in df.columns
               else F.lit(None).cast("string")).alias(n) for n in names]
    if header_per is None:
        lead = [F.lit(None).cast("string").alias("_c0")] if leading_blank else []
        out = df.select(export, *lead, *fields)
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("export")
         .option("header", True).option("maxRecordsPerFile", max_records_per_file)
         .option("compression", compression)
         .csv(directory))
        return
    lead = [F.lit("").alias("_c0")] if leading_blank else []
    # to_csv quotes values holding separators or quotes
    line = F.to_csv(F.struct(*lead, *fields))
    table = F.col(f"`{header_per}`").alias("__table")
    body = df.select(export, table, F.xxhash64(*df.columns).alias("__row"), line.alias("value"))
    large = (body.groupBy("export", "__table").count().filter(F.col("count") > rows_per_part)
             .select("export", "__table", F.ceil(F.col("count") / rows_per_part).alias("__parts")))
    salt = F.pmod(F.col("__row"), F.coalesce("__parts", F.lit(1).cast("long")))
    body = (body.join(large, ["export", "__table"], "left").withColumn("__salt", salt)
            .select("export", "__table", "__salt", F.lit(1).alias("__part"), "value"))
    header = ("," if leading_blank else "") + ",".join(names)
    top = F.explode(F.array(F.lit(""), F.lit(header)))
    keys = ["export", "__table", "__salt"]
    tables = body.select(*keys).distinct().select(*keys, F.lit(0).alias("__part"), top.alias("value"))
    # in a file: each result's blank line and header (part 0), then its rows
    order = [*keys, "__part", F.length(F.trim("value")) > 0]
    (body.unionByName(tables).repartition(*keys).sortWithinPartitions(*order)
     .select("export", "value").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("export").text(directory))
