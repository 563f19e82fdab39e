"""URL rules by host suffix and path prefix, looked up by short hash prefixes.

Each URL is expanded into expressions: every suffix of its host's labels with
every prefix of its path that ends in a slash (and the empty one).  Each rule
is filed under its host and its path up to the last slash.  Expressions and
rules are equi-joined on the first ``PREFIX_HEX`` hex digits of the SHA-256 of
``host + '\\n' + path prefix``; a hit counts if the full digests agree and the
URL's path starts with the rule's.  Of the rules that fit, the longest wins
(host and path together; then the longer host; then block before allow).

Only DataFrame functions are used.  An expression is made only where a rule of
as many labels and slashes exists, which drops none that could hit.

Cases: a null URL or one without ``://`` has empty host and path and fits no
rule; a rule with a null host, path or verdict is ignored; repeated rules count
once; repeated pages are judged one by one; an empty rule table gives every
page the default verdict; extra input columns are kept, a result column
replaces an input column of its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, ascii_lower, hot_cold_join, materialize, own_names

#: Hex digits of the digest by which rules are looked up (32 bits).
PREFIX_HEX = 8
RULE_SCHEMA = "host string, path string, verdict string"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL (both empty if null or without ``://``)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)),
                            r"(?s)^[^?#]*", 0)
    return ascii_lower(host), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def compile_rules(rules: DataFrame) -> DataFrame:
    """Rules with their lookup digest, one row per distinct rule."""
    r = rules.select("host", "path", "verdict").na.drop().distinct()
    folder = F.regexp_extract("path", r"(?s)^(.*/)?", 0)
    return r.select(
        _digest(F.col("host"), folder).alias("rule_digest"),
        F.col("path").alias("rule_path"), F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"), F.col("verdict").alias("rule_verdict"),
        F.size(F.split("host", r"\.")).alias("labels"),
        (F.length(folder) - F.length(F.replace(folder, F.lit("/"), F.lit("")))).alias("slashes"))


def expressions(host: Column, path: Column, labels: int, slashes: int) -> Column:
    """Array of (digest, path) over host suffixes of up to ``labels`` labels and path
    prefixes of up to ``slashes`` slashes."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(max(labels, 1)))),
        lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))
    folders = F.split(path, "/")
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(folders) - 1, F.lit(slashes))),
        lambda k: F.when(k == 0, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(folders, 1, k), "/"), F.lit("/"))))
    return F.flatten(F.transform(suffixes, lambda h: F.transform(
        prefixes, lambda p: _digest(h, p))))


@own_names
def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """The input rows with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``."""
    added = {"host", "path", "rule", "verdict"}
    keep = [c for c in pages.columns if c.lower() not in added]
    compiled = materialize(compile_rules(rules), "url-rules")
    head = compiled.agg(F.count(F.lit(1)).alias("n"), F.max("labels").alias("labels"),
                        F.max("slashes").alias("slashes"),
                        F.sum(F.octet_length("rule") * 2 + 96).alias("bytes")).first()
    compiled = compiled.drop("labels", "slashes").withColumn(
        "prefix", F.substring("rule_digest", 1, PREFIX_HEX))
    host, path = url_parts(F.col(f"`{url_col}`"))
    urls = pages.select(F.col(f"`{url_col}`").alias("__url"), host.alias("__host"),
                        path.alias("__path"))
    # rules depend on host and path alone: copies of a URL are judged once
    urls = materialize(urls.groupBy("__host", "__path").agg(F.count(F.lit(1)).alias("__uses")),
                       "url-distinct")
    exprs = urls.select("__host", "__path", F.explode(expressions(
        F.col("__host"), F.col("__path"), head["labels"] or 1, head["slashes"] or 0))
        .alias("digest")).withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    confirmed = (F.col("digest") == F.col("rule_digest")) & F.startswith(
        F.col("__path"), F.col("rule_path"))
    if (head["bytes"] or 0) * 4 <= BROADCAST_BYTES:
        hits = exprs.join(F.broadcast(compiled), "prefix").filter(confirmed)
    else:
        # a prefix shared by a large part of the URLs is split off by its count
        exprs = materialize(exprs, "url-expressions")
        counts = exprs.groupBy("prefix").agg(F.count(F.lit(1)).alias("uses"))
        by_prefix = (compiled.groupBy("prefix")
                     .agg(F.collect_list(F.struct("rule_digest", "rule_path", "rule",
                                                  "host_length", "rule_verdict")).alias("rules"))
                     .join(counts, "prefix"))
        total = exprs.count()
        hits = (hot_cold_join(exprs, by_prefix, ["prefix"], "uses", total)
                .select("__host", "__path", "digest", F.inline("rules")).filter(confirmed))
    rank = F.struct(F.length("rule"), F.col("host_length"),
                    (F.col("rule_verdict") == "block").cast("int"), F.col("rule"))
    best = (hits.groupBy("__host", "__path")
            .agg(F.max_by(F.struct("rule", "rule_verdict"), rank).alias("__best")))
    keys = ["__host", "__path"]
    judged = materialize(urls.join(best, keys, "left"), "url-judged")
    total = judged.agg(F.coalesce(F.sum("__uses"), F.lit(0)).alias("n")).first()["n"]
    rows = pages.withColumns({"__host": host, "__path": path})
    out = hot_cold_join(rows, judged, keys, "__uses", total)
    return out.select(
        *[F.col(f"`{c}`") for c in keep], F.col("__host").alias("host"),
        F.col("__path").alias("path"), F.col("__best.rule").alias("rule"),
        F.coalesce("__best.rule_verdict", F.lit(default)).alias("verdict"))
