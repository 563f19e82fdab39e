"""Registered queries of the corpus operators, and their DuckDB SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspark.session import ship_package

from . import (
    collocations,
    exact_dedup,
    factorisation,
    language_model,
    license_scan,
    mixing,
    packing,
    quality,
    sharding,
    simhash,
    substring,
    url_filter,
    whitening,
)
from .common import materialize, read_table

#: The rules of query op2 (fixed values).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def pack_table(docs: DataFrame) -> DataFrame:
    """Pieces of ``documents`` with their place; the ids are returned as their CRC32."""
    pieces = packing.token_pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    pieces = materialize(pieces, "pack-pieces")
    return packing.pack(pieces, pieces.count()).drop("row")


def packed_ids(docs: DataFrame) -> DataFrame:
    """Pieces with their token ids (``ids``, little-endian uint32) and their place: packed on
    lengths alone, then the ids are joined back by row and piece."""
    pieces = materialize(packing.token_pieces(docs), "pack-pieces")
    placed = packing.pack(pieces.drop("ids"), pieces.count())
    places = materialize(placed.select("row", "piece", "sequence_id", "offset"), "pack-places")
    return (pieces.join(places, ["row", "piece"])
            .withColumn("ids_crc32", F.crc32("ids")).drop("row"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 1024 tokens (best two fit)."""
    return pack_table(read_table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge the URL of every page by the rules of the contract."""
    rules = spark.createDataFrame(URL_RULES, url_filter.RULE_SCHEMA)
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"),
                                 rules).select("page_id", "host", "path", "rule", "verdict")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: words taken of each, by apportioned blocks per source."""
    return mixing.mix_rows(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "shard", "block")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics and the verdict of the line field, trained on ``labels``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality.train_field(docs, read_table(spark, sf_dir, "labels"))
    return quality.label_quality(docs, field).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "content_share")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document (3-word shingles, 2 bits)."""
    return simhash.near_duplicate_groups(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and texts in every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan_licenses(docs).drop("text")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document left after repeated passages are removed."""
    return substring.remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, shards of near-equal bytes."""
    return sharding.shard_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the backoff automaton."""
    return language_model.score_texts(read_table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of two and three words of every language."""
    return collocations.mine_phrases(read_table(spark, sf_dir, "documents")).drop("cut")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leading 16 whitened components of every embedding (spectrum slicing)."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a factorisation machine."""
    docs = read_table(spark, sf_dir, "documents")
    machine = factorisation.train_machine(docs, read_table(spark, sf_dir, "labels"))
    return factorisation.score_quality(docs, machine)


_QUERIES = (
    op1_best_fit_packing, op2_url_filter, op3_source_mixing, op4_quality_rules,
    op5_simhash_near_dedup, op6_license_scan, op7_exact_dedup, op8_substring_dedup,
    op9_sharding, op10_language_model, op11_phrase_collocations, op12_embedding_whitening,
    op13_quality_classifier,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for fn in _QUERIES:
        def run(spark, sf_dir, _fn=fn):
            ship_package(spark)
            return _fn(spark, sf_dir)
        run.__doc__ = fn.__doc__
        out[fn.__name__] = run
    return out


_OP2 = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0
                       THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
cut AS (
  SELECT page_id, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw_host,
         coalesce(rest, '') AS rest FROM parts),
urls AS (
  SELECT page_id,
         translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM cut),
rules(rule_host, rule_path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
hits AS (
  SELECT u.page_id, u.host, u.path, r.rule_host || r.rule_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY u.page_id, u.host, u.path
                            ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS nth
  FROM urls u LEFT JOIN rules r
    ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host))
   AND starts_with(u.path, r.rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM hits WHERE nth = 1
"""

_OP7 = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents),
grouped AS (
  SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size FROM texts)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM grouped
"""

_OP8 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
starts AS (
  SELECT doc_id, unnest(range(1, len(ws) - 33)) AS s, ws FROM words WHERE len(ws) >= 35),
windows AS (
  SELECT doc_id, s, md5(array_to_string(ws[s:s + 34], ' ')) AS w FROM starts),
again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
hit AS (SELECT doc_id, s FROM windows WHERE w IN (SELECT w FROM again)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM hit),
every AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM words),
kept AS (
  SELECT e.doc_id, string_agg(e.w, ' ' ORDER BY e.p) AS t, count(*) AS n
  FROM every e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p GROUP BY e.doc_id)
SELECT x.doc_id, CAST(len(x.ws) AS BIGINT) AS n_words,
       CAST(len(x.ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM words x LEFT JOIN kept k ON x.doc_id = k.doc_id
"""


_OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
           coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
sizes AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM words GROUP BY lang),
one AS (SELECT lang, w, count(*) AS f FROM (SELECT lang, unnest(ws) AS w FROM words)
        GROUP BY lang, w),
two AS (
  SELECT lang, g.a AS a, g.b AS b, count(*) AS f
  FROM (SELECT lang, unnest([{'a': ws[i], 'b': ws[i + 1]} for i in range(1, len(ws))]) AS g
        FROM words WHERE len(ws) >= 2)
  GROUP BY ALL),
three AS (
  SELECT lang, g.a AS a, g.b AS b, g.c AS c, count(*) AS f
  FROM (SELECT lang, unnest([{'a': ws[i], 'b': ws[i + 1], 'c': ws[i + 2]}
                             for i in range(1, len(ws) - 1)]) AS g
        FROM words WHERE len(ws) >= 3)
  GROUP BY ALL HAVING count(*) >= 10),
covers AS (
  SELECT lang, a, b, max(f) AS f FROM (
    SELECT lang, a, b, f FROM three UNION ALL SELECT lang, b, c, f FROM three) GROUP BY ALL),
cuts AS (
  SELECT t.lang, t.a || ' ' || t.b AS phrase, t.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM two t JOIN one x ON x.lang = t.lang AND x.w = t.a
             JOIN one y ON y.lang = t.lang AND y.w = t.b
             LEFT JOIN covers c ON c.lang = t.lang AND c.a = t.a AND c.b = t.b
  WHERE t.f >= 10 AND (c.f IS NULL OR 100 * c.f < 50 * t.f)
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, t.f, x.f, y.f, 1
  FROM three t JOIN one x ON x.lang = t.lang AND x.w = t.a
               JOIN two y ON y.lang = t.lang AND y.a = t.b AND y.b = t.c
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, t.f, x.f, y.f, 2
  FROM three t JOIN two x ON x.lang = t.lang AND x.a = t.a AND x.b = t.b
               JOIN one y ON y.lang = t.lang AND y.w = t.c),
scored AS (
  SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score
  FROM cuts),
lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored),
ranks AS (
  SELECT lang, phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest WHERE nth = 1)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, s.n, k.score
FROM ranks k JOIN sizes s ON s.lang = k.lang WHERE k.rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the operators SQL can state; the others are tested against brute force."""
    return {"op2_url_filter": _OP2, "op7_exact_dedup": _OP7, "op8_substring_dedup": _OP8,
            "op11_phrase_collocations": _OP11}
