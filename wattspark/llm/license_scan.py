"""License texts found by diagonal voting of word k-grams.

All rolling word k-grams of every text are hashed and joined to the positions
of the same grams in the templates.  A hit at document position ``p`` of a
gram at template position ``t`` votes for the diagonal ``p - t``.  The votes
of the documents that have any are verified word by word against the text.
Votes are summed per (document, template, diagonal); neighbouring diagonals
are merged (a few inserted or missing words shift the diagonal); a merged span
counts by the share of the template's words that its votes cover.

Short phrases use two-word grams and must be covered whole on one diagonal;
long templates use five-word grams and must be covered to ``min_coverage``.

Only DataFrame functions are used.

Cases: a null text counts as empty; texts without a hit have no labels, null
places and score 0; repeated rows get equal results; a text found several
times is one label; an empty table gives an empty result; extra columns are
kept, a result column replaces an input column of its name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, checked_broadcast, materialize, own_names

#: A word is a run of these: digits, letters a-z, and all non-ASCII characters.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same separators for a text whose A-Z are not yet lower-cased.
NOT_WORD_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MIN_COVERAGE = 0.6
#: Diagonals at most this far apart are merged.
SLACK = 4


@dataclass(frozen=True)
class Template:
    """A text to find.  ``exact`` phrases must occur whole; each place counts."""

    label: str
    text: str
    exact: bool = False
    base: bool = False

    @property
    def k(self) -> int:
        return 2 if self.exact or len(self.text.split()) < 8 else 5


#: The phrases that make the base labels.
BASE_PHRASES = (
    Template("mit", "mit license", True, True),
    Template("apache", "apache license", True, True),
    Template("gpl", "general public license", True, True),
)
#: Templates of the method's own labels (lower case, words joined by one space).
OWN_TEMPLATES = (
    Template("cc-by-nc", "licensed under cc by nc", True),
    Template("bsd", "bsd license", True),
    Template("mpl", "mozilla public license", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
             "this software and associated documentation files the software to deal in the software "
             "without restriction"),
    Template("apache", "you may not use this file except in compliance with the license you may "
             "obtain a copy of the license at"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under "
             "the terms of the gnu general public license as published by the free software "
             "foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification "
             "are permitted provided that the following conditions are met"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose "
             "with or without fee is hereby granted"),
)
TEMPLATES = BASE_PHRASES + OWN_TEMPLATES


def license_words(text: Column) -> Column:
    """Words of a text for this scan, A-Z lower-cased (null: empty array)."""
    lower = ascii_lower(F.coalesce(text, F.lit("")))
    return F.filter(F.split(lower, NOT_WORD), lambda w: w != "")


def _gram_hash(words: Column, at: Column | int, k: int) -> Column:
    return F.xxhash64(*[F.get(words, at + j) for j in range(k)])


def rolling_hashes(words: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` words, in order."""
    last = F.size(words) - k
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: _gram_hash(words, i, k))
    return F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


def template_positions(spark, templates: Sequence[Template]) -> DataFrame:
    """One row per gram and place in a template (bounded by the template words)."""
    rows = []
    for no, t in enumerate(templates):
        words = t.text.split()
        for at in range(len(words) - t.k + 1):
            rows.append((no, t.k, at, words[at:at + t.k]))
    grams = spark.createDataFrame(rows, "template int, k int, at int, gram array<string>")
    hashed = F.coalesce(*[F.when(F.col("k") == k, _gram_hash(F.col("gram"), 0, k))
                          for k in sorted({t.k for t in templates})])
    return grams.withColumn("gram_hash", hashed)


def _verified_votes(docs: DataFrame, places: DataFrame, ks: list[int], id_col: str,
                    text_col: str) -> DataFrame:
    """Distinct (``id_hash``, ``text_hash``, ``template``, ``pos``, ``at``) whose words agree."""
    text = F.col(f"`{text_col}`")
    key = ["id_hash", "text_hash"]
    raw = docs.select(F.xxhash64(F.col(f"`{id_col}`")).alias("id_hash"),
                      F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
                      text.alias("text"))
    words = raw.select(*key, license_words(F.col("text")).alias("words"))
    # one array holds the grams of all lengths, one after the other
    arrays = words.select(*key, F.size("words").alias("n"), *[
        rolling_hashes(F.col("words"), k).alias(f"h{k}") for k in ks])
    grams = arrays.select(*key, "n", F.posexplode(F.concat(*[f"h{k}" for k in ks]))
                          .alias("slot", "gram_hash"))
    hits = grams.join(F.broadcast(places), "gram_hash")
    count = {k: F.greatest(F.col("n") - (k - 1), F.lit(0)) for k in ks}
    before = F.lit(0)
    pos = F.lit(None).cast("int")
    for k in ks:
        inside = (F.col("slot") >= before) & (F.col("slot") < before + count[k])
        pos = F.when((F.col("k") == k) & inside, F.col("slot") - before).otherwise(pos)
        before = before + count[k]
    hits = hits.withColumn("pos", pos).filter("pos is not null")
    # a row per document with hits: repeated rows vote once
    hits = (hits.groupBy(*key, "template", "pos", "at").agg(F.first("gram").alias("gram"))
            .groupBy(*key).agg(F.collect_list(F.struct("template", "pos", "at", "gram"))
                               .alias("votes")))
    hits = materialize(hits, "license-hits")
    few = checked_broadcast(hits.select(*key), hits.count(), 64)
    same = F.filter("votes", lambda v: F.slice(
        F.col("words"), v["pos"] + 1, F.size(v["gram"])) == v["gram"])
    checked = (raw.join(few, key, "left_semi").dropDuplicates(key).join(hits, key)
               .select(*key, license_words(F.col("text")).alias("words"), "votes")
               .select(*key, F.explode(same).alias("v")))
    return checked.select(*key, "v.template", "v.pos", "v.at")


def find_spans(docs: DataFrame, templates: Sequence[Template] = TEMPLATES,
               id_col: str = "doc_id", text_col: str = "text",
               min_coverage: float = MIN_COVERAGE, slack: int = SLACK) -> DataFrame:
    """Verified spans: ``id_hash``, ``text_hash``, ``template``, ``first_word`` and
    ``last_word`` of the span, ``coverage`` of the template."""
    spark = docs.sparkSession
    info = F.broadcast(spark.createDataFrame(
        [(no, t.k, len(t.text.split()), t.exact) for no, t in enumerate(templates)],
        "template int, k int, length int, exact boolean"))
    votes = _verified_votes(docs, template_positions(spark, templates),
                            sorted({t.k for t in templates}), id_col, text_col)
    key = ["id_hash", "text_hash", "template"]
    votes = votes.join(info, "template").withColumn("diagonal", F.expr("pos - at"))
    diagonals = votes.groupBy(*key, "k", "length", "exact", "diagonal").agg(
        F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_list("at").alias("ats"))
    # neighbouring diagonals are one cluster; each place of a phrase is its own
    order = Window.partitionBy(*key).orderBy("diagonal", "lo")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > slack, F.lit(True))
    merged = (diagonals.withColumn("cluster", F.sum(
        (F.col("exact") | apart).cast("int")).over(order))
        .groupBy(*key, "k", "length", "exact", "cluster")
        .agg(F.flatten(F.collect_list("ats")).alias("ats"), F.min("lo").alias("first_word"),
             F.max("hi").alias("last_word")))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "ats", lambda a: F.sequence(a, a + F.col("k") - 1)))))
    merged = merged.withColumn("coverage", covered / F.col("length"))
    return merged.filter(F.when(F.col("exact"), F.col("coverage") == 1.0)
                         .otherwise(F.col("coverage") >= min_coverage)).select(
        *key, "first_word", (F.col("last_word") + F.col("k") - 1).alias("last_word"),
        "coverage")


@own_names
def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES,
                  id_col: str = "doc_id", text_col: str = "text",
                  min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """The input rows with ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels`` and ``score`` (best coverage of a verified template)."""
    added = {"n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"}
    keep = [c for c in docs.columns if c.lower() not in added]
    spark = docs.sparkSession
    spans = find_spans(docs, templates, id_col, text_col, min_coverage)
    info = F.broadcast(spark.createDataFrame(
        [(no, t.label, t.base) for no, t in enumerate(templates)],
        "template int, label string, base boolean"))
    base = lambda c: F.when(F.col("base"), F.col(c))
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    found = (spans.join(info, "template").groupBy("id_hash", "text_hash").agg(
        F.count(base("template")).alias("n_base"),
        F.min(base("first_word")).cast("long").alias("first_word"),
        F.max(base("first_word")).cast("long").alias("last_word"),
        joined(base("label")).alias("base_labels"), joined("label").alias("labels"),
        F.max("coverage").alias("score")))
    found = materialize(found.withColumnsRenamed({"id_hash": "__k", "text_hash": "__h"})
                        .withColumnsRenamed({c: f"__{c}" for c in added}), "license-found")
    text = F.col(f"`{text_col}`")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep],
                       F.xxhash64(F.col(f"`{id_col}`")).alias("__k"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("__h"),
                       F.size(F.filter(F.split(F.coalesce(text, F.lit("")), NOT_WORD_ANY_CASE),
                                       lambda w: w != "")).cast("long").alias("n_words"))
    out = rows.join(checked_broadcast(found, found.count(), 200), ["__k", "__h"], "left")
    return out.select(
        *[F.col(f"`{c}`") for c in keep], "n_words",
        F.coalesce("__n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("__first_word").alias("first_word"), F.col("__last_word").alias("last_word"),
        F.coalesce("__base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("__labels", F.lit("")).alias("labels"),
        F.coalesce("__score", F.lit(0.0)).alias("score"))
