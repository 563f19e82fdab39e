"""Exact, near and substring duplicates against brute force."""

import random
from collections import Counter, defaultdict

import brute
import pytest
from corpus_fixtures import (  # noqa: F401  fixtures are used by name
    DOCS,
    as_multiset,
    docs,
    empty_docs,
    rows,
    wide_docs,
)
from pyspark.sql import functions as F

from wattspark.llm import exact_dedup, simhash, substring


def test_exact_groups_match_brute_force(docs, rows, wide_docs):
    out = exact_dedup.exact_groups(docs, capacity=4).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[brute.normal(r.text)].append(r.doc_id)
    by_sha = {brute.sha(t): ids for t, ids in groups.items()}
    assert len(out) == len(rows)
    kept = Counter()
    for r in out:
        ids = by_sha[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert (r.keep_id, r.group_size) == (min(known) if known else None, len(ids))
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert as_multiset(exact_dedup.exact_groups(wide_docs), *cols) == sorted(
        repr(r) for r in exact_dedup.exact_groups(docs).select(*cols).collect())


def test_directory_splits_only_overfull_buckets(spark):
    keys = spark.range(4000).select(F.xxhash64("id").alias("h"))
    held = keys.union(spark.range(3000).select(F.col("id").alias("h")))  # crowd one prefix
    directory = exact_dedup.bucket_directory(held, 7000, 64)
    bits = directory.first()["global_depth"]
    sizes = (held.withColumn("slot", F.shiftrightunsigned("h", 64 - bits))
             .join(directory, "slot").groupBy("bucket", "local_depth").count().collect())
    assert sum(r["count"] for r in sizes) == 7000
    assert all(r["count"] <= 64 or r.local_depth == bits for r in sizes)
    assert len({r.local_depth for r in sizes}) > 1
    assert len({r.bucket for r in sizes}) == len(sizes)


def test_chains_are_those_of_a_bucket(spark, monkeypatch):
    real_hash, real_index = F.xxhash64, exact_dedup.build_index
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: real_hash(*c) % 2)
    docs = spark.createDataFrame([(i, f"text {i % 7}", "en", "s", 1) for i in range(40)], DOCS)
    right = sorted((r.doc_id, r.text_sha256, r.chain) for r in exact_dedup.exact_groups(docs).collect())
    assert len(right) == 40

    def wrong(entries, capacity):      # every text in a bucket of its own
        return real_index(entries, capacity).withColumn("bucket", F.col("h") * 1000 + F.conv(
            F.substring("sha", 1, 6), 16, 10).cast("long"))

    monkeypatch.setattr(exact_dedup, "build_index", wrong)
    out = exact_dedup.exact_groups(docs).collect()
    assert sorted((r.doc_id, r.text_sha256, r.chain) for r in out) != right


def test_texts_that_share_a_key_are_chained(spark, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: real(*c) % 2)
    data = [(i, f"text {i % 7}", "en", "s", 1) for i in range(40)]
    out = exact_dedup.exact_groups(spark.createDataFrame(data, DOCS)).collect()
    assert sorted({r.keep_id for r in out}) == list(range(7)) and len(out) == 40
    assert max(r.chain for r in out) >= 1


def test_exact_drop_keeps_one_row_per_text(docs, rows, wide_docs):
    out = exact_dedup.drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    texts = [brute.normal(r.text) for r in out.collect()]
    assert sorted(texts) == sorted({brute.normal(r.text) for r in rows})
    assert exact_dedup.drop_exact_duplicates(wide_docs).columns == wide_docs.columns


def test_near_groups_match_brute_force(docs, rows):
    out = simhash.near_duplicate_groups(docs)
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in out.collect())
    order = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id))
    prints = [brute.simhash(r.text) for r in order]
    roots = brute.near_groups(prints, 2)
    assert got == Counter((r.doc_id, f"{p:016x}", order[k].doc_id)
                          for r, p, k in zip(order, prints, roots, strict=True))
    kept = simhash.drop_near_duplicates(docs).collect()
    assert len(kept) == len(set(roots))
    assert {r.doc_id for r in kept} == {order[k].doc_id for k in roots}


@pytest.mark.parametrize("distance", [0, 2, 4])
def test_ball_links_connect_what_all_pairs_connect(spark, distance):
    rng = random.Random(distance)
    points = [rng.getrandbits(64) for _ in range(60)]
    for p in list(points):
        for _ in range(3):
            p ^= 1 << rng.randrange(64)
            p ^= 1 << rng.randrange(64)
            points.append(p)
    points = sorted({p - (1 << 64) if p >> 63 else p for p in points})
    table = spark.createDataFrame([(p,) for p in points], "fp long")
    tree = {r.node: r.root for r in simhash.components(simhash.ball_links(table, distance)).collect()}
    roots = brute.near_groups([p & (1 << 64) - 1 for p in points], distance)
    assert [tree.get(p, p) for p in points] == [points[k] for k in roots]


def test_components_of_a_long_chain(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    out = simhash.components(links).collect()
    assert len(out) == 201 and {r.root for r in out} == {0}


@pytest.mark.parametrize("length,k", [(35, 8), (12, 3), (5, 5)])
def test_repeats_match_brute_force(docs, rows, length, k):
    out = substring.remove_repeats(docs, length, k).collect()
    want = brute.without_repeats([r.text for r in rows], length)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out) == Counter(
        (r.doc_id, *w) for r, w in zip(rows, want, strict=True))


def test_overlapping_and_partial_repeats(spark):
    rng = random.Random(3)
    words = [f"v{rng.randrange(40)}" for _ in range(900)]
    texts = [" ".join(words[a:b]) for a, b in
             [(0, 300), (100, 420), (90, 130), (299, 700), (650, 900), (120, 155), (0, 34)]]
    texts += ["a " * 200, "b c " * 60, " ".join(words[200:260] + ["q"] + words[261:330])]
    data = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    out = substring.remove_repeats(spark.createDataFrame(data, DOCS)).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept_text) for r in out] == brute.without_repeats(texts, 35)


def test_empty_tables(empty_docs):
    assert exact_dedup.exact_groups(empty_docs).count() == 0
    assert exact_dedup.drop_exact_duplicates(empty_docs).count() == 0
    assert simhash.near_duplicate_groups(empty_docs).count() == 0
    assert substring.remove_repeats(empty_docs).count() == 0


def test_clashing_names(wide_docs, docs):
    a = as_multiset(simhash.near_duplicate_groups(wide_docs), "doc_id", "fingerprint", "component_id")
    assert a == as_multiset(simhash.near_duplicate_groups(docs), "doc_id", "fingerprint",
                            "component_id")
    assert as_multiset(substring.remove_repeats(wide_docs), "doc_id", "n_removed") == as_multiset(
        substring.remove_repeats(docs), "doc_id", "n_removed")
