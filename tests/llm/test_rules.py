"""URL rules, license scan and quality rules against brute force."""

import re
from collections import Counter

import brute
import numpy as np
import pytest
from corpus_fixtures import (  # noqa: F401  fixtures are used by name
    DOCS,
    as_multiset,
    docs,
    empty_docs,
    rows,
    wide_docs,
)
from itertools import product

from wattspark.llm import license_scan, quality, url_filter

URLS = ["http://a.com/x", "https://Sub.EXAMPLE.com/en/1?q=/fr/", "http://www.example.com/en/2#top",
        "https://b.net/es/", "b.net/es/", "https://b.net/fr/7", "https://b.net", "http://com/",
        "http://.com/", "http://a..com//", "ftp://x.net/es", "", None, "http://", "://net/fr/z",
        "http://exampleXcom/en/", "http://evilexample.com/en/", "http://net/en/es/", "http://a.com?x/",
        "http://ex.org/abcd", "http://ex.org/ab", "http://ex.org/a/b/c/d/" + "e/" * 300]
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"), ("ex.org", "/ab", "block"),
         ("ex.org", "/abc", "allow"), ("ex.org", "/a/b/", "block"), ("org", "", "allow"),
         ("ex.org", "/a/b/", "allow"), (None, "/", "block"), ("net", None, "block")]


def _judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = brute.lower(host)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in RULES
            if h is not None and p is not None
            and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, 0, None, "allow")
    return host, path, best[3], best[4]


@pytest.mark.parametrize("broadcast", [True, False])
def test_urls_match_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(url_filter, "BROADCAST_BYTES", -1)
    pages = spark.createDataFrame([(i, u, "own", "own") for i, u in enumerate(URLS + URLS[:3])],
                                  "page_id long, url string, rule string, extra string")
    out = url_filter.judge_urls(pages, spark.createDataFrame(RULES, url_filter.RULE_SCHEMA))
    assert out.columns == ["page_id", "url", "extra", "host", "path", "rule", "verdict"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert got == {i: _judge(u) for i, u in enumerate(URLS + URLS[:3])}


def test_urls_without_rules_or_pages(spark):
    none = spark.createDataFrame([], url_filter.RULE_SCHEMA)
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge_urls(pages, none, default="block").collect()] == ["block"]
    rules = spark.createDataFrame(RULES, url_filter.RULE_SCHEMA)
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


PHRASES = [(("mit", "license"), "mit"), (("apache", "license"), "apache"),
           (("general", "public", "license"), "gpl")]
MIT = license_scan.OWN_TEMPLATES[3].text
LICENSED = [
    "Released under the MIT License.", "MIT-license MIT  license, Apache\nLicense",
    "the GNU General Public License general public", "public license mit", None, "", "mitlicense",
    "Licensed under CC BY-NC 4.0.", "some words " + MIT + " and more",
    MIT.replace("any person", "any one legal person").replace("deal", "work"),
    MIT[:60], "MİT license é mit license", "mit license " * 400]


def test_licenses_match_brute_force(spark):
    data = [(i, t, "en", "s", 1) for i, t in enumerate(LICENSED)] + [(0, LICENSED[0], "en", "s", 1)]
    docs = spark.createDataFrame(data, DOCS).selectExpr("*", "'own' AS labels", "'own' AS n")
    out = license_scan.scan_licenses(docs).collect()
    assert len(out) == len(data)
    for r in out:
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(r.text or ""))
        hits = [(i, label) for p, label in PHRASES for i in range(len(ws))
                if tuple(ws[i:i + len(p)]) == p]
        places = [i for i, _ in hits]
        assert (r.n_words, r.n_base) == (len(ws), len(hits)), r
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if hits else (None, None))
        base = {label for _, label in hits}
        assert r.base_labels == ",".join(sorted(base))
        assert base <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by = {r.doc_id: r for r in out}
    assert by[7].labels == "cc-by-nc" and by[8].labels == "mit" and by[8].score == 1.0
    assert by[9].labels == "mit" and 0.6 <= by[9].score < 1.0 and by[10].labels == ""


def test_license_scan_of_nothing(empty_docs):
    assert license_scan.scan_licenses(empty_docs).count() == 0


def _base(text):
    ws = brute.words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if brute.words(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    covered = {j for i in range(len(ws) - 4) if count[tuple(ws[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered),
            len(ws) < 10 or 100 * len(covered) > 20 * len(ws))


def test_quality_base_matches_brute_force(docs, rows, wide_docs):
    field = quality.fit_field([], [])
    out = quality.label_quality(wide_docs, field)
    assert as_multiset(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed") == sorted(repr(r) for r in spark_rows(
                           docs, rows))
    assert out.filter("kept = base_failed").count() == 0  # no labels: all lines are content


def spark_rows(docs, rows):
    from pyspark.sql import Row

    make = Row("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
               "base_failed")
    return [make(r.doc_id, *_base(r.text)) for r in rows]


def test_repeat_words_of_many_distinct_words():
    rng = np.random.default_rng(1)
    words = [b"%d" % i for i in rng.integers(0, 9000, 20000)]
    words += words[100:160] + [b"x"] * 40
    assert quality.repeat_words(words) == _base(" ".join(w.decode() for w in words))[4]


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(2)
    starts = np.array([0, 1, 4, 9])
    scores = rng.normal(size=(16, 2))
    field = quality.LineField(np.zeros((1, 2)), rng.normal(size=(2, 2)), rng.normal(size=2), 0, 1)
    got = quality.viterbi(scores, starts, field)
    for a, b in zip(starts, [1, 4, 9, 16], strict=True):
        def value(y):
            s = field.start[y[0]] + sum(scores[a + i, c] for i, c in enumerate(y))
            return s + sum(field.transition[p, q] for p, q in zip(y, y[1:], strict=False))
        best = max(product((0, 1), repeat=b - a), key=value)
        assert tuple(got[a:b]) == best


def test_marginals_match_enumeration():
    rng = np.random.default_rng(3)
    scores, start, trans = rng.normal(size=(1, 4, 2)), rng.normal(size=2), rng.normal(size=(2, 2))
    z, single, _ = quality._forward_backward(scores, np.ones((1, 4), bool), start, trans)
    weight = {y: np.exp(start[y[0]] + sum(scores[0, i, c] for i, c in enumerate(y))
                        + sum(trans[p, q] for p, q in zip(y, y[1:], strict=False)))
              for y in product((0, 1), repeat=4)}
    total = sum(weight.values())
    assert np.isclose(z[0], np.log(total))
    for i in range(4):
        assert np.isclose(single[0, i, 1], sum(v for y, v in weight.items() if y[i]) / total)


def test_field_learns_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    field = quality.train_field(docs, labels.filter("doc_id % 2 = 0"))
    out = quality.label_quality(docs, field).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    good = [r.kept for r in out if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in out if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_quality_of_nothing(empty_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    field = quality.train_field(empty_docs, none)
    assert quality.label_quality(empty_docs, field).count() == 0


def test_training_lines_come_from_the_whole_text(spark):
    from pyspark.sql import functions as F

    from wattspark.llm import quality

    rows = spark.createDataFrame([(i, [f"l{k}" for k in range(n)]) for i, n in enumerate((0, 5, 64, 65, 400))],
                                 "id long, lines array<string>")
    got = {r.id: r.t for r in rows.select("id", quality.training_lines(F.col("id"), F.col("lines"), 64).alias("t")).collect()}
    assert [len(got[i]) for i in range(5)] == [0, 5, 64, 64, 64]
    at = [int(x[1:]) for x in got[4]]
    assert [a // 100 for a in at] == [0] * 16 + [1] * 16 + [2] * 16 + [3] * 16
    assert all(b - a == 1 for a, b in zip(at, at[1:]) if a // 100 == b // 100)


def test_columns_named_like_the_operators_own_are_kept(spark):
    from pyspark.sql import functions as F

    from wattspark.llm import license_scan, url_filter

    docs = spark.createDataFrame([(1, "under the mit license"), (2, None)], "doc_id long, text string")
    wide = docs.withColumns({"__k": F.lit("own"), "__n_base": F.lit(7), "in_0": F.lit(1)})
    got = license_scan.scan_licenses(wide)
    assert got.drop("__k", "__n_base", "in_0").collect() == license_scan.scan_licenses(docs).collect()
    assert {r["__k"] for r in got.collect()} == {"own"}
    pages = spark.createDataFrame([(1, "http://a.com/x"), (2, None)], "page_id long, url string")
    rules = spark.createDataFrame([("com", "/", "block")], url_filter.RULE_SCHEMA)
    odd = pages.withColumnRenamed("url", "__url").withColumn("__uses", F.lit(3))
    got = url_filter.judge_urls(odd, rules, url_col="__url")
    assert {(r.page_id, r.rule, r["__uses"]) for r in got.collect()} == {(1, "com/", 3), (2, None, 3)}
