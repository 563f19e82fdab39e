"""Phrase collocations, whitening and the quality classifier against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_fixtures import (  # noqa: F401  fixtures are used by name
    CLASHING,
    DOCS,
    as_multiset,
    docs,
    empty_docs,
    rows,
    wide_docs,
)
from pyspark.sql import functions as F

from wattspark.llm import collocations, factorisation, whitening

PHRASE = ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute_phrases(rows, least, top, inside=50):
    one, two, three, n = (defaultdict(Counter) for _ in range(4))
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            w = re.findall("[^ \t]+", piece)
            one[lang].update(w)
            two[lang].update(zip(w, w[1:]))
            three[lang].update(zip(w, w[1:], w[2:]))
            n[lang][0] += len(w)
    out = []
    for lang in one:
        f1, f2, f3 = one[lang], two[lang], three[lang]
        long = {g: f for g, f in f3.items() if f >= least}
        inside_of = defaultdict(int)
        for g, f in long.items():
            for pair in (g[:2], g[1:]):
                inside_of[pair] = max(inside_of[pair], f)
        found = []
        for g, a in [*((g, f) for g, f in f2.items() if f >= least), *long.items()]:
            if len(g) == 2:
                if 100 * inside_of[g] >= inside * a:
                    continue
                cuts = [(f1[g[0]], f1[g[1]], 1)]
            else:
                cuts = [(f1[g[0]], f2[g[1:]], 1), (f2[g[:2]], f1[g[2]], 2)]
            score, k, left, r = min((10**6 * a * a // (x * y), k, x, y) for x, y, k in cuts)
            found.append((-score, -a, " ".join(g).encode(), left, r, k))
        for rank, (s, a, p, left, r, k) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, r, n[lang][0], -s, k))
    return sorted(out)


def phrase_rows(seed=3, n=160):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(2500)] + ["É", "語", "A\x00b", "it's"]
    weights = [1 / (i + 3) for i in range(len(vocabulary))]
    out = []
    for i in range(n):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 400))
        for k in range(0, len(words), 13):
            words[k:k + 3] = [["New", "York", "City"], ["of", "the", "v1"], ["v1.", "x", "Y"]][k % 3]
        sep = rng.choice([" ", "  ", "\t", " \n", ", "])
        out.append((i, sep.join(words), ["en", "de", None, "und", ""][i % 7 % 5]))
    out += [(500, None, "en"), (501, "", "xx"), (502, " .,; ", "xx"), out[3], out[3], (None, out[4][1], "en"),
            (503, "same word " * 3000, "en"), (504, "y" * 30000, "de")]
    return out


def test_phrases_match_brute_force(spark, monkeypatch):
    data = phrase_rows()
    table = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(4)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(collocations, "FAN_IN", 2)
    monkeypatch.setattr(collocations, "PART_WORDS", 5_000)
    pairs = [(r[2], r[1]) for r in data]
    for least, top in ((3, 40), (10, 2000)):
        got = sorted(map(tuple, collocations.mine_phrases(table, least, top).select(*PHRASE).collect()))
        assert got == brute_phrases(pairs, least, top)
        assert any(r[8] == 2 for r in got) and any(r[2].count(" ") == 1 for r in got)
    assert {r[0] for r in got} == {"en", "de", "und", ""}


def test_phrases_of_wide_and_empty_tables(docs, rows, wide_docs, empty_docs):
    want = brute_phrases([(r.lang, r.text) for r in rows], 2, 30)
    for table in (docs, wide_docs.withColumns({c: F.lit(1) for c in ("f", "n", "unit", "at", "__x")})):
        got = collocations.mine_phrases(table, 2, 30).select(*PHRASE).collect()
        assert sorted(map(tuple, got)) == want
    assert collocations.mine_phrases(empty_docs).collect() == []
    blank = empty_docs.sparkSession.createDataFrame([(1, None, None, None, 0), (2, " ,", "a", "s", 2)], DOCS)
    assert collocations.mine_phrases(blank).collect() == []


def test_tiles_count_alike_dense_and_sorted():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1024, 400_000), rng.integers(0, 1024, 400_000)
    a[::5] += 5000
    keys, counts = collocations.count_pairs(a, b)
    want = Counter(zip(a.tolist(), b.tolist()))
    ra, rb = collocations.key_ranks(keys)
    assert dict(zip(zip(ra.tolist(), rb.tolist()), counts.tolist())) == want
    near = keys < 1 << 20
    many = np.tile(keys[near], 3)                       # one tile, filled: dense
    assert 4 * len(many) >= collocations.TILE ** 2
    k, c = collocations.add_cells(many, np.tile(counts[near], 3))
    assert np.array_equal(k, keys[near]) and np.array_equal(c, 3 * counts[near])
    k, c = collocations.add_cells(np.append(keys, keys[:5]), np.append(counts, counts[:5]))
    assert np.array_equal(k, keys) and np.array_equal(c[5:], counts[5:]) and np.array_equal(c[:5], 2 * counts[:5])
    big = np.array([(1 << 33) - 1, 7]), np.array([(1 << 30) - 1, 1 << 29])
    assert [x.tolist() for x in collocations.key_ranks(collocations.tile_key(*big))] == [x.tolist() for x in big]


def test_long_texts_are_encoded_in_parts(monkeypatch):
    text = ("Ab, c d\te.  f\n" * 40 + "x" * 90 + " y z").encode()
    whole = np.concatenate(collocations.encode_text(text, one := collocations._Codes()))
    monkeypatch.setattr(collocations, "_CHUNK", 7)
    parts = collocations.encode_text(text, two := collocations._Codes())
    assert len(parts) > 20 and one == two and np.array_equal(np.concatenate(parts), whole)


def test_phrase_scores_are_exact_beyond_64_bits(spark):
    n = 10 ** 14
    row = spark.createDataFrame([(n - 1, n, n)], "f long, l long, r long")
    assert row.select(collocations._score("f", "l", "r")).first()[0] == 10**6 * (n - 1) ** 2 // n ** 2


def embeddings(spark, vectors, extra=()):
    data = [(i, [None if c is None else float(c) for c in v] if v is not None else None)
            for i, v in enumerate(vectors)] + list(extra)
    return spark.createDataFrame(data, "vec_id long, embedding array<float>")


def brute_whitening(vectors, k):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = (n * fit - s) / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    deviation = n * x - s
    return n, (deviation.astype(object) ** 2).sum(1), (deviation / n) @ u / np.sqrt(e), e / np.trace(v)


def test_whitening_matches_eigenvectors(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(300, 20)) * np.linspace(1, 9, 20)
    vectors = [*base, *base[:40], *[base[0]] * 200]     # copies count once in the fit
    noise = [(900, None), (901, [None] * 20), (902, [1.0] * 19 + [float("nan")]), (903, []),
             (904, [1.0] * 19 + [float("inf")]), (905, [1.0] * 19), (None, base[3].tolist())]
    table = embeddings(spark, vectors, noise).repartition(5)
    wide = table.withColumns({c: F.lit("own") for c in ("x", "n", "component", "whitened", "task", *CLASHING[:5])})
    n, deviation, white, explained = brute_whitening(vectors, 16)
    for source in (table, wide):
        got = defaultdict(list)
        for r in whitening.whiten(source).collect():
            got[r.vec_id].append(r)
        assert set(got) == {*range(len(vectors)), None}
        sign = {}
        for i in range(len(vectors)):
            own = sorted(got[i], key=lambda r: r.component)
            assert [r.component for r in own] == list(range(1, 17))
            for k, r in enumerate(own):
                sign.setdefault(k, np.sign(r.whitened * white[i, k]))
                assert abs(r.whitened * sign[k] - white[i, k]) < 1e-9
                assert r.n == n and r.deviation == deviation[i]
                assert abs(r.explained - explained[k]) < 1e-12 and r.identity_error < 1e-10


def test_whitening_of_degenerate_tables(spark):
    assert whitening.whiten(embeddings(spark, [])).collect() == []
    assert whitening.whiten(embeddings(spark, [None, [], [float("nan")]])).collect() == []
    assert whitening.whiten(embeddings(spark, [[1.0, 2.0]] * 5)).collect() == []      # no spread
    two = whitening.whiten(embeddings(spark, [[1.0, 2.0, 5.0], [2.0, 2.0, 5.0]])).collect()
    assert [(r.component, r.n) for r in two] == [(1, 2)] * 2      # rank one
    assert sorted(abs(r.whitened) for r in two) == pytest.approx([1, 1])
    line = [[float(10 ** k), 0.0] for k in range(0, 30, 3)]      # saturates, beyond a long
    far = whitening.whiten(embeddings(spark, line)).collect()
    assert {r.component for r in far} == {1} and {r.deviation for r in far} == {None}


def test_slices_are_certified_for_ties_and_close_values():
    rng = np.random.default_rng(2)
    for values in ([5.0] * 5 + [3.0] * 4 + [3 - 1e-7] * 2 + [1.0] * 20, [4.0, 4 - 1e-10, 4 - 3e-10, 1, 1e-5],
                   list(np.geomspace(1e4, 1e-4, 30)), [2.0, 0, 0, 0]):
        d = len(values)
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        a = (q * np.array(values)) @ q.T
        a = (a + a.T) / 2
        true = np.linalg.eigvalsh(a)[::-1]
        for shift in rng.uniform(0, values[0], 15):
            assert whitening.eigenvalues_above(a, shift) == (true > shift).sum()
        e, u = whitening.Slicer(a).leading(16, 1e-11 * np.trace(a))
        assert np.allclose(e, true[:len(e)], atol=1e-14 * 50 * values[0])
        assert len(e) == min(16, (true > 1e-11 * np.trace(a)).sum())
        assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12


def test_pair_sums_in_linear_time():
    rng = np.random.default_rng(4)
    size = factorisation.BUCKETS + 3 * (factorisation.BINS + 1)
    m = factorisation.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, 4)), [np.array([1.0, 2.0])] * 3)
    words = [(np.array([3, 9, 70]), np.array([1, 4, 4]), 9), (np.zeros(0, np.int32), np.zeros(0, int), 0)]
    start, index, value = m.features(words, np.array([[0.5, 1.0, np.nan], [1.5, 2.5, 0.0]]))
    got = m.raw(start, index, value)
    for k, end in enumerate([start[1], len(index)]):
        i, x = index[start[k]:end], value[start[k]:end]
        pairs = sum(m.factors[i[a]] @ m.factors[i[b]] * x[a] * x[b]
                    for a in range(len(i)) for b in range(a + 1, len(i)))
        assert got[k] == pytest.approx(0.3 + m.linear[i] @ x + pairs)
        assert (x ** 2).sum() == pytest.approx(2 if k == 0 else 1)


def test_words_of_long_texts_are_all_read(monkeypatch):
    text = (" ".join(f"W{i % 700}" for i in range(9000)) + "\n\x0b").encode()
    want = Counter(zlib.crc32(w) & (factorisation.BUCKETS - 1) for w in text.lower().split())
    for chunk in (50, 1 << 22):
        monkeypatch.setattr(factorisation, "CHUNK", chunk)
        index, counts, n = factorisation.word_buckets(text, factorisation._Buckets())
        assert dict(zip(index.tolist(), counts.tolist())) == want and n == 9000


def test_classifier_learns_from_its_fold_alone(spark, docs, rows, wide_docs, empty_docs):
    rng = random.Random(1)
    clean = [f"good{i}" for i in range(40)]
    junk = [f"bad{i}" for i in range(40)]
    data, labels = [], []
    for i in range(400):
        y = int(rng.random() < 0.6)
        data.append((i, " ".join(rng.choice(clean if y else junk) for _ in range(30)), "en", "s", 100))
        labels.append((i, y, 0))
    table = spark.createDataFrame(data, DOCS).repartition(3)
    schema = "doc_id long, quality int, toxic int"
    fold = lambda i: zlib.crc32(str(i).encode()) % 3
    turned = [(i, 1 - y if fold(i) == 1 else y, t) for i, y, t in labels]     # held-out labels lie
    noise = [(None, 1, 0), (5, None, 0), (7000, 1, 0), *([labels[0]] * 3), (labels[0][0], 1 - labels[0][1], 0)]
    machines = [factorisation.train_machine(t, spark.createDataFrame(r, schema)) for t, r in (
        (table, labels), (table, turned + noise),
        (table.withColumns({"quality": F.lit("own"), "y": F.lit(1), "n": F.lit(2)}), labels))]
    scored = [sorted(map(tuple, factorisation.score_quality(table, m).collect())) for m in machines]
    assert scored[0] == scored[1] == scored[2]
    truth = dict((i, y) for i, y, _ in labels)
    held = [(p, truth[i]) for i, out, s, p in scored[0] if out]
    assert len(held) > 80 and sum(p == y for p, y in held) / len(held) > 0.97
    assert all(out == (fold(i) == 1) and 0 <= s <= 1 and p == (s >= 0.5) for i, out, s, p in scored[0])

    m = machines[0]
    base = as_multiset(factorisation.score_quality(docs, m), "doc_id", "held_out", "score", "predicted")
    assert len(base) == len(rows)
    assert base == as_multiset(factorisation.score_quality(wide_docs, m), "doc_id", "held_out", "score", "predicted")
    other = docs.withColumns({"lang": F.lit("zz"), "source": F.lit("zz")})
    assert base == as_multiset(factorisation.score_quality(other, m), "doc_id", "held_out", "score", "predicted")
    assert factorisation.score_quality(empty_docs, m).collect() == []
    none = spark.createDataFrame([], schema)
    flat = factorisation.train_machine(table, none)
    assert {r.score for r in factorisation.score_quality(table, flat).collect()} == {0.5}
    ones = factorisation.train_machine(table, spark.createDataFrame([(i, 1, 0) for i in range(9) if fold(i) != 1],
                                                                   schema))
    n = sum(fold(i) != 1 for i in range(9))
    assert {round(r.score, 9) for r in factorisation.score_quality(table, ones).collect()} == {
        round((n + 1) / (n + 2), 9)}
    assert factorisation.train_machine(empty_docs, spark.createDataFrame(labels, schema)).bias == 0


def test_classifier_on_held_out_documents(spark):
    from wattspark.llm import catalog

    path = "/root/testdata/sf0.01"
    out = catalog.op13_quality_classifier(spark, path).filter("held_out")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    r = out.join(labels, "doc_id").select("quality", "score", "predicted").collect()
    assert np.mean([x.quality == x.predicted for x in r]) > 0.95
    good, bad = ([x.score for x in r if x.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
