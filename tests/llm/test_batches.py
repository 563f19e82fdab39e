"""Packing, mixing, sharding, language model and pipeline against brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

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
from pyspark.sql import functions as F

from wattspark.llm import catalog, language_model, mixing, packing, sharding


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary_paths()[0])


TRICKY = ["", " ", "  a", "a  b ", "a\n\n b", "don't we'll", "x\t y\r\n", "é ñ 語 語語", "a<|endoftext|> b",
          "1234 5,6", "  \n \n", "  x ", "a" * 5000, "😀 👩‍👩‍👧", "<|endoftext|>", "foo bar\n"]


def test_ids_equal_the_tokenizers_library(tokenizer, rows):
    encode = packing.encoder(*packing.vocabulary_paths())
    for t in TRICKY + [r.text or "" for r in rows]:
        want = tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(encode(t), "<u4").tolist() == want, t


def test_pieces_and_sequences(docs, rows, wide_docs, tokenizer):
    out = catalog.pack_table(docs).collect()
    whole = Counter()
    for r in rows:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        head = len(ids) % 1024 or 1024
        cuts = [0, *range(head, len(ids), 1024), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            whole[r.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == whole
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 1024
    assert len(bins) <= sum(r.length for r in out) / 1024 * 1.25 + 1
    assert as_multiset(catalog.pack_table(wide_docs), "doc_id", "piece", "ids_crc32") == as_multiset(
        catalog.pack_table(docs), "doc_id", "piece", "ids_crc32")


def _slow_two_fit(lengths, capacity):
    """The rule on a plain list of pieces."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        gap, own = capacity, []
        while any(n <= gap for n in left):
            n = next(n for n in left if n <= gap)
            left.remove(n)
            own.append(n)
            gap -= n
        small = own[-1]
        pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1:]
                 if small < a + b <= gap + small]
        if gap and pairs:
            _, a, b = max(pairs)
            own[-1:] = [a, b]
            left.remove(a)
            left.remove(b)
            left = sorted([*left, small], reverse=True)
        bins.append(own)
    return bins


@pytest.mark.parametrize("seed", range(6))
def test_two_fit_follows_the_rule(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 100) for _ in range(80)]
    fast = packing.best_two_fit(np.bincount(lengths, minlength=101), 100)
    assert [sorted(b) for b in fast] == [sorted(b) for b in _slow_two_fit(lengths, 100)]
    assert sorted(n for b in fast for n in b) == sorted(lengths)


def test_mix_meets_targets(docs, rows, wide_docs):
    out = mixing.mix_rows(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(brute.words(r.text))
    keys = sorted(sizes, key=lambda k: (k is None, k))
    want = brute.targets(sizes, {k: 1 + i % 3 for i, k in enumerate(keys)}, 3)
    taken = Counter()
    for r in out:
        assert 0 <= r.taken <= 3 * r["size"] and r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9)
        taken[r.source] += r.taken
    block = -(-sum(sizes.values()) // mixing.BLOCKS)
    assert all(abs(taken[k] - want[k]) <= block for k in keys)
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    assert as_multiset(mixing.mix_rows(docs), *cols) == as_multiset(mixing.mix_rows(wide_docs), *cols)


def test_mixed_documents_hold_what_was_taken(docs, rows):
    taken = Counter()
    for r in mixing.mix_rows(docs).collect():
        taken[r.doc_id] += r.taken
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    found = out.collect()
    got = Counter()
    for r in found:
        got[r.doc_id] += len(brute.words(r.text))
    assert +got == +taken
    texts = {r.text for r in rows}
    assert sum(r.text not in texts for r in found) <= len({r.source for r in rows})


def test_quotas_are_sainte_lague_awards(spark):
    targets = spark.createDataFrame(
        [("a", 530, 1000.0, 530.0), ("b", 240, 1000.0, 240.0), ("c", 230, 1000.0, 230.0)],
        "source string, source_size long, all_words double, target double")
    got = mixing.block_quotas(targets, blocks=10, shards=2).collect()
    seats = dict.fromkeys("abc", 0)
    awards = []
    for _ in range(10):
        best = max(seats, key=lambda k: ({"a": 530, "b": 240, "c": 230}[k] / (2 * seats[k] + 1), k))
        seats[best] += 1
        awards.append(best)
    want = Counter((s, k // 5) for k, s in enumerate(awards))
    assert {(r.source, r.shard): r.blocks for r in got} == dict(want)


def test_blocks_fill_the_quotas_of_their_shards(docs):
    out = [r for r in mixing.mix_rows(docs, blocks=300, shards=7).collect() if r.block is not None]
    rows = mixing.mix_rows(docs, blocks=300, shards=7)
    assert {r.shard is None for r in rows.filter("start >= drawn").collect()} <= {True}
    held = defaultdict(set)
    for r in out:
        assert 0 <= r.shard < 7
        held[r.source, r.shard].add(r.block)
    totals = {r.source: (r.source_size, r.target) for r in out}
    t = docs.sparkSession.createDataFrame(
        [(k, s, float(sum(x for x, _ in totals.values())), w) for k, (s, w) in totals.items()],
        "source string, source_size long, all_words double, target double")
    least, words = t.agg(F.min("target"), F.max("all_words")).first()
    blocks = max(300, math.ceil(words / max(1, least // mixing.LEAST_BLOCKS)))
    quotas = {(r.source, r.shard): r.blocks for r in mixing.block_quotas(t, blocks, 7).collect()}
    for key, own in held.items():
        assert len(own) <= quotas[key]
    won = Counter()
    for (source, _), n in quotas.items():
        won[source] += n
    for source in won:      # every block of the draw falls to one shard, as many as its quota
        ordered = sorted((s, n) for (k, s), n in quotas.items() if k == source)
        places = Counter()
        for b in range(won[source]):
            at, end = (mixing.STEP * b + mixing.SEED) % won[source], 0
            for s, n in ordered:
                end += n
                if at < end:
                    places[s] += 1
                    break
        assert places == Counter(dict(ordered))
        for (k, s), own in held.items():
            if k == source:
                for b in own:
                    at = (mixing.STEP * b + mixing.SEED) % won[source]
                    assert sum(n for x, n in ordered if x < s) <= at < sum(n for x, n in ordered if x <= s)


def test_small_sources_keep_their_targets(spark):
    sizes = {"big": 600_000, "mid": 9_000, "tiny": 8, "small": 30}
    data = [(i, "w " * n, "en", s, 1) for i, (s, n) in enumerate(sizes.items())]
    out = mixing.mix_rows(spark.createDataFrame(data, DOCS)).collect()
    assert all(abs(r.taken - r.target) <= max(1, 0.02 * r.target) for r in out)
    assert all(r.taken > 0 for r in out)


def _groups(spark, sizes):
    rng = random.Random(len(sizes))
    keys = sorted({rng.getrandbits(64) - (1 << 63) for _ in sizes})
    data = sorted(zip(keys, sizes, strict=True))
    return spark.createDataFrame(data, "g long, size long"), [s for _, s in data], [k for k, _ in data]


@pytest.mark.parametrize("seed", range(4))
def test_cuts_have_the_smallest_capacity(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 5, 40, 300][: 3 + seed]) for _ in range(rng.randint(3, 300))]
    groups, order, keys = _groups(spark, sizes)
    capacity, firsts = sharding.minimax_cuts(groups, 5, fan_bits=3)
    assert capacity == brute.smallest_capacity(order, 5)
    held = Counter(sum(f <= k for f in firsts) for k in keys for _ in [0])
    load = Counter()
    for k, s in zip(keys, order, strict=True):
        load[sum(f <= k for f in firsts)] += s
    assert max(load.values()) <= capacity and len(held) <= 5


def test_shards_keep_groups_and_have_gapless_slots(docs, rows, wide_docs):
    out = sharding.shard_documents(docs, 4).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))
        for r in rows)
    places, slots = defaultdict(set), defaultdict(list)
    for r in out:
        places[r.g].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in places.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert as_multiset(sharding.shard_documents(wide_docs, 4), "doc_id", "shard", "slot") == \
        as_multiset(sharding.shard_documents(docs, 4), "doc_id", "shard", "slot")


def test_a_group_larger_than_a_share_leaves_no_shard_empty(spark):
    data = [(i, "copy of one text", "en", "s", 1) for i in range(600)]
    data += [(1000 + i, f"text number {i}", "en", "s", 1) for i in range(600)]
    out = sharding.shard_documents(spark.createDataFrame(data, DOCS), 8)
    load = {r.shard: r["sum(size)"] for r in out.groupBy("shard").sum("size").collect()}
    assert len(load) == 8
    rest = sorted(load.values())[:-1]
    assert rest[-1] <= 1.1 * rest[0]


def test_written_shards_hold_all_rows(docs, spark, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert as_multiset(back, *docs.columns) == as_multiset(docs, *docs.columns)
    assert as_multiset(back, "doc_id", "shard") == as_multiset(
        sharding.shard_documents(docs, 4), "doc_id", "shard")


def test_numbers_do_not_depend_on_buckets(spark, monkeypatch):
    from wattspark.llm import common

    rows = spark.range(500).selectExpr("id", "id % 3 AS k", "id % 7 AS w")
    spread = common.order_key(F.col("id"))
    one = common.numbered(rows, ["k"], [F.col("id")], spread, "at", 500, F.col("w"))
    monkeypatch.setattr(common, "BUCKET_ROWS", 20)
    many = common.numbered(rows, ["k"], [F.col("id")], spread, "at", 500, F.col("w"))
    assert as_multiset(one, "id", "at") == as_multiset(many, "id", "at")


def _is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_scores_match_a_plain_model(docs, rows, block):
    share, order = 2e-3, 3
    out = language_model.score_texts(docs, order, share, block_bytes=block).collect()
    texts = {}
    for r in rows:
        texts[r.doc_id, r.text] = [*brute.words(brute.lower(r.text or "")), "\n"]
    train = [[*brute.words(brute.lower(r.text or "")), "\n"] for r in rows if not _is_held_out(r.doc_id)]
    grams = [Counter(), Counter(), Counter()]
    for ws in train:
        for n in (1, 2, 3):
            seq = ws if n == 1 else ["<s>", *ws]
            grams[n - 1].update(tuple(seq[i:i + n]) for i in range(len(seq) - n + 1))
    total, vocabulary = sum(grams[0].values()), len(grams[0])
    bar = max(2, share * total)
    kept = [{g: c for g, c in level.items() if c >= bar} for level in grams[1:]]
    one = lambda w: (grams[0][(w,)] + 1) / (total + vocabulary + 1)
    size = lambda h: len(train) if h == ("<s>",) else grams[len(h) - 1][h]

    def prob(h, w):
        if not h:
            return one(w)
        level = kept[len(h) - 1]
        own = {g[-1]: c for g, c in level.items() if g[:-1] == h}
        if w in own:
            return (own[w] - 0.5) / size(h)
        if not own:
            return prob(h[1:], w)
        left = 1 - sum((c - 0.5) / size(h) for c in own.values())
        return left / (1 - sum(prob(h[1:], x) for x in own)) * prob(h[1:], w)

    want = Counter()
    for (doc_id, _), ws in texts.items():
        if len(ws) > 400:
            continue
        score, seq = 0.0, ["<s>", *ws]
        for i, w in enumerate(ws):
            score += math.log10(prob(tuple(seq[max(0, i - 1):i + 1]), w))
        base = sum(math.log10(one(w)) for w in ws)
        want[doc_id, _is_held_out(doc_id), len(ws), sum((w,) in grams[0] for w in ws), total,
             round(base, 6), round(score, 6)] += 1
    got = {(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6),
            round(r.score, 6)) for r in out}
    assert len(out) == len(rows) and set(want) <= got


def test_arcs_of_a_count_of_two_stay_in_a_large_input(spark, monkeypatch):
    monkeypatch.setattr(language_model, "RANGE_TOKENS", 1 << 16, raising=False)
    ids = [i for i in range(40) if not _is_held_out(i)]
    data = [(i, t, "en", "s", 1) for i, t in zip(ids, [
        "w " * 400_000, "alpha beta gamma", "x alpha beta gamma y", "w x w alpha"])]
    data.append((2 if _is_held_out(2) else next(i for i in range(99) if _is_held_out(i)),
                 "w alpha beta gamma w alpha x alpha beta", "en", "s", 1))
    table = spark.createDataFrame(data, DOCS)
    train = table.filter(F.col("doc_id").isin(ids)).select(F.col("text").cast("binary"))
    model, _, total = language_model.train_automaton(train, 3, 0.0)
    assert 1e-5 * total > 3
    single = Counter(w for _, t, *_ in data[:-1] for w in language_model.tokens(t.encode()))
    got = {r.doc_id: r for r in language_model.score_texts(table, block_bytes=64).collect()}
    assert len(got) == len(data)
    for doc_id, text, *_ in data:
        score, _, rare = language_model.traverse(
            language_model.tokens(text.encode()), model.states, model.start)
        score += sum(math.log10((single[w] + 1) * model.unseen) for w in rare)
        assert math.isclose(got[doc_id].score, score, rel_tol=1e-9)


def test_probabilities_of_every_state_sum_to_one(docs):
    train = docs.select(F.col("text").cast("binary").alias("text"))
    model, table, total = language_model.train_automaton(train, 3, 4e-4)
    vocabulary = [bytes(r.word) for r in table.collect()]
    single = {bytes(r.word): (r.c + 1) * model.unseen for r in table.collect()}
    assert len(model.states) > 20
    for state in range(len(model.states)):
        mass = model.unseen * _chain(model, state)
        for w in vocabulary:
            p = model.probability(state, w)
            rare = w not in model.single
            mass += p / model.unseen * single[w] if rare else p
        assert math.isclose(mass, 1.0, rel_tol=1e-9)


def _chain(model, state):
    scale = 1.0
    while model.fail[state] >= 0:
        scale *= model.weight[state]
        state = model.fail[state]
    return scale


def test_model_beats_unigrams_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = (language_model.score_texts(docs).filter("held_out")
         .agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first())
    assert r.s > r.b


def test_empty_tables(empty_docs):
    assert catalog.pack_table(empty_docs).count() == 0
    assert mixing.mix_rows(empty_docs).count() == 0
    assert mixing.mix_documents(empty_docs).count() == 0
    assert sharding.shard_documents(empty_docs).count() == 0
    assert language_model.score_texts(empty_docs).count() == 0


def test_only_held_out_texts(spark):
    ids = [i for i in range(60) if _is_held_out(i)]
    data = [(i, "a b", "en", "s", 1) for i in ids]
    out = language_model.score_texts(spark.createDataFrame(data, DOCS)).collect()
    assert len(out) == len(ids) and {(r.n_known, r.train_tokens, r.score) for r in out} == {(0, 0, 0.0)}


def test_clashing_names(docs, wide_docs):
    cols = ["doc_id", "n_tokens", "n_known"]
    assert as_multiset(language_model.score_texts(wide_docs), *cols) == as_multiset(
        language_model.score_texts(docs), *cols)
    assert mixing.mix_documents(wide_docs).columns == wide_docs.columns
