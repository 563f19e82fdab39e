"""The distributed automaton at its registered setting against a plain model, every text."""

import math
import random
import zlib
from collections import Counter, defaultdict
from functools import cache

import brute
import numpy as np
import pytest
from corpus_fixtures import DOCS, docs, rows  # noqa: F401  fixtures are used by name

from wattspark.llm import language_model


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


class Plain:
    """Counts in dictionaries, probabilities by recursion."""

    def __init__(self, data, order=3):
        self.order = order
        train = [t for i, t in data if not is_held_out(i)]
        self.texts = len(train)
        self.grams = [Counter() for _ in range(order)]
        for t in train:
            ws = self.words(t)
            for n in range(1, order + 1):
                seq = ws if n == 1 else ["<s>", *ws]
                self.grams[n - 1].update(zip(*(seq[k:] for k in range(n))))
        self.total, self.types = sum(self.grams[0].values()), len(self.grams[0])
        self.next = defaultdict(dict)
        for level in self.grams[1:]:
            for g, c in level.items():
                if c >= 2:
                    self.next[g[:-1]][g[-1]] = c
        self.prob = cache(self.prob)
        self.back = cache(self.back)

    @staticmethod
    def words(text):
        return [*brute.words(brute.lower(text or "")), "\n"]

    def size(self, h):
        return self.texts if h == ("<s>",) else self.grams[len(h) - 1][h]

    def one(self, w):
        return (self.grams[0][(w,)] + 1) / (self.total + self.types + 1)

    def back(self, h):
        own = self.next[h]
        left = 1 - sum((c - 0.5) / self.size(h) for c in own.values())
        return left / (1 - sum(self.prob(h[1:], x) for x in own))

    def prob(self, h, w):
        if not h:
            return self.one(w)
        own = self.next.get(h)
        if not own:
            return self.prob(h[1:], w)
        if w in own:
            return (own[w] - 0.5) / self.size(h)
        return self.back(h) * self.prob(h[1:], w)

    def row(self, doc_id, text):
        ws = self.words(text)
        seq = ["<s>", *ws]
        score = sum(math.log10(self.prob(tuple(seq[max(0, i - self.order + 2):i + 1]), w)) for i, w in enumerate(ws))
        return (doc_id, is_held_out(doc_id), len(ws), sum((w,) in self.grams[0] for w in ws), self.total,
                sum(math.log10(self.one(w)) for w in ws), score)


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:4], round(r[5], 4))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6])


def test_every_text_at_the_registered_setting(docs, rows):
    plain = Plain([(r.doc_id, r.text) for r in rows])
    want = [plain.row(r.doc_id, r.text) for r in rows]
    assert max(w[2] for w in want) == 3001
    same(language_model.score_texts(docs).collect(), want)


def test_texts_cut_over_blocks_score_alike(spark, monkeypatch):
    monkeypatch.setattr(language_model, "RANGE_TOKENS", 300)
    rng = random.Random(2)
    data = [(i, " ".join(f"w{min(rng.randint(0, 40), rng.randint(0, 40))}" for _ in range(n)))
            for i, n in enumerate([700, 3, 0, 90, 400, 1, 260, 33])]
    data += [(50, None), (51, " \n "), (52, "x" * 900), (52, "x" * 900)]
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in data], DOCS).repartition(3)
    for order in (1, 2, 3):
        plain = Plain(data, order)
        want = [plain.row(i, t) for i, t in data]
        for part in (150, 1 << 20):
            same(language_model.score_texts(table, order, block_bytes=400, part_bytes=part).collect(), want)


def test_runs_start_in_the_state_they_would_have_reached(monkeypatch):
    rng = np.random.default_rng(1)
    words = np.sort(rng.integers(1, 1 << 62, 12).astype(np.uint64))
    sizes = [60, 2, 31]
    lids = np.concatenate([[0, *rng.integers(1, 12, n - 1)] for n in sizes]).astype(np.int32)
    row = {"hashes": words.tobytes(), "lids": language_model._packed(lids), "sizes": sizes, "lead": [1, 1, 1],
           "held_out": [False] * 3, "part": [0, 0, 0], "block": 0}
    import pyarrow as pa

    answers = []
    for m in range(3):
        block = language_model.Block(row, answers)
        if m:
            block.extend()
        sent = list(block.messages(2) if m else language_model._words_sent(block, 2))
        for r in {x["range"] for x in sent}:
            part = pa.Table.from_pylist([x for x in sent if x["range"] == r], language_model._SENT_ARROW)
            answers += language_model._owned(part, 2, 2.0).to_pylist()
    block = language_model.Block(row, answers)
    mass = len(lids) - 3 + 12
    auto = language_model.LocalAutomaton(block, 3, mass, 0.5)
    assert auto.length.max() == 2 and len(auto.fail) > 8
    whole = auto.traverse(block, 3, 1000)
    for run in (1, 2, 7, 30):
        assert np.allclose(auto.traverse(block, 3, run), whole)


def test_answers_cross_no_shuffle_once_they_are_stored(docs, spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    out = language_model.score_texts(docs)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get(key) == before


def test_numbers_are_coded_by_group_and_by_word():
    rng = np.random.default_rng(3)
    sizes = np.array([0, 4, 0, 1, 700, 0])
    words = np.concatenate([np.sort(rng.choice(1 << 20, n, replace=False)) for n in sizes])
    data = language_model._steps_within(words, sizes)
    assert (language_model._from_steps_within(data, sizes) == words).all()
    assert len(data) < len(language_model._packed(words))
    assert not len(language_model._from_steps_within(language_model._steps_within(words[:0], sizes[:1]), sizes[:1]))
    counts = 10_000_000 // (words + 1) + words % 3
    data = language_model._by_word(words, counts)
    assert (language_model._from_by_word(words, data) == counts).all()


def test_answers_hold_only_what_a_block_cannot_know():
    rng = np.random.default_rng(4)
    words = np.sort(rng.integers(1, 1 << 62, 40).astype(np.uint64))
    import pyarrow as pa

    def row(k, lids):
        return {"hashes": words.tobytes(), "lids": language_model._packed(np.array([0, *lids], np.int32)),
                "sizes": [len(lids) + 1], "lead": [1], "held_out": [False], "part": [0], "block": k}

    # the second block repeats a part of the first, which has one text more of the same words
    lids = rng.integers(1, 40, 3000)
    rows = [row(0, lids), row(1, lids[:400]), row(2, np.tile([1, 2, 3], 20))]
    answers = {k: [] for k in range(3)}
    for m in range(3):
        sent = []
        for k, r in enumerate(rows):
            block = language_model.Block(r, answers[k])
            if m:
                block.extend()
            sent += list(block.messages(2) if m else language_model._words_sent(block, 2))
        for r in {x["range"] for x in sent}:
            part = pa.Table.from_pylist([x for x in sent if x["range"] == r], language_model._SENT_ARROW)
            for a in language_model._owned(part, 2, 2.0).to_pylist():
                answers[a["block"]].append(a)
    blocks = [language_model.Block(r, answers[k]) for k, r in enumerate(rows)]
    rests = [np.concatenate([language_model._from_sparse(a["sums"]) for a in answers[k] if a["m"]])
             for k in range(3)]
    assert all(a["arcs"] is None for k in range(3) for a in answers[k] if a["m"])
    assert (rests[0][:, 0] > 0).sum() < (blocks[0].levels[0].sums[:, 0] > 0).sum() + (
        blocks[0].levels[1].sums[:, 0] > 0).sum()
    # where a block can fail, its sums are those over the arcs of all blocks
    for m in (1, 2):
        blocks = [language_model.Block(r, [a for a in answers[k] if a["m"] <= m])
                  for k, r in enumerate(rows)]
        total = {}
        for b in blocks:
            below, top = b.levels[m - 1], b.levels[m]
            for g in np.flatnonzero(top.count > 0):
                total.setdefault(below.id[top.context[g]], {})[b.levels[0].id[top.word[g]]] = (
                    top.count[g], below.count[top.suffix[g]])
        checked = 0
        for b in blocks:
            below, top = b.levels[m - 1], b.levels[m]
            fails = b.open()
            fails[top.context[top.count == 0]] = True
            for h in np.flatnonzero(fails & (below.id >= 0)):
                arcs = list(total.get(below.id[h], {}).values())
                want = [len(arcs), sum(c for c, _ in arcs), sum(x for _, x in arcs)]
                assert below.sums[h].tolist() == want
                checked += any(want)
        assert checked


def test_a_block_stores_frequent_words_first(spark, tmp_path):
    rows = spark.createDataFrame([(1, False, b"b a c a d a b e"), (2, True, None)],
                                 "doc_id long, held_out boolean, text binary").coalesce(1)
    table, _ = language_model._blocks(rows, 1 << 20, 1 << 20, 3)
    row = table.first().asDict()
    block = language_model._stored(row, [])
    name = {language_model.xxhash.xxh64_intdigest(w): w for w in
            (language_model.START, language_model.END, b"a", b"b", b"c", b"d", b"e")}
    words = [name[int(h)] for h in block.words]
    counts = np.bincount(block.lids, minlength=len(words))
    assert words[0] == language_model.START and words[1] == b"a" and (np.diff(counts[1:]) <= 0).all()
    assert [words[k] for k in block.lids] == [language_model.START, *b"b a c a d a b e".split(),
                                              language_model.END, language_model.START, language_model.END]


def test_numbers_are_packed_by_class():
    rng = np.random.default_rng(5)
    for values in (np.zeros(0, np.int64), np.arange(70_000), np.array([-1, 0, 2 ** 63 - 1, -2 ** 63, 15, 16, 17]),
                   rng.integers(0, 2 ** 63 - 1, 500), rng.integers(0, 300_000, 100_000)):
        assert (language_model._from_classed(language_model._classed(values))[:, 0] == values).all()
    # gaps of all lengths take few more bits than they differ in
    gaps = (2.0 ** rng.uniform(0, 16, 20_000)).astype(np.int64)
    sizes = np.full(20, 1000)
    words = np.cumsum(gaps.reshape(20, 1000), axis=1).ravel()
    assert (language_model._from_steps_within(language_model._steps_within(words, sizes), sizes) == words).all()
    assert len(language_model._steps_within(words, sizes)) < 20_000 * 1.48
    # sums whose arcs are counted about twice take little more than their arcs
    arcs = rng.integers(1, 200, 20_000)
    rows = np.stack([arcs, 2 * arcs + rng.integers(0, 2, 20_000), 2 * arcs + rng.integers(1, 3, 20_000)], axis=1)
    rows[::3] = 0
    data = language_model._sparse(rows)
    assert (language_model._from_sparse(data) == rows).all()
    assert len(data) < 1.5 * len(language_model._packed(arcs))


def test_hashes_and_messages_leave_the_disk(docs, spark):
    import os

    from wattspark.session import checkpoint_dir, local_path

    home = local_path(checkpoint_dir(spark))
    before = set(os.listdir(home))
    out = language_model.score_texts(docs)
    kept = {x.rsplit("-", 1)[0] for x in set(os.listdir(home)) - before}
    assert kept <= {"lm-texts", "lm-answers", "pyfiles"}
    assert "hashes" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == docs.count()


def test_a_block_without_hashes_knows_their_order(spark):
    rows = spark.createDataFrame([(1, False, " ".join(f"w{k % 97 % (k % 13 + 1)}" for k in range(900)).encode()),
                                  (2, True, None)], "doc_id long, held_out boolean, text binary").coalesce(1)
    for part in (1 << 20, 200):     # blocks of later parts of a text have no start
        table, _ = language_model._blocks(rows, part, part, 3)
        for row in table.collect():
            block = language_model._stored(row.asDict(), [])
            bare = language_model.Block(row.asDict() | {"hashes": None, "uses": language_model._uses(block)}, [])
            assert bare.words is None and (bare.order0 == block.order0).all()
