"""The pipeline stage by stage against brute force on its own input."""

from collections import Counter, defaultdict

import brute
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspark.llm import quality
from wattspark.llm.common import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), "test-stage"))
    return out


def test_stages_chain(stages, spark):
    assert len(corpus_pipeline.STAGES) == 5
    for out in stages[1:-1]:
        assert out.schema.simpleString() == stages[0].schema.simpleString()
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(repr, run.collect())) == sorted(map(repr, stages[-1].collect()))


def test_quality_stage_drops_what_the_operator_rejects(stages, spark):
    field = quality.train_field(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    kept = quality.label_quality(stages[0], field).filter("kept").select("doc_id").collect()
    assert Counter(kept) == Counter(stages[1].select("doc_id").collect())
    assert 0 < len(kept) < stages[0].count()


def test_duplicate_stages(stages):
    before, exact, near = (s.collect() for s in stages[1:4])
    first = {}
    for r in before:
        key = brute.normal(r.text)
        first[key] = min(first.get(key, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(first.values())
    order = sorted(exact, key=lambda r: r.doc_id)
    roots = brute.near_groups([brute.simhash(r.text) for r in order], 2)
    assert sorted(r.doc_id for r in near) == sorted({order[k].doc_id for k in roots})


def test_mix_stage_meets_its_targets(stages):
    before, after = stages[3].collect(), stages[4].collect()
    sizes, got = Counter(), Counter()
    for r in before:
        sizes[r.source] += len(brute.words(r.text))
    for r in after:
        got[r.source] += len(brute.words(r.text))
        assert r.n_chars == len(r.text)
    keys = sorted(sizes, key=lambda k: (k is None, k))
    want = brute.targets(sizes, {k: 1 + i % 3 for i, k in enumerate(keys)}, 3)
    assert all(abs(got[k] - want[k]) <= 0.01 * want[k] + 50 for k in keys)
    assert max(Counter(r.doc_id for r in after).values()) <= 3


def test_packed_stage_holds_all_tokens(stages):
    docs, out = stages[4], stages[5].collect()
    assert Counter(r.doc_id for r in out if r.piece == 0) == Counter(
        r.doc_id for r in docs.collect())
    load = Counter()
    for r in out:
        load[r.sequence_id] += r.length
    assert max(load.values()) <= 1024


def test_sequences_are_rebuilt_from_the_output(stages):
    from wattspark.llm import packing

    encode = packing.encoder(*packing.vocabulary_paths())
    end = np.array([packing.END_ID], "<u4").tobytes()
    want = Counter(encode(r.text or "") + end for r in stages[4].collect())
    out = stages[5].collect()
    sequences, texts = defaultdict(bytearray), defaultdict(list)
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert len(sequences[r.sequence_id]) == 4 * r.offset and len(r.ids) == 4 * r.length
        sequences[r.sequence_id] += r.ids
    for r in out:
        texts[r.doc_id].append((r.piece, bytes(r.ids)))
    whole = Counter()
    for pieces in texts.values():
        pieces.sort(key=lambda x: x[0])
        if sum(p == 0 for p, _ in pieces) == 1:          # repeated documents: checked by count below
            whole[b"".join(b for _, b in pieces)] += 1
    assert whole and all(want[t] for t in whole)
    assert sum(map(len, sequences.values())) == sum(len(t) * n for t, n in want.items())


def test_extra_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    own = {c: F.lit("own") for c in ("__k", "__n", "__h", "__takes", "__b", "row", "block", "shard", "in_x")}
    wide = docs.withColumns(own)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns and set(out.select("__takes", "in_x").distinct().collect()) == {("own", "own")}
        assert sorted(map(repr, out.drop(*own).collect())) == sorted(map(repr, stage(spark, docs, SF).collect()))
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
