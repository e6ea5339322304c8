"""Language-model scores: exact parts against plain counting, the filter against exact counts, the model on held-out text."""

import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cirrolake.llm import language_model as lm

SCHEMA = "doc_id bigint, text string, learnt string, score int"


def tokens(text):
    return [*(text or "").encode().lower().split(), b"<end>"]


def plain_base(rows, learn):
    counts = Counter(t for i, text in rows if learn(i) for t in tokens(text))
    total, different = sum(counts.values()), len(counts)
    found = []
    for i, text in rows:
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (different + 1))) for t in tokens(text))
        found.append((i, len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), total, round(base, 6)))
    return sorted(found, key=str)


def base_of(rows):
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=str)


def sample_rows():
    rng = random.Random(8)
    phrase = [f"rare{i}" for i in range(60)]
    rows = []
    for i in range(200):
        found = [f"w{int(rng.paretovariate(0.8)) % 3000}" for _ in range(rng.randrange(1, 80))]
        if i % 10 < 2:
            found += phrase
        rows.append((i, " ".join(found)))
    return rows + [(500, None), (501, ""), (502, "Nowhere ELSE"), (503, "w1 " * 100_000), (7, "twice"), (7, "twice"), (None, "no id")]


def test_exact_parts_and_order_of_groups(spark):
    rows = sample_rows()
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA)
    one = lm.scored(df, F.col("doc_id") % 4 != 1).collect()
    assert base_of(one) == plain_base(rows, lambda i: i is not None and i % 4 != 1)
    several = lm.scored(df.repartition(3), F.col("doc_id") % 4 != 1, group_bytes=2000).collect()
    scores = lambda found: sorted(((r.doc_id, r.n_tokens, round(r.score, 6)) for r in found), key=str)
    assert scores(one) == scores(several)


def test_known_phrases_score_above_the_base(spark):
    rows = sample_rows()
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA)
    got = {r.doc_id: r for r in lm.scored(df, F.col("doc_id") % 4 != 1).collect()}
    for i in (1, 21, 41, 61):
        assert got[i].score > got[i].base_score + 20
    assert all(r.score <= 0 for r in got.values())


def test_filter_returns_levels():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << lm.KEY_BITS, 20000).astype(np.uint64))
    counts = np.minimum(1 + rng.pareto(1, len(keys)), 1e6).astype(np.int64)
    back = lm._unpacked(*lm._packed(keys, counts))
    assert (back[0] == keys).all() and (back[1] == counts).all()
    levels = lm.levels_of(counts)
    bits = np.uint64(8 * (int(levels.sum()) * lm.BITS_PER_ENTRY // 8))
    data = np.zeros(int(bits), bool)
    for level in range(1, levels.max() + 1):
        for at in lm._places(keys[levels >= level], np.uint64(level), bits):
            data[at] = True
    made = lm.CountFilter(1, np.zeros(2, np.uint64), np.full(2, bits, np.uint64), np.packbits(data, bitorder="little").tobytes())
    got = made.levels(keys)
    assert (got >= levels).all() and (got == levels).mean() > 0.95
    other = np.setdiff1d(rng.integers(0, 1 << lm.KEY_BITS, 20000).astype(np.uint64), keys)
    assert (made.levels(other) > 0).mean() < 0.04


def test_no_rows_and_nothing_to_learn(spark):
    assert lm.scored(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []
    df = spark.createDataFrame([(1, "a b", "x", 0)], SCHEMA)
    (row,) = lm.scored(df, F.lit(False)).collect()
    assert (row.train_tokens, row.n_known, row.base_score, row.score) == (0, 0, 0.0, 0.0)


def test_query_over_the_given_table(spark):
    from cirrolake.llm.queries import op1_language_model

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    got = op1_language_model(spark, "/root/testdata/sf0.001").collect()
    assert base_of(got) == plain_base(rows, lambda i: not held(i))
    assert all(r.held_out == held(r.doc_id) for r in got)
