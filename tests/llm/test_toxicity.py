"""The kernel against its definition, and held-out accuracy of the machine."""

import itertools
import random
import zlib

import numpy as np

from cirrolake.llm import toxicity

SCHEMA = "doc_id bigint, text string, score string, label int"


def plain_kernel(a, b, decay):
    def occurrences(word):
        found = {}
        for at in itertools.combinations(range(len(word)), 3):
            key = "".join(word[i] for i in at)
            found[key] = found.get(key, 0.0) + decay ** (at[2] - at[0] + 1)
        return found

    x, y = occurrences(a), occurrences(b)

    def inner(p, q):
        return sum(v * q.get(k, 0.0) for k, v in p.items())

    scale = (inner(x, x) * inner(y, y)) ** 0.5
    return inner(x, y) / scale if scale else 0.0


def test_kernel_is_the_gap_weighted_one():
    triples = toxicity.Triples(0.6)
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdz") for _ in range(rng.randrange(1, 12))) for _ in range(40)] + ["abcabcabc", "aaaa"]
    table = triples.table(words)
    got = triples.project(words, table)
    for i, j in itertools.product(range(len(words)), repeat=2):
        assert abs(got[i, j] - plain_kernel(words[i], words[j], 0.6)) < 1e-6


def test_units_and_tokens():
    assert toxicity.units("***idiot%%") == ["\x01idiot\x02"]
    long = "x" * 50
    cut = toxicity.units(long)
    assert all(len(u) <= toxicity.LONGEST for u in cut) and cut[0][0] == "\x01" and cut[-1][-1] == "\x02"
    assert "idiot" in toxicity.tokens("an i d i o t here")


def corpus(seed, n, insults):
    rng = random.Random(seed)
    syllables = ["ta", "ri", "no", "bel", "sho", "and", "er", "mi", "lu"]
    rows = []
    for i in range(n):
        found = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(20, 80))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(3):
                found.insert(rng.randrange(len(found)), rng.choice(insults))
        rows.append((i, " ".join(found), "x", toxic))
    return rows


def test_held_out_and_disguised_insults(spark):
    rows = corpus(1, 600, ["idiot", "moron", "worthless", "pathetic"])
    df = spark.createDataFrame(rows, SCHEMA)
    labels = df.where("doc_id % 5 <> 0").select("doc_id", "label")
    model = toxicity.fit(df, labels)
    got = {r.doc_id: r.score for r in toxicity.scored(df, model).collect()}
    held = [(got[i] >= 0.5, bool(y)) for i, _, _, y in rows if i % 5 == 0]
    assert np.mean([p == y for p, y in held]) > 0.95
    odd = [(1, "tari nobel idi-ot and er"), (2, "tari worthhless er and"), (3, "tari nobel and er"), (4, ""), (5, None), (None, "a")]
    odd += [(6, "x" * 100_000), (7, "mo.ron " * 2000), (7, "mo.ron " * 2000)]
    scores = [(r.doc_id, r.score) for r in toxicity.scored(spark.createDataFrame([(*r, "x", 0) for r in odd], SCHEMA), model).collect()]
    assert len(scores) == len(odd) and all(0 <= s <= 1 for _, s in scores)
    by_id = dict(scores)
    assert min(by_id[1], by_id[2], by_id[7]) > 0.5 > max(by_id[3], by_id[4], by_id[5])


def test_no_labels_and_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1, "some text", "x", 1)], SCHEMA)
    assert toxicity.fit(one, one.select("doc_id", "label")) is None
    assert toxicity.fit(empty, empty.select("doc_id", "label")) is None
    assert [r.score for r in toxicity.scored(one, None).collect()] == [0.0]
    model = toxicity.train([(["\x01idiot\x02", "\x01one\x02"], 1), (["\x01one\x02", "\x01two\x02"], 0)])
    assert toxicity.scored(empty, model).collect() == []


def test_query_over_the_given_table(spark):
    from cirrolake.llm.queries import op7_toxicity

    got = op7_toxicity(spark, "/root/testdata/sf0.001").collect()
    ids = [r.doc_id for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sorted(r.doc_id for r in got) == sorted(ids)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in got)


def test_fit_streams_the_sample_and_learns_the_same(spark, monkeypatch):
    """The driver gets the labelled sample one partition at a time, as units; the model is the one from all rows at once."""
    rows = corpus(2, 300, ["idiot", "moron", "worthless", "pathetic"])
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    labels = df.where("doc_id % 5 <> 0").select("doc_id", "label")
    whole = [(f, y) for f, y in toxicity.labelled_sample(df.select("doc_id", "text"), labels, 1800, 1000).collect()]
    expected = toxicity.train(sorted((sorted({u for t in f for u in toxicity.units(t) if len(u) > 2}), y) for f, y in whole))

    def refused(self):
        raise AssertionError("the whole sample went to the driver at once")

    monkeypatch.setattr(type(df), "collect", refused)
    model = toxicity.fit(df, labels)
    assert np.array_equal(model.weights, expected.weights)
    assert (model.bias, model.slope, model.offset) == (expected.bias, expected.slope, expected.offset)
