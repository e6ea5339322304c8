"""Substring deduplication against counts of all windows."""

import random
from collections import Counter

import pytest

from cirrolake.llm import substring_dedup
from cirrolake.llm.common import written

SCHEMA = "doc_id bigint, text string, kept int, n_words string, block string, shard int"


def plain(texts, length):
    """(number of words, words that stay, ranges that go) of every text."""
    parsed = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in parsed for i in range(len(w) - length + 1))
    result = []
    for w in parsed:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        edges = [i for i in range(len(w) + 1) if (0 < i and gone[i - 1]) != (i < len(w) and gone[i])]
        result.append((len(w), b" ".join(x for x, g in zip(w, gone) if not g).decode(), list(zip(edges[::2], edges[1::2]))))
    return result


def check(spark, texts, length, first, parts=2):
    rows = [(n, t, 1, "n", "b", 2) for n, t in enumerate(texts)]
    found = substring_dedup.without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(parts), length, first).collect()
    got = {r.doc_id: (r.n_words, r.kept, [tuple(s) for s in r.removed]) for r in found}
    assert len(found) == len(texts) and got == dict(enumerate(plain(texts, length)))
    assert all(r.n_removed == sum(e - s for s, e in r.removed) for r in found)
    return got


def random_texts(seed, n=40, vocabulary=6, most=30):
    rng = random.Random(seed)
    return [rng.choice((" ", "\n", "\t ")).join(rng.choices("abcdefgh"[:vocabulary], k=rng.randrange(most))) for _ in range(n)]


@pytest.mark.parametrize(("length", "first"), [(5, 1), (7, 2), (6, 3), (4, 9), (2, 1), (1, 1)])
def test_like_counting_all_windows(spark, length, first):
    check(spark, random_texts(length, vocabulary=4 if length > 4 else 8), length, first)


def test_levels_double():
    assert substring_dedup.levels(35) == [18, 35]
    assert substring_dedup.levels(35, 1) == [1, 2, 3, 5, 9, 18, 35]
    assert substring_dedup.levels(1) == [1] and substring_dedup.levels(64, 16) == [16, 32, 64]


def test_small_blocks_and_many_shards(spark, monkeypatch):
    """Repeats are found across blocks, within them, and both."""
    cut = lambda: monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 60)
    cut()
    monkeypatch.setattr(substring_dedup, "WINDOWS_PER_SHARD", 50)
    texts = random_texts(1) + ["x y z u v w"] * 3 + ["p q r s t p q r s t"]
    got = check(spark, texts, 5, 2, parts=3)
    assert got[len(texts) - 1][1] == ""


def test_nulls_empty_short_and_repeated_rows(spark):
    texts = [None, "", "  \n", "a b c d", "a b c d e", "é ü 漢 字 ß", "é ü 漢", "A b c d e", "a  b\tc\x0bd\x0ce"]
    got = check(spark, texts, 5, 2)
    assert got[4][1] == "" and got[8][1] == "" and got[7][1] == "A b c d e" and got[0] == (0, "", [])
    rows = [(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (7, "other words than those above")]
    found = substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), 5, 2).collect()
    assert sorted((str(r.doc_id), r.kept) for r in found) == [("7", ""), ("7", ""), ("7", "other words than those above"), ("None", "")]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.without_repeats(none).collect() == []


def test_same_text_within_itself(spark):
    """A text of one word: all windows overlap and are equal."""
    check(spark, ["w " * 300, "v", "w " * 34], 35, 16)


def test_very_long_texts(spark):
    rng = random.Random(3)
    long = " ".join(str(rng.randrange(10**6)) for _ in range(60_000))
    passage = " ".join(long.split()[30_000:30_050])
    got = check(spark, [long, "y" * 3_000_000, f"before {passage} after"], 35, 16)
    assert got[0][0] - len(got[0][1].split()) == 50 and got[2][1] == "before after"


def test_candidates_shrink_from_level_to_level(spark):
    """The second level counts only windows whose halves are repeated."""
    rng = random.Random(5)
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(200)) for _ in range(5)]
    texts.append(" ".join(texts[0].split()[:20]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    blocks = written(substring_dedup.blocks_of(docs.repartition(2)), "blocks")

    def entries(k, verdict):
        cells = substring_dedup.cells_of(blocks, verdict, [18, 35], k, 1)
        kind = "uint64" if k else "uint32"
        return sum(len(substring_dedup.unpacked(r.mains, kind)) for r in cells.where("shard >= 0").collect()), cells

    first, cells = entries(0, None)
    assert first >= 5 * 183
    second, _ = entries(1, substring_dedup.verdicts_of(cells, False))
    assert second == 0
