"""Unigram token counts against a plain Viterbi search, pre-token by pre-token."""

import random

import public_tokenizers as P
import pytest
import regex

from cirrolake.llm import token_counts
from cirrolake.llm.bpe import read_ranks

PATH = P.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id bigint, text string, n_tokens string, score int"


@pytest.fixture(scope="module")
def counter(spark):
    return token_counts.shared_counter(spark, PATH, P.PATTERN)


def plain_count(scores, longest, piece, known={}):  # noqa: B006
    if piece not in known:
        best = [(0, 0)]
        for end in range(1, len(piece) + 1):
            ways = []
            for start in range(max(0, end - longest), end):
                own = scores.get(piece[start:end])
                if own is not None:
                    ways.append((best[start][0] + own, -best[start][1] - 1))
            score, tokens = max(ways)
            best.append((score, -tokens))
        known[piece] = best[-1][1]
    return known[piece]


def expected(counter, texts):
    scores = counter.value.scores
    longest = max(map(len, scores))
    return [sum(plain_count(scores, longest, p.encode()) for p in regex.findall(P.PATTERN, t or "")) for t in texts]


def test_texts_of_all_kinds(spark, counter):
    rng = random.Random(6)
    texts = ["".join(rng.choice("etaoin shr ÄéßD漢🙂\n\t 01.,'") for _ in range(rng.randrange(150))) for _ in range(150)]
    texts += ["", None, "a" * 3000, " " * 2000, "word " * 250_000, "and the and there therefore"]
    rows = list(enumerate(texts)) + [(3, "again"), (3, "again"), (None, "no id")]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA)
    got = sorted(map(tuple, token_counts.counted(df, counter).collect()), key=str)
    wanted = expected(counter, [t for _, t in rows])
    assert got == sorted(((i, n) for (i, _), n in zip(rows, wanted)), key=str)


def test_no_rows(spark, counter):
    assert token_counts.counted(spark.createDataFrame([], SCHEMA), counter).collect() == []


def test_restarting_changes_nothing(counter, monkeypatch):
    texts = ["some words here", "other words there", "some other"] * 3
    wanted = expected(counter, texts)
    monkeypatch.setattr(token_counts, "KEPT_TOKENS", 2)
    own = token_counts.UnigramCounter(read_ranks(PATH), P.PATTERN)
    assert [own.count(t) for t in texts] == wanted


def test_query_over_the_given_table(spark, counter):
    from cirrolake.llm.queries import op8_token_counts

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in op8_token_counts(spark, "/root/testdata/sf0.001").select("doc_id", "n_tokens").collect()}
    assert got == set(zip([r.doc_id for r in rows], expected(counter, [r.text for r in rows])))


def test_long_pre_tokens_need_no_nodes(counter):
    """Both ways count alike, and a pre-token of a megabyte leaves the trie as it was and takes little memory."""
    import tracemalloc

    rng, own = random.Random(8), counter.value
    own.count("a word")
    for size in (1, 2, 300, 1500):
        piece = "".join(rng.choice("etaoinshr") for _ in range(size)).encode()
        assert own.alone(piece) == own.insert(piece) == plain_count(own.scores, max(map(len, own.scores)), piece)
    text, nodes = "".join(rng.choice("etaoinshr") for _ in range(1 << 20)), own.nodes
    tracemalloc.start()
    assert own.count(text) > 1 << 17
    assert tracemalloc.get_traced_memory()[1] < 16 << 20 and own.nodes == nodes
    tracemalloc.stop()


def test_one_text_does_not_outgrow_the_trie(counter, monkeypatch):
    rng, own = random.Random(9), counter.value
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(12)) for _ in range(3000))
    own._restart()
    whole = own.count(text)
    monkeypatch.setattr(token_counts, "KEPT_NODES", 500)
    own._restart()
    assert own.count(text) == whole and own.nodes <= 520
