"""Byte-level BPE against the public library, and its round trip."""

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from cirrolake.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id bigint, text string, ids string, decoded int"


@pytest.fixture(scope="module")
def library():
    ranks = {token: rank for rank, token in enumerate(bpe.read_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec(spark):
    return bpe.shared_codec(spark, PATH, P.PATTERN)


def texts():
    rng = random.Random(3)
    letters = "etaoin shrdlu ETÄé ß漢字🙂\n\t 0123.,'<|>"
    found = ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(300)]
    return found + ["", None, "a" * 3000, " " * 5000, "<|endoftext|>", "I'll we've\r\n\r\n  x", "é" * 999, "word " * 300_000]


def test_ids_and_round_trip(spark, codec, library):
    rows = list(enumerate(texts())) + [(3, "again"), (3, "again"), (None, "no id")]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in bpe.round_trip(df, codec).collect()), key=str)
    expected = sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=str)
    assert got == expected
    encoded = bpe.encode(df, codec)
    back = sorted(((r.doc_id, bytes(r.decoded)) for r in bpe.decode(encoded, codec).collect()), key=str)
    assert back == sorted(((i, t) for i, _, t in expected), key=str)


def test_no_rows(spark, codec):
    assert bpe.round_trip(spark.createDataFrame([], SCHEMA), codec).collect() == []


def test_both_engines_split_alike():
    import regex

    plain, full = bpe.plain_pattern(P.PATTERN), regex.compile(P.PATTERN)
    rng = random.Random(9)
    letters = [chr(c) for c in range(bpe.PLAIN_BELOW)]
    common = list("aé ß1²'  \n\t\x85\xa0\x1c.,stremvld")
    for n in range(3000):
        text = "".join(rng.choice(letters if rng.random() < 0.3 else common) for _ in range(rng.randrange(40)))
        assert plain.findall(text) == full.findall(text)
    every = " ".join(letters) + "".join(letters)
    assert plain.findall(every) == full.findall(every)
    assert bpe.plain_pattern(r"\w+") is None and bpe.plain_pattern(r"(?i)a") is None and bpe.plain_pattern(r"[\S]") is None


def test_null_lists_decode_to_nothing(spark, codec, library):
    df = spark.createDataFrame([(1, None), (2, []), (3, library.encode_ordinary("à la")), (4, None)], "doc_id bigint, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode(df.coalesce(1), codec).collect()}
    assert got == {1: b"", 2: b"", 3: "à la".encode(), 4: b""}


def test_perfect_hash_is_minimal():
    tokens = bpe.read_ranks(PATH)
    table = bpe.PerfectHash(tokens)
    assert sorted(table.slots) == list(range(len(tokens)))
    assert all(table.find(token) == number for number, token in enumerate(tokens))
    assert table.find(b"surely not in it") == -1
    assert bpe.PerfectHash([b"only"]).find(b"only") == 0


def test_query_over_the_given_table(spark, library):
    from cirrolake.llm.queries import op5_byte_bpe

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    expected = set()
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.add((r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert {tuple(r) for r in op5_byte_bpe(spark, "/root/testdata/sf0.001").collect()} == expected
