"""Order MinHash against a plain Python account of it."""

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from cirrolake.llm import order_minhash

SCHEMA = "doc_id bigint, text string, signature string, part int"
M = (1 << 64) - 1


def long_hash(value, seed=42):
    return xxhash.xxh64_intdigest(value.to_bytes(8, "little"), seed)


def int_hash(value, seed):
    """Spark hashes an int as four bytes."""
    return xxhash.xxh64_intdigest(value.to_bytes(4, "little"), seed)


def plain_signature(text, words=3, count=32, size=2):
    tokens = [t for t in re.split(r"[ \t\n\x0b\f\r]+", text) if t]
    singles = [xxhash.xxh64_intdigest(t.encode(), 42) for t in tokens]
    grams = []
    for i in range(len(singles)):
        h = 42
        for x in singles[i : i + words]:
            h = long_hash(x, h)
        grams.append(h)
    seen, entries = {}, []
    for place, g in enumerate(grams):
        key = g >> 32
        occurrence = seen[key] = seen.get(key, -1) + 1
        entries.append((int_hash(occurrence, long_hash(key)) >> 32, place))
    signature = []
    for b in range(count):
        chosen = sorted(e for e in entries if e[0] >> 27 == b)[:size]
        h = 42
        for place in sorted(p for _, p in chosen):
            h = long_hash(grams[place], h)
        signature.append(h & 0xFFFFFFFF if chosen else -1)
    return signature


def plain_likeness(a, b):
    used = [(x, y) for x, y in zip(a, b) if x >= 0 or y >= 0]
    return sum(x == y for x, y in used) / len(used) if used else 1.0


def plain_rows(rows):
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    found = []
    for at, (i, text) in enumerate(ordered):
        other = ordered[(at + 1) % len(ordered)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        found.append((i, text, edited, plain_signature(text), plain_signature(edited), plain_signature(other)))
    return found


def check(spark, rows, **how):
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA)
    got = order_minhash.beside_next(df, **how).select("doc_id", "text", "edited", "signature", "edited_signature", "next_signature")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain_rows(rows), key=str)


def test_texts_of_all_kinds(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(120)))) for i in range(0, 60, 2)]
    rows += [(3, None), (5, ""), (7, " \n\t "), (9, "é漢🙂 ab c"), (9, "é漢🙂 ab c"), (9, "tie"), (None, "no id"), (None, None)]
    rows += [(1001, "same " * 5000), (1000, " ".join(f"x{i % 700}" for i in range(20000)))]
    check(spark, rows)
    check(spark, rows, rows_each=5)


def test_single_row_and_no_rows(spark):
    check(spark, [(1, "abc def ghi jkl")])
    assert order_minhash.beside_next(spark.createDataFrame([], SCHEMA)).collect() == []


def test_order_is_felt(spark):
    rng = random.Random(9)
    parts = [" ".join(f"p{i}w{rng.randrange(9999)}" for _ in range(40)) for i in range(8)]
    rows = [(1, " ".join(parts)), (2, " ".join(reversed(parts))), (3, " ".join(parts[:7] + ["other words here"]))]
    df = order_minhash.fingerprints(spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA))
    one = df.where("doc_id = 1").select(F.col("signature").alias("one"))
    pairs = df.where("doc_id > 1").crossJoin(one).select("doc_id", order_minhash.likeness(F.col("one"), F.col("signature")).alias("like"))
    like = dict(map(tuple, pairs.collect()))
    assert like[3] > like[2]


def test_query_over_the_given_table(spark):
    from cirrolake.llm.queries import op9_order_minhash

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    name = lambda s: "".join("--------" if x < 0 else f"{x:08x}" for x in s)
    expected = {
        (i, len(t), hashlib.sha256(e.encode()).hexdigest(), name(a), name(b), plain_likeness(a, b), plain_likeness(a, c))
        for i, t, e, a, b, c in plain_rows(rows)
    }
    assert {tuple(r) for r in op9_order_minhash(spark, "/root/testdata/sf0.001").collect()} == expected
