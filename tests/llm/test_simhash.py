"""SimHash against brute force: every pair compared, components by union-find."""

import random

import pytest
import xxhash

from cirrolake.llm import simhash

SCHEMA = "doc_id bigint, text string, fingerprint string, component_id int"


def plain_print(text):
    tokens = (text or "").encode().lower().split()
    pieces = [b" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, distance=3):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(ids))]


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "other", 1) for i, t in rows], SCHEMA)
    found = simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()
    found = sorted(map(tuple, found), key=str)
    prints = [plain_print(t) for _, t in rows]
    expected = plain_components([i for i, _ in rows], prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    assert found == sorted(((i, p, c) for (i, _), p, c in zip(rows, signed, expected)), key=str)
    return found


def test_texts_of_all_kinds(spark):
    rng = random.Random(1)
    base = [rng.choice(["ab", "cd", "Ef", "é", "ß"]) + str(rng.randrange(300)) for _ in range(400)]
    rows = [(100 + k, " ".join(base[:k] + ["x"] + base[k + 1 :])) for k in range(0, 200, 9)]
    rows += [(7, None), (8, ""), (9, " \t\n"), (5, "one"), (5, "one"), (6, "one two"), (None, "one"), (None, "alone 1 2 3")]
    rows += [(2, "w " * 70000), (1, "W " * 70001), (3, "a b c d"), (4, "A B c d")]
    check(spark, rows)


def test_no_rows(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("largest", [2048, 2])
def test_links_connect_what_brute_force_connects(spark, largest):
    rng = random.Random(largest)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(150)}
    prints |= {rng.getrandbits(64) for _ in range(50)} | {0, (1 << 64) - 1}
    prints = sorted(prints)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint bigint")
    got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(df, largest=largest).collect()]
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in got:
        root[max(find(a), find(b))] = min(find(a), find(b))
    expected = plain_components(prints, prints)
    assert [find(p) for p in prints] == expected


def test_query_over_the_given_table(spark):
    from cirrolake.llm.queries import op3_simhash

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_print(r.text) for r in rows]
    expected = zip([r.doc_id for r in rows], prints, plain_components([r.doc_id for r in rows], prints))
    got = {(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in op3_simhash(spark, "/root/testdata/sf0.001").collect()}
    assert got == set(expected)


def test_one_of_each_group_stays(spark):
    rows = [(4, "a b c d"), (2, "A B c d"), (2, "A B c d"), (None, "a b c d"), (None, "x y z"), (None, "p q r s"), (9, None), (8, "")]
    df = spark.createDataFrame([(i, t, "f", 1) for i, t in rows], SCHEMA)
    kept = sorted(((r.doc_id, r.text) for r in simhash.one_of_each(df).collect()), key=str)
    assert kept == sorted([(2, "A B c d"), (None, "x y z"), (None, "p q r s"), (8, "")], key=str)


def test_columns_of_any_name_stay(spark):
    df = spark.createDataFrame([(1, "a b c", 5, "x", "y"), (2, "a b c", 6, "z", "w")], "doc_id bigint, text string, __id int, __KEY string, __text string")
    assert [tuple(r) for r in simhash.one_of_each(df).collect()] == [(1, "a b c", 5, "x", "y")]
