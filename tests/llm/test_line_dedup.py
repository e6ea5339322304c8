"""Line deduplication against a search of all earlier windows, without fingerprints."""

import random

from cirrolake.llm import line_dedup

SCHEMA = "doc_id bigint, text string, removed string, id int, key string"


def plain(rows, least):
    """Line numbers that go: those of every window with an earlier copy, extended along its first copy."""
    documents = sorted({(line_dedup.NO_ID if i is None else i, t or "") for i, t in rows}, key=lambda d: (d[0], key_of(d[1])))
    parsed = []
    for _, text in documents:
        lines = [line.strip() for line in text.split("\n")]
        places = [i for i, line in enumerate(lines) if line]
        parsed.append(([lines[i] for i in places], places))
    first, gone = {}, [set() for _ in documents]
    for d, (lines, places) in enumerate(parsed):
        for start in range(len(lines)):
            end, words = start, 0
            while end < len(lines) and words < least:
                words += len(lines[end].split())
                end += 1
            if words < least:
                break
            d0, start0 = first.setdefault(tuple(lines[start:end]), (d, start))
            if (d0, start0) != (d, start):
                other = parsed[d0][0]
                a, b = 0, end - start
                while start + a > 0 and start0 + a > 0 and lines[start + a - 1] == other[start0 + a - 1]:
                    a -= 1
                while start + b < len(lines) and start0 + b < len(other) and lines[start + b] == other[start0 + b]:
                    b += 1
                gone[d].update(range(places[start + a], places[start + b - 1] + 1))
    return {d: g for d, g in zip(documents, gone)}


def key_of(text):
    import xxhash

    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def check(spark, rows, least):
    df = spark.createDataFrame([(i, t, "r", 1, "k") for i, t in rows], SCHEMA)
    got = line_dedup.without_repeats(df, least)
    assert got.columns == ["doc_id", "text", "id", "key", "removed", "lines_removed"]
    expected = plain(rows, least)
    found = sorted(((r.doc_id, r.text, r.lines_removed) for r in got.collect()), key=str)
    wanted = []
    for i, t in rows:
        gone = expected[(line_dedup.NO_ID if i is None else i, t or "")]
        kept = None if t is None else "\n".join(line for n, line in enumerate(t.split("\n")) if n not in gone)
        wanted.append((i, kept, len(gone)))
    assert found == sorted(wanted, key=str)
    return found


def test_passages_of_all_kinds(spark):
    rng = random.Random(2)

    def line(n):
        return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))

    long, parts, short = line(12), [line(4), "  ", line(4), line(5)], line(6)
    rows = [(i, "\n".join(line(rng.randrange(1, 9)) for _ in range(rng.randrange(12)))) for i in range(30)]
    rows += [(100 + i, "\n".join([line(3), long, *parts, line(2)])) for i in range(5)]
    rows += [(200 + i, "\n".join([line(3), short, line(2), *parts[1:], ""])) for i in range(5)]
    rows += [(50, f"{line(2)}\n{long} \n{line(2)}\n  {long}"), (None, long), (None, None), (7, ""), (7, ""), (8, long), (8, long)]
    rows += [(300, "\n".join(["same line of five words"] * 3000)), (301, "\n".join(["same line of five words"] * 40))]
    found = check(spark, rows, 10)
    assert (None, long, 0) in found and (8, "", 1) in found


def test_random_corpora(spark):
    for seed in range(3):
        rng = random.Random(seed)
        lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 5))) for _ in range(12)]
        rows = [(rng.randrange(25), "\n".join(rng.choice(lines) for _ in range(rng.randrange(25)))) for _ in range(40)]
        check(spark, rows, 8)


def test_no_rows(spark):
    assert line_dedup.without_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_over_the_given_table(spark):
    from cirrolake.llm.queries import op4_line_dedup

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    expected = plain(rows, line_dedup.LEAST_WORDS)
    got = {r.doc_id: r.lines_removed for r in op4_line_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: len(gone) for (i, _), gone in expected.items()} and sum(got.values()) > 0


def test_minima_are_few_and_those_of_their_windows(spark):
    """Each selected minimum is the first smallest line of the windows from low to high, and of no other."""
    import numpy as np

    rng = random.Random(9)
    for n in (0, 1, 7, 400):
        hashes = np.array([rng.randrange(1 << 20) for _ in range(n)], np.uint64)
        words = np.array([rng.randrange(1, 9) for _ in range(n)], np.int32)
        ends, places = line_dedup.windows_of(hashes, words, 30)
        for start, (end, place) in enumerate(zip(ends, places)):
            assert words[start:end].sum() >= 30 > words[start : end - 1].sum()
            assert place == start + int(np.argmin(hashes[start:end]))
        assert words[len(ends) :].sum() < 30
    docs = spark.createDataFrame([(i, "\n".join(f"w{rng.randrange(10**6)} a b c d" for _ in range(300))) for i in range(20)], "doc_id bigint, text string")
    lines = line_dedup.line_table(docs, "doc_id", "text")
    assert 300 < line_dedup.fingerprints(lines, 50).count() < 20 * 300 / 4


def test_a_minimum_that_first_stands_in_other_company(spark):
    """One line with the smallest hash of all, first among other lines: the later copies still find each other."""
    import xxhash

    small = min((f"one line {i}" for i in range(5000)), key=lambda x: xxhash.xxh64_intdigest(x.encode()))
    ahead, behind = [f"ahead {i} of it" for i in range(4)], [f"behind {i} of it" for i in range(4)]
    alone = [f"other {i} words here" for i in range(4)]
    passage = "\n".join([*ahead, small, *behind])
    rows = [(1, "\n".join([*alone, small, *reversed(alone)]))] + [(i, f"begin {i}\n{passage}\nend {i}") for i in range(2, 8)]
    rows += [(9, "\n".join([*ahead[2:], small, *behind[:1]])), (10, "\n".join([*alone[1:], small, *behind]))]
    found = check(spark, rows, 10)
    assert {i: n for i, _, n in found}[5] == 9


def test_many_equal_lines(spark):
    """Thirty thousand equal lines, in one text and again in a later one, are compared in one piece each."""
    import time

    text = "\n".join(["same line of five words"] * 32_000)
    df = spark.createDataFrame([(1, text), (2, text + "\nend")], "doc_id bigint, text string")
    begin = time.perf_counter()
    got = {r.doc_id: (r.lines_removed, r.text) for r in line_dedup.without_repeats(df, 50).collect()}
    assert got == {1: (31_999, "same line of five words"), 2: (32_000, "end")}
    assert time.perf_counter() - begin < 60


def test_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a b c", 5, "x", "y"), (2, "a b c", 6, "z", "w")], "doc_id bigint, text string, __id int, __KEY string, hash string")
    got = line_dedup.without_repeats(df, 3).orderBy("doc_id").collect()
    assert [tuple(r)[:5] for r in got] == [(1, "a b c", 5, "x", "y"), (2, "", 6, "z", "w")]
