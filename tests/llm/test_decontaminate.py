"""Decontamination on copies, questions with other values, chance likeness, and against brute force."""

import collections
import re

from pyspark.sql import functions as F

from cirrolake.llm import decontaminate

DOCS = "doc_id bigint, text string, plain string, window int, item string"
ITEMS = "item_id bigint, text string, template int"
QUESTION = (
    "A train leaves the station at 60 miles per hour and then travels 180 miles before it meets Anna, who walks 5 km each "
    "day; how many hours does the journey take if it stops for 60 minutes?"
)


def found(spark, docs, items, **how):
    docs = spark.createDataFrame([(i, t, "p", 1, "x") for i, t in docs], DOCS)
    items = spark.createDataFrame([(i, t, 2) for i, t in items], ITEMS)
    rows = decontaminate.contaminated(docs, items, **how).collect()
    clean = sorted((r.doc_id for r in decontaminate.clean(docs, items).collect()), key=str)
    return {(r.doc_id, r.item_id): (r.kind, r.changed) for r in rows}, clean


def test_copies_and_other_values(spark):
    other = QUESTION.replace("60", "45").replace("180", "1,350").replace("Anna", "Boris").replace("5 km", "7.5 miles")
    chance = QUESTION.replace("at 60", "at 45").replace("for 60", "for 30")
    half = " ".join(QUESTION.split()[:8])
    docs = [
        (1, f"Some words first.\n{QUESTION} And more."), (2, f"Before.\n{other} After."), (3, f"Before. {chance}"), (4, half),
        (5, QUESTION.upper()), (6, QUESTION.replace(" ", "\n  ")), (7, None), (8, ""), (9, "Nothing of the kind."),
        (10, "word " * 50_000 + QUESTION), (11, QUESTION), (11, QUESTION), (None, QUESTION),
    ]
    got, clean = found(spark, docs, [(70, QUESTION), (71, None), (72, ""), (None, "without an id but with many words here")])
    assert {k: v[0] for k, v in got.items() if k[0] != 2} == {(i, 70): "verbatim" for i in (1, 5, 6, 10, 11, None)}
    assert got[2, 70][0] == "re-parameterised" and got[2, 70][1] >= 4
    assert clean == sorted([3, 4, 7, 8, 9], key=str)


def test_ties_short_items_and_empty_tables(spark):
    got, clean = found(spark, [(1, "short text"), (2, "has short text inside")], [(5, "short text"), (6, "Short text!")])
    assert set(got) == {(1, 5), (1, 6)} and clean == [2]
    assert found(spark, [], [(5, "some words of an item")]) == ({}, [])
    assert found(spark, [(1, "some words of an item")], []) == ({}, [1])


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    docs, items = [(1, QUESTION), (None, QUESTION), (2, "Nothing.")], [(70, QUESTION)]
    sent = found(spark, docs, items)
    monkeypatch.setattr(decontaminate, "SENT_ROWS", 0)
    assert found(spark, docs, items) == sent


def test_template_words_stay_side_by_side(spark):
    texts = ["At 3.14 km, Anna O'Brien saw 1,000 m2 of land; five days, B2B 50%.", "ÉTÉ à Paris le 5 mai", "..", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(decontaminate.plain(F.col("text")).alias("p"))
    rows = df.select(decontaminate.template(df.p).alias("t"), decontaminate.words_of(df.p).alias("w")).collect()
    assert all(len(r.t) == len(r.w) for r in rows)
    assert rows[0].t[:4] == ["at", decontaminate.NUMBER, decontaminate.UNIT, decontaminate.NAME]


def test_query_over_the_given_table(spark):
    from cirrolake.llm.queries import op2_decontamination

    sf = "/root/testdata/sf0.01"
    windows, totals = collections.defaultdict(set), {}
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        words = re.findall(r"\w+", r.text.lower())
        runs = {tuple(words[j : j + 5]) for j in range(len(words) - 4)}
        totals[r.item_id] = len(runs)
        for run in runs:
            windows[run].add(r.item_id)
    expected = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words = re.findall(r"\w+", r.text.lower())
        counts = collections.Counter(i for run in {tuple(words[j : j + 5]) for j in range(len(words) - 4)} for i in windows.get(run, ()))
        expected |= {(r.doc_id, i) for i, n in counts.items() if n >= totals[i] / 2}
    assert {(r.doc_id, r.item_id) for r in op2_decontamination(spark, sf).collect()} == expected and expected


def test_items_without_a_template_window(spark):
    sums, names, short = "What is 12 + 30 + 7 + 4?", "Then Anna, Boris, Clara, Dora, Emil met.", "seven plus eight"
    docs = [
        (1, sums), (2, f"Some words before. {sums} And some after."), (3, "What is 13 + 31 + 8 + 5?"), (4, f"So {names.upper()} Again."),
        (5, f"Say how much {short} is."), (6, "seven plus nine"), (7, "12 km"), (8, "It is 12 km from here."), (9, "Nothing of the kind."),
        (10, "A red car\nstops here"),
    ]
    got, clean = found(spark, docs, [(70, sums), (71, names), (72, short), (73, "12 km"), (74, "a red car stops")])
    assert set(got) == {(1, 70), (2, 70), (4, 71), (5, 72), (7, 73), (10, 74)}
    assert set(got.values()) == {("verbatim", 0)} and clean == [3, 6, 8, 9]


def test_columns_of_any_name_stay(spark):
    docs = spark.createDataFrame([(1, QUESTION, 5, "x"), (2, "Nothing.", 6, "z")], "doc_id bigint, text string, __id int, __KEY string")
    items = spark.createDataFrame([(70, QUESTION, 2)], ITEMS)
    assert [tuple(r) for r in decontaminate.clean(docs, items).collect()] == [(2, "Nothing.", 6, "z")]
