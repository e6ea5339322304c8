"""Benchmark decontamination by template windows, in DataFrame functions only.

A text is cut into words; numbers, names and units become typed placeholders, so a question with other values keeps its
template. Windows of five template words are hashed and joined with those of the benchmark's items. Where a document
holds enough of an item's windows, the two are laid side by side and the values in their placeholders are compared: a
value of the item must stand for one value of the document throughout, else the likeness is by chance. Items whose
template has no window of enough literal words, and short ones, are searched by their own lower-cased words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrolake.llm.common import keyed_texts, text_key, unused, written

WINDOW, LITERALS, COVERAGE = 5, 3, 0.5
#: An item of fewer words is only looked for as a whole document: one or two words occur by chance.
LEAST_WORDS = 3
#: Up to so many rows of two numbers (some 40 MB) are sent to every task; more are joined by shuffle.
SENT_ROWS = 1_000_000

# Number words and units, as plain English writes them.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
)
UNITS = (
    "mm cm m km inch inches ft foot feet yard yards mile miles mg g kg t lb lbs oz ounce ounces gram grams ton tons ml l "
    "liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks "
    "month months year years mph kph w kw kwh v hz khz mhz ghz kb mb gb tb percent degree degrees dollar dollars euro "
    "euros cent cents usd eur gbp"
)

NAME, NUMBER, UNIT = "\u0001", "\u0002", "\u0003"
SPLIT = r"[^\p{L}\p{N}\x01-\x03]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once a row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def plain(text: Column) -> Column:
    """Separators inside numbers go, and a letter after a digit begins a word, so that a number is one word."""
    joined = F.regexp_replace(text, r"(?<=\p{N})[.,:/](?=\p{N})", "")
    return F.when(text.rlike(r"\p{N}"), F.regexp_replace(joined, r"(?<=\p{N})(?=\p{L})", " ")).otherwise(text)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPLIT), lambda w: w != "")


def template(text: Column) -> Column:
    """The words of a plain text, as many as it has, with placeholders for names, numbers and units.

    A name is a capitalised word that follows a word or comma on its line, but not one in capitals throughout, so that
    a shouted copy keeps its words; a unit is a known one after a number.
    """
    # The capital is tried first: few places have one, and only there the look back is made.
    named = F.lower(F.regexp_replace(text, r"\p{Lu}(?<=[\p{L}\p{N},;:] .)\p{Ll}\p{L}*", NAME))
    digits = F.regexp_replace(named, r"(?<![\p{L}\p{N}])\p{N}+(?![\p{L}\p{N}])", NUMBER)
    tokens = words_of(F.when(named.rlike(r"\p{N}"), digits).otherwise(named))

    def typed(t: Column) -> Column:
        number = lambda w: w.isin(NUMBER, *NUMBER_WORDS.split())
        return F.transform(
            t,
            lambda w, i: F.when(number(w), NUMBER)
            .when(w.isin(*UNITS.split()), F.when(F.coalesce(number(F.get(t, i - 1)), F.lit(False)), UNIT).otherwise(w))
            .otherwise(w),
        )

    return let(tokens, typed)


def window_hashes(tokens: Column, width: int) -> Column:
    """A hash for each run of `width` words; a shorter text is one run, one without words has none."""
    return let(
        tokens,
        lambda t: F.when(
            F.size(t) > 0,
            F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(t) - width + 1)), lambda i: F.xxhash64(F.slice(t, i, width))),
        ),
    )


def exact_hashes(plain: Column, width: int) -> Column:
    """A hash for each run of `width` words as they are, in small letters; below LEAST_WORDS only of texts of `width` words."""
    return let(
        words_of(F.lower(plain)),
        lambda t: F.when(
            (F.size(t) == width) if width < LEAST_WORDS else (F.size(t) >= width),
            F.transform(F.sequence(F.lit(1), F.size(t) - width + 1), lambda i: F.xxhash64(F.lit(width), F.slice(t, i, width))),
        ),
    )


def sent_if_small(df: DataFrame) -> DataFrame:
    """Of a written table: a broadcast hint where its rows, counted, are few."""
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def item_windows(items: DataFrame, width: int, literals: int) -> DataFrame:
    """(item_id, item, window, at, total, exact): an item's different windows and how many of them count as all.

    Windows of its template that hold enough literal words have exact 0. Items without any, and those of LEAST_WORDS to
    `width` - 1 words, have windows of their own words: exact is how many words, at most `width`.
    """
    cut = written(items.select("item_id", "item", "plain", template("plain").alias("template")), "templates")
    each = cut.select("item_id", "item", "template", F.posexplode(window_hashes(F.col("template"), width)).alias("at", "window"))
    literal = F.size(F.filter(F.slice("template", F.col("at") + 1, width), lambda w: ~w.isin(NAME, NUMBER, UNIT)))
    needed = F.least(F.lit(literals), F.size("template"))
    found = written(each.where(literal >= needed).groupBy("item_id", "item", "window").agg(F.min("at").alias("at")), "template-windows")
    known = found.select("item_id", "item").distinct()
    long_enough = F.size("template").between(LEAST_WORDS, width - 1)
    own = cut.join(known.withColumn("known", F.lit(True)), ["item_id", "item"], "left").where(F.col("known").isNull() | long_enough)
    own = own.select("item_id", "item", "plain", F.least(F.size("template"), F.lit(width)).alias("words"))
    own = written(own.where("words > 0"), "own-words")
    every = found.withColumn("exact", F.lit(0))
    for n in sorted(row.words for row in own.select("words").distinct().collect()):
        runs = own.where(F.col("words") == n).select("item_id", "item", F.posexplode(exact_hashes(F.col("plain"), n)).alias("at", "window"))
        runs = runs.groupBy("item_id", "item", "window").agg(F.min("at").alias("at"))
        every = every.unionByName(runs.withColumn("exact", F.lit(n)))
    every = written(every, "windows")
    # A short item is one window of its template or one of its words.
    totals = every.groupBy("item_id", "item", "exact").agg(F.count("*").alias("total"))
    totals = totals.groupBy("item_id", "item").agg(F.max("total").alias("total"))
    return every.join(totals, ["item_id", "item"])


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WINDOW,
    coverage: float = COVERAGE,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, text_key, item_id, windows, total, coverage, slots, changed, kind): each document with each item it holds.

    windows of the item's total are in the document, at least the share `coverage`; changed of the slots laid side by
    side have another value. kind is verbatim (none changed) or re-parameterised. A document that gives one value of an
    item two values is left out. Rows equal in doc_id and text are one document, text_key the hash of its text. A text
    of fewer than `width` words is one window. An item without a window of LITERALS literal words is held where its own
    words are, by windows of `width` of them; one of LEAST_WORDS to `width` - 1 words where all are side by side, a shorter
    one where it is the whole document. Empty and null texts hold nothing; items without id or words are in no document.
    Two texts of one item_id are two items.
    """
    items = keyed_texts(benchmark, item_id, item_text).where("doc_id is not null").distinct()
    items = written(items.select(F.col("doc_id").alias("item_id"), text_key().alias("item"), plain(F.col("text")).alias("plain")), "items")
    wanted = written(item_windows(items, width, LITERALS), "item-windows")
    keyed = keyed_texts(docs, doc_id, text).select("doc_id", text_key().alias("text_key"), plain(F.col("text")).alias("plain"))
    windows = keyed.select("doc_id", "text_key", F.posexplode(window_hashes(template(F.col("plain")), width)).alias("pos", "window"))
    windows = windows.withColumn("exact", F.lit(0))
    # At most `width` lengths, and none where each item has a template to search by.
    for n in sorted(r.exact for r in wanted.where("exact > 0").select("exact").distinct().collect()):
        runs = keyed.select("doc_id", "text_key", F.posexplode(exact_hashes(F.col("plain"), n)).alias("pos", "window"))
        windows = windows.unionByName(runs.withColumn("exact", F.lit(n)))
    found = windows.join(sent_if_small(wanted), ["window", "exact"])
    found = found.groupBy("doc_id", "text_key", "item_id", "item", "total", "exact", "window").agg(F.min(F.expr("pos - at")).alias("shift"))
    found = found.groupBy("doc_id", "text_key", "item_id", "item", "total").agg(
        F.least(F.count("*"), F.col("total")).alias("windows"),
        F.mode("shift", deterministic=True).alias("shift"),
        (F.max("exact") > 0).alias("exact"),
    )
    found = written(found.where(F.col("windows") >= F.col("total") * coverage), "found")

    hit = written(found.select("doc_id", "text_key").distinct(), "hit")
    hit = sent_if_small(hit).select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key"))
    wide = keyed.join(hit, same).drop("hit_id", "hit_key").dropDuplicates(["doc_id", "text_key"])
    laid = wide.withColumnRenamed("plain", "doc_plain").alias("d").join(
        found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_key") == F.col("f.text_key"))
    )
    laid = laid.join(items, ["item_id", "item"]).select(
        "f.doc_id", "f.text_key", "item_id", "windows", "total", "shift", "exact",
        template(F.col("doc_plain")).alias("td"), words_of(F.col("doc_plain")).alias("rd"),
        template(F.col("plain")).alias("ti"), words_of(F.col("plain")).alias("ri"),
    )
    agree = lambda p: F.get("ti", p) == F.get("td", p + F.col("shift"))
    inside = F.filter(
        F.sequence(F.lit(0), F.size("ti") - 1),
        lambda p: F.get("ti", p).isin(NAME, NUMBER, UNIT)
        & F.coalesce(agree(p), F.lit(False))
        & (F.coalesce(agree(p - 1), F.lit(False)) | F.coalesce(agree(p + 1), F.lit(False))),
    )
    value = lambda words, p: F.lower(F.get(words, p))
    pairs = F.transform(inside, lambda p: F.struct(value("ri", p).alias("item"), value("rd", p + F.col("shift")).alias("doc")))
    laid = laid.select("doc_id", "text_key", "item_id", "windows", "total", "exact", pairs.alias("pairs"))
    once = F.array_distinct("pairs")
    consistent = F.size(once) == F.size(F.array_distinct(F.transform("pairs", lambda x: x["item"])))
    changed = F.size(F.filter("pairs", lambda x: x["item"] != x["doc"]))
    # Words as they are need no values to agree.
    return laid.where(F.col("exact") | consistent).select(
        "doc_id", "text_key", "item_id", "windows", "total",
        (F.col("windows") / F.col("total")).alias("coverage"),
        F.size("pairs").alias("slots"),
        changed.alias("changed"),
        F.when(changed == 0, "verbatim").otherwise("re-parameterised").alias("kind"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that hold no item of the benchmark, with all their columns, which can have any name."""
    own_id, own_key = unused(docs.columns, "__id"), unused(docs.columns, "__key")
    found = contaminated(docs, benchmark, doc_id=doc_id, text=text)
    found = written(found.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key)).distinct(), "contaminated")
    same = F.col(doc_id).eqNullSafe(F.col(own_id)) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col(own_key))
    return docs.join(sent_if_small(found), same, "left_anti")
