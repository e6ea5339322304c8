"""Order MinHash fingerprints, in DataFrame functions only.

A text's words give k-mers of three words; equal ones are numbered by occurrence, so that repeats count. Of the
numbered k-mers the minimal ones are selected, and those selected together are hashed as a tuple in the order in which
they stand in the text. So a signature feels both which pieces two texts share and how these are arranged, as the edit
distance does. One permutation serves all signatures: its values are cut into as many ranges, and each range selects
its own minima.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cirrolake.llm.common import written

WORDS, SIGNATURES, TUPLE = 3, 32, 2
#: Hashes keep 32 bits beside a place of 31 bits, so that both sort as one number.
PLACE_BITS = 31


def let(value: Column, use) -> Column:
    """`use` of a value that is computed once a row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _packed(number: Column, place: Column) -> Column:
    """32 bits of a hash above a place, never negative."""
    upper = F.shiftrightunsigned(number, 32)
    return F.shiftleft(upper, PLACE_BITS).bitwiseOR(place.cast("bigint"))


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")


def _number(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def kmers(text: Column, words: int = WORDS) -> Column:
    """A hash for each run of `words` words; the last runs are shorter. A text without words has none."""
    tokens = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return let(
        F.transform(tokens, lambda w: F.xxhash64(w)),
        lambda h: F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, words)])),
    )


def numbered(hashes: Column) -> Column:
    """A sorted array: for each k-mer 32 bits of the hash of itself and its occurrence number, above its place.

    Sorted by k-mer and place, equal k-mers stand together; where none is equal to the one before, all are first
    occurrences. Otherwise the array is cut where a new k-mer begins, and each part is numbered.
    """

    def number(s: Column) -> Column:
        first = lambda x, i: (i == 0) | (_number(x) != _number(F.get(s, i - 1)))
        starts = F.filter(F.transform(s, lambda x, i: F.when(first(x, i), i)), lambda i: i.isNotNull())
        fresh = F.transform(s, lambda x: _packed(F.xxhash64(_number(x), F.lit(0)), _place(x)))
        parts = let(
            starts,
            lambda at: F.flatten(
                F.transform(
                    at,
                    lambda start, j: F.transform(
                        F.slice(s, start + 1, F.coalesce(F.get(at, j + 1), F.size(s)) - start),
                        lambda x, o: _packed(F.xxhash64(_number(x), o), _place(x)),
                    ),
                )
            ),
        )
        repeated = F.size(F.array_distinct(F.transform(s, _number))) < F.size(s)
        return F.sort_array(F.when(repeated, parts).otherwise(fresh))

    return let(F.sort_array(F.transform(hashes, _packed)), number)


def signatures(text: Column, words: int = WORDS, count: int = SIGNATURES, size: int = TUPLE) -> Column:
    """An array of `count` signatures, -1 where a range of the permutation has no k-mer of the text.

    `count` is a power of two. Each is a hash of its at most `size` minimal k-mers in the order of the text.
    """
    bits = count.bit_length() - 1
    if 1 << bits != count:
        raise ValueError("the number of signatures must be a power of two")
    bin_of = lambda x: F.shiftright(_number(x), 32 - bits)

    def select(h: Column) -> Column:
        return let(
            numbered(h),
            lambda s: F.filter(s, lambda x, i: (i < size) | (bin_of(x) != bin_of(F.get(s, i - size)))),
        )

    def hashed(h: Column) -> Column:
        def tuples(chosen: Column) -> Column:
            def one(b: Column) -> Column:
                places = F.sort_array(F.transform(F.filter(chosen, lambda x: bin_of(x) == b), _place))
                return let(
                    places,
                    lambda p: F.when(
                        F.size(p) > 0, F.xxhash64(F.transform(p, lambda at: F.get(h, at))).bitwiseAND(F.lit((1 << 32) - 1))
                    ).otherwise(F.lit(-1).cast("bigint")),
                )

            return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), one)

        return let(select(h), tuples)

    return let(kmers(text, words), hashed)


def as_hex(signature: Column) -> Column:
    """A fingerprint as text: eight hex digits for each signature, dashes for one without k-mers."""
    return F.array_join(
        F.transform(signature, lambda x: F.when(x < 0, F.lit("--------")).otherwise(F.lower(F.lpad(F.hex(x), 8, "0")))), ""
    )


def likeness(a: Column, b: Column) -> Column:
    """The share of equal signatures among those that either text has; 1 for two texts without words."""
    both = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    used = F.filter(both, lambda p: (p["x"] >= 0) | (p["y"] >= 0))
    same = F.size(F.filter(used, lambda p: p["x"] == p["y"]))
    return F.when(F.size(used) > 0, same / F.size(used)).otherwise(F.lit(1.0))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, signature) of every row, null texts as empty ones; repeated rows keep their number."""
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return chosen.select("doc_id", "text", signatures(F.col("text")).alias("signature"))


def edited(text: Column, other: Column) -> Column:
    """`text` with its last third of code points replaced by the first as many of `other`, or by all if it has fewer."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(other, F.lit(1), third))


def in_ranges(docs: DataFrame, rows_each: int, most: int = 4096) -> DataFrame:
    """`docs` (doc_id, text) and part: ranges of ids, the largest ids in part 0, nulls in the last one.

    A range has about `rows_each` rows; of more than `most` ranges' worth of rows, as many as it takes.
    """
    ids = docs.where("doc_id is not null").select("doc_id")
    parts = max(1, min(most, -(-ids.count() // rows_each)))
    points = [i / parts for i in range(1, parts)]
    edges = sorted({int(x) for x in ids.approxQuantile("doc_id", points, 0.1 / parts)}) if points else []
    above = F.filter(F.array(*map(F.lit, edges)).cast("array<bigint>"), lambda e: e > F.col("doc_id"))
    return docs.withColumn("part", F.when(F.col("doc_id").isNull(), F.lit(len(edges))).otherwise(F.size(above)))


def beside_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows_each: int = 4000) -> DataFrame:
    """(doc_id, text, signature, edited, edited_signature, next_signature) of every row, next to the row after it.

    Rows are ordered by descending doc_id, rows of one id by text, null ids last; after the last row comes the first,
    and a single row is its own next. edited is the text with its last third replaced from the next text. One shuffle
    brings neighbours together in ranges of ids; only the first row of each range is handed to the range before it.
    """
    cut = in_ranges(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), rows_each)
    first = cut.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), (-F.col("doc_id")).alias("order"), "text")).alias("head"))
    heads = written(first.select("part", F.col("head.text").alias("head_text")), "range-heads")
    heads = heads.withColumn("head_signature", signatures(F.col("head_text")))
    order = [r.part for r in heads.select("part").orderBy("part").collect()]  # a number for each range, at most 4,096
    pairs = [(part, after) for part, after in zip(order, order[1:] + order[:1])]
    follows = docs.sparkSession.createDataFrame(pairs, "before int, part int")
    heads = heads.join(follows, "part").select(F.col("before").alias("part"), "head_text", "head_signature")

    ordered = Window.partitionBy("part").orderBy(F.desc_nulls_last("doc_id"), "text")
    rows = cut.withColumn("next_text", F.lead("text").over(ordered)).withColumn("signature", signatures(F.col("text")))
    rows = rows.withColumn("next_signature", F.lead("signature").over(ordered)).join(heads, "part")
    rows = rows.select(
        "doc_id",
        "text",
        "signature",
        edited(F.col("text"), F.coalesce("next_text", "head_text")).alias("edited"),
        F.coalesce("next_signature", "head_signature").alias("next_signature"),
    )
    return rows.withColumn("edited_signature", signatures(F.col("edited")))
