"""Near-duplicates by SimHash, found through deletion-variant signatures.

A fingerprint has 64 bits. Two that differ in at most three bits, cut into two segments of 32, agree in one segment but
for at most one bit. So each fingerprint is indexed under 64 keys, one for each segment and each bit of it left out;
near ones share a key, and an equality join finds them. A key that many fingerprints share is cut further: what its
members do not share again differs in at most three bits, so one half of it differs in at most one. After three levels
a key leaves 11 bits open, hence at most 2,048 fingerprints, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrolake.llm.common import as_bytes, batchwise, keyed_texts, text_key, unused, words, written
from cirrolake.llm.graph import components

SEED = 42
LARGEST_BUCKET = 2048
CHUNK = 1 << 16


def shingles(tokens: list[bytes], width: int) -> Iterator[bytes]:
    """Runs of `width` words joined by a space, repeats included; of fewer words the whole sequence."""
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(0, len(tokens) - width)
    return (line[a:b] for a, b in zip(starts[: last + 1].tolist(), ends[len(tokens) - 1 - last :].tolist()))


def simhash(text: bytes, width: int = 3) -> int:
    """The signed 64-bit fingerprint: a bit is 1 if it is set in over half of the shingles' hashes; no words give 0."""
    tokens = words(text)
    if not tokens:
        return 0
    total = max(1, len(tokens) - width + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles(tokens, width)), np.uint64, total)
    counts = np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        bits = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, fingerprint) for every row; text_key is a hash of the text."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([simhash(t, width) for t in as_bytes(batch, "text")], pa.int64())
        return pa.RecordBatch.from_arrays([*batch.select(["doc_id", "text_key"]).columns, found], ["doc_id", "text_key", "fingerprint"])

    chosen = keyed_texts(docs, doc_id, text).withColumn("text_key", text_key())
    return batchwise(chosen, step, "doc_id bigint, text_key bigint, fingerprint bigint")


def _without_one(value: Column, low: int, width: int, tag: int) -> list[Column]:
    """Keys of the `width` bits from bit `low` on, each with one bit left out; `tag` numbers the first of them."""
    part = F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1))
    return [
        part.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << bit))).bitwiseOR(F.lit((tag + bit) << width)) for bit in range(width)
    ]


def _halves(value: Column, low: int, width: int) -> Column:
    """Both halves of a range of bits, each under every key with one bit left out, and where the other half begins."""
    half = width // 2
    return F.array(
        *[
            F.struct(key.alias("key"), F.lit(other).alias("rest"))
            for at, other, tag in ((low, low + half, 0), (low + half, low, half))
            for key in _without_one(value, at, half, tag)
        ]
    )


def _linked(found: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Enough pairs within `distance` to connect what is connected in one bucket: each member with its group's first."""
    root = np.arange(len(found))
    for i in range(1, len(found)):
        near = np.flatnonzero(np.bitwise_count(found[:i] ^ found[i]) <= distance)
        if len(near):
            merged = np.append(np.unique(root[near]), root[i])
            root[np.isin(root[: i + 1], merged).nonzero()[0]] = merged.min()
    for i in np.flatnonzero(root != np.arange(len(found))):
        yield int(found[root[i]]), int(found[i])


def _resolve(buckets: DataFrame, distance: int) -> DataFrame:
    """Links inside buckets of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [p for x in batch.column("members") for p in _linked(np.array(x.as_py(), np.int64).view(np.uint64), distance)]
            signed = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed[:, 0]), pa.array(signed[:, 1])], ["a", "b"])

    return buckets.mapInArrow(run, "a bigint, b bigint")


def links(prints: DataFrame, distance: int = 3, largest: int = LARGEST_BUCKET) -> DataFrame:
    """(a, b): pairs of different fingerprints whose components are those of all pairs at most `distance` <= 3 bits apart.

    A pair names a member of a bucket and the first one that it is connected with there, so that a bucket of n members
    gives at most n - 1 pairs.
    Keys of one fingerprint end in the map-side count. Keys of two are resolved from their smallest and largest
    member. The members of a key are gathered only where their number is known to be at most `largest`.
    """
    if not 0 <= distance <= 3:
        raise ValueError("two segments with one bit left out find differences of up to three bits")
    value = F.col("fingerprint")
    # A row becomes 64, so rows are dealt over as many tasks as the session's shuffles have.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    level = prints.select("fingerprint").distinct().repartition(tasks, "fingerprint")
    level = level.select("fingerprint", F.explode(_halves(value, 0, 64)).alias("cut"))
    level = level.select("fingerprint", F.col("cut.key").alias("key"), F.col("cut.rest").alias("rest"))
    found = []
    for width in (32, 16, 8):
        # The range left open differs from key to key only by where it begins, which the key determines.
        sizes = level.groupBy("key").agg(
            F.count("*").alias("n"), F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b")
        )
        sizes = written(sizes.where("n > 1"), "buckets")
        found.append(sizes.where((F.col("n") == 2) & (F.bit_count(F.expr("a ^ b")) <= distance)).select("a", "b"))
        members = level.join(sizes.where("n > 2").select("key", "n"), "key")
        last = width == 8
        small = members if last else members.where(F.col("n") <= largest)
        found.append(_resolve(small.groupBy("key").agg(F.collect_list("fingerprint").alias("members")), distance))
        if last or sizes.where(F.col("n") > largest).isEmpty():
            break
        cuts = F.coalesce(*[F.when(F.col("rest") == low, _halves(value, low, width)) for low in range(0, 64, width)])
        large = members.where(F.col("n") > largest)
        large = large.select("fingerprint", F.col("key").alias("outer"), F.explode(cuts).alias("cut"))
        level = written(
            large.select("fingerprint", F.xxhash64("outer", "cut.key").alias("key"), F.col("cut.rest").alias("rest")), "cuts"
        )
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.distinct()


def near_duplicates(
    docs: DataFrame, width: int = 3, distance: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, text_key, fingerprint, component_id, component) for every row; component_id is the smallest doc_id it is
    linked with, component the smallest fingerprint.

    Rows whose fingerprints differ in at most `distance` bits are linked, and links carry on. Null and empty texts have
    fingerprint zero and are linked like any other. Repeated rows keep their number. A null doc_id takes part in the
    links but never names a component, unless no row of the component has an id. No rows give no rows.
    """
    prints = written(fingerprints(docs, width, doc_id, text), "fingerprints")
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    joined = components(written(links(prints, distance), "links")).withColumnRenamed("node", "fingerprint")
    groups = distinct.join(joined, "fingerprint", "left")
    linked = groups.where("component is not null")
    smallest = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    named = linked.join(smallest, "component").select("fingerprint", "component_id", "component")
    alone = groups.where("component is null")
    alone = alone.select("fingerprint", F.col("first").alias("component_id"), F.col("fingerprint").alias("component"))
    found = prints.join(named.unionByName(alone), "fingerprint")
    return found.select("doc_id", "text_key", "fingerprint", "component_id", "component")


def one_of_each(docs: DataFrame, width: int = 3, distance: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row with the smallest doc_id of each group of near-duplicates, with all its columns.

    A row without id stays only where its group has no other; of rows with one id the one with the smallest hash of
    its text stays, and of repeated rows one. Columns can have any name.
    """
    groups = near_duplicates(docs, width, distance, doc_id, text)
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("text_key"))
    first = groups.groupBy("component").agg(F.min(order).alias("first"))
    own_id, own_key, own_text = (unused(docs.columns, name) for name in ("__id", "__key", "__text"))
    first = written(first.select(F.col("first.doc_id").alias(own_id), F.col("first.text_key").alias(own_key)), "first-ones")
    keyed = docs.withColumn(own_text, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    same = keyed[doc_id].eqNullSafe(F.col(own_id)) & (F.col(own_text) == F.col(own_key))
    return keyed.join(first, same, "left_semi").dropDuplicates([doc_id, own_text]).drop(own_text)
