"""Language-model scores from a log-frequency Bloom filter.

The filter holds the quantised counts of words and word pairs: a count c has the level 1 + floor(log c / log base), and
the pair is inserted once for each level up to its own. A probe asks for level after level until one is missing; the
last one found gives the count. The filter is built in shards of the key space, each sized by what it holds, so it
grows with the corpus; shards are broadcast in groups of bounded size, one pass over the corpus each.

Texts travel once, as blocks: documents next to each other, their different words, and every token as a number into
them. Counts are made, sent and looked up for the different words of a block instead of for every token.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrolake.llm.common import as_bytes, pieces, words, written

BLOCK_BYTES = 6 << 20
KEY_BITS = 48
TOKENS_PER_SHARD = 1 << 21
GROUP_BYTES = 128 << 20
BASE, BITS_PER_ENTRY, HASHES = 1.5, 8, 5
#: Weight of the pair's own frequency beside the word's.
PAIR_WEIGHT = 0.4
END = b""

BLOCK = (
    "block bigint, doc_ids array<bigint>, learnt array<boolean>, lengths array<int>, words array<binary>, counts array<int>, "
    "ids binary"
)


def blocks_of(docs: DataFrame) -> DataFrame:
    """Blocks of `docs` (doc_id, text, learn): a text's words and one end, numbered; counts are those to learn from."""
    schema = pa.schema(
        [
            ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("learnt", pa.list_(pa.bool_())),
            ("lengths", pa.list_(pa.int32())), ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int32())), ("ids", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, numbers = TaskContext.get().partitionId(), itertools.count()
        rows = (row for batch in pieces(batches) for row in zip(batch.column("doc_id").to_pylist(), batch.column("learn").to_pylist(), as_bytes(batch, "text")))
        row = next(rows, None)
        while row is not None:
            index: dict[bytes, int] = defaultdict()
            index.default_factory = index.__len__
            doc_ids, learnt, lengths, ids, size = [], [], [], [], 0
            while row is not None and size < BLOCK_BYTES:
                doc_id, learn, text = row
                found = words(text)
                found.append(END)
                ids.append(np.fromiter(map(index.__getitem__, found), np.int32, len(found)))
                doc_ids.append(doc_id)
                learnt.append(learn)
                lengths.append(len(found))
                size += len(text) + 1
                row = next(rows, None)
            every = np.concatenate(ids)
            counts = np.bincount(every[np.repeat(learnt, lengths)], minlength=len(index)).astype(np.int32)
            values = [part << 32 | next(numbers), doc_ids, learnt, lengths, list(index), counts, _planes(every)]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    return docs.mapInArrow(run, BLOCK)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte apart, compressed: small ones leave whole planes of zeros."""
    width = numbers.dtype.itemsize
    return zstandard.ZstdCompressor(level=1).compress(numbers.view(np.uint8).reshape(-1, width).T.tobytes())


def _numbers(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def _mixed(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """Keys of KEY_BITS bits from pairs of 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53), (32, 1)):
            x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x >> np.uint64(64 - KEY_BITS)


class Block:
    """One block's tokens and the keys of its words and pairs."""

    def __init__(self, words: list[bytes], ids: bytes, learnt: list[bool], lengths: list[int]):
        self.ids = _numbers(ids, np.int32)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        self.word_keys = _mixed(hashes, np.uint64(0))
        self.learnt, self.lengths = np.array(learnt, bool), np.array(lengths, np.int64)
        # Every text ends with the end, so the end also stands before every text.
        self.before = np.concatenate((self.ids[-1:], self.ids[:-1]))
        self.pair_keys = _mixed(hashes[self.before], hashes[self.ids])


def _packed(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as differences, and counts."""
    return _planes(np.diff(keys, prepend=np.uint64(0))), _planes(counts.astype(np.uint32))


def _unpacked(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_numbers(keys, np.uint64), dtype=np.uint64), _numbers(counts, np.uint32)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row after the other as Python values."""
    for batch in batches:
        for row in range(batch.num_rows):
            yield batch.slice(row, 1).to_pylist()[0]


def counted_keys(blocks: DataFrame, shard_bits: int) -> DataFrame:
    """(shard, keys, counts): of each block the keys of what may be learnt, with their counts, cut into shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            block = Block(r["words"], r["ids"], r["learnt"], r["lengths"])
            mask = np.repeat(block.learnt, block.lengths)
            pairs, pair_counts = np.unique(block.pair_keys[mask], return_counts=True)
            counts = np.array(r["counts"], np.int64)
            keys = np.concatenate((pairs, block.word_keys[counts > 0]))
            counts = np.concatenate((pair_counts, counts[counts > 0]))
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            shards, starts = np.unique(keys >> np.uint64(KEY_BITS - shard_bits), return_index=True)
            ends = [*starts[1:].tolist(), len(keys)]
            packed = [_packed(keys[a:b], counts[a:b]) for a, b in zip(starts.tolist(), ends)]
            columns = [pa.array([p[i] for p in packed], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(shards.astype(np.int64)), *columns], ["shard", "keys", "counts"])

    return blocks.select("words", "ids", "learnt", "lengths", "counts").mapInArrow(run, "shard bigint, keys binary, counts binary")


def _places(keys: np.ndarray, level: int | np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """The bits of a level of each key, one after the other, inside filters of `sizes` bits."""
    first = _mixed(keys, np.uint64(1) + np.uint64(2) * level)
    second = _mixed(keys, np.uint64(2) + np.uint64(2) * level) | np.uint64(1)
    for i in range(HASHES):
        yield (first + np.uint64(i) * second) % sizes


def levels_of(counts: np.ndarray) -> np.ndarray:
    """The level of each count from 1 on."""
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def filled_shards(keys: DataFrame) -> DataFrame:
    """(shard, bits, filter): each shard's keys counted over all blocks and inserted into a filter of its own size."""

    def fill(table: pa.Table) -> pa.Table:
        parts = [_unpacked(k, c) for k, c in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist())]
        found = np.concatenate([p[0] for p in parts])
        counts = np.concatenate([p[1] for p in parts]).astype(np.int64)
        order = np.argsort(found, kind="stable")
        found, counts = found[order], counts[order]
        starts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        found, levels = found[starts], levels_of(np.add.reduceat(counts, starts))
        bits = 8 * -(-int(levels.sum()) * BITS_PER_ENTRY // 8)
        data = np.zeros(bits, bool)
        for level in range(1, int(levels.max()) + 1):
            for at in _places(found[levels >= level], np.uint64(level), np.uint64(bits)):
                data[at] = True
        packed = np.packbits(data, bitorder="little").tobytes()
        shard = table.column("shard")[0].as_py()
        return pa.table({"shard": pa.array([shard], pa.int64()), "bits": pa.array([bits], pa.int64()), "filter": pa.array([packed], pa.binary())})

    return keys.groupBy("shard").applyInArrow(fill, "shard bigint, bits bigint, filter binary")


@dataclass
class CountFilter:
    """Some shards of the filter, next to each other; shards that are not here have no bits."""

    shard_bits: int
    first: np.ndarray
    bits: np.ndarray
    data: bytes

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key, 0 for one that is not in these shards."""
        data = np.frombuffer(self.data, np.uint8)
        shard = keys >> np.uint64(KEY_BITS - self.shard_bits)
        found = np.zeros(len(keys), np.uint8)
        left = np.flatnonzero(self.bits[shard] > 0)
        level = 1
        while len(left):
            sizes, offsets = self.bits[shard[left]], self.first[shard[left]]
            alive = np.ones(len(left), bool)
            for at in _places(keys[left], np.uint64(level), sizes):
                at = at + offsets
                alive &= (data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            left = left[alive]
            found[left] = level
            level += 1
        return found


def filter_groups(shards: DataFrame, shard_bits: int, most: int = GROUP_BYTES) -> Iterator[CountFilter]:
    """The written `shards` in groups of at most `most` bytes (one shard, if it is larger)."""
    sizes = sorted((r.shard, r.bits // 8) for r in shards.select("shard", "bits").collect())
    groups: list[list[tuple[int, int]]] = [[]]
    for shard, size in sizes:
        if groups[-1] and sum(s for _, s in groups[-1]) + size > most:
            groups.append([])
        groups[-1].append((shard, size))
    for group in groups:
        first, bits, data, at = np.zeros(1 << shard_bits, np.uint64), np.zeros(1 << shard_bits, np.uint64), [], 0
        if group:
            for r in shards.where(F.col("shard").between(group[0][0], group[-1][0])).toLocalIterator():
                first[r.shard], bits[r.shard] = 8 * at, r.bits
                data.append(bytes(r["filter"]))
                at += len(r["filter"])
        yield CountFilter(shard_bits, first, bits, b"".join(data))


#: The count that a level stands for: the middle of those that have it.
EXPECTED = np.array([0.0] + [max(1.0, (BASE ** (j - 1) + BASE**j - 1) / 2) for j in range(1, 256)])


LEVELS = "block bigint, word_levels binary, pair_levels binary"
SCORED = "block bigint, doc_ids array<bigint>, learnt array<boolean>, lengths array<int>, ids binary, scores array<double>"


def _levels(r: dict, keys: list[np.ndarray], group: CountFilter) -> list[np.ndarray]:
    """The levels of words and pairs in this group's shards, and what earlier groups found."""
    found = [group.levels(k) for k in keys]
    for i, name in enumerate(("word_levels", "pair_levels")):
        if r.get(name) is not None:
            found[i] = np.maximum(found[i], _numbers(r[name], np.uint8))
    return found


def probed(blocks: DataFrame, group: CountFilter) -> DataFrame:
    """(block, word_levels, pair_levels): `blocks` asked about all words and different pairs."""
    shared = blocks.sparkSession.sparkContext.broadcast(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            block = Block(r["words"], r["ids"], r["learnt"], r["lengths"])
            found = _levels(r, [block.word_keys, np.unique(block.pair_keys)], shared.value)
            arrays = [pa.array([r["block"]], pa.int64()), *(pa.array([_planes(x)], pa.binary()) for x in found)]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "word_levels", "pair_levels"])

    return blocks.mapInArrow(run, LEVELS)


def model_scores(blocks: DataFrame, group: CountFilter, smoothing: float, weight: float) -> DataFrame:
    """The blocks without their words, with the model's score of each text; `group` is the last of the filter's groups."""
    shared = blocks.sparkSession.sparkContext.broadcast(group)
    schema = pa.schema(
        [
            ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("learnt", pa.list_(pa.bool_())),
            ("lengths", pa.list_(pa.int32())), ("ids", pa.binary()), ("scores", pa.list_(pa.float64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            block = Block(r["words"], r["ids"], r["learnt"], r["lengths"])
            pairs, inverse = np.unique(block.pair_keys, return_inverse=True)
            word, pair = (EXPECTED[x] for x in _levels(r, [block.word_keys, pairs], shared.value))
            single, history = ((word + 0.5) / smoothing)[block.ids], word[block.before]
            share = np.minimum(1.0, pair[inverse] / np.maximum(history, 1.0))
            logs = np.log10(np.where(history > 0, (1 - weight) * single + weight * share, single))
            scores = np.add.reduceat(logs, np.cumsum(block.lengths) - block.lengths)
            values = [r["block"], r["doc_ids"], r["learnt"], r["lengths"], r["ids"], scores]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    return blocks.mapInArrow(run, SCORED)


def word_counts(blocks: DataFrame) -> DataFrame:
    """(word, count): how often each word, or the end, occurs in what may be learnt."""
    pairs = blocks.select(F.explode(F.arrays_zip("words", "counts")).alias("x")).select("x.*").where("counts > 0")
    return pairs.groupBy(F.col("words").alias("word")).agg(F.sum(F.col("counts").cast("bigint")).alias("count"))


def counts_of_blocks(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, exact): the corpus counts of each block's words, in their order."""
    asked = blocks.select("block", F.posexplode("words").alias("pos", "word"))
    found = asked.join(counts, "word").select("block", F.struct("pos", "count").alias("found"))
    return found.groupBy("block").agg(F.collect_list("found").alias("exact"))


def with_base(scored_blocks: DataFrame, total: int, smoothing: float, schema: str) -> DataFrame:
    """A row for each text: its counts of tokens and its exact base score beside the model's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                ids = _numbers(one.column("ids")[0].as_py(), np.int32)
                lengths = one.column("lengths").flatten().to_numpy().astype(np.int64)
                starts = np.cumsum(lengths) - lengths
                counts, exact = one.column("exact").flatten(), np.zeros(int(ids.max()) + 1)
                exact[counts.field("pos").to_numpy()] = counts.field("count").to_numpy()
                logs = np.log10((exact + 0.5) / smoothing)
                arrays = [one.column("doc_ids").flatten(), one.column("learnt").flatten(), pa.array(lengths)]
                arrays.append(pa.array(np.add.reduceat((exact > 0).astype(np.int64)[ids], starts)))
                arrays.append(pa.array(np.full(len(lengths), total, np.int64)))
                arrays += [pa.array(np.add.reduceat(logs[ids], starts)), one.column("scores").flatten()]
                names = ["doc_id", "learnt", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return scored_blocks.mapInArrow(run, schema)


def scored(docs: DataFrame, learn: Column, weight: float = PAIR_WEIGHT, group_bytes: int = GROUP_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, learnt, n_tokens, n_known, train_tokens, base_score, score) of every row, learning from those where
    `learn` holds.

    A text's tokens are its words, lower-cased (A-Z), and one end; null and empty texts have the end alone. base_score
    is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))) with exact counts c. score is the model's: a token has the
    probability (1 - w) p1 + w p2, p1 as above with the filter's count, p2 the filter's count of the pair by that of
    the word before (the end, at the start), or p1 alone after an unseen word. Counts are the middles of their levels,
    and a missing pair is taken for a seen one about once in fifty, so the probabilities sum to one only nearly.
    Without rows to learn from N and V are 0. Repeated rows each count and each get their row; a null `learn` is false.
    """
    chosen = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn")
    )
    blocks = written(blocks_of(chosen), "blocks")
    counts = written(word_counts(blocks), "word-counts")
    total, different = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    shard_bits = max(1, math.ceil(math.log2(max(2, total / TOKENS_PER_SHARD))))
    shards = written(filled_shards(counted_keys(blocks, shard_bits)), "shards")
    exact = written(counts_of_blocks(blocks, counts), "exact")
    smoothing = total + 0.5 * (different + 1)
    slim, groups = blocks.drop("counts"), list_ahead(filter_groups(shards, shard_bits, group_bytes))
    for group, last in groups:
        if last:
            found = model_scores(slim, group, smoothing, weight)
        else:
            levels = written(probed(slim, group), "levels")
            slim = blocks.drop("counts").join(levels, "block")
    schema = "doc_id bigint, learnt boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return with_base(found.join(exact, "block", "left"), total, smoothing, schema)


def list_ahead(groups: Iterator[CountFilter]) -> Iterator[tuple[CountFilter, bool]]:
    """Each group, and whether it is the last; one is held beside the current one."""
    current = next(groups)
    for following in groups:
        yield current, False
        current = following
    yield current, True
