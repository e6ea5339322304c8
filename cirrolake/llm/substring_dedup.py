"""Substring deduplication by level-wise doubling.

A window of n words can only be repeated where both windows of half its length that make it up are. So windows of the
first length are counted everywhere, and those repeated at one length alone are extended to twice that length, until the
asked length is reached or no candidate survives. (An odd length is made of two halves that share a word: 18 and 35.)

Texts travel as blocks of whole documents, written once: their different words, and every word as a number into these.
For each level a block names its candidates by hashes, each different one once, sorted and cut into cells, one for each
shard of the hash space. A shard sees which hashes more than one block has and answers with one bit for each. So a window
that a third of all documents share is one entry a block, and nothing but bits travels back. Levels before the last use
32 bits beside the shard's number, since the next level sees to false ones; the last has 80 bits beside it (at 10^13
windows, fewer than one in a thousand runs errs).
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrolake.llm.common import keyed_texts, pieces, written

LENGTH = 35
#: Levels start at half, a quarter, ... of the length, not below this.
FIRST = 16
#: Texts of one block; a longer text is a block of its own. Both numbers bound a task's memory: raise them with it.
BLOCK_BYTES = 8 << 20
WINDOWS_PER_SHARD = 4 << 20
#: The cells of this shard's number and below hold no hashes but which positions of a block are still candidates.
STATE = -1

BLOCK = "block bigint, n_words bigint, doc_ids array<bigint>, lengths array<bigint>, words array<string>, ids binary"
CELL = "shard int, block bigint, mains binary, extras binary"
VERDICT = "block bigint, shard int, marks binary"
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept string, removed array<struct<start: bigint, end: bigint>>"


def levels(length: int, first: int = FIRST) -> list[int]:
    """The lengths of the levels, each at most twice the one before it."""
    found = [length]
    while (found[0] + 1) // 2 >= max(first, 1) and found[0] > 1:
        found.insert(0, (found[0] + 1) // 2)
    return found


def packed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte apart, compressed."""
    width = numbers.dtype.itemsize
    return zstandard.ZstdCompressor(level=1).compress(numbers.view(np.uint8).reshape(-1, width).T.tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def rising(numbers: np.ndarray) -> bytes:
    """Sorted numbers as the steps between them."""
    return packed(np.diff(numbers, prepend=numbers.dtype.type(0)))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of pairs, which depends on their order."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ b >> np.uint64(31)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ x >> np.uint64(29)


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """The hash of the `length` words from each position on, by doubling."""
    size = 1
    while size < length:
        step = min(size, length - size)
        hashes = mixed(hashes[:-step], hashes[step:]) if len(hashes) > step else hashes[:0]
        size += step
    return hashes


@dataclass
class Candidates:
    """A block's windows at one level: their starts, and the different ones in the order of shard and hash."""

    starts: np.ndarray
    number: np.ndarray  # of each start's window among the different ones
    counts: np.ndarray
    shards: np.ndarray
    mains: np.ndarray
    extras: np.ndarray


class Words:
    """The words of one block as two independent 64-bit hashes each."""

    def __init__(self, row: pa.RecordBatch, shards: int):
        self.shards = shards
        self.doc_ids = row.column("doc_ids").flatten()
        self.different = row.column("words").flatten()
        self.ids = unpacked(row.column("ids")[0].as_py(), np.int32)
        self.lengths = row.column("lengths").flatten().to_numpy()
        self.ends = np.cumsum(self.lengths)
        self.room = np.repeat(self.ends, self.lengths) - np.arange(len(self.ids))
        prints = b"".join(xxhash.xxh3_128_digest(word) for word in self.different.cast(pa.binary()).to_pylist())
        self.prints = np.frombuffer(prints, ">u8").astype(np.uint64).reshape(-1, 2)

    def hashes(self, half: int, length: int, starts: np.ndarray) -> np.ndarray:
        """One of the two hashes of the windows of `length` words at `starts`."""
        return windows(self.prints[self.ids, half], length)[starts] if len(starts) else np.zeros(0, np.uint64)

    def candidates(self, before: int, alive: np.ndarray | None, length: int, last: bool) -> Candidates:
        """Windows of `length` whose halves, windows of `before`, are alive; at the first level all."""
        fits = self.room >= length
        if alive is not None:
            fits[: len(fits) - (length - before)] &= alive[length - before :]
            fits &= alive
        starts = np.flatnonzero(fits)
        a = self.hashes(0, length, starts)
        if last:
            b = self.hashes(1, length, starts)
            shard = (b >> np.uint64(32)) % np.uint64(self.shards)
            main, extra = a, b.astype(np.uint16)
            order = np.lexsort((extra, main, shard))
        else:
            shard = (a >> np.uint64(32)) % np.uint64(self.shards)
            main, extra = a.astype(np.uint32), np.zeros(len(a), np.uint16)
            order = np.argsort(shard << np.uint64(32) | main)
        shard, main, extra = shard[order], main[order], extra[order]
        new = np.ones(len(order), bool)
        new[1:] = (shard[1:] != shard[:-1]) | (main[1:] != main[:-1]) | (extra[1:] != extra[:-1])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        firsts = np.flatnonzero(new)
        counts = np.diff(firsts, append=len(order))
        return Candidates(starts, number, counts, shard[firsts].astype(np.int32), main[firsts], extra[firsts])

    def alive(self, found: Candidates, verdict: dict[int, bytes]) -> np.ndarray:
        """For each position whether its window is repeated: in this block, or by the shards' marks elsewhere."""
        repeated = found.counts > 1
        bounds = np.searchsorted(found.shards, np.arange(self.shards + 1))
        for shard, marks in verdict.items():
            if shard >= 0:
                low, high = bounds[shard], bounds[shard + 1]
                repeated[low:high] |= np.unpackbits(np.frombuffer(marks, np.uint8), count=high - low).view(bool)
        result = np.zeros(len(self.room), bool)
        result[found.starts] = repeated[found.number]
        return result

    def state(self, verdict: dict[int, bytes]) -> np.ndarray | None:
        """The live positions that the block had when it named the candidates which the verdict is on."""
        bits = next((marks for shard, marks in verdict.items() if shard <= STATE), None)
        return None if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8), count=len(self.room)).view(bool)


def after(words: Words, lengths: list[int], k: int, verdict: dict[int, bytes]) -> np.ndarray:
    """The live positions after level k, whose verdict is given."""
    before = lengths[k - 1] if k else 0
    alive = words.state(verdict)
    if k and alive is None:
        return np.zeros(len(words.room), bool)
    return words.alive(words.candidates(before, alive, lengths[k], k == len(lengths) - 1), verdict)


def one_row(schema: pa.Schema, *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def blocks_of(docs: DataFrame) -> DataFrame:
    """Whole documents, next to each other, in blocks."""
    schema = pa.schema(
        [
            ("block", pa.int64()), ("n_words", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
            ("lengths", pa.list_(pa.int64())), ("words", pa.list_(pa.string())), ("ids", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, numbers = TaskContext.get().partitionId(), itertools.count()
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            sizes = np.cumsum(pc.binary_length(texts).to_numpy()) if len(texts) else np.zeros(0)
            cuts = np.flatnonzero(np.diff(sizes // BLOCK_BYTES)) + 1
            for low, high in itertools.pairwise([0, *cuts.tolist(), len(texts)]):
                # White space is space, and tab to carriage return.
                split = pc.ascii_split_whitespace(texts[low:high])
                flat, ends = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
                full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
                lengths = np.diff(np.concatenate([[0], np.cumsum(full)])[ends])
                coded = flat.filter(pa.array(full)).dictionary_encode()
                ids = packed(coded.indices.to_numpy().astype(np.int32))
                yield one_row(
                    schema, part << 32 | next(numbers), lengths.sum(), batch.column("doc_id")[low:high], lengths,
                    coded.dictionary.cast(pa.string()), ids,
                )

    return docs.mapInArrow(run, BLOCK)


def beside(blocks: DataFrame, verdict: DataFrame | None) -> DataFrame:
    """Blocks beside the marks of the level before, if there is one."""
    return blocks if verdict is None else blocks.join(verdict, "block", "left")


def marks_of(row: pa.RecordBatch) -> dict[int, bytes]:
    return {m["shard"]: m["marks"] for m in row.column("marks")[0].as_py() or []}


def cells_of(blocks: DataFrame, verdict: DataFrame | None, lengths: list[int], k: int, shards: int) -> DataFrame:
    """Each block's different candidates of level k, a row for each shard, and after the first level their positions."""
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("mains", pa.binary()), ("extras", pa.binary())])
    last = k == len(lengths) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in pieces(batches, 1):
            words, block, alive = Words(row, shards), row.column("block")[0].as_py(), None
            if k:
                alive = after(words, lengths, k - 1, marks_of(row))
                if not alive.any():
                    continue
                yield one_row(schema, STATE - block % shards, block, np.packbits(alive).tobytes(), b"")
            found = words.candidates(lengths[k - 1] if k else 0, alive, lengths[k], last)
            bounds = np.searchsorted(found.shards, np.arange(shards + 1))
            for shard in np.flatnonzero(np.diff(bounds)).tolist():
                part = slice(bounds[shard], bounds[shard + 1])
                extras = packed(found.extras[part]) if last else b""
                yield one_row(schema, shard, block, rising(found.mains[part]), extras)

    return beside(blocks, verdict).mapInArrow(run, CELL)


def verdicts_of(cells: DataFrame, last: bool) -> DataFrame:
    """(block, marks): for each cell one bit an entry, set where another block has it too; cells without any are left out."""
    kind = np.uint64 if last else np.uint32
    schema = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("marks", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        blocks, steps = table.column("block").to_pylist(), table.column("mains").to_pylist()
        if shard <= STATE:
            found = list(zip(blocks, steps))
        else:
            parts = [np.cumsum(unpacked(s, kind), dtype=kind) for s in steps]
            mains = np.concatenate(parts)
            if last:
                extras = np.concatenate([unpacked(e, np.uint16) for e in table.column("extras").to_pylist()])
                order = np.lexsort((extras, mains))
                same = (mains[order[1:]] == mains[order[:-1]]) & (extras[order[1:]] == extras[order[:-1]])
            else:
                order = np.argsort(mains)
                same = mains[order[1:]] == mains[order[:-1]]
            marked = np.zeros(len(mains), bool)
            marked[order[1:]] |= same
            marked[order[:-1]] |= same
            ends = np.cumsum([len(p) for p in parts])
            cut = [(b, marked[end - len(p) : end]) for b, p, end in zip(blocks, parts, ends)]
            found = [(b, np.packbits(m).tobytes()) for b, m in cut if m.any()]
        columns = [[b for b, _ in found], [shard] * len(found), [m for _, m in found]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    marks = cells.groupBy("shard").applyInArrow(run, VERDICT)
    # At most one row a shard for each block, together one bit for each window of the block.
    return marks.groupBy("block").agg(F.collect_list(F.struct("shard", "marks")).alias("marks"))


def without_repeats(docs: DataFrame, length: int = LENGTH, first: int = FIRST) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, removed): each row of `docs` without the words of repeated windows.

    Words stand between white space (space, tab to carriage return) and are compared as they are. A window is `length`
    consecutive words of one row; it is repeated when the same words start anywhere else too, in the same row or another,
    and then every word it covers goes, in all places. Windows are judged on the input. `kept` is the words that stay,
    joined by one space, and `removed` the ranges [start, end) of words that went.

    Every row is a document of its own, so rows that are equal repeat each other. A null text has no words, a null doc_id
    stays null, texts below `length` words stay whole, an empty table gives an empty one. Other columns of `docs` can have
    any name and do not travel. A text of any length is held by one task, as some 100 bytes for each of its words.
    """
    lengths = levels(length, first)
    blocks = written(blocks_of(keyed_texts(docs)), "substring-blocks")
    shards = 1 + (blocks.agg(F.sum("n_words")).first()[0] or 0) // WINDOWS_PER_SHARD
    verdict = None
    for k in range(len(lengths)):
        cells = cells_of(blocks, verdict, lengths, k, shards)
        verdict = written(verdicts_of(cells, k == len(lengths) - 1), "substring-marks")
    return beside(blocks, verdict).mapInArrow(cleaner(lengths, shards), RESULT)


def cleaner(lengths: list[int], shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("removed", pa.list_(span))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in pieces(batches, 1):
            words = Words(row, shards)
            alive = after(words, lengths, len(lengths) - 1, marks_of(row))
            cover = np.zeros(len(alive) + 1, np.int64)
            starts = np.flatnonzero(alive)
            cover[starts] += 1
            cover[starts + lengths[-1]] -= 1
            gone = np.cumsum(cover[:-1]) > 0
            ends = np.concatenate([[0], words.ends])
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[ends])
            kept = words.different.take(pa.array(words.ids[~gone]))
            offsets = np.concatenate([[0], np.cumsum(words.lengths - removed)])
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), kept), " ")
            # Ranges end with their document, also where the next one's begins beside it.
            edge = np.zeros(len(gone) + 1, bool)
            edge[ends] = True
            begins = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate([[False], gone])[:-1]))
            stops = np.flatnonzero(gone & (edge[1:] | ~np.concatenate([gone, [False]])[1:])) + 1
            docs = np.searchsorted(words.ends, begins, side="right")
            base = (words.ends - words.lengths)[docs]
            spans = pa.StructArray.from_arrays([pa.array(begins - base), pa.array(stops - base)], fields=list(span))
            cuts = np.searchsorted(docs, np.arange(len(words.lengths) + 1))
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans)
            columns = [words.doc_ids, pa.array(words.lengths), pa.array(removed), text, lists]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run
