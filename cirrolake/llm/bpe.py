"""Byte-level BPE, encoding and decoding, in two tiers.

A minimal perfect hash over the vocabulary resolves a pre-token that is a vocabulary entry in one probe. Any other
pre-token goes through a heap of adjacent pairs over a linked list of its bytes, which stays n log n for a pre-token of
any length. Rows are independent, so nothing is shuffled; the vocabulary is broadcast, its size checked.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from cirrolake.llm.common import keyed_texts, pieces

LARGEST_VOCABULARY = 1 << 20
#: Pre-tokens that a Python worker remembers; more only costs time, never changes a result.
REMEMBERED = 400_000
#: Characters of a text above which its pre-tokens are taken one by one instead of as a list.
LONG_TEXT = 1 << 20


#: Texts of code points below this are split by the standard library's engine, which is faster: with the pattern's classes
#: spelled out it finds the same matches.
PLAIN_BELOW = 0x250
NOT_PLAIN = re.compile(f"[^\\x00-{chr(PLAIN_BELOW - 1)}]")


def plain_pattern(pattern: str) -> re.Pattern | None:
    """The pattern with its classes of letters, numbers and white space as ranges of code points below PLAIN_BELOW.

    None if it holds any other class or escape, which the two engines might read differently.
    """

    def ranges(kind: str) -> str:
        has = [bool(regex.fullmatch(kind, chr(c))) for c in range(PLAIN_BELOW)]
        starts = [c for c in range(PLAIN_BELOW) if has[c] and not (c and has[c - 1])]
        ends = [c for c in range(PLAIN_BELOW) if has[c] and not (c + 1 < PLAIN_BELOW and has[c + 1])]
        return "".join(f"\\u{low:04x}-\\u{high:04x}" for low, high in zip(starts, ends))

    found, inside, at = [], False, 0
    while at < len(pattern):
        kind = next((k for k in (r"\p{L}", r"\p{N}", r"\s", r"\S") if pattern.startswith(k, at)), None)
        if kind == r"\S" and inside or kind is None and pattern[at] == "\\" or pattern[at : at + 2] == "(?" and pattern[at + 2] not in "!=:":
            return None
        if kind is None:
            inside = {"[": True, "]": False}.get(pattern[at], inside)
            found.append(pattern[at])
            at += 1
        else:
            members = ranges(kind.replace("S", "s"))
            found.append(members if inside else f"[{'^' if kind == r'\S' else ''}{members}]")
            at += len(kind)
    return re.compile("".join(found))


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file in the order of their ranks, which are 0 to n - 1."""
    with open(path, "rb") as file:
        ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, file))
    if [rank for rank, _ in ranked] != list(range(len(ranked))) or len(ranked) > LARGEST_VOCABULARY:
        raise ValueError(f"{path}: ranks must run from 0 without gaps, to at most {LARGEST_VOCABULARY} entries")
    return [token for _, token in ranked]


class PerfectHash:
    """A minimal perfect hash: n keys to n slots, with one small number (pilot) for each bucket of about four keys.

    Buckets are placed from the largest to the smallest, each with the first pilot that sends its keys to free slots;
    buckets of one key take what is left, their slot stored as -1 - slot. A slot keeps its key's number, and the key is
    compared, so that foreign keys are told apart.
    """

    def __init__(self, keys: list[bytes]):
        self.keys, n = keys, len(keys)
        self.buckets = max(1, n // 4)
        self.pilots = [0] * self.buckets
        self.slots = [-1] * n
        groups: dict[int, list[int]] = {}
        for number, key in enumerate(keys):
            groups.setdefault(xxhash.xxh64_intdigest(key) % self.buckets, []).append(number)
        taken = np.zeros(n, bool)
        ordered = sorted(groups.items(), key=lambda group: -len(group[1]))
        for bucket, members in ordered:
            if len(members) == 1:
                continue
            first = np.array([xxhash.xxh64_intdigest(keys[m], 1) % n for m in members])
            step = np.array([xxhash.xxh64_intdigest(keys[m], 2) % n for m in members])
            for low in range(0, n * n, 1024):
                tries = (first + np.arange(low, low + 1024)[:, None] * step + (np.arange(low, low + 1024)[:, None] ** 2)) % n
                free = ~taken[tries].any(axis=1)
                ranked = np.sort(tries, axis=1)
                found = np.flatnonzero(free & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1))
                if len(found):
                    break
                if low > 64 * n:
                    raise ValueError("two keys are equal or hash alike")
            self.pilots[bucket] = low + int(found[0])
            taken[tries[found[0]]] = True
            for member, slot in zip(members, tries[found[0]].tolist()):
                self.slots[slot] = member
        left = iter(np.flatnonzero(~taken).tolist())
        for bucket, members in ordered:
            if len(members) == 1:
                slot = next(left)
                self.pilots[bucket] = -1 - slot
                self.slots[slot] = members[0]

    def find(self, key: bytes) -> int:
        """The number of `key`, or -1."""
        pilot = self.pilots[xxhash.xxh64_intdigest(key) % self.buckets]
        n = len(self.slots)
        if pilot < 0:
            slot = -1 - pilot
        else:
            slot = (
                xxhash.xxh64_intdigest(key, 1) % n + pilot * (xxhash.xxh64_intdigest(key, 2) % n) + pilot * pilot
            ) % n
        number = self.slots[slot]
        return number if self.keys[number] == key else -1


class Codec:
    """A vocabulary with its pattern; builds its table of merges where it is first used."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        self.whole = PerfectHash(tokens)
        self.merges: dict[int, int] | None = None

    def _prepare(self) -> None:
        rank = {token: number for number, token in enumerate(self.tokens)}
        self.single = [rank.get(bytes([b]), -1) for b in range(256)]
        self.split, self.plain_split = regex.compile(self.pattern), plain_pattern(self.pattern)
        self.table = pa.array(self.tokens, pa.large_binary())
        self.remembered: dict[str, bytes] = {}
        self.merges = {
            rank[token[:at]] << 20 | rank[token[at:]]: number
            for number, token in enumerate(self.tokens)
            for at in range(1, len(token))
            if token[:at] in rank and token[at:] in rank
        }

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: the pair of lowest rank is merged first, the leftmost of equal ones."""
        if self.merges is None:
            self._prepare()
        merges, n = self.merges, len(piece)
        ids = [self.single[b] for b in piece]
        if min(ids) < 0:
            raise ValueError("the vocabulary lacks a single byte that a text holds")
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [found << 40 | i for i in range(n - 1) if (found := merges.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            rank, i = entry >> 40, entry & (1 << 40) - 1
            j = after[i]
            if ids[i] < 0 or j >= n or merges.get(ids[i] << 20 | ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (found := merges.get(rank << 20 | ids[k])) is not None:
                    heapq.heappush(heap, found << 40 | i)
            h = before[i]
            if h >= 0 and (found := merges.get(ids[h] << 20 | rank)) is not None:
                heapq.heappush(heap, found << 40 | h)
        return [i for i in ids if i >= 0]

    def _look_up(self, piece: str) -> bytes:
        raw = piece.encode()
        number = self.whole.find(raw)
        ids = np.array([number] if number >= 0 else self.merge(raw), "<i4").tobytes()
        if len(self.remembered) >= REMEMBERED:
            self.remembered.clear()
        self.remembered[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers."""
        if self.merges is None:
            self._prepare()
        plain = self.plain_split is not None and NOT_PLAIN.search(text) is None
        split = self.plain_split if plain else self.split
        if len(text) < LONG_TEXT:
            found: Iterable[str] = split.findall(text)
        else:
            found = (match[0] for match in split.finditer(text))
        get, look_up = self.remembered.get, self._look_up
        return b"".join([get(piece) or look_up(piece) for piece in found])

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids; a null list has none."""
        if self.merges is None:
            self._prepare()
        bounds = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())))
        bytes_of = self.table.take(ids.flatten())
        ends = np.frombuffer(bytes_of.buffers()[1], np.int64, len(bytes_of) + 1)[bounds]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), bytes_of.buffers()[2]]).cast(pa.binary())


def shared_codec(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    return spark.sparkContext.broadcast(Codec(read_ranks(path), pattern))


def _lists(encoded: list[bytes]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded))))) // 4
    return pa.ListArray.from_arrays(offsets.astype(np.int32), np.frombuffer(b"".join(encoded), "<i4"))


def encode(docs: DataFrame, codec: Broadcast, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every row, as the public library encodes ordinary text; null and empty texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids = [codec.value.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(ids)], ["doc_id", "ids"])

    return keyed_texts(docs, doc_id, text).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, codec: Broadcast, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, decoded) of every row, decoded binary; null ids decode to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), codec.value.decode(batch.column("ids"))], ["doc_id", "decoded"])

    chosen = encoded.selectExpr(f"`{doc_id}` AS doc_id", f"`{ids}` AS ids")
    return chosen.mapInArrow(run, "doc_id bigint, decoded binary")


def round_trip(docs: DataFrame, codec: Broadcast, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row in one pass: the bytes in `decoded` come from the ids alone.

    Rows are independent: repeated rows, null doc_ids and texts of any length each give their own row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids = _lists([codec.value.encode(t) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, codec.value.decode(ids)], ["doc_id", "ids", "decoded"])

    return keyed_texts(docs, doc_id, text).mapInArrow(run, "doc_id bigint, ids array<int>, decoded binary")
