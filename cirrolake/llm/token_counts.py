"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

The best segmentation of a prefix does not depend on what follows, so all pre-tokens that share a prefix share its
forward scores. A batch's different pre-tokens are inserted into a trie; each new node gets its best score and number of
tokens once, from the vocabulary entries that end there, and each pre-token's end keeps its count. Very long pre-tokens
keep no prefixes, only the scores that an entry reaches back to, so memory does not grow with them. Rows are
independent, so nothing is shuffled; the vocabulary is broadcast, its size checked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from cirrolake.llm.bpe import LONG_TEXT, read_ranks
from cirrolake.llm.common import keyed_texts, pieces

#: Nodes and pre-tokens that a Python worker keeps; beyond it starts a new trie, which costs time but changes no result.
KEPT_NODES = 1_500_000
KEPT_TOKENS = 400_000
#: Pre-tokens of more bytes are counted without the trie, and not kept: they are seldom met twice.
LONG_PIECE = 1024


class UnigramCounter:
    """A vocabulary whose entry of rank r has the log-probability of Zipf's law, -log(r + 1) - log(H).

    Scores are whole numbers of millionths, so that sums do not depend on their order; of segmentations with one score
    the one with the fewest tokens counts.
    """

    def __init__(self, tokens: list[bytes], pattern: str):
        if len(set(tokens)) != len(tokens) or not {bytes([b]) for b in range(256)} <= set(tokens):
            raise ValueError("the vocabulary must hold every single byte, and no entry twice")
        total = math.log(sum(1 / (rank + 1) for rank in range(len(tokens))))
        self.scores = {token: round(1e6 * (-math.log(rank + 1) - total)) for rank, token in enumerate(tokens)}
        self.pattern = pattern
        self.trie: dict | None = None

    def _prepare(self) -> None:
        """The vocabulary as a trie of reversed entries: from an end backwards, it says which entries end there."""
        self.width = max(map(len, self.scores)) + 1
        self.backwards: dict = {}
        for token, score in self.scores.items():
            node = self.backwards
            for byte in reversed(token):
                node = node.setdefault(byte, {})
            node[-1] = score
        self.split = regex.compile(self.pattern)
        self._restart()

    def _restart(self) -> None:
        self.trie, self.nodes, self.counts = {}, 0, {}

    def _best(self, piece: bytes, at: int, best: list[int], fewest: list[int], width: int) -> tuple[int, int]:
        """(score, tokens) of the prefix that ends with byte `at`: every entry that ends there joins the best way to where
        it begins. `best` and `fewest` hold the prefix of length n at n % width."""
        score, tokens, step, place = None, 0, self.backwards, at
        while place >= 0 and (step := step.get(piece[place])) is not None:
            own = step.get(-1)
            if own is not None:
                whole, many = best[place % width] + own, fewest[place % width] + 1
                if score is None or whole > score or whole == score and many < tokens:
                    score, tokens = whole, many
            place -= 1
        return score, tokens

    def insert(self, piece: bytes) -> int:
        """The number of tokens of a pre-token; makes the nodes that its prefixes lack."""
        node, best, fewest, width = self.trie, [0], [0], len(piece) + 1
        for at, byte in enumerate(piece):
            known = node.get(byte)
            if known is None:
                known = node[byte] = {-1: self._best(piece, at, best, fewest, width)}
                self.nodes += 1
            node = known
            score, tokens = node[-1]
            best.append(score)
            fewest.append(tokens)
        return fewest[-1]

    def alone(self, piece: bytes) -> int:
        """The same number, without nodes and with as many scores as the longest entry has bytes."""
        width = self.width
        best, fewest = [0] * width, [0] * width
        for at in range(len(piece)):
            best[(at + 1) % width], fewest[(at + 1) % width] = self._best(piece, at, best, fewest, width)
        return fewest[len(piece) % width]

    def count(self, text: str) -> int:
        if self.trie is None:
            self._prepare()
        found = self.split.findall(text) if len(text) < LONG_TEXT else (m[0] for m in self.split.finditer(text))
        get, total = self.counts.get, 0
        for piece in found:
            number = get(piece)
            if number is None:
                raw = piece.encode()
                if len(raw) > LONG_PIECE:
                    total += self.alone(raw)
                    continue
                if self.nodes > KEPT_NODES or len(self.counts) > KEPT_TOKENS:
                    self._restart()
                    get = self.counts.get
                number = self.counts[piece] = self.insert(raw)
            total += number
        return total


def shared_counter(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    return spark.sparkContext.broadcast(UnigramCounter(read_ranks(path), pattern))


def counted(docs: DataFrame, counter: Broadcast, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every row, over its whole text; null and empty texts have none. Repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            counts = pa.array([counter.value.count(t) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts], ["doc_id", "n_tokens"])

    return keyed_texts(docs, doc_id, text).mapInArrow(run, "doc_id bigint, n_tokens bigint")
