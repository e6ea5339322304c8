"""Toxicity by a support vector machine over a gap-weighted subsequence kernel with Nyström landmarks.

An insult is a word, perhaps with characters put in or an unusual ending, so the machine scores words and a text is as
toxic as its most toxic word. The kernel of two words sums over the letter triples that both hold in this order, gaps
allowed, each occurrence weighted by a decay to the power of its span, and is scaled to 1 for equal words. Landmarks
are words of the labelled sample; features are kernel values against them, whitened. As these features are linear in
the triples, the trained machine collapses to one weight per triple, and scoring costs the same for any number of
landmarks.

Words of a clean text are all clean; of a toxic text only some word is toxic. So training starts from words that stand
out in toxic texts and then takes, in turn, the words of each toxic text that the machine finds most toxic.
"""

from __future__ import annotations

import itertools
import math
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrolake.llm.common import keyed_texts, pieces

LETTERS = 40
LONGEST, STRIDE = 18, 6
#: Marks of a word's beginning and end, which are letters to the kernel.
BEGIN, END = "\x01", "\x02"
#: Words that a Python worker remembers; more only costs time, never changes a result.
REMEMBERED = 600_000


def units(token: str) -> list[str]:
    """A token without punctuation at its ends, with marks of begin and end; a long one as windows that cover it whole."""
    start, end = 0, len(token)
    while start < end and not token[start].isalnum():
        start += 1
    while end > start and not token[end - 1].isalnum():
        end -= 1
    word = BEGIN + token[start:end] + END
    if len(word) <= LONGEST:
        return [word]
    return [word[at : at + LONGEST] for at in range(0, len(word) - LONGEST + STRIDE, STRIDE)]


def tokens(text: str) -> set[str]:
    """The different tokens of a text, and every run of three or more single characters as one more token."""
    found = text.lower().split()
    different = set(found)
    if sum(len(t) == 1 for t in different) > 1:
        for single, run in itertools.groupby(found, key=lambda t: len(t) == 1):
            if single and len(joined := "".join(run)) > 2:
                different.add(joined)
    return different


class Triples:
    """The letter triples of words, in order and with gaps, and their weights."""

    def __init__(self, decay: float):
        self.decay = decay
        self.where = {n: np.array(list(itertools.combinations(range(n), 3)), np.int64) for n in range(3, LONGEST + 1)}

    def of(self, words: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes and weights, a row for each of `words`, all of `length` letters. Other characters are gaps."""
        points = np.array(words, f"<U{length}").view(np.uint32).reshape(-1, length).astype(np.int64)
        latin = (points >= 97) & (points <= 122)
        other = (points >= 128) | ((points >= 48) & (points <= 57))
        letters = np.where(latin, points - 96, np.where(other, 29 + points % (LETTERS - 29), 0))
        letters = np.where((points == 1) | (points == 2), points + 26, letters)
        at = self.where[length]
        a, b, c = (letters[:, at[:, k]] for k in range(3))
        weights = np.where((a > 0) & (b > 0) & (c > 0), self.decay ** (at[:, 2] - at[:, 0] + 1.0), 0.0)
        return (a * LETTERS + b) * LETTERS + c, weights

    def grouped(self, words: list[str], chunk: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places in `words`, codes, weights) by length; equal triples of a word are summed in one of their places."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for length in range(3, LONGEST + 1):
            every = np.flatnonzero(lengths == length)
            for low in range(0, len(every), chunk):
                places = every[low : low + chunk]
                codes, weights = self.of([words[i] for i in places], length)
                order = np.argsort(codes, axis=1, kind="stable")
                codes, weights = np.take_along_axis(codes, order, 1), np.take_along_axis(weights, order, 1)
                first = np.ones(codes.shape, bool)
                first[:, 1:] = codes[:, 1:] != codes[:, :-1]
                starts = np.flatnonzero(first.ravel())
                summed = np.zeros(codes.size)
                summed[starts] = np.add.reduceat(weights.ravel(), starts)
                yield places, codes, summed.reshape(codes.shape)

    def project(self, words: list[str], table: np.ndarray) -> np.ndarray:
        """For each word its scaled triples times `table` (triples by columns)."""
        found = np.zeros((len(words), table.shape[1]), table.dtype)
        for places, codes, weights in self.grouped(words, 512 if table.shape[1] == 1 else 32):
            norms = np.sqrt((weights**2).sum(axis=1))
            scaled = (weights / np.where(norms > 0, norms, 1.0)[:, None]).astype(table.dtype)
            if table.shape[1] == 1:
                found[places, 0] = (scaled * table[codes, 0]).sum(axis=1)
            else:
                found[places] = np.matmul(scaled[:, None, :], table[codes])[:, 0]
        return found

    def table(self, landmarks: list[str]) -> np.ndarray:
        """A column of scaled triples for each landmark."""
        found = np.zeros((LETTERS**3, len(landmarks)), np.float32)
        for places, codes, weights in self.grouped(landmarks):
            norms = np.sqrt((weights**2).sum(axis=1))
            np.add.at(found, (codes, places[:, None]), weights / np.where(norms > 0, norms, 1.0)[:, None])
        return found


@dataclass
class Model:
    """One weight per triple, and the line from a text's best word to its score."""

    decay: float
    weights: np.ndarray = field(repr=False)
    bias: float
    slope: float
    offset: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        if not hasattr(self, "_triples"):
            self._triples = Triples(self.decay)
        cut = [units(w) for w in words]
        flat = self._triples.project([u for x in cut for u in x], self.weights[:, None])[:, 0] + self.bias
        starts = np.concatenate(([0], np.cumsum([len(x) for x in cut])[:-1])).astype(np.int64)
        return np.maximum.reduceat(flat, starts) if len(words) else np.zeros(0)

    def score(self, best: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * best + self.offset, -60, 60)))


def fit_svm(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, start: np.ndarray, ridge: float = 1e-5, rounds: int = 20
) -> np.ndarray:
    """A linear machine with squared hinge loss by Newton steps; the last column of `x` is the constant."""
    w = start.copy()
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-9
    for _ in range(rounds):
        active = y * (x @ w) < 1
        hessian, target = np.diag(penalty), np.zeros(x.shape[1])
        for low in range(0, len(x), 4096):
            part = np.flatnonzero(active[low : low + 4096]) + low
            xa, wa = x[part].astype(float), weight[part]
            hessian += (xa * wa[:, None]).T @ xa
            target += xa.T @ (wa * y[part])
        step = np.linalg.solve(hessian, target) - w
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit_line(best: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of a logistic line, clean texts with twice the weight of toxic ones, targets drawn in a little."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y > 0, 1 / 3 / n1, 2 / 3 / n0)
    x, w = np.stack([best, np.ones_like(best)], axis=1), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weight * (target - p)) - 1e-4 * w)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return float(w[0]), float(w[1])


def _association(toxic: Counter, clean: Counter, n1: int, n0: int) -> dict[str, float]:
    """Log-likelihood ratio of the words that are relatively more frequent in toxic texts."""
    found = {}
    for word, k1 in toxic.items():
        k0 = clean.get(word, 0)
        if k1 * n0 <= k0 * n1:
            continue
        p = (k1 + k0) / (n1 + n0)

        def part(k: int, n: int, p: float = p) -> float:
            return (k * math.log(k / (n * p)) if k else 0.0) + ((n - k) * math.log((n - k) / (n * (1 - p))) if n > k and p < 1 else 0.0)

        found[word] = 2 * (part(k1, n1) + part(k0, n0))
    return found


def train(rows: list[tuple[list[str], int]], landmarks: int = 224, decay: float = 0.6, rounds: int = 8, mined: int = 4000) -> Model | None:
    """A model from texts as lists of different units, with labels 1 and 0; None where a class is missing."""
    n1, n0 = sum(y == 1 for _, y in rows), sum(y == 0 for _, y in rows)
    if not n1 or not n0:
        return None
    triples = Triples(decay)
    clean = Counter(u for found, y in rows if y == 0 for u in found)
    toxic = Counter(u for found, y in rows if y == 1 for u in found)
    related = _association(toxic, clean, n1, n0)
    ranked = sorted(related, key=lambda u: (-related[u], u))
    seeds = [u for u in ranked if related[u] > 10.83 and clean.get(u, 0) * 20 * n1 <= toxic[u] * n0] or ranked[:1]
    if not seeds:
        return None
    usual = [u for u, _ in sorted(clean.items(), key=lambda x: (-x[1], x[0]))]
    positive = _spread(triples, seeds[: 16 * landmarks], landmarks // 2)
    # Clean words that look most like the seeds, and the most frequent ones.
    alike = triples.project(usual[:20000], triples.table(positive)).max(axis=1)
    hard = [usual[i] for i in np.argsort(-alike, kind="stable")[: landmarks // 4]]
    chosen = list(dict.fromkeys([*positive, *hard, *usual[: landmarks // 4]]))
    table = triples.table(chosen)
    values, vectors = np.linalg.eigh(triples.project(chosen, table))
    keep = values > 1e-6
    whitening = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)
    for low in range(0, len(table), 4096):  # in place: the table is the largest thing here
        table[low : low + 4096, : keep.sum()] = table[low : low + 4096] @ whitening
    table = table[:, : keep.sum()]

    vocabulary = sorted(set(clean) | set(toxic))
    number = {u: i for i, u in enumerate(vocabulary)}
    seen = np.array([clean.get(u, 0) for u in vocabulary], float)
    known = {number[u] for u in seeds}
    texts = [(np.array([number[u] for u in found], np.int64), y) for found, y in rows]
    unexplained = [i for i, y in texts if y == 1 and not known.intersection(i.tolist())]
    positives = np.array(sorted(known), np.int64)
    frequent = np.array([number[u] for u in [*usual[:6000], *usual[-6000:]]], np.int64)
    negatives = np.setdiff1d(frequent, positives)
    features = _Features(triples, table, vocabulary)
    w = np.zeros(table.shape[1] + 1)
    for _ in range(rounds):
        at = np.concatenate([positives, negatives])
        y = np.concatenate([np.ones(len(positives)), -np.ones(len(negatives))])
        heavy = np.sqrt(seen[negatives])
        weight = np.concatenate([np.full(len(positives), 1 / len(positives)), 4 * heavy / heavy.sum()])
        w = fit_svm(features.of(at), y, weight, w)
        f = triples.project(vocabulary, (table @ w[:-1])[:, None])[:, 0] + w[-1]
        best = {int(i[np.argmax(np.where(seen[i] == 0, f[i], -np.inf))]) for i in unexplained if (seen[i] == 0).any()}
        positives = np.array(sorted(known | {i for i in best if f[i] > -0.5}), np.int64)
        wrong = np.setdiff1d(np.flatnonzero((seen > 0) & (f > -0.8)), positives)
        wrong = wrong[np.argsort(-f[wrong], kind="stable")][:mined]
        negatives = np.setdiff1d(np.union1d(negatives, wrong), positives)
    best = np.array([f[i].max() if len(i) else w[-1] for i, _ in texts])
    slope, offset = fit_line(best, np.array([1 if y == 1 else -1 for _, y in texts]))
    return Model(decay, table @ w[:-1], float(w[-1]), slope, offset)


class _Features:
    """Whitened kernel values of words, computed once each, and a constant."""

    def __init__(self, triples: Triples, table: np.ndarray, words: list[str]):
        self.triples, self.table, self.words = triples, table, words
        self.rows: dict[int, np.ndarray] = {}

    def of(self, places: np.ndarray) -> np.ndarray:
        new = [i for i in places.tolist() if i not in self.rows]
        self.rows.update(zip(new, self.triples.project([self.words[i] for i in new], self.table)))
        found = np.ones((len(places), self.table.shape[1] + 1), np.float32)
        for row, place in enumerate(places.tolist()):
            found[row, :-1] = self.rows[place]
        return found


def _spread(triples: Triples, words: list[str], count: int) -> list[str]:
    """The first of `words`, leaving out those that are nearly a chosen one, then filled up in order."""
    words = words[: 3 * count]
    parts = [triples.project(words, triples.table(words[at : at + 64])) for at in range(0, len(words), 64)]
    alike = np.concatenate(parts, axis=1)
    chosen: list[int] = []
    for i in range(alike.shape[0]):
        if len(chosen) < count and (not chosen or alike[i, chosen].max() < 0.9):
            chosen.append(i)
    return [words[i] for i in chosen]


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int, words: int) -> DataFrame:
    """(found, label): of each class at most `bound` labelled ids, drawn by hash, with up to `words` tokens of each text.

    `labels` has doc_id and label 0 or 1; the larger one counts where an id has both.
    """
    unique = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    drawn = F.xxhash64(F.col("doc_id").cast("string"))
    halves = [unique.where(F.col("label") == y).orderBy(drawn, "doc_id").limit(bound) for y in (0, 1)]
    # At most 2 * bound ids, so they can be sent to every task.
    chosen = docs.join(F.broadcast(halves[0].unionByName(halves[1])), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [sorted(tokens(t), key=lambda t: (hash_of(t), t))[:words] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), batch.column("label")], ["found", "label"])

    return chosen.select("text", F.col("label").cast("int").alias("label")).mapInArrow(run, "found array<string>, label int")


def hash_of(token: str) -> int:
    """A number that does not depend on the process."""
    return int.from_bytes(token.encode()[-8:], "little") * 0x9E3779B97F4A7C15 % (1 << 64)


def fit(docs: DataFrame, labels: DataFrame, bound: int = 1800, words: int = 1000) -> Model | None:
    """A model from the labelled rows of `docs` (doc_id, text): at most `bound` ids of each class and `words` tokens of each."""
    sample = labelled_sample(keyed_texts(docs), labels, bound, words)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [sorted({u for t in ts for u in units(t) if len(u) > 2}) for ts in batch.column("found").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), batch.column("label")], ["found", "label"])

    # The units of each text are found by the executors and come one partition at a time, interned as they arrive, as
    # most are in many texts: the driver never holds the texts' tokens, nor all rows before interning. The order of the
    # rows must not matter.
    found = sample.mapInArrow(cut, "found array<string>, label int").toLocalIterator()
    rows = sorted(([sys.intern(u) for u in units_], y) for units_, y in found)
    return train(rows)


class _Scorer:
    """Scores texts in a worker, remembering words."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def of(self, texts: list[str | None]) -> np.ndarray:
        found = [tokens(t or "") for t in texts]
        fresh = list(set().union(*found).difference(self.known))
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known, fresh = {}, list(set().union(*found))
        self.known.update(zip(fresh, self.model.word_scores(fresh).tolist()))
        best = [max(map(self.known.__getitem__, t), default=self.model.bias) for t in found]
        return self.model.score(np.array(best))


def scored(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row, over the whole text; without a model every score is 0.

    Empty and null texts get the score of a text without words. Repeated rows each get their own row.
    """
    chosen = keyed_texts(docs, doc_id, text)
    if model is None:
        return chosen.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 64,000 weights, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in pieces(batches):
            scores = pa.array(scorer.of(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    return chosen.mapInArrow(run, "doc_id bigint, score double")


def clean(docs: DataFrame, model: Model | None, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of `docs` whose score is below `threshold`, with all their columns; without a model all rows."""
    if model is None:
        return docs
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in pieces(batches):
            yield batch.filter(pa.array(scorer.of(batch.column(place).to_pylist()) < threshold))

    return docs.mapInArrow(run, docs.schema)
