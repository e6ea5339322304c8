"""Line deduplication by winnowing over line hashes.

Only lines with words count. A window is the shortest run of lines from a line on that holds `least` words, so any
repeated passage of `least` words holds a whole window, and a single line of that length is one. The line with the
smallest hash of each window is its fingerprint, a position that equal passages share; neighbouring windows mostly
share it too, so there are far fewer fingerprints than lines. Fingerprints are joined on the hash of their line to its
first position in the corpus, by doc_id and then by place; from there the match is extended both ways while lines agree,
and where it holds a whole window of the fingerprint the run is deleted. As a deleted line always has an earlier equal
one, the first occurrence of every line stays.

The first position of a line may stand in other company than a later one. Windows that do not agree with it meet a
second time, by the digest of all their lines. All copies of a window agree or disagree with the same first position,
so the two steps find the first copy of every window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrolake.llm.common import as_bytes, keyed_texts, pieces, text_key, unused, written

LEAST_WORDS = 50
#: A null doc_id counts as this one, the smallest.
NO_ID = -(1 << 63)


def line_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, key, n, lines): for each different document the hashes (8 bytes), words and places (4 bytes) of its n lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sizes, columns = [], ([], [], [])
            for text in as_bytes(batch, "text"):
                lines = [line.strip() for line in text.split(b"\n")]
                places = [i for i, line in enumerate(lines) if line]
                sizes.append(len(places))
                columns[0].append(b"".join(xxhash.xxh64_digest(lines[i]) for i in places))
                columns[1].append(np.array([len(lines[i].split()) for i in places], np.int32).tobytes())
                columns[2].append(np.array(places, np.int32).tobytes())
            arrays = [batch.column("id"), batch.column("key"), pa.array(sizes, pa.int32())]
            arrays += [pa.array(c, pa.binary()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "key", "n", "hashes", "words", "places"])

    chosen = keyed_texts(docs, doc_id, text).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), text_key().alias("key"), "text")
    schema = "id bigint, key bigint, n int, hashes binary, words binary, places binary"
    return chosen.mapInArrow(run, schema).where("n > 0").dropDuplicates(["id", "key"])


def windows_of(hashes: np.ndarray, words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(end, place of the smallest hash, the first of equal ones) of the window from each line on that has one."""
    total = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    ends = np.searchsorted(total, total[:-1] + least)
    ends = ends[ends < len(total)]
    places, known = np.zeros(len(ends), np.int64), -1
    for start, end in enumerate(ends.tolist()):
        # Windows move ahead at both ends: while the last minimum is inside, only new lines can be below it.
        if known < start:
            known, seen = start + int(np.argmin(hashes[start:end])), end
        elif end > seen:
            new = seen + int(np.argmin(hashes[seen:end]))
            known, seen = (new if hashes[new] < hashes[known] else known), end
        places[start] = known
    return ends, places


def fingerprints(lines: DataFrame, least: int) -> DataFrame:
    """(hash, id, key, n, pos, low, high): the selected minima of every document and the first and last line at which a
    window with that minimum starts. Windows with one minimum start in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            row, columns = [], ([], [], [], [])
            for at, (h, w) in enumerate(zip(batch.column("hashes").to_pylist(), batch.column("words").to_pylist())):
                hashes = np.frombuffer(h, np.uint64)
                _, places = windows_of(hashes, np.frombuffer(w, np.int32), least)
                chosen, low, many = np.unique(places, return_index=True, return_counts=True)
                row.append(np.full(len(chosen), at))
                for column, values in zip(columns, (hashes[chosen].view(np.int64), chosen, low, low + many - 1)):
                    column.append(values)
            at = pa.array(np.concatenate(row))
            digest, *numbers = (np.concatenate(c) for c in columns)
            arrays = [pa.array(digest), *(batch.column(c).take(at) for c in ("id", "key", "n"))]
            arrays += [pa.array(c.astype(np.int32)) for c in numbers]
            yield pa.RecordBatch.from_arrays(arrays, ["hash", "id", "key", "n", "pos", "low", "high"])

    chosen = lines.select("id", "key", "n", "hashes", "words")
    return chosen.mapInArrow(run, "hash bigint, id bigint, key bigint, n int, pos int, low int, high int")


def agreement(own: np.ndarray, other: np.ndarray, at: np.ndarray, opposite: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For places `at` of `own` opposite to those of `other`: first line and end, in `own`, of the run that agrees there.

    Sums of lines times powers of an odd number tell whether two stretches are equal, so all runs are found together by
    halving, whatever their length and number.
    """
    power = np.cumprod(np.full(max(len(own), len(other)) + 1, 0x9E3779B97F4A7C15, np.uint64))
    sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * power[: len(x)], dtype=np.uint64))) for x in (own, other)]

    def equal(begin: np.ndarray, begin0: np.ndarray, size: np.ndarray) -> np.ndarray:
        one, two = sums[0][begin + size] - sums[0][begin], sums[1][begin0 + size] - sums[1][begin0]
        return one * power[begin0] == two * power[begin]

    def longest(most: np.ndarray, same) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            fits = same(middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low

    ahead = longest(np.minimum(len(own) - at, len(other) - opposite), lambda size: equal(at, opposite, size))
    back = longest(np.minimum(at, opposite), lambda size: equal(at - size, opposite - size, size))
    return at - back, at + ahead


def _opposite_first(prints: DataFrame, by: str, lines: DataFrame) -> DataFrame:
    """One row for each document and each other (or itself) that holds the first of its fingerprints: their places with
    those opposite (struct pos, low, high, pos0), the lines, and of the other one's lines those that can lie opposite."""
    first = prints.groupBy(by).agg(F.min(F.struct("id", "key", "pos")).alias("first"), F.count("*").alias("copies"))
    later = prints.join(first.where("copies > 1").select(by, "first"), by)
    later = later.where("struct(id, key, pos) <> first").select(
        "id", "key", "n", F.col("first.id").alias("id0"), F.col("first.key").alias("key0"),
        F.struct("pos", "low", "high", F.col("first.pos").alias("pos0")).alias("at"),
    )
    shift = F.col("at.pos0") - F.col("at.pos")
    pairs = later.groupBy("id", "key", "id0", "key0").agg(
        F.collect_list("at").alias("at"), F.greatest(F.lit(0), F.min(shift)).alias("begin"), F.max(shift + F.col("n")).alias("end")
    )
    source = lines.select(F.col("id").alias("id0"), F.col("key").alias("key0"), F.col("n").alias("n0"), F.col("hashes").alias("all0"))
    facing = F.expr("substring(all0, 8 * begin + 1, 8 * (least(end, n0) - begin))").alias("facing")
    pairs = pairs.join(source, ["id0", "key0"]).select("id", "key", "at", "begin", facing)
    return pairs.join(lines, ["id", "key"]).select("id", "key", "n", "at", "begin", "facing", "hashes", "words", "places")


def _compared(pairs: DataFrame, least: int) -> DataFrame:
    """Runs that agree and hold a window of their fingerprint, as (id, key, n, start, end) by places in the text; windows
    that do not agree as (id, key, n, digest, pos, low, high), start being null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 64):
            rows, columns = [], ([], [], [], [], [], [])
            for row, r in enumerate(batch.select(["at", "begin", "facing", "hashes", "words", "places"]).to_pylist()):
                own, words, places = (np.frombuffer(r[c], kind) for c, kind in (("hashes", np.uint64), ("words", np.int32), ("places", np.int32)))
                at = np.array([(x["pos"], x["low"], x["high"], x["pos0"]) for x in r["at"]], np.int64)
                pos, low, high = at[:, 0], at[:, 1], at[:, 2]
                start, end = agreement(own, np.frombuffer(r["facing"], np.uint64), pos, at[:, 3] - r["begin"])
                total = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
                ends = np.searchsorted(total, total[:-1] + least)
                # Of the windows from low to high those from `one` to `two` lie in the run.
                one = np.maximum(low, start)
                two = np.minimum(high, np.searchsorted(ends, end, "right") - 1)
                fits = one <= two
                if fits.any():
                    # Runs that overlap are one.
                    found = np.unique(np.stack((start[fits], end[fits]), 1), axis=0)
                    reach = np.maximum.accumulate(found[:, 1])
                    cut = np.flatnonzero(np.concatenate(([True], found[1:, 0] > reach[:-1])))
                    begins, stops = found[cut, 0], reach[np.append(cut[1:], len(found)) - 1]
                    rows += [row] * len(cut)
                    columns[0].extend((places[begins]).tolist())
                    columns[1].extend((places[stops - 1] + 1).tolist())
                    for column in columns[2:]:
                        column.extend([None] * len(cut))
                for i in range(len(pos)):
                    left = range(low[i], high[i] + 1) if not fits[i] else [*range(low[i], one[i]), *range(two[i] + 1, high[i] + 1)]
                    for s in left:
                        rows.append(row)
                        values = (None, None, xxhash.xxh64_intdigest(own[s : ends[s]].tobytes()), int(pos[i]), s, s)
                        for column, value in zip(columns, values):
                            column.append(value)
            taken = pa.array(rows, pa.int64())
            digests = pa.array([None if d is None else d - (d >> 63 << 64) for d in columns[2]], pa.int64())
            numbers = [pa.array(c, pa.int32()) for i, c in enumerate(columns) if i != 2]
            arrays = [*(batch.column(c).take(taken) for c in ("id", "key", "n")), *numbers[:2], digests, *numbers[2:]]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "key", "n", "start", "end", "digest", "pos", "low", "high"])

    return pairs.mapInArrow(run, "id bigint, key bigint, n int, start int, end int, digest bigint, pos int, low int, high int")


def repeated_runs(lines: DataFrame, least: int) -> DataFrame:
    """(id, key, start, end): runs of lines, by their places in the text, that occur earlier in the corpus.

    Windows that disagree with the first position of their minimum have no copy there, so those left by the first step
    hold all copies of theirs.
    """
    prints = written(fingerprints(lines, least), "line-prints")
    met = written(_compared(_opposite_first(prints, "hash", lines), least), "line-runs")
    again = _compared(_opposite_first(met.where("digest is not null"), "digest", lines), least)
    runs = met.where("start is not null").unionByName(again.where("start is not null"))
    return runs.select("id", "key", "start", "end")


def without_repeats(docs: DataFrame, least: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of `docs`, its text without later repeats of passages of `least` words, and lines_removed (bigint),
    removed (array of structs start, end: the runs of lines, from 0, that went, ends exclusive; they may overlap).

    Passages consist of whole lines, compared without white space at their ends. Blank lines between deleted lines go
    with them; other lines stay as they are. Rows equal in doc_id and text are one document: they do not repeat each
    other and get the same result. A null text stays null. Texts without a repeated passage come back unchanged.
    Columns of `docs` that are named as the two new ones are replaced; others can have any name.
    """
    lines = written(line_table(docs, doc_id, text), "lines")
    runs = repeated_runs(lines, least).distinct()
    runs = runs.groupBy("id", "key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed"))
    kept = [c for c in docs.columns if c.lower() not in ("removed", "lines_removed")]
    own_id, own_key = unused(kept, "__id"), unused(kept, "__key")
    keyed = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        F.coalesce(F.col(doc_id), F.lit(NO_ID)).alias(own_id),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias(own_key),
    )
    runs = runs.select(F.col("id").alias(own_id), F.col("key").alias(own_key), "removed")
    joined = keyed.join(runs, [own_id, own_key], "left").drop(own_id, own_key)
    place = kept.index(text)
    schema = joined.withColumn("lines_removed", F.lit(0).cast("bigint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts, removed = batch.column(place), batch.column(len(kept))
            counts = np.zeros(batch.num_rows, np.int64)
            if removed.null_count < batch.num_rows:
                values = texts.to_pylist()
                for row, spans in enumerate(removed.to_pylist()):
                    if spans:
                        found = values[row].split("\n")
                        keep = np.ones(len(found), bool)
                        for span in spans:
                            keep[span["start"] : span["end"]] = False
                        values[row] = "\n".join(line for line, stays in zip(found, keep.tolist()) if stays)
                        counts[row] = (~keep).sum()
                texts = pa.array(values, texts.type)
            columns = batch.columns
            columns[place] = texts
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts)], [*batch.schema.names, "lines_removed"])

    return joined.mapInArrow(run, schema)
