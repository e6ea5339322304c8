"""Merkle manifest of a dataset: a postorder append log of hashes, and proofs read from it.

Every language has a tree over its rows in the order of their ids, and the roots of these trees are the leaves of one
more tree. A node is the hash of two neighbours, or of one where a level ends with an odd one.

A tree is kept as the log of its nodes in the order in which they are completed, when leaves are appended one by one.
Where a node lies then follows from sizes of subtrees alone (`position`). Builders are aligned: one takes the 2^HEIGHT
leaves below one node and writes everything up to that node, which is one unbroken run of the log; their roots are the
next builders' leaves. A proof addresses siblings by position: those below the builder's node lie in its own run, those
above are the same for the whole run and are looked up once for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cirrolake.llm.common import pieces, written

#: A builder takes 2^HEIGHT leaves.
HEIGHT = 12

RUN = "tree bigint, block bigint, n bigint, first bigint, ids array<bigint>, altered array<string>, digests binary"
NODE = "tree bigint, n bigint, level int, index bigint, position bigint, digest string"
STEP = "struct<side: string, digest: string>"


def hashed(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def depth(n: int) -> int:
    """The level of the root over n leaves, which are at level 0."""
    return (n - 1).bit_length() if n else 0


def width(n: int, level: int) -> int:
    """Number of nodes at a level over n leaves."""
    return (n + (1 << level) - 1) >> level


def before(leaves: int) -> int:
    """Number of nodes that are complete once so many leaves are appended, and more follow."""
    return 2 * leaves - leaves.bit_count()


def position(level: int, index: int, n: int) -> int:
    """Where a node lies in the log of n leaves: behind all to the left of its subtree, at its subtree's end."""
    first = index << level
    leaves = min(1 << level, n - first)
    return before(first) + sum(width(leaves, h) for h in range(level + 1)) - 1


def grown(digests: list[str], levels: int) -> list[list[str]]:
    """Levels of a subtree over its leaves, themselves included."""
    found = [digests]
    for _ in range(levels):
        below = found[-1]
        found.append([hashed(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return found


def _depth(n: Column) -> Column:
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """Hash of a row: each value as its number of bytes, a colon and itself, a null as a dash."""
    values = [v.cast("string") for v in (doc_id, source, lang, n_chars, text)]
    fields = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*fields), 256)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(lang, id, digest, altered) of documents; `altered` is the hash with one more in n_chars, where `tampered` is true."""
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    altered = leaf(*values[:3], more, values[4])
    return docs.select(
        F.col("lang").cast("string").alias("lang"),
        F.col("doc_id").cast("bigint").alias("id"),
        leaf(*values).alias("digest"),
        (F.lit(None).cast("string") if tampered is None else F.when(tampered, altered)).alias("altered"),
    )


def numbered(df: DataFrame, name: str, *order: str) -> DataFrame:
    """`df` with the place of each row in the given order; rows equal in it are placed as they come.

    Rows are dealt by ranges of the order, equal ones over several tasks, and numbered within each; the ranges' sizes,
    one row for each task, give where each begins.
    """
    salted = df.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    dealt = salted.repartitionByRange(*order, "_salt").sortWithinPartitions(*order, "_salt").drop("_salt")
    kept = written(dealt.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    sizes = kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_start"))
    placed = kept.withColumn("_part", part).join(starts, "_part")
    return placed.withColumn(name, F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_start")


def trees_of(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves (tree, n, rank, id, digest, altered), and trees (tree, lang, n); trees are numbered in the order of lang."""
    places = written(numbered(leaves, "place", "lang", "id", "digest"), "leaves-in-order")
    sizes = places.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    trees = written(numbered(sizes, "tree", "lang"), "trees")
    of_lang = trees.withColumnRenamed("lang", "_lang")
    joined = places.join(of_lang, F.col("lang").eqNullSafe(F.col("_lang")))
    ranked = joined.select("tree", "n", (F.col("place") - F.col("first")).alias("rank"), "id", "digest", "altered")
    return ranked, trees.select("tree", "lang", "n")


def runs_of(ranked: DataFrame) -> DataFrame:
    """The log's runs below the builders' nodes: the leaves' ids, and the digests in the order of completion."""
    schema = pa.schema(
        [
            ("tree", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("first", pa.int64()),
            ("ids", pa.list_(pa.int64())), ("altered", pa.list_(pa.string())), ("digests", pa.binary()),
        ]
    )

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        head = table.slice(0, 1).to_pylist()[0]
        n, block = head["n"], head["rank"] >> HEIGHT
        levels = grown(table.column("digest").to_pylist(), min(HEIGHT, depth(n)))
        first, count = block << HEIGHT, table.num_rows
        start = before(first)
        log = bytearray(32 * sum(len(nodes) for nodes in levels))
        for level, nodes in enumerate(levels):
            for i, digest in enumerate(nodes):
                at = 32 * position(level, i, count)
                log[at : at + 32] = bytes.fromhex(digest)
        values = [head["tree"], block, n, start, table.column("id").to_pylist(), table.column("altered").to_pylist(), bytes(log)]
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    block = F.shiftright("rank", HEIGHT).alias("block")
    return ranked.groupBy("tree", block).applyInArrow(build, RUN)


def nodes_above(runs: DataFrame) -> DataFrame:
    """The nodes from the builders' own on up to the roots, in as many rounds as the largest tree has heights."""
    level = F.least(F.lit(HEIGHT), _depth(F.col("n")))
    last = F.col("first") + F.length("digests") / 32 - 1
    tops = runs.select(
        "tree",
        "n",
        level.cast("int").alias("level"),
        F.col("block").alias("index"),
        last.cast("bigint").alias("position"),
        F.lower(F.hex(F.substring("digests", -32, 32))).alias("digest"),
    )
    tops = written(tops, "nodes")
    schema = pa.schema(
        [
            ("tree", pa.int64()), ("n", pa.int64()), ("level", pa.int32()), ("index", pa.int64()),
            ("position", pa.int64()), ("digest", pa.string()),
        ]
    )

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("index")
        head = table.slice(0, 1).to_pylist()[0]
        n, base, start = head["n"], head["level"], head["index"]
        rows = []
        for k, nodes in enumerate(grown(table.column("digest").to_pylist(), min(HEIGHT, depth(n) - base))):
            level = base + k
            places = ((start >> k) + i for i in range(len(nodes)))
            rows += [(head["tree"], n, level, i, position(level, i, n), d) for i, d in zip(places, nodes) if k]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    largest = tops.agg(F.max("n")).first()[0] or 0
    for base in range(HEIGHT, depth(largest), HEIGHT):
        open_ones = tops.where((F.col("level") == base) & (_depth(F.col("n")) > base))
        more = open_ones.groupBy("tree", F.shiftright("index", HEIGHT).alias("_group")).applyInArrow(build, NODE)
        tops = tops.unionByName(written(more, "nodes"))
    return tops


def log_of(runs: DataFrame, tops: DataFrame) -> DataFrame:
    """(tree, position, digest): the append logs of all trees, every node once."""
    count = (F.length("digests") / 32).cast("int")
    at = F.explode(F.sequence(F.lit(0), count - 1)).alias("_at")
    below = runs.select("tree", "first", "digests", at)
    digest = F.lower(F.hex(F.expr("substring(digests, 32 * _at + 1, 32)")))
    low = below.select("tree", (F.col("first") + F.col("_at")).alias("position"), digest.alias("digest"))
    return low.unionByName(tops.where(F.col("level") > HEIGHT).select("tree", "position", "digest"))


def upper_steps(runs: DataFrame, tops: DataFrame) -> DataFrame:
    """(tree, block, above): for each run the steps from its node to the root, siblings looked up by their position."""
    schema = pa.schema(
        [("tree", pa.int64()), ("block", pa.int64()), ("level", pa.int32()), ("side", pa.string()), ("position", pa.int64())]
    )

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = []
            for row in batch.to_pylist():
                for level in range(HEIGHT, depth(row["n"])):
                    index = row["block"] >> (level - HEIGHT)
                    side, at = sibling(index, level, row["n"])
                    rows.append((row["tree"], row["block"], level, side, at))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    asked = runs.select("tree", "block", "n").mapInArrow(wanted, "tree bigint, block bigint, level int, side string, position bigint")
    answered = asked.join(tops.select("tree", "position", "digest"), ["tree", "position"], "left")
    steps = F.sort_array(F.collect_list(F.struct("level", "side", "digest")))
    return answered.groupBy("tree", "block").agg(F.transform(steps, lambda s: F.struct(s["side"].alias("side"), s["digest"].alias("digest"))).alias("above"))


def sibling(index: int, level: int, n: int) -> tuple[str, int | None]:
    """On which side of a node its sibling stands, and where in the log; none for a last odd one."""
    if index ^ 1 >= width(n, level):
        return "none", None
    return ("left" if index & 1 else "right"), position(level, index ^ 1, n)


def folded(digest: str, steps: list[tuple[str, str | None]]) -> str:
    """The root that a leaf and the siblings on its way give."""
    for side, other in steps:
        digest = hashed(other, digest) if side == "left" else hashed(digest, other) if side == "right" else hashed(digest)
    return digest


def paths(runs: DataFrame, tops: DataFrame, beyond: DataFrame | None = None) -> DataFrame:
    """(tree, id, rank, digest, altered, root, steps): for each leaf the way to the root, siblings read from the log.

    `beyond` (tree, steps, root) continues each tree's ways above its own root.
    """
    roots = tops.where(F.col("level") == _depth(F.col("n"))).select("tree", F.col("digest").alias("subroot"))
    found = runs.join(upper_steps(runs, tops), ["tree", "block"], "left").join(roots, "tree")
    if beyond is None:
        beyond = roots.select("tree", F.lit(None).cast(f"array<{STEP}>").alias("steps"), F.col("subroot").alias("root"))
    found = found.join(beyond.select("tree", F.col("steps").alias("beyond"), "root"), "tree")
    step = pa.struct([("side", pa.string()), ("digest", pa.string())])
    schema = pa.schema(
        [
            ("tree", pa.int64()), ("id", pa.int64()), ("rank", pa.int64()), ("position", pa.int64()), ("digest", pa.string()),
            ("altered", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("folded_root", pa.string()), ("steps", pa.list_(step)),
        ]
    )

    def ways(row: dict) -> Iterator[tuple]:
        log, count, n = row["digests"], len(row["ids"]), row["n"]
        at = lambda place: log[32 * place : 32 * place + 32].hex()
        shared = [(s["side"], s["digest"]) for part in ("above", "beyond") for s in row[part] or []]
        for i, (doc, altered) in enumerate(zip(row["ids"], row["altered"])):
            steps = []
            for level in range(min(HEIGHT, depth(n))):
                side, place = sibling(i >> level, level, count)
                steps.append((side, None if place is None else at(place)))
            steps += shared
            place = position(0, i, count)
            digest = at(place)
            end = folded(altered or digest, steps)
            rank = (row["block"] << HEIGHT) + i
            yield (row["tree"], doc, rank, row["first"] + place, digest, altered, row["subroot"], row["root"], end,
                   [{"side": s, "digest": d} for s, d in steps])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            columns = zip(*ways(batch.to_pylist()[0]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    out = (
        "tree bigint, id bigint, rank bigint, position bigint, digest string, altered string, subroot string, root string, "
        f"folded_root string, steps array<{STEP}>"
    )
    return found.mapInArrow(run, out)


def proofs(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, lang, position, leaf, subroot, root, folded_root, steps) for every row of `docs`.

    `docs` has doc_id, source, lang, n_chars and text, nulls in any of them; other columns can have any name. Leaves of a
    language stand by doc_id, nulls first, rows of one doc_id by their hash; equal rows are leaves of their own. A null
    lang is a language, the first one. `steps` are the siblings (side, digest) up to `root`; side `none` is a level at
    which the node is alone. `folded_root` is what these make of the leaf, or of its altered form where `tampered` is
    true. An empty table gives an empty one; of several languages or one, a single leaf is its own root.
    """
    ranked, trees = trees_of(written(leaves(docs, tampered), "leaves"))
    runs = written(runs_of(ranked), "log-runs")
    tops = nodes_above(runs)
    subroots = tops.where(F.col("level") == _depth(F.col("n"))).select("tree", "digest")
    n_trees = trees.agg(F.count(F.lit(1)).alias("n"))
    top_leaves = subroots.crossJoin(F.broadcast(n_trees)).select(
        F.lit(0).cast("bigint").alias("tree"), "n", F.col("tree").alias("rank"), F.col("tree").alias("id"), "digest",
        F.lit(None).cast("string").alias("altered"),
    )
    top_runs = written(runs_of(top_leaves), "log-runs")
    upper = paths(top_runs, nodes_above(top_runs)).select(F.col("id").alias("tree"), "steps", "root")
    found = paths(runs, tops, written(upper, "tree-proofs"))
    return found.join(trees, "tree").select(
        F.col("id").alias("doc_id"), "lang", "position", F.col("digest").alias("leaf"), "subroot", "root", "folded_root", "steps"
    )
