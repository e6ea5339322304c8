"""Registered queries of the text operators; each takes (spark, sf_dir) and works on whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrolake.llm import (
    bpe, decontaminate, language_model, licenses, line_dedup, merkle, order_minhash, simhash, substring_dedup, token_counts, toxicity, warc, whitening,
)
from cirrolake.llm.common import table, written
from cirrolake.session import importable_by_workers, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable_by_workers(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_model.scored(docs, learning_part("doc_id", 1))
    return found.select(
        "doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeats(docs).select("doc_id", "lines_removed", "removed", "text")


def byte_bpe(spark: SparkSession, docs: DataFrame) -> DataFrame:
    codec = bpe.shared_codec(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip(docs, codec).select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(spark, table(spark, sf_dir, "documents")).drop("ids")


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("uri"), F.col("html").alias("payload"))
    path = f"{scratch_dir(spark, 'archives')}/warc"
    warc.write_archives(pages, path)
    # Read once: what is kept of each record is its head.
    heads = written(warc.read_archives(spark, path, payloads=False), "record-heads")
    return warc.resolved(heads).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def learning_part(doc_id: str, left_out: int) -> Column:
    """Whether a row may be learnt from: all but one of five parts, drawn by the checksum of the id as text."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 != left_out


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model | None:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learnt = labels.where(learning_part("doc_id", 0)).select("doc_id", F.col("toxic").alias("label"))
    return toxicity.fit(docs, learnt)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.scored(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return found.select(
        "doc_id",
        F.coalesce(~learning_part("doc_id", 0), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counter = token_counts.shared_counter(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return token_counts.counted(table(spark, sf_dir, "documents"), counter)


@query
def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_minhash.beside_next(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        order_minhash.as_hex(F.col("signature")).alias("fingerprint"),
        order_minhash.as_hex(F.col("edited_signature")).alias("edited_fingerprint"),
        order_minhash.likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        order_minhash.likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )


@query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


@query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = merkle.proofs(table(spark, sf_dir, "documents"), tampered)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join("steps.digest", ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: Ten hex digits of a SHA-1, from `at` on, as eight base32 digits.
BASE32_PART = """list_aggregate(list_transform(range(8), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(h, {at}, 10))::BIGINT >> (35 - 5 * j)) & 31) + 1)::BIGINT, 1)), 'string_agg', '')"""



def merkle_leaf(n_chars: str) -> str:
    """A row's hash input."""
    values = [f"({v})::VARCHAR" for v in ("doc_id", "source", "lang", n_chars, "text")]
    return " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values)


#: CRC-32 of the decimal doc_id in eight hex digits, bit by bit.
CRC32 = """printf('%08x', xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(strlen(doc_id::VARCHAR)), lambda j: ord(substr(doc_id::VARCHAR, j + 1, 1))::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))))"""

ORACLE: dict[str, str] = {
    "op6_warc": f"""
        WITH hashed AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
        ), named AS (
            SELECT page_id, payload_bytes,
                {" || ".join(BASE32_PART.format(at=at) for at in (1, 11, 21, 31))} AS payload_digest
            FROM hashed
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM named
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
        FROM firsts""",
    "op11_substring_dedup": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), words AS (
            SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, len(w) AS n FROM docs
        ), windows AS (
            SELECT r, i, md5(string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) AS h
            FROM words QUALIFY i + 34 <= n
        ), repeated AS (
            SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY h) > 1
        ), judged AS (
            SELECT words.r, words.i, word,
                coalesce(max(repeated.i) OVER (PARTITION BY words.r ORDER BY words.i) >= words.i - 34, false) AS gone
            FROM words LEFT JOIN repeated USING (r, i)
        ), kept AS (
            SELECT r, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
                string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text
            FROM judged GROUP BY r
        )
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
            sha256(coalesce(text, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (r)""",
    "op13_merkle": f"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, lang, row_number() OVER () AS r, sha256({merkle_leaf("n_chars")}) AS leaf,
                CASE WHEN ('0x' || crc)::BIGINT % 7 = 0 THEN sha256({merkle_leaf("(n_chars + 1)")}) ELSE sha256({merkle_leaf("n_chars")}) END AS altered
            FROM (SELECT *, {CRC32} AS crc FROM documents)
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS t
            FROM docs
        ), nodes AS (
            SELECT t, 0 AS level, i, n, leaf AS h FROM leaves
            UNION ALL
            SELECT t, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
            FROM nodes WHERE n > 1 GROUP BY t, level, i // 2, n
        ), tops AS (
            SELECT 0 AS level, t - 1 AS i, count(*) OVER () AS n, h FROM nodes WHERE n = 1
            UNION ALL
            SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
            FROM tops WHERE n > 1 GROUP BY level, i // 2, n
        ), low AS (
            SELECT r, t, 0 AS level, i, n, altered AS d, '' AS proof FROM leaves
            UNION ALL
            SELECT r, low.t, low.level + 1, low.i // 2, (low.n + 1) // 2,
                sha256(CASE WHEN low.i % 2 = 1 THEN s.h || d ELSE d || coalesce(s.h, '') END), proof || coalesce(s.h, '')
            FROM low LEFT JOIN nodes AS s ON s.t = low.t AND s.level = low.level AND s.i = xor(low.i, 1)
            WHERE low.n > 1
        ), high AS (
            SELECT r, 0 AS level, t - 1 AS i, (SELECT max(t) FROM leaves) AS n, d, proof FROM low WHERE n = 1
            UNION ALL
            SELECT r, high.level + 1, high.i // 2, (high.n + 1) // 2,
                sha256(CASE WHEN high.i % 2 = 1 THEN s.h || d ELSE d || coalesce(s.h, '') END), proof || coalesce(s.h, '')
            FROM high LEFT JOIN tops AS s ON s.level = high.level AND s.i = xor(high.i, 1)
            WHERE high.n > 1
        )
        SELECT doc_id, leaf, subroots.h AS subroot, roots.h AS root, sha256(proof) AS proof_sha256, d AS folded_root,
            d = roots.h AS verified
        FROM leaves JOIN high ON high.r = leaves.r AND high.n = 1
            JOIN nodes AS subroots ON subroots.t = leaves.t AND subroots.n = 1
            CROSS JOIN (SELECT h FROM tops WHERE n = 1) AS roots""",
}
