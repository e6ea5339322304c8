"""The pipeline's stages against brute force, each on what the one before it kept."""

import hashlib

import corpus_pipeline
import public_tokenizers as P
import pytest
import tiktoken
from tests.llm.test_line_dedup import plain
from tests.llm.test_simhash import plain_components, plain_print

from cirrolake.llm import bpe, line_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        rows = [r.asDict() for r in docs.collect()]
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        found.append((name, rows, [r.asDict() for r in docs.collect()], docs.columns))
    return found


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_names_and_columns(stages):
    assert [s[0] for s in stages] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    assert all(s[3] == corpus_pipeline.COLUMNS for s in stages[:-1])


def test_toxic_documents_go(stages):
    _, before, after, _ = stages[0]
    assert all(by_id(before)[i] == r for i, r in by_id(after).items()) and 0 < len(after) <= len(before)


def test_repeated_passages_go(stages):
    _, before, after, _ = stages[1]
    gone = plain([(r["doc_id"], r["text"]) for r in before], line_dedup.LEAST_WORDS)
    expected = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in g) for (i, t), g in gone.items()}
    assert {r["doc_id"]: r["text"] for r in after} == expected and any(gone.values())
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_one_of_each_group_stays(stages):
    _, before, after, _ = stages[2]
    ids = [r["doc_id"] for r in before]
    groups = plain_components(ids, [plain_print(r["text"]) for r in before])
    assert by_id(after) == {i: by_id(before)[i] for i in set(groups)}


def test_benchmark_passages_go(spark, stages):
    _, before, after, _ = stages[3]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {r["doc_id"] for r in before if any(" ".join(t.split()) in " ".join(r["text"].split()) for t in items)}
    assert not holds & set(by_id(after)) and all(by_id(before)[i] == r for i, r in by_id(after).items())


def test_tokens_of_the_rest(stages):
    _, before, after, _ = stages[4]
    ranks = {token: rank for rank, token in enumerate(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {r["doc_id"]: (library.encode_ordinary(r["text"]), hashlib.sha256(r["text"].encode()).hexdigest()) for r in before}
    assert {r["doc_id"]: (r["ids"], r["decoded_sha256"]) for r in after} == expected
