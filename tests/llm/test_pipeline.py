import hashlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from checks.compare import compare, connect
from sparkloom.llm import decontaminate, queries, quality, secrets
from tests.conftest import SMALL
from tests.llm.test_near_dedup import brute

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_all_queries_are_registered():
    names = entry.queries().keys()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert queries.ORACLES.keys() <= names


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_results_equal_sql(spark, name):
    assert compare(spark, connect(SMALL), SMALL, entry.queries()[name], entry.oracle_sql()[name]) == ""


def test_pipeline_equals_brute_force(spark):
    import sentencepiece

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = {r["doc_id"] for r in quality.quality(docs).filter("kept").select("doc_id").collect()}
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    heads = {i for i, _, _, kept in brute([(i, rows[i]) for i in sorted(good)]) if kept}
    held = {r["doc_id"] for r in decontaminate.contaminated(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    want = {}
    for i in heads - held:
        text = secrets.redacted(rows[i], secrets.base_spans(rows[i]) + secrets.method_spans(rows[i]))
        ids = library.encode(text, add_bos=True, add_eos=True)
        want[i] = (ids, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:] for r in pipeline.run(spark, SMALL).collect()}
    assert got == want and 50 < len(got) < len(rows)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "near_duplicates", "benchmark_decontamination", "secret_scans", "piece_encoding"]
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == DOCUMENTS
        assert stage(spark, docs.limit(0), SMALL).count() == 0
