"""The registered queries: SQL oracles, contract columns, and the pipeline by brute force."""

import hashlib

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from subledger.llm import quality
from subledger.llm.registry import ORACLE, QUERIES

from conftest import SF_SMALL
from test_corpus_operators import brute_components, brute_contamination, brute_fingerprint
from test_text_operators import brute_spans, reference_encoding  # noqa: F401

COLUMNS = {
    "op1_benchmark_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op2_simhash_near_dedup": "doc_id fingerprint component_id",
    "op3_url_filters": "page_id host path rule verdict",
    "op4_license_scans": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op5_secret_scans": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op6_quality_classifier": "doc_id held_out score predicted",
    "op7_toxicity": "doc_id held_out score predicted",
    "op8_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op9_html_extraction": "page_id url text n_chars",
    "op10_exact_top_k": "query_id rank vec_id score",
    "op11_conversation_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_fill_in_middle": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op13_substring_dedup": "doc_id n_words n_removed kept_sha256",
}


def test_every_query_is_registered():
    assert set(COLUMNS) == set(QUERIES) and set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    table = "pages" if df.columns[0] == "page_id" else "documents"
    if name not in ("op10_exact_top_k", "op11_conversation_trie"):
        assert df.count() == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.execute(ORACLE[name])
    columns = [c[0] for c in rel.description]
    assert sorted(map(tuple, QUERIES[name](spark, SF_SMALL).select(*columns).collect())) == sorted(rel.fetchall())


def test_pipeline_by_brute_force(spark, reference_encoding):  # noqa: F811
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in quality.quality(docs, labels).where("predicted = 1").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    root = brute_components(list(fps.values()), 2)
    first = {}
    for i in sorted(texts):
        first.setdefault(root[fps[i]], i)
    kept = sorted(first.values())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = [i for i, _, hit, _ in brute_contamination([(i, texts[i]) for i in kept], items, 10) if not hit]
    want = {}
    for i in clean:
        text, out, at = texts[i], "", 0
        for s, _, e in brute_spans(text):
            if e > at:
                out += (text[at:s] + "[SECRET]") if s >= at else ""
                at = max(at, e)
        want[i] = reference_encoding.encode_ordinary(out + text[at:])
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(got) == set(want)
    for i, ids in want.items():
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false").withColumn("score", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and out.count() == 0
