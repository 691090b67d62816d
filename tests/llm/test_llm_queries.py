"""The registered queries against their SQL, and the pipeline against a plain version."""

import hashlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import language
from millrace.llm.queries import QUERIES, SQL
from tests.conftest import SF_DIR
from tests.llm import brute
from tests.llm.test_bpe import NAMES, reference


def comparable(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = con.execute(SQL[name])
    result = QUERIES[name](spark, SF_DIR)
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert comparable(tuple(r) for r in result.select(*columns).collect()) == comparable(expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_covers_its_table(spark, name):
    table = "pages" if name == "op9_urls" else "documents"
    assert QUERIES[name](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_pipeline_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    sizer = language.Sizer(language.learned(docs.where(language.remainder(docs["doc_id"]) != 0)))
    left = {}
    for i, r in rows.items():
        lang, score = language._best(sizer, r["text"].encode())
        if lang != language.UNDETERMINED and score >= language.MIN_MARGIN:
            left[i] = r
    assert len(left) >= 0.95 * len(rows)
    texts = brute.lines_cleaned([(i, r["text"], r["source"]) for i, r in left.items()])
    once = brute.kept(sorted(texts.items()))
    clean = {i: brute.without_hits(t, items) for i, t in once}
    _, known = reference(NAMES[0])
    expected = {i: known.encode_ordinary(t) for i, t in clean.items() if t is not None}
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(expected)
    for r in found:
        ids = np.array(expected[r["doc_id"]], "<u4").tobytes()
        assert bytes(r["ids"]) == ids and r["n_tokens"] == len(ids) // 4
        assert r["decoded_sha256"] == hashlib.sha256(clean[r["doc_id"]].encode()).hexdigest()


def test_every_stage_keeps_the_columns_of_documents(spark):
    frame = brute.awkward(spark, [*brute.prose(30, 4), "", None])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, frame, SF_DIR)
        assert done.dtypes == frame.dtypes
        assert stage(spark, frame.limit(0), SF_DIR).collect() == []
