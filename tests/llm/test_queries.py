"""Registered queries of the subpackage and the pipeline on the smallest tables."""
import glob
import hashlib
import math
import os

import duckdb
import pytest

import corpus_pipeline
from oreleaf.llm import decontamination, quality
from oreleaf.llm.common import staged
from oreleaf.llm.queries import ORACLE, QUERIES, table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_gives_expected_rows(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SF)
    expected = con.execute(ORACLE[name])
    names = [d[0] for d in expected.description]
    columns = sorted(df.columns)
    assert columns == sorted(names)
    place = [names.index(c) for c in columns]
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    want = sorted((tuple(plain(r[i]) for i in place) for r in expected.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_has_a_row_for_each_document(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in table(spark, SF, "documents").select("doc_id").collect())


def test_stages(spark):
    docs = table(spark, SF, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    columns = docs.columns
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(staged(stage(spark, kept[-1], SF), "stage"))
    assert all(df.columns == columns for df in kept[:-1])
    scores = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, table(spark, SF, "labels"))).collect()}
    after = [{r.doc_id: r for r in df.collect()} for df in kept]
    assert set(after[1]) == {i for i in before if scores[i] >= quality.CUTOFF}
    assert set(after[2]) <= set(after[1]) and len({r.text for r in after[2].values()}) == len(after[2])
    assert set(after[3]) == set(after[2]) and all(len(r.text) <= len(after[2][i].text) for i, r in after[3].items())
    bad = {r.doc_id for r in decontamination.decontaminated(kept[3], table(spark, SF, "benchmark")).where("contaminated").collect()}
    assert set(after[4]) == set(after[3]) - bad
    assert {i: r.decoded_sha256 for i, r in after[5].items()} == {i: hashlib.sha256(r.text.encode()).hexdigest() for i, r in after[4].items()}
    assert sorted(corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect()) == sorted((i, r.ids_sha256) for i, r in after[5].items())
