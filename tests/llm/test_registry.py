"""Every query of the subpackage against its SQL, and the pipeline's contract."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.oracle import difference
from tillroll.llm.registry import ORACLES, QUERIES

from .conftest import SF_DIR


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, key):
    assert difference(QUERIES[key](spark, SF_DIR), duck, ORACLES[key]) is None


def test_every_operator_is_registered_once():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys()


def test_the_stages_keep_the_columns_and_take_effect(spark, edge_docs, tmp_path):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text", "lang", "source", "n_chars")
    given.unionByName(edge_docs, allowMissingColumns=True).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").selectExpr("doc_id + 1000 AS doc_id", "quality", "toxic")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        left[name] = sorted(r[0] or 0 for r in docs.select("doc_id").collect())
    edge = {name: [i for i in ids if i < 1000] for name, ids in left.items()}
    assert edge["langid"] == [0, 1, 2, 2, 3, 8, 9, 10, 11, 12, 13]  # without a letter: out
    assert edge["exact_dedup"] == [0, 1, 3, 8, 9, 10, 11, 12, 13]
    assert edge["near_dedup"] == [0, 1, 8, 10, 11, 13]  # 3 and 12 differ in case only, 9 is near 8
    assert set(left["mixing"]) <= set(left["near_dedup"]) and len(left["langid"]) == given.count() + 11
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r[0] or 0 for r in packed.select("doc_id").collect()} == set(left["mixing"])


def test_the_pipeline_on_the_given_tables(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    rows = out.groupBy("sequence_id").sum("length").collect()
    assert rows and all(0 < r[1] <= 2048 for r in rows)
