from __future__ import annotations

import corpus_pipeline
import edge
import pytest
from compare import difference, open_tables, type_difference
from conftest import SMALL

import __spark_entry__ as contract
from orelake.llm import exact_dedup, near_dedup, quality_rules
from orelake.llm.queries import CHECKS, QUERIES
from orelake.storage import write_out


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_rows_as_sql(spark, name):
    frame = QUERIES[name](spark, SMALL)
    check = open_tables(SMALL).sql(CHECKS[name])
    assert type_difference(frame, check) is None
    assert difference(frame.toPandas(), check.df()) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = write_out(stage(spark, docs, SMALL), f"test-{name}")
        seen.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "exact_dedup":
            assert exact_dedup.groups(docs).filter("group_size > 1").count() == 0
        if name == "minhash_near_dedup":
            assert near_dedup.classes(docs).filter("class_size > 1").count() == 0
        if name == "quality_rules":
            assert quality_rules.apply_policy(quality_rules.ledger(docs)).filter("NOT kept").count() == 0
    assert seen[0] > seen[1] > seen[2] >= seen[3] and seen[4] == seen[5] > 0


def test_pipeline_on_an_empty_table(spark):
    docs = edge.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
