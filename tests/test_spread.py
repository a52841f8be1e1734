"""The tasks of steps that hold all their rows at once grow with the files that are read."""

import pytest

from tidemark import work
from tidemark.plans.fact_queries import QUERIES


def test_tasks_grow_with_files(spark, sf_dir, monkeypatch):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    few = work.spread(lines, "l_orderkey").rdd.getNumPartitions()
    monkeypatch.setattr(work, "TASK_BYTES", 2_000)
    assert work.spread(lines, "l_orderkey").rdd.getNumPartitions() > 4 * few
    assert work.spread(spark.range(5), "id").rdd.getNumPartitions() == few


@pytest.mark.parametrize("name", ["q81_idempotent_append", "q95_bounded_edges"])
def test_plans(spark, sf_dir, name):
    assert "RepartitionByExpression" in QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
