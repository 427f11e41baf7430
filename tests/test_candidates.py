"""Candidates are dealt by part, groups by their number; texts are made where they are merged."""

from datetime import datetime

import pytest

from harrow.plans import catalog

PART = "p_partkey long, p_name string, p_brand string, p_type string"
LINE = "l_partkey long, l_suppkey long, l_shipdate timestamp"


@pytest.fixture
def folder(spark, tmp_path):
    day = lambda m: datetime(1995, m, 3)
    # Part 1 of supplier 1000 and part 2 of supplier 0 have one number in March, and so have 41 and 2 of it with 39000: numbers that lie apart by part.
    lines = [(1, 1000, day(3)), (2, 0, day(3)), (2, 0, day(3)), (41, 0, day(4)), (2, 39000, day(4)), (7, 3, day(5)), (7, 14, day(5)), (7, 14, day(6)), (9, 1, day(1))]
    spark.createDataFrame([(k, f"name {k}", f"Brand#{k}", "LARGE") for k in (1, 2, 7, 41)], PART).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(lines, LINE).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_groups_of_one_number_are_one_record(spark, folder):
    got = {r.group_id: r for r in catalog.queries()["merge_clusters"](spark, folder).collect()}
    assert {k: r.n_members for k, r in got.items()} == {2_000_063: 2, 41_000_064: 2, 7_003_065: 2, 7_014_066: 1}
    assert got[2_000_063].sources == "s0,s0" and got[2_000_063].cluster_id in ("name-1-brand-1-1", "name-2-brand-2-2")
    assert got[7_003_065].sources == "s3,s14" and got[7_003_065].cluster_id == "name-7-brand-7-7" and got[7_003_065].n_extracts == 2


def test_texts_are_not_shuffled(spark, folder):
    plan = catalog.queries()["merge_clusters"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("repeat(") < plan.index("Exchange hashpartitioning(") and "hashpartitioning(group_id" not in plan
