"""Checks of several columns in one pass equal the checks of one column each."""

from pricelens.operators import quality as Q

CHILD = [(1, 1), (2, 9), (2, None), (None, 8), (7, 8), (7, 1), (7, 1)]


def frames(spark):
    child = spark.createDataFrame(CHILD, "a long, b long")
    parent = spark.createDataFrame([(i,) for i in (1, 2, 2, 3, 8, None)], "id long")
    return child, parent


def rows(*dfs):
    return sorted(tuple(r) for df in dfs for r in df.collect())


def test_references_in_one_pass(spark):
    child, parent = frames(spark)
    got = rows(Q.check_references(child, ["a", "b"], parent, "id", "t"))
    assert got == rows(Q.check_reference(child, "a", parent, "id", "t"), Q.check_reference(child, "b", parent, "id", "t"))
    assert [r[-1] for r in got] == [3, 1]
    assert [r[-1] for r in rows(Q.check_references(child.limit(0), ["a", "b"], parent, "id"))] == [0, 0]
    assert [r[-1] for r in rows(Q.check_references(child, ["a", "b"], parent.limit(0), "id"))] == [6, 6]


def test_references_scan_each_table_once(spark, tmp_path):
    child, parent = frames(spark)
    child.write.parquet(f"{tmp_path}/child")
    parent.write.parquet(f"{tmp_path}/parent")
    df = Q.check_references(spark.read.parquet(f"{tmp_path}/child"), ["a", "b"], spark.read.parquet(f"{tmp_path}/parent"), "id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "Join" not in plan


def test_uniques_in_one_pass(spark):
    child, _ = frames(spark)
    assert rows(Q.check_uniques(child, ["a", "b"], "t")) == rows(Q.check_unique(child, "a", "t"), Q.check_unique(child, "b", "t"))
    plan = Q.check_uniques(child, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1
