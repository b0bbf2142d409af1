"""Loads counted in the pass that writes them."""

from pyspark.sql import functions as F

from bazaar.sinks import observed as Ob
from tests.test_operators import rows
from tests.test_records import jobs_of

SCHEMA = "a int, b string"


def test_counts_of_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (-1, None), (-2, "z")], SCHEMA)
    rules = {"no b": F.col("b").isNotNull(), "a not positive": F.col("a") > 0}
    report, jobs = jobs_of(spark, lambda: Ob.load_observed(df, rules, str(tmp_path / "t")))
    assert jobs == 1
    row = report.first()
    assert (row.loaded_rows, row.rejected_rows, row.loaded_columns) == (1, 3, 2)
    assert row.rejected_by == {"no b": 1, "a not positive": 2}
    assert rows(Ob.loaded(spark, str(tmp_path / "t"), SCHEMA)) == rows(spark.createDataFrame([(1, "x")], SCHEMA))
    bad = Ob.rejected(spark, str(tmp_path / "t"), SCHEMA)
    assert {(r.a, r.reject_reason) for r in bad.collect()} == {(None, "a not positive"), (-1, "no b"), (-2, "a not positive")}


def test_empty_loads(spark, tmp_path):
    row = Ob.load_observed(spark.createDataFrame([], SCHEMA), {"a": F.col("a") > 0}, str(tmp_path / "t")).first()
    assert (row.loaded_rows, row.rejected_rows, row.rejected_by) == (0, 0, {"a": 0})
    assert Ob.loaded(spark, str(tmp_path / "t"), SCHEMA).count() == 0
    Ob.load_observed(spark.createDataFrame([(1, "x")], SCHEMA), {}, str(tmp_path / "t"))
    assert Ob.loaded(spark, str(tmp_path / "t"), SCHEMA).count() == 1
