"""What the physical plans of the main queries look like."""

import pytest

from bazaar.checks import QUERIES

PYTHON_ROWS = {"html_elements", "scan_workbook_grid", "category_page", "feed_bilingual", "feed_sales", "feed_positional"}
STORED = {  # run eagerly against folders; their read-back plan says nothing
    name
    for name in QUERIES
    if name.startswith(("sink_", "stream_", "merge_", "scan_report", "scan_preamble", "feed_traffic"))
}


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_no_cross_join_and_no_row_python(spark, sf, name):
    text = plan_text(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert ("MapInPandas" in text) == (name in PYTHON_ROWS)
    assert "SinglePartition" not in text or name in ("load_report", "load_observed", "topk_orders", "table_catalog"), text


@pytest.mark.parametrize(
    "name,pushed",
    [
        ("filter_day_range", "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)"),
        ("reconcile_coverage", "LessThan(o_orderdate,2002-01-01T00:00)"),
        ("reconcile_coverage", "In(l_linestatus, [F,O])"),
        ("param_sql", "EqualTo(o_orderstatus,F)"),
        ("missing_orders", "IsNotNull(l_orderkey)"),
    ],
)
def test_filters_reach_the_scan(spark, sf, name, pushed):
    assert pushed in formatted(spark, QUERIES[name](spark, sf))


@pytest.mark.parametrize(
    "name,column",
    [("dedupe_latest", None), ("agg_sum", "l_comment"), ("html_links", "url"), ("left_join_flag", "l_quantity")],
)
def test_scans_read_only_needed_columns(spark, sf, name, column):
    text = formatted(spark, QUERIES[name](spark, sf))
    schemas = [part.split("\n")[0] for part in text.split("ReadSchema: struct<")[1:]]
    assert schemas and all(column is None or column not in schema for schema in schemas)


def test_reconcile_has_one_scan_per_table(spark, sf):
    assert plan_text(QUERIES["reconcile_coverage"](spark, sf)).count("FileScan parquet") == 2


@pytest.mark.parametrize(
    "name,function",
    [
        ("explode_items", "from_json"),
        ("hashtag_posts", "from_json"),
        ("operational_report", "from_json"),
        ("html_links", "regexp_extract_all"),
        ("grid_to_table", "split(text"),
    ],
)
def test_expensive_arrays_are_computed_once(spark, sf, name, function):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(function) == 1
