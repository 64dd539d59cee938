"""Physical-plan properties the design relies on (checked with explain)."""

import re

import pytest

from conftest import SF_SMALL


def plan(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture(scope="module")
def qs():
    from marketlake.plans import catalog

    # The optional training-data operators may use Python; these plans are the catalogue's.
    return catalog.queries()


def test_no_python_udf_or_cross_join_anywhere(spark, qs, capsys):
    for name, fn in qs.items():
        text = plan(fn(spark, SF_SMALL), capsys)
        for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                       "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert marker not in text, f"{name} uses {marker}"


def test_top_n_is_take_ordered(spark, qs, capsys):
    assert "TakeOrderedAndProject" in plan(qs["rank_top100"](spark, SF_SMALL), capsys)


def test_top3_history_pushes_the_codes_into_the_scan(spark, qs, capsys):
    text = plan(qs["topk_history"](spark, SF_SMALL), capsys)
    assert "In(o_custkey" in text and "Join" not in text


def test_per_key_layout_reads_only_the_listed_code_partitions(spark, capsys):
    from pyspark.sql import functions as F

    from marketlake.operators.history import history_of
    from marketlake.session import scratch_path
    from marketlake.sinks.files import write_per_key

    p = scratch_path(spark, "pk_prune")
    df = spark.range(0, 300).select((F.col("id") % 30).alias("code"), F.col("id").alias("v"))
    write_per_key(df, p, fmt="parquet")
    top = spark.createDataFrame([(3,), (7,)], "code long")
    got = history_of(spark.read.parquet(p), top, 10)
    text = plan(got, capsys)
    assert re.search(r"PartitionFilters: \[code#\d+ IN \((3,7|7,3)\)\]", text)  # only two code= directories
    assert sorted({r.code for r in got.collect()}) == [3, 7]


def test_retention_and_lookup_push_the_short_code_list_into_the_scan(spark, qs, capsys):
    for name in ("retention_keep", "history_since"):
        text = plan(qs[name](spark, SF_SMALL), capsys)
        assert "Join" not in text and re.search(r"PushedFilters: \[[^\]]*In\(o_custkey", text), name
    # the complement reads every other code anyway: a NOT IN filter, still no join
    assert "Join" not in plan(qs["retention_drop"](spark, SF_SMALL), capsys)


def test_filter_reaches_scan(spark, qs, capsys):
    text = plan(qs["pivot_filtered"](spark, SF_SMALL), capsys)
    assert "PushedFilters: [IsNotNull(event_type), In(event_type" in text or "In(event_type" in text


def test_column_pruning(spark, qs, capsys):
    text = plan(qs["latest_date"](spark, SF_SMALL), capsys)
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_aggregates_are_partial_before_shuffle(spark, qs, capsys):
    for name, marker in [("pivot_wide", "partial_min_by"), ("latest_row", "partial_max"),
                         ("group_sum_by_entity", "partial_sum"), ("high_volatility", "partial_min_by")]:
        assert marker in plan(qs[name](spark, SF_SMALL), capsys), name


def test_newest_row_uses_aggregate_not_sort(spark, qs, capsys):
    assert "Window" not in plan(qs["latest_row"](spark, SF_SMALL), capsys)


def test_volatility_window_runs_after_daily_preaggregation(spark, qs, capsys):
    text = plan(qs["high_volatility"](spark, SF_SMALL), capsys)
    # the formatted plan lists the top node first: the window sits above the daily aggregate
    assert text.index("Window") < text.index("Aggregate")


def test_hot_paths_run_in_whole_stage_codegen(spark, qs, capsys):
    for name in ("pivot_wide", "group_sum", "latest_date", "incremental_append", "retention_keep", "typed_load"):
        df = qs[name](spark, SF_SMALL)
        df.collect()  # AQE assigns codegen stages when the plan executes
        capsys.readouterr()
        df.explain()  # the final plan marks code-generated operators with *(n)
        text = capsys.readouterr().out
        assert re.search(r"\*\(\d+\) ", text), name
