"""The physical plans keep the properties the design relies on."""

import datetime as dt
import re

from pyspark.sql import functions as F

from barsmith.operators.bars import latest_n_per_symbol
from barsmith.plans import catalog
from barsmith.sources import tables
from barsmith.sources.files import scan, write_serving
from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def own_exchanges(p: str, keys: str) -> list[str]:
    return [line for line in p.splitlines() if re.search(rf"Exchange hashpartitioning\({keys}", line) and "Reused" not in line]


def test_scan_plans_have_no_python_and_no_job_while_they_are_built(spark):
    sc = spark.sparkContext
    for name in ("ema_multi", "ema_orders", "macd", "levels", "trailing_extremes", "pivot_position", "sma_range_scan", "sma_window_join", "enriched_bars"):
        sc.setJobGroup(f"build-{name}", name)
        settings = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
        df = catalog.catalog()[name](spark, SF_SMALL)
        jobs = sc.statusTracker().getJobIdsForGroup(f"build-{name}")
        sc.setLocalProperty("spark.jobGroup.id", None)
        assert len(jobs) <= 1, name      # Spark's own job that reads the schema of the file
        assert settings == {k: spark.conf.get(k) for k in settings}
        p = plan(df)
        assert "MapInPandas" not in p and "ArrowEvalPython" not in p and "InMemoryTableScan" not in p, name
        assert "rangepartitioning" not in p, name


def test_rows_are_exchanged_once_and_events_are_read_once(spark):
    for name in ("ema_multi", "macd", "enriched_bars"):
        p = final_plan(catalog.catalog()[name](spark, SF_SMALL))
        assert p.count("FileScan") == 1, name
        assert "ReusedExchange" in p and "Expand" not in p, name
        # the rows go once by (symbol, bucket); the summaries use the same exchange
        assert len(own_exchanges(p, r"_k#\d+, _b#")) == 1, name


def test_window_means_are_frames_of_one_layout(spark):
    p = final_plan(catalog.catalog()["sma_window_join"](spark, SF_SMALL))
    assert "Join" not in p and "Expand" not in p
    assert p.count("FileScan") == 1 and len(own_exchanges(p, "_k#")) == 1


def test_newest_n_is_a_group_limit_before_the_shuffle(spark):
    p = plan(latest_n_per_symbol(tables.bars_1h(spark, SF_SMALL), 10))
    assert "WindowGroupLimit" in p


def test_tick_scan_prunes_columns_and_pushes_null_filters(spark):
    p = plan(tables.ticks(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in p
    assert "IsNotNull(event_type)" in p and "IsNotNull(value)" in p


def test_store_scan_prunes_symbol_partitions_and_pushes_time(spark, tmp_path):
    path = str(tmp_path / "store")
    write_serving(tables.bars_1h(spark, SF_SMALL), path, mode="overwrite")
    df = scan(spark, path, "click", dt.datetime(2024, 1, 20), 5)
    p = plan(df.select("datetime", "close"))
    assert "PartitionFilters: [isnotnull(symbol" in p and "(symbol#" in p
    assert "PushedFilters: [IsNotNull(datetime), GreaterThan(datetime" in p
    assert df.select("symbol").distinct().count() == 1


def test_ranks_and_newest_bars_hold_no_symbol_in_one_window(spark):
    from barsmith.operators.bars import indicator_state
    from barsmith.operators.serving import level_options
    bars = tables.bars_1h(spark, SF_SMALL).withColumn("support", F.round("low", 0))
    for df in (level_options(bars), indicator_state(bars, ["close"], tail=6)):
        windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[", plan(df))
        assert windows and all("," in keys for keys in windows)


def test_ranks_are_places_in_the_sorted_list(spark):
    from barsmith.operators.serving import level_options
    rows = [("a", v) for v in (3.5, 0.0, 3.25, 3.5, -2.0, 100.0, None, 3.5)] + [("b", 0.0), ("c", 7.0)]
    df = spark.createDataFrame(rows, "symbol string, support double")
    for distinct in (False, True):
        got = sorted((r.symbol, r["rank"], r.option) for r in level_options(df, "support", distinct).collect())
        want = []
        for s in "abc":
            vals = sorted(v for k, v in rows if k == s and v)
            want += [(s, i, o) for i, o in enumerate(["none", *map(str, sorted(set(vals)) if distinct else vals)])]
        assert got == want


def test_ranks_read_their_input_once(spark):
    from barsmith.operators.serving import level_options
    bars = tables.bars_1h(spark, SF_SMALL).withColumn("support", F.round("low", 0))
    assert final_plan(level_options(bars)).count("FileScan") == 1
