"""Findings F10 to F12: what is dealt over the tasks, and small cases of the rewritten steps."""

from __future__ import annotations

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from shelfscope.operators import drivers, pos
from shelfscope.operators.calendar import Frame, FrameSet
from shelfscope.sources import testviews
from shelfscope.sources.testviews import adapter_params
SF = "/root/testdata/sf0.001"
P = adapter_params()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pos_lines_meet_orders_and_parts_once(spark, no_broadcast):
    weekly = testviews.pos_weekly(testviews.load_tables(spark, SF)).filter(F.col("fisc_yr_wk").between("200101", "200130"))
    text = plan(weekly)
    assert len(re.findall(r"SortMergeJoin", text)) == 3
    # Lines, orders, customers, parts (twice where a side of the union has its own scan) and one exchange by store.
    assert text.count("orders.parquet") == 1 and text.count("part.parquet") == 1


def test_rollup_is_one_aggregation_and_keeps_the_largest_source(spark):
    frames = FrameSet((Frame("P4W", None, "202401", None, "202404"), Frame("P13W", None, "202401", None, "202413")))
    columns = "fisc_yr_wk string, sold_to_nbr string, chain_nbr string, catg_nm string, brand_nm string, corp_nm string, src_nm string, ic_ind boolean, " + \
        ", ".join(f"{m} decimal(18,2)" for m in pos.ALL_MEASURES) + ", kortex_upld_ts timestamp_ntz, kortex_dprct_ts timestamp_ntz"

    def row(week, src, v, brand="B"):
        return (week, "1", None, "A", brand, P.own_corp, src, False, *[v] * 6, None, None)

    from decimal import Decimal as D
    base = spark.createDataFrame([row("202401", "b", D(1)), row("202402", "a", D(2)), row("202405", "c", D(4)),
                                  row("202401", None, D(8)), row("202401", None, D(16), None)], columns)
    catgs = spark.createDataFrame([("A",)], "catg_nm string")
    out = pos.pos_rollup_plain(base, frames, catgs)
    got = {(r["tmfrm_cd"], r["brand_nm"]): (int(r["sale_val"]), r["src_nm"]) for r in out.collect()}
    assert got == {("P4W", "B"): (11, "b"), ("P13W", "B"): (15, "c"), ("P4W", None): (16, None), ("P13W", None): (16, None)}
    assert "ObjectHashAggregate" not in plan(out) and "SortAggregate" not in plan(out)


def test_active_rows_come_from_the_activity_keys(spark):
    frames = SimpleNamespace(codes=lambda: ["P4W"])
    stores = spark.createDataFrame([("1", "c"), ("1", "d"), ("1", "c"), ("2", None), (None, "c")], "sold_to_nbr string, chain_nbr string")
    products = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), (None, 1)], "catg_nm string, n int")
    events = spark.createDataFrame([("P4W", "1", "A", 1), ("P4W", "1", "A", 2), ("P4W", "2", "B", 0), ("P4W", "1", "X", 1), ("YTD", "1", "A", 1)],
                                   "tmfrm_cd string, sold_to_nbr string, catg_nm string, ans_in_store_val int")
    oos = spark.createDataFrame([("P4W", "2", "B"), (None, "2", "A"), ("P4W", None, "A"), ("P4W", "1", None)], "tmfrm_cd string, sold_to_nbr string, catg_nm string")
    plain = spark.createDataFrame([("P4W", "2", "A", P.own_corp, 1.0, 0.0), ("P4W", "1", "A", "X", 1.0, 0.0)],
                                  "tmfrm_cd string, sold_to_nbr string, catg_nm string, corp_nm string, sale_val double, sale_yr_ago_val double")
    got = drivers.active_categories(stores, products, frames, events, oos, plain, P)
    assert sorted((r["metrc_nm"], r["sold_to_nbr"], r["chain_nbr"] or "", r["catg_nm"]) for r in got.collect()) == sorted([
        (drivers.METRIC_EVENTS, "1", "c", "A"), (drivers.METRIC_EVENTS, "1", "d", "A"),
        (drivers.METRIC_OOS, "2", "", "B"), (drivers.METRIC_POS_PRFM, "2", "", "A")])


def test_lists_are_gathered_without_a_join(spark, no_broadcast):
    rows = spark.createDataFrame([("EVENTS", "P4W", "1", "c", "B"), ("EVENTS", "P4W", "1", "c", "A"), ("EVENTS", "P4W", "1", None, "A"),
                                  ("OOS", "P4W", None, "c", None), ("OOS", None, "1", "c", "A")], "metrc_nm string, tmfrm_cd string, sold_to_nbr string, chain_nbr string, catg_nm string")
    out = drivers.store_category_lists(rows.limit(0), rows, rows.limit(0))
    assert "Join" not in plan(out)
    got = sorted((r["sold_to_nbr"] or "", r["chain_nbr"] or "", r["catg_nm"] or "", r["mult_catg_nm"]) for r in out.collect())
    assert got == [("", "c", "", ""), ("1", "", "A", "A, B"), ("1", "c", "A", "A, B"), ("1", "c", "B", "A, B")]


def test_dense_rows_meet_the_facts_in_one_join(spark, no_broadcast):
    from shelfscope.plans.queries import job_for

    j = job_for(spark, SF)
    f = drivers.store_facts(j.drv_store_lists, j.drv_chain_lists, j.drv_active, j.drv_event_facts.limit(0), j.oos, j.pos_plain, P)
    joins = re.findall(r"Join[^\n]*\[sold_to_nbr#\d+, metrc_nm#\d+, tmfrm_cd#\d+, catg_nm#\d+\]", plan(f))
    assert len(joins) == 2  # the stores' rows and the active ones, each with the facts of both metrics
