"""Property tests: rewrites that replace SQL constructs agree with brute force."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfscope.operators import visits
from shelfscope.operators.calendar import Frame, FrameSet
from shelfscope.params import PRIORITY_BLOCKED

WEEKS = [f"2001{w:02d}" for w in range(1, 53)]

frame_st = st.tuples(st.sampled_from(WEEKS), st.sampled_from(WEEKS), st.sampled_from(["L4W", "L13W", "YTD", "X"]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(frames=st.lists(frame_st, min_size=0, max_size=4),
       weeks=st.lists(st.sampled_from(WEEKS), min_size=1, max_size=20))
def test_frame_explode_equals_range_join(spark, frames, weeks):
    """``FrameSet.by_week`` == ``JOIN frames ON week BETWEEN start AND end`` (with multiplicity)."""
    fs = FrameSet(tuple(Frame(code, dt.date(2001, 1, 1), lo, dt.date(2001, 12, 31), hi) for lo, hi, code in frames))
    df = spark.createDataFrame([(i, w) for i, w in enumerate(weeks)], "id int, fisc_yr_wk string")
    got = sorted((r.id, r.tmfrm_cd, r.pd_start_yr_wk, r.pd_end_yr_wk) for r in fs.by_week(df, "fisc_yr_wk").collect())
    expected = sorted((i, code, lo, hi) for i, w in enumerate(weeks) for lo, hi, code in frames if lo <= w <= hi)
    assert got == expected


part_st = st.sampled_from(["a", " b", "c ", "", " ", "OTHER", "Cereal mix", "frozen", "dd", "a"])


def _expected_parts(text: str) -> list[str]:
    parts = text.split(",")
    out = []
    for n in range(1, 8):  # SPLIT_PART(text, ',', n) for n = 1..7; '' past the end
        p = parts[n - 1].strip() if n <= len(parts) else ""
        if p and p.upper() not in PRIORITY_BLOCKED and "CEREAL" not in p.upper():
            out.append(p)
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lists=st.lists(st.lists(part_st, min_size=1, max_size=10).map(",".join), min_size=1, max_size=6))
def test_category_split_equals_split_part(spark, lists):
    rows = [("L4W", f"S{i}", "CH", text, 1, 1, 1, 1, 1, 1) for i, text in enumerate(lists)]
    df = spark.createDataFrame(rows, "tmfrm_cd string, sold_to_nbr string, chain_nbr string, mult_catg_nm string, "
                                     "up_in_store_val bigint, ans_in_store_val bigint, visit_in_store_val bigint, "
                                     "ans_wk_cnt bigint, visit_wk_cnt bigint, true_in_store_wk_cnt bigint")
    got = {}
    for r in visits.events_split(df).orderBy("sold_to_nbr", "part_nbr").collect():
        got.setdefault(r.sold_to_nbr, []).append(r.catg_nm)
    for i, text in enumerate(lists):
        assert got.get(f"S{i}", []) == _expected_parts(text)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                               st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5, -3.0, 7.0]))),
                     min_size=1, max_size=40),
       descending=st.booleans(), nulls_first=st.booleans())
def test_rank_within_equals_window_rank(spark, rows, descending, nulls_first):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from shelfscope.functions.ranking import rank_within

    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id int, g string, v double")
    v = F.col("v")
    order = ((v.desc_nulls_first() if nulls_first else v.desc_nulls_last()) if descending
             else (v.asc_nulls_first() if nulls_first else v.asc_nulls_last()))
    expected = {r.id: r.r for r in df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(order))).collect()}
    got = {r.id: r.r for r in rank_within(df, ["g"], v, "r", descending=descending, nulls_first=nulls_first,
                                          buckets=4).collect()}
    assert got == expected
