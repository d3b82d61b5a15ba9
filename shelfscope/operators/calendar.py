"""Run dates and time frames (L4W / L13W / YTD and the 26 weekly frames).

Frames are tiny by construction (3 rolling frames; 13 + 13 weekly frames), so
after they are computed on Spark they are collected once into a ``FrameSet``
and attached to fact rows as literals: a fact row is exploded into the frames
that contain its week.  That replaces the reference's range join
(``week BETWEEN start AND end``) with a map-side operation, and the overall
week bounds become literal filters that reach the Parquet scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope.params import YEAR_AGO_DAYS, MartParams

FRAME_COLUMNS = ["pd_start_dt", "pd_start_yr_wk", "pd_end_dt", "pd_end_yr_wk", "tmfrm_cd"]


def run_date_frame(cal_day: DataFrame, params: MartParams) -> DataFrame:
    """``NVL(run_date, week end of today - 14 days)`` for POS and for visits (1 row)."""
    today = params.today or dt.date.today()
    probe = cal_day.filter(F.col("fisc_dt") == F.lit(today - dt.timedelta(days=14)))
    return probe.agg(
        F.coalesce(F.lit(params.pos_run_date).cast("date"), F.max("fisc_wk_end_dt")).alias("pos_run_dt"),
        F.coalesce(F.lit(params.visit_run_date).cast("date"), F.max("fisc_wk_end_dt")).alias("psd_run_dt"),
    )


def resolve_run_dates(cal_day: DataFrame, params: MartParams) -> tuple[dt.date | None, dt.date | None]:
    if params.pos_run_date and params.visit_run_date:
        return params.pos_run_date, params.visit_run_date
    row = run_date_frame(cal_day, params).first()  # one row by construction
    return row["pos_run_dt"], row["psd_run_dt"]


def _frame(days: DataFrame, code: str) -> DataFrame:
    return days.agg(
        F.min("fisc_wk_start_dt").alias("pd_start_dt"),
        F.min("fisc_yr_wk").alias("pd_start_yr_wk"),
        F.max("fisc_wk_end_dt").alias("pd_end_dt"),
        F.max("fisc_yr_wk").alias("pd_end_yr_wk"),
        F.lit(code).alias("tmfrm_cd"),
    )


def period_frames(cal_day: DataFrame, run_dt: dt.date) -> DataFrame:
    """The three rolling frames; each spans whole fiscal weeks up to the run date."""
    d = F.col("fisc_dt")
    run = F.lit(run_dt)
    l4w = cal_day.filter(d.between(F.date_sub(run, 21), run))
    l13w = cal_day.filter(d.between(F.date_sub(run, 84), run))
    run_year = cal_day.filter(d == run).select("fisc_yr").distinct()
    ytd = cal_day.filter(d <= run).join(run_year, "fisc_yr", "left_semi")
    return _frame(l4w, "L4W").unionByName(_frame(l13w, "L13W")).unionByName(_frame(ytd, "YTD"))


def weekly_frames(cal_day: DataFrame, run_dt: dt.date) -> DataFrame:
    """One frame per week: the last 13 weeks, and weeks -51..-39 (next 13 weeks a year ago)."""
    d = F.col("fisc_dt")
    run = F.lit(run_dt)

    def weeks(lo_days: int, hi_days: int, code: str) -> DataFrame:
        return cal_day.filter(d.between(F.date_sub(run, lo_days), F.date_sub(run, hi_days))).select(
            F.col("fisc_wk_start_dt").alias("pd_start_dt"),
            F.col("fisc_yr_wk").alias("pd_start_yr_wk"),
            F.col("fisc_wk_end_dt").alias("pd_end_dt"),
            F.col("fisc_yr_wk").alias("pd_end_yr_wk"),
            F.lit(code).alias("tmfrm_cd"),
        ).distinct()

    return weeks(84, 0, "WEEKLY_L13W").unionByName(weeks(357, 273, "WEEKLY_N13W"))


@dataclass(frozen=True)
class Frame:
    tmfrm_cd: str
    pd_start_dt: dt.date | None
    pd_start_yr_wk: str | None
    pd_end_dt: dt.date | None
    pd_end_yr_wk: str | None


@dataclass(frozen=True)
class FrameSet:
    """A small, driver-side list of frames (at most 3 + 26 rows)."""

    frames: tuple[Frame, ...]

    MAX_FRAMES = 64

    @classmethod
    def collect(cls, frames_df: DataFrame) -> FrameSet:
        rows = frames_df.limit(cls.MAX_FRAMES + 1).collect()
        if len(rows) > cls.MAX_FRAMES:
            raise ValueError("time-frame table is larger than expected")
        return cls(tuple(Frame(**{k: r[k] for k in ["tmfrm_cd", *FRAME_COLUMNS[:4]]}) for r in rows))

    def __add__(self, other: FrameSet) -> FrameSet:
        return FrameSet(self.frames + other.frames)

    @property
    def valid(self) -> tuple[Frame, ...]:
        return tuple(f for f in self.frames if f.pd_start_yr_wk is not None and f.pd_end_yr_wk is not None)

    def codes(self) -> list[str]:
        return sorted({f.tmfrm_cd for f in self.frames})

    def week_bounds(self) -> tuple[str | None, str | None]:
        v = self.valid
        if not v:
            return None, None
        return min(f.pd_start_yr_wk for f in v), max(f.pd_end_yr_wk for f in v)

    def date_bounds(self) -> tuple[dt.date | None, dt.date | None]:
        starts = [f.pd_start_dt for f in self.frames if f.pd_start_dt is not None]
        ends = [f.pd_end_dt for f in self.frames if f.pd_end_dt is not None]
        return (min(starts) if starts else None, max(ends) if ends else None)

    def _array(self) -> Column:
        return F.array(*[
            F.struct(
                F.lit(f.pd_start_dt).cast("date").alias("pd_start_dt"),
                F.lit(f.pd_start_yr_wk).cast("string").alias("pd_start_yr_wk"),
                F.lit(f.pd_end_dt).cast("date").alias("pd_end_dt"),
                F.lit(f.pd_end_yr_wk).cast("string").alias("pd_end_yr_wk"),
                F.lit(f.tmfrm_cd).alias("tmfrm_cd"),
            )
            for f in self.frames
        ])

    def _explode(self, df: DataFrame, keep) -> DataFrame:
        if not self.frames:
            return df.filter(F.lit(False)).select(
                "*", *[F.lit(None).cast(t).alias(c) for c, t in
                       zip(FRAME_COLUMNS, ["date", "string", "date", "string", "string"])]
            )
        return df.select("*", F.explode(F.filter(self._array(), keep)).alias("_frame")).select(
            *[F.col(c) for c in df.columns], *[F.col(f"_frame.{c}").alias(c) for c in FRAME_COLUMNS]
        )

    def by_week(self, df: DataFrame, week_col: str) -> DataFrame:
        """Inner join with the frames on ``week BETWEEN pd_start_yr_wk AND pd_end_yr_wk``."""
        w = F.col(week_col)
        lo, hi = self.week_bounds()
        if lo is not None:
            df = df.filter(w.between(F.lit(lo), F.lit(hi)))  # literal bounds reach the scan
        return self._explode(df, lambda f: w.between(f["pd_start_yr_wk"], f["pd_end_yr_wk"]))

    def by_year_ago_date(self, df: DataFrame, date_col: str) -> DataFrame:
        """Inner join on ``date BETWEEN pd_start_dt - 52 weeks AND pd_end_dt - 52 weeks``."""
        d = F.col(date_col)
        return self._explode(df, lambda f: d.between(
            F.date_sub(f["pd_start_dt"], YEAR_AGO_DAYS), F.date_sub(f["pd_end_dt"], YEAR_AGO_DAYS)
        ))

    def with_each(self, df: DataFrame) -> DataFrame:
        """Cross product with the (few) frames, as a map-side explode."""
        return self._explode(df, lambda f: F.lit(True))

    def start_date_of(self, code_col: str, week_col: str) -> Column:
        """Frame start date looked up by (frame code, end year-week) from the literal list."""
        pairs = []
        for f in self.frames:
            if f.pd_end_yr_wk is not None:
                pairs += [F.lit(f"{f.tmfrm_cd}|{f.pd_end_yr_wk}"), F.lit(f.pd_start_dt).cast("date")]
        if not pairs:
            return F.lit(None).cast("date")
        return F.element_at(F.create_map(*pairs), F.concat_ws("|", F.col(code_col), F.col(week_col)))

    def with_each_code(self, df: DataFrame) -> DataFrame:
        """Cross product with the distinct frame codes only."""
        codes = self.codes()
        if not codes:
            return df.filter(F.lit(False)).withColumn("tmfrm_cd", F.lit(None).cast("string"))
        return df.withColumn("tmfrm_cd", F.explode(F.array(*[F.lit(c) for c in codes])))
