"""Facts laid out by fiscal week, and per-week roll-ups that are kept between runs.

``lay_out`` writes the source tables with the three facts partitioned by the time
that the frames select by, so that a run opens the frames' partitions only.

``WeekStore`` keeps the weekly roll-up of the point-of-sale fact, the step that reads
most, and ``ShipmentWeekStore`` that of shipments. A week's revision is what its partition folder lists (file names, lengths and
times), so finding the new and revised weeks reads no data; only those are scanned,
rolled up and entered into a new version of the store's manifest.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.operators import pos, shipment
from shelfscope.sources.martstore import Manifest, PublishConflict, _fs, commit, latest, write_place
from shelfscope.sources.tables import FACT_PARTITIONS, SOURCE_NAMES, VISIT_DAY, SourceTables, read_table


def lay_out(sources: SourceTables, root: str) -> None:
    """Write the ten source tables to ``<root>/<name>``, facts partitioned by week (visits by day).

    The adaptive engine splits large weeks and sizes the files.
    """
    for name in SOURCE_NAMES:
        df: DataFrame = getattr(sources, name)
        parts = FACT_PARTITIONS.get(name)
        if parts:
            if name == "visit_audit":
                df = df.withColumn(VISIT_DAY, F.to_date("actl_start_dt_time"))
            df.hint("rebalance", *[F.col(c) for c in parts]).write.partitionBy(*parts).parquet(f"{root}/{name}")
        else:
            df.write.parquet(f"{root}/{name}")


class WeekStore:
    """Weekly POS roll-ups in ``root``, kept up to date with the week-partitioned fact in ``facts``."""

    parts = FACT_PARTITIONS["pos_weekly"]
    rollup = staticmethod(pos.week_rollup)

    def __init__(self, spark: SparkSession, facts: str, root: str):
        self.spark, self.facts, self.root = spark, facts, root

    @staticmethod
    def week_of(*values: str) -> str | None:
        """The week that partition values name, as a string that sorts by time; None for a partition without one."""
        return values[0]

    @staticmethod
    def kept_folder(week: str) -> str:
        """A week's folder in the store."""
        return f"fisc_yr_wk={week}"

    def folders(self) -> dict[str, str]:
        """week -> its partition folder in the fact."""
        path, fs = _fs(self.spark, self.facts)
        found = [(path, (), "")]
        for part in self.parts:
            inner = [(f.getPath(), values, name) for at, values, name in found for f in fs.listStatus(at)]
            found = [(at, (*values, at.getName().partition("=")[2]), f"{name}/{at.getName()}".lstrip("/"))
                     for at, values, name in inner if at.getName().partition("=")[0] == part]
        weeks = {self.week_of(*values): name for _, values, name in found}
        return {w: name for w, name in weeks.items() if w is not None}

    def revisions(self) -> dict[str, str]:
        """week -> what its partition folder lists."""
        out = {}
        for week, name in self.folders().items():
            path, fs = _fs(self.spark, f"{self.facts}/{name}")
            files = sorted(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}" for f in fs.listStatus(path))
            out[week] = hashlib.md5("\n".join(files).encode()).hexdigest()
        return out

    def stale(self, lo: str, hi: str) -> list[str]:
        """Weeks of the range that are new or revised since their roll-up."""
        held = latest(self.spark, self.root).totals
        return sorted(w for w, r in self.revisions().items() if lo <= w <= hi and held.get(w) != r)

    def refresh(self, lo: str, hi: str, tries: int = 5) -> Manifest:
        """Roll up the stale weeks of the range and publish them; another run may do so at the same time."""
        for _ in range(tries):
            base, now = latest(self.spark, self.root), self.revisions()
            weeks = [w for w in now if lo <= w <= hi and base.totals.get(w) != now[w]]
            if not weeks:
                return base
            folders = self.folders()
            place = write_place(self.rollup(self._read(self.facts, [folders[w] for w in weeks])), self.root, "weeks", self.parts)
            try:
                return commit(self.spark, self.root, base, {**base.families, **dict.fromkeys(weeks, place)},
                              {**base.totals, **{w: now[w] for w in weeks}})
            except PublishConflict:
                continue
        raise PublishConflict(f"{self.root}: {tries} other runs came first")

    def _read(self, path: str, folders: list[str]) -> DataFrame:
        """Some folders of a partitioned table: no other week is listed or opened."""
        return read_table(self.spark, path, self.parts, sorted(folders))

    def _none(self) -> DataFrame:
        return self.rollup(read_table(self.spark, self.facts, self.parts).filter(F.lit(False)))

    def rollups(self, lo: str | None, hi: str | None) -> DataFrame:
        """The roll-ups of the weeks between the bounds, brought up to date first."""
        if lo is None or hi is None:
            return self._none()
        manifest, now = self.refresh(lo, hi), self.revisions()
        places: dict[str, list[str]] = {}
        for week, place in manifest.families.items():
            if lo <= week <= hi and week in now:
                places.setdefault(place, []).append(week)
        if not places:
            return self._none()
        parts = [self._read(f"{self.root}/{p}", [self.kept_folder(w) for w in weeks]) for p, weeks in places.items()]
        return reduce(lambda a, b: a.unionByName(b), parts)


class ShipmentWeekStore(WeekStore):
    """Weekly shipment roll-ups of a fact partitioned by fiscal year and week; a week is named YYYYWW."""

    parts = FACT_PARTITIONS["shipments"]
    rollup = staticmethod(shipment.week_rollup)

    @staticmethod
    def week_of(*values: str) -> str | None:
        # Rows without a fiscal week meet no week of the calendar.
        return "{:04d}{:02d}".format(*map(int, values)) if all(v.isdecimal() for v in values) else None

    @staticmethod
    def kept_folder(week: str) -> str:
        return f"fisc_yr={int(week[:4])}/fisc_wk={int(week[4:])}"

    def of_frames(self, weeks: list[tuple[int, int]]) -> DataFrame:
        """The roll-ups of the range that these fiscal years and weeks span."""
        names = [self.week_of(str(y), str(w)) for y, w in weeks]
        return self.rollups(min(names, default=None), max(names, default=None))
