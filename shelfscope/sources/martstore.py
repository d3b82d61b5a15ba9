"""The published mart: one folder or table per metric family under versioned manifests.

A version is a manifest: a number, and for each family the place of its rows and of
its category totals. Publishing claims the next number with a create-if-absent file
named by the number alone, so of two publishers of one number exactly one wins; the
other gets ``PublishConflict`` and the mart stays as the winner left it. A refresh
of one family writes that family only and carries the other entries over.

Rows are stored before the mart-wide pruning of empty categories: whether a
category is empty depends on all families, and a refresh of one may bring back
another's rows. Each family keeps exact totals by category, and a reader leaves out
the categories whose totals over all families are not positive. ``PRUNE_KEY`` holds
the category as it was before NULLs got their defaults.

Folder targets keep their manifests in ``<target>/_versions``, ``catalog:<table>``
targets beside the table's database, with a view over the current version.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.operators.mart import PRUNE_KEY, TOTALS, empty_of_totals
from shelfscope.plans.stages import side_by_side
from shelfscope.sources.schemas import MART_COLUMNS, empty_mart, mart_struct
from shelfscope.sources.tables import CATALOG

#: Versions that stay readable; older manifests go, with the data that only they name.
RETAIN = 3
#: Name of the only entry of a mart that was published as one DataFrame.
WHOLE = "MART"
TOTALS_DDL = "catg_nm string, " + ", ".join(f"{t} decimal(38,6)" for t in TOTALS)


class PublishConflict(RuntimeError):
    """Another run published the version that this one was going to."""


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    families: dict[str, str] = field(default_factory=dict)
    totals: dict[str, str] = field(default_factory=dict)

    def places(self) -> set[str]:
        return {*self.families.values(), *self.totals.values()}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Create a file with its content if there is none of its name; False where another came first.

    Local files are written aside and linked, which fails if the name exists;
    other stores create exclusively (HDFS, conditional writes of object stores).
    """
    jvm = spark.sparkContext._jvm
    p, fs = _fs(spark, path)
    fs.mkdirs(p.getParent())
    local = fs.getUri().getScheme() == "file"
    at = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part") if local else p
    try:
        out = fs.create(at, False)
    except Exception as e:  # Py4J wraps the store's exception
        if "FileAlreadyExists" in str(e):
            return False
        raise
    out.write(bytearray(content.encode()))
    out.close()
    if not local:
        return True
    try:
        jvm.java.nio.file.Files.createLink(*[jvm.java.io.File(x.toUri().getPath()).toPath() for x in (p, at)])
        return True
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            return False
        raise
    finally:
        fs.delete(at, False)


def _log(spark: SparkSession, target: str) -> str:
    if not target.startswith(CATALOG):
        return f"{target}/_versions"
    database, _, table = target[len(CATALOG):].rpartition(".")
    place = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{place}/{table}__versions"


def manifests(spark: SparkSession, target: str) -> list[Manifest]:
    """All committed versions, oldest first. A file without whole content is no version: its writer died or is at it."""
    log, fs = _fs(spark, _log(spark, target))
    if not fs.exists(log):
        return []
    out = []
    for s in fs.listStatus(log):
        if s.getPath().getName().isdigit():
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(fs.open(s.getPath()), "UTF-8")
            try:
                out.append(Manifest(int(s.getPath().getName()), **json.loads(text)))
            except json.JSONDecodeError:
                continue
    return sorted(out, key=lambda m: m.number)


def latest(spark: SparkSession, target: str) -> Manifest:
    """The published version; number 0 without entries where nothing is."""
    return (manifests(spark, target) or [Manifest()])[-1]


def _next_number(spark: SparkSession, target: str, base: Manifest) -> int:
    """The number after ``base``; numbers left behind by writers that died count as taken only if nothing came of them."""
    log, fs = _fs(spark, _log(spark, target))
    whole = {m.number for m in manifests(spark, target)}
    taken = {int(s.getPath().getName()) for s in fs.listStatus(log) if s.getPath().getName().isdigit()} if fs.exists(log) else set()
    number = base.number + 1
    while number in taken - whole:
        number += 1
    return number


def commit(spark: SparkSession, target: str, base: Manifest, families: dict[str, str], totals: dict[str, str], retain: int = RETAIN) -> Manifest:
    """Publish the version after ``base``, or raise ``PublishConflict`` if there is a newer one than ``base``."""
    number = _next_number(spark, target, base)
    made = Manifest(number, families, totals)
    content = json.dumps({"families": families, "totals": totals}, indent=1)
    if latest(spark, target).number >= number or not create_once(spark, f"{_log(spark, target)}/{number}", content):
        raise PublishConflict(f"version {number} of {target} is another run's")
    if target.startswith(CATALOG):
        _point_view(spark, target)
    _retire(spark, target, retain)
    return made


def _retire(spark: SparkSession, target: str, retain: int) -> None:
    """Manifests before the last ``retain`` go, then what only they named: no reader finds a manifest without its data."""
    every = manifests(spark, target)
    old, kept = every[:-retain], every[-retain:]
    for m in old:
        p, fs = _fs(spark, f"{_log(spark, target)}/{m.number}")
        fs.delete(p, False)
    for place in set().union(*[m.places() for m in old]) - set().union(*[m.places() for m in kept]):
        if target.startswith(CATALOG):
            spark.sql(f"DROP TABLE IF EXISTS {place}")
        else:
            p, fs = _fs(spark, f"{target}/{place}")
            fs.delete(p, True)


def write_rows(df: DataFrame, target: str, family: str, dealt: bool = False) -> str:
    """Write a family's rows (or totals) to a place of their own; returns its name.

    Rows that are ``dealt`` over many tasks already are written by those, without a shuffle.

    The adaptive engine sizes the files: rows are dealt by store, large parts are
    split and small ones joined, to the session's advisory partition size.
    """
    columns = df.columns
    if "sold_to_nbr" in columns and not dealt:
        df = df.hint("rebalance", F.col("sold_to_nbr"))
    name = re.sub(r"\W", "_", family).lower() + "_" + uuid.uuid4().hex
    if target.startswith(CATALOG):
        table = f"{target[len(CATALOG):]}__{name}"
        df.write.saveAsTable(table, format="parquet")
        return table
    df.write.parquet(f"{target}/{name}")
    return name


def write_place(df: DataFrame, target: str, name: str, by: list[str]) -> str:
    """Write rows to a new folder of ``target``, partitioned; returns its name."""
    place = f"{name}_{uuid.uuid4().hex}"
    df.hint("rebalance", *[F.col(c) for c in by]).write.partitionBy(*by).parquet(f"{target}/{place}")
    return place


def _rows(spark: SparkSession, target: str, place: str, ddl: str) -> DataFrame:
    if target.startswith(CATALOG):
        return spark.table(place)
    return spark.read.schema(ddl).parquet(f"{target}/{place}")


_ROWS_DDL = ", ".join(f"{c} {t}" for c, t in MART_COLUMNS) + f", {PRUNE_KEY} string"


def publish_families(spark: SparkSession, target: str, families: dict[str, DataFrame], totals: dict[str, DataFrame],
                     base: Manifest | None = None, retain: int = RETAIN, dealt: tuple[str, ...] = ()) -> Manifest:
    """Write each family and its totals, then publish them as the whole mart in one step.

    ``base`` is the version that the run started from: if another run has published
    since, nothing changes and ``PublishConflict`` is raised. Families that are ``dealt``
    are made and written by the same tasks.
    """
    base = latest(spark, target) if base is None else base
    jobs = [(df, k) for k, df in families.items()] + [(df, f"{k}_totals") for k, df in totals.items()]
    written = side_by_side([lambda df=df, name=name: write_rows(df, target, name, name in dealt) for df, name in jobs])
    return commit(spark, target, base, dict(zip(families, written)), dict(zip(totals, written[len(families):])), retain)


def publish_family(spark: SparkSession, target: str, family: str, rows: DataFrame, totals: DataFrame, retain: int = RETAIN, tries: int = 5, dealt: bool = False) -> Manifest:
    """Replace one family of the published mart; the other families' places are carried over untouched.

    A conflict with a run that replaced other families is no conflict: the entry goes
    into the newer manifest. A run that replaced the same family wins.
    """
    base = latest(spark, target)
    if family not in base.families:
        raise ValueError(f"{target} has no family {family}: publish the mart by families first")
    place, sums = write_rows(rows, target, family, *[dealt] * dealt), write_rows(totals, target, f"{family}_totals")
    now = base
    for _ in range(tries):
        try:
            return commit(spark, target, now, {**now.families, family: place}, {**now.totals, family: sums}, retain)
        except PublishConflict:
            now = latest(spark, target)
            if now.families.get(family) != base.families[family]:
                raise
    raise PublishConflict(f"{target}: {tries} other runs came first")


def publish_mart(df: DataFrame, target: str, retain: int = RETAIN) -> Manifest:
    """Publish rows that are a whole, pruned mart already, as one entry."""
    spark = df.sparkSession
    base = latest(spark, target)
    return commit(spark, target, base, {WHOLE: write_rows(df.withColumn(PRUNE_KEY, F.lit(None).cast("string")), target, WHOLE)}, {}, retain)


def empty_categories_of(spark: SparkSession, target: str, manifest: Manifest) -> DataFrame:
    """The categories that the whole mart leaves out, from the families' totals alone."""
    parts = [_rows(spark, target, p, TOTALS_DDL) for p in manifest.totals.values()]
    return empty_of_totals(reduce(lambda a, b: a.unionByName(b), parts or [spark.createDataFrame([], TOTALS_DDL)]))


def read_mart(spark: SparkSession, target: str, families: list[str] | None = None, manifest: Manifest | None = None) -> DataFrame:
    """The published mart (or some of its families), in the mart's column order and types."""
    manifest = latest(spark, target) if manifest is None else manifest
    chosen = [p for k, p in manifest.families.items() if families is None or k in families]
    if not chosen:
        return empty_mart(spark)
    empty = empty_categories_of(spark, target, manifest).withColumnRenamed("catg_nm", PRUNE_KEY)
    parts = [_rows(spark, target, p, _ROWS_DDL).join(empty, PRUNE_KEY, "left_anti") for p in chosen]
    df = reduce(lambda a, b: a.unionByName(b), parts)
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in MART_COLUMNS])


def _point_view(spark: SparkSession, target: str) -> None:
    """The table's view over the newest version; again if a newer one came meanwhile."""
    done = None
    while done != (now := latest(spark, target)):
        done = now
        sums = " UNION ALL ".join(f"SELECT * FROM {t}" for t in now.totals.values()) or "SELECT NULL AS catg_nm, " + ", ".join(f"0 AS {t}" for t in TOTALS)
        positive = " OR ".join(f"sum({t}) > 0" for t in TOTALS)
        columns = ", ".join(c for c, _ in MART_COLUMNS)
        rows = " UNION ALL ".join(f"SELECT {columns} FROM {t} LEFT ANTI JOIN emptied ON {PRUNE_KEY} = emptied.catg_nm" for t in now.families.values())
        spark.sql(f"CREATE OR REPLACE VIEW {target[len(CATALOG):]} AS WITH emptied AS "
                  f"(SELECT catg_nm FROM ({sums}) GROUP BY catg_nm HAVING NOT ({positive})) {rows}")


def clone_schema(spark: SparkSession, path: str) -> DataFrame:
    """P04 on storage: an empty mart written and read back."""
    empty_mart(spark).write.parquet(path)
    return spark.read.schema(mart_struct()).parquet(path)


