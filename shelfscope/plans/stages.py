"""Stage boundaries: stage tables and dense grids.

* ``materialize`` cuts lineage by writing the stage as a Parquet table under the
  cluster's ``spark.checkpoint.dir`` (the shared folder, never a machine-local
  one) and reading it back.  A lost executor then does not force a recompute of
  every upstream fact join, stages read by several metric families are computed
  once, and Spark knows the stage's size in bytes when it picks a join.
* ``densify`` builds the grids that the mart is defined over as an equi-join, so
  that Spark may broadcast, hash or sort-merge it by measured size.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.params import MartParams
from shelfscope.session import checkpoint_dir

#: Rows of a dimension that share a chunk of a grid.
GRID_CHUNK_ROWS = 256


def stage_root(spark, params: MartParams) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/stages/{params.run_id}"


def materialize(df: DataFrame, params: MartParams) -> DataFrame:
    spark = df.sparkSession
    path = f"{stage_root(spark, params)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark, params: MartParams) -> None:
    """Delete this run's stage tables (Hadoop FileSystem API: works on any shared store)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(stage_root(spark, params))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


#: Rows of one key that share a salt; keys with fewer are not split.
ROWS_PER_SALT = 20_000


def key_salts(rows: DataFrame, keys: list[str], rows_per_salt: int) -> DataFrame:
    """keys, _salts: the heavy keys of ``rows`` with the number of salts that their own number of rows asks for.

    The counts are one partial aggregation; at most rows / ``rows_per_salt`` keys are heavy.
    """
    n = F.ceil(F.count(F.lit(1)) / F.lit(rows_per_salt)).cast("int")
    return rows.groupBy(*keys).agg(n.alias("_salts")).where("_salts > 1")


def salted_join(many: DataFrame, few: DataFrame, keys: list[str], spread_by: list[str], params: MartParams,
                rows_per_salt: int | None = None, parts: int | None = None) -> DataFrame:
    """``many`` joined with ``few`` on ``keys`` where a key of ``many`` may hold most of its rows.

    A histogram of the heavy keys gives each its own number of salts: the rows of
    ``many`` are dealt over them by ``spread_by``, the rows of ``few`` repeated for
    them. Other keys keep one salt, so nothing is repeated for them. Rows that multiply are dealt over a number of
    ``parts``, as the engine goes by their size before that; the deal is the last one before the join, whatever its kind.
    """
    heavy = materialize(key_salts(many, keys, rows_per_salt or ROWS_PER_SALT), params)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    dealt = many.join(heavy, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts).cast("int")).drop("_salts")
    if parts:
        dealt = dealt.repartition(parts, *keys, "_salt")
    repeated = few.join(heavy, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return dealt.join(repeated, [*keys, "_salt"]).drop("_salt")


#: Jobs that are submitted side by side; Spark shares its tasks' slots out among them.
SIDE_BY_SIDE = 4


class Shared:
    """Base of objects whose stages are made once, also when several threads ask for them."""

    def __init__(self):
        self._locks: dict[str, threading.RLock] = {}
        self._guard = threading.Lock()

    def once(self, held: dict, name: str, make: Callable):
        if name not in held:
            with self._guard:
                lock = self._locks.setdefault(name, threading.RLock())
            # Stages form a DAG, so a thread never waits for one that waits for it.
            with lock:
                if name not in held:
                    held[name] = make()
        return held[name]


class shared_property:
    """A cached property of a ``Shared`` object."""

    def __init__(self, make: Callable):
        self.make, self.__doc__ = make, make.__doc__

    def __set_name__(self, owner, name: str):
        self.name = name

    def __get__(self, obj, owner=None):
        return self if obj is None else obj.once(obj.__dict__, self.name, lambda: self.make(obj))


def side_by_side(tasks: Iterable[Callable]) -> list:
    """Results of the callables, which may run Spark jobs, in order; the first error is raised after all have ended."""
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        futures = [pool.submit(t) for t in tasks]
    return [f.result() for f in futures]


def grid_partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunked(dim: DataFrame) -> DataFrame:
    """``dim`` in rows of about ``GRID_CHUNK_ROWS`` members each: _chunk, _members (array of structs)."""
    chunks = max(1, -(-dim.count() // GRID_CHUNK_ROWS))
    member = F.struct(*dim.columns)
    return dim.groupBy(F.pmod(F.xxhash64(*dim.columns), F.lit(chunks)).cast("int").alias("_chunk")).agg(
        F.collect_list(member).alias("_members"))


def meet_chunks(rows: DataFrame, chunks: DataFrame, spread_by) -> DataFrame:
    """Rows that carry a chunk's number with that chunk, as an equi-join on (chunk, salt).

    The chunk side is repeated for each salt, so neither a hot chunk nor a large row
    side meets in one task.
    """
    salts = grid_partitions(rows.sparkSession)
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    right = chunks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.join(right, ["_chunk", "_salt"]).drop("_chunk", "_salt")


def with_chunks(left: DataFrame, chunks: DataFrame, spread_by) -> DataFrame:
    """Every row of ``left`` with every chunk."""
    n = chunks.agg(F.max("_chunk")).first()[0] or 0
    left = left.repartition(grid_partitions(left.sparkSession), *spread_by)
    return meet_chunks(left.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(n)))), chunks, spread_by)


def densify(left: DataFrame, dim: DataFrame, spread_by) -> DataFrame:
    """Every row of ``left`` with every row of the dimension ``dim``."""
    grid = with_chunks(left, chunked(dim), spread_by)
    return grid.withColumn("_m", F.explode("_members")).select(*left.columns, *[F.col(f"_m.{c}").alias(c) for c in dim.columns])
