"""The published mart: versions, conflicts, families, totals, retention, file sizes."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from shelfscope.operators import mart
from shelfscope.plans.job import MartJob
from shelfscope.sources import martstore
from shelfscope.sources.martstore import PublishConflict, commit, create_once, latest, manifests, publish_families, publish_family, read_mart
from shelfscope.sources.schemas import to_mart_rows
from shelfscope.sources.testviews import adapter_params, build_sources

SF = "/root/testdata/sf0.001"


def family(spark, name, rows):
    """(stored rows, totals) of (category, value) pairs."""
    df = spark.createDataFrame(rows, "catg_nm string, sale_val double").withColumn("metrc_nm", F.lit(name)).withColumn("sold_to_nbr", F.lit("s"))
    stored = to_mart_rows(df).withColumn(mart.PRUNE_KEY, F.col("catg_nm")).withColumn("catg_nm", F.coalesce("catg_nm", F.lit("")))
    return stored, mart.category_totals(df)


def publish(spark, target, parts, **kw):
    made = {k: family(spark, k, rows) for k, rows in parts.items()}
    return publish_families(spark, target, {k: v[0] for k, v in made.items()}, {k: v[1] for k, v in made.items()}, **kw)


def held(df):
    return sorted((r["metrc_nm"], r["catg_nm"], r["sale_val"]) for r in df.collect())


def test_one_of_many_creators_wins(spark, scratch):
    path = f"{scratch}/once/1"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: create_once(spark, path, f"content {i}"), range(24)))
    assert sum(won) == 1
    assert open(path).read() == f"content {won.index(True)}"
    assert os.listdir(f"{scratch}/once") == ["1"] or {x.strip(".crc") for x in os.listdir(f"{scratch}/once")} <= {"1", "."}


def test_two_publishers_of_one_number(spark, scratch):
    target = f"{scratch}/race"
    publish(spark, target, {"SHP": [("a", 1.0)]})
    base = latest(spark, target)
    first = publish(spark, target, {"SHP": [("a", 2.0)]}, base=base)
    with pytest.raises(PublishConflict):
        publish(spark, target, {"SHP": [("a", 3.0)]}, base=base)
    assert latest(spark, target) == first and first.number == base.number + 1
    assert held(read_mart(spark, target)) == [("SHP", "a", 2.0)]


def test_concurrent_commits_of_one_base(spark, scratch):
    target = f"{scratch}/race2"
    base = publish(spark, target, {"SHP": [("a", 1.0)]})

    def attempt(i):
        try:
            return commit(spark, target, base, base.families, base.totals)
        except PublishConflict:
            return None

    with ThreadPoolExecutor(6) as pool:
        assert sum(m is not None for m in pool.map(attempt, range(6))) == 1


def test_a_writer_that_died_blocks_nobody(spark, scratch):
    target = f"{scratch}/dead"
    publish(spark, target, {"SHP": [("a", 1.0)]})
    open(f"{target}/_versions/2", "w").close()  # claimed, never written
    assert latest(spark, target).number == 1
    assert publish(spark, target, {"SHP": [("a", 5.0)]}).number == 3
    assert held(read_mart(spark, target)) == [("SHP", "a", 5.0)]


def test_refresh_of_one_family_keeps_the_others_files(spark, scratch):
    target = f"{scratch}/families"
    base = publish(spark, target, {"SHP": [("a", 1.0), ("b", 0.0), (None, 0.0)], "POS": [("b", -1.0), ("c", 4.0)]})
    # b is empty over both families and goes from both; a NULL category stays.
    assert held(read_mart(spark, target)) == [("POS", "c", 4.0), ("SHP", "", 0.0), ("SHP", "a", 1.0)]
    files = {k: sorted(os.listdir(f"{target}/{p}")) for k, p in base.families.items()}
    now = publish_family(spark, target, "POS", *family(spark, "POS", [("b", 3.0)]))
    assert now.families["SHP"] == base.families["SHP"] and now.families["POS"] != base.families["POS"]
    assert sorted(os.listdir(f"{target}/{now.families['SHP']}")) == files["SHP"]
    # b has a value now: the other family's row is back, though nothing of it was written.
    assert held(read_mart(spark, target)) == [("POS", "b", 3.0), ("SHP", "", 0.0), ("SHP", "a", 1.0), ("SHP", "b", 0.0)]
    assert held(read_mart(spark, target, families=["POS"])) == [("POS", "b", 3.0)]
    with pytest.raises(ValueError):
        publish_family(spark, target, "EVENTS", *family(spark, "EVENTS", []))


def test_refreshes_of_different_families_merge_and_of_one_conflict(spark, scratch, monkeypatch):
    target = f"{scratch}/merge"
    publish(spark, target, {"SHP": [("a", 1.0)], "POS": [("a", 2.0)]})
    write = martstore.write_rows
    other = []

    def slow(df, where, name):
        if not other:  # another run comes between this run's start and its commit
            other.append(name)
            publish_family(spark, target, rival, *family(spark, rival, [("a", 9.0)]))
        return write(df, where, name)

    rival = "SHP"
    monkeypatch.setattr(martstore, "write_rows", slow)
    publish_family(spark, target, "POS", *family(spark, "POS", [("a", 7.0)]))
    assert held(read_mart(spark, target)) == [("POS", "a", 7.0), ("SHP", "a", 9.0)]
    other.clear()
    rival = "POS"
    with pytest.raises(PublishConflict):
        publish_family(spark, target, "POS", *family(spark, "POS", [("a", 8.0)]))
    assert held(read_mart(spark, target)) == [("POS", "a", 9.0), ("SHP", "a", 9.0)]


def test_old_versions_and_their_data_go(spark, scratch):
    target = f"{scratch}/retain"
    made = [publish(spark, target, {"SHP": [("a", float(i + 1))]}, retain=2) for i in range(4)]
    assert [m.number for m in manifests(spark, target)] == [3, 4]
    assert {x for x in os.listdir(target) if x != "_versions"} == made[2].places() | made[3].places()
    assert held(read_mart(spark, target, manifest=made[2])) == [("SHP", "a", 3.0)]


def test_large_families_are_written_by_many_tasks(spark, scratch):
    target = f"{scratch}/wide"
    rows = spark.range(60_000).select(F.lit("POS").alias("metrc_nm"), F.concat(F.lit("s"), F.col("id") % 500).alias("sold_to_nbr"),
                                      F.sha2(F.col("id").cast("string"), 256).alias("brand_nm"), F.rand(1).alias("sale_val"), F.lit("a").alias("catg_nm"))
    stored = to_mart_rows(rows).withColumn(mart.PRUNE_KEY, F.col("catg_nm"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.minPartitionSize")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        many = martstore.write_rows(stored, target, "POS")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        one = martstore.write_rows(stored, target, "POS")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    count = lambda p: len([x for x in os.listdir(f"{target}/{p}") if x.endswith(".parquet")])
    assert count(many) > 8 and count(one) < count(many) / 8


def test_catalog_target_has_families_versions_and_a_view(spark):
    target = "catalog:shelf_versions"
    for n in range(4):
        publish(spark, target, {"SHP": [("a", n + 1.0), ("z", 0.0)], "POS": [("a", 2.0)]}, retain=2)
    publish_family(spark, target, "POS", *family(spark, "POS", [("a", 5.0)]), retain=2)
    want = [("POS", "a", 5.0), ("SHP", "a", 4.0)]
    assert held(read_mart(spark, target)) == want and held(spark.table("shelf_versions")) == want
    tables = [t.name for t in spark.catalog.listTables() if t.name.startswith("shelf_versions__")]
    assert len(tables) == len(set().union(*[m.places() for m in manifests(spark, target)]))


def test_refresh_builds_one_family_only(spark, scratch):
    target = f"{scratch}/job"
    job = MartJob(spark, build_sources(spark, SF), adapter_params())
    base = job.publish(target)
    whole = read_mart(spark, target).drop("kortex_cre_ts", "kortex_updt_ts")
    before = whole.count()
    again = MartJob(spark, build_sources(spark, SF), adapter_params())
    now = again.refresh_family(target, "POS_CATG_AMPS")
    for built in ("pos_sparse", "pos_ic", "shipment_detail", "shipment_plan_level", "visit_detail", "drv_store_lists", "key_brand_metrics"):
        assert built not in again.__dict__
    assert {k for k in base.families if base.families[k] != now.families[k]} == {"POS_CATG_AMPS"}
    after = read_mart(spark, target).drop("kortex_cre_ts", "kortex_updt_ts")
    assert after.count() == before and after.exceptAll(whole).count() == 0
    job.drop_stages()


def test_totals_of_dense_families_equal_those_of_their_rows(spark):
    from shelfscope.plans.queries import job_for

    job = job_for(spark, SF)
    for name in ("SHP", "POS"):
        made = {r["catg_nm"]: r["v"] for r in job.family_totals(name).groupBy("catg_nm").agg(F.sum("_v").alias("v")).collect()}
        rows = {r["catg_nm"]: r["_v"] for r in mart.category_totals(job.family_rows(name)).collect()}
        assert rows.keys() <= made.keys() and all(made[c] == v for c, v in rows.items())
        assert all(made[c] == 0 for c in made.keys() - rows.keys())
