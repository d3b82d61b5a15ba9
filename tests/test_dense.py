"""The dense families: their rows meet nothing after they are made, and bring their stores' attributes along."""

import re

import pytest
from pyspark.sql import functions as F

from shelfscope.operators import mart, pos
from shelfscope.plans.queries import job_for
from shelfscope.sources.martstore import write_rows

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("family", ["POS", "SHP"])
def test_dense_rows_are_enriched_without_a_join_of_their_own(spark, family):
    """With nothing broadcast, the store's attributes come before the rows are multiplied and no finished row is shuffled."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = job_for(spark, SF)
        df = mart.finish_family(j.family_with_stores(family), j.spr_stores, j.store_attributes, j.pos_run_dt, j.params)
        plain = mart.finish_family(j.family_rows(family), j.spr_stores, j.store_attributes, j.pos_run_dt, j.params)
        rows = df.collect()
        assert sorted(map(str, rows)) == sorted(map(str, plain.collect()))
        p = _plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "_e_key" not in p
    # Whatever is exchanged above the stage tables has the measures of store rows, not the 83 columns of the mart.
    assert not [x for x in p.splitlines() if "Join" in x and "hash_key" in x]


def test_share_and_growth_are_computed_before_the_grid_rows(spark):
    """No conversion or division of a total stands above the explosion of the grid's brands."""
    j = job_for(spark, SF)
    metrics = pos.pos_share_growth(j.spr_stores, j.products, j.pos_frames, j.pos_ic, j.pos_sparse, j.pos_totals,
                                   j.pos_store_level, j.pos_ranks, j.params)
    lines = metrics._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, x in enumerate(lines) if re.search(r"Generate explode\(transform\(filter\(_members", x))
    above = lines[next(i for i in range(at, -1, -1) if "Project" in lines[i])]
    assert " / " not in above and "cast(" not in above


def test_dealt_rows_are_written_without_a_shuffle(spark, scratch):
    rows = spark.range(0, 5000, 1, 7).select(F.col("id").cast("string").alias("sold_to_nbr"), F.lit(1.0).alias("v"))
    made = {dealt: write_rows(rows, f"{scratch}/dealt-{dealt}", "POS", dealt) for dealt in (False, True)}
    read = {k: spark.read.parquet(f"{scratch}/dealt-{k}/{v}") for k, v in made.items()}
    assert len(read[True].inputFiles()) == 7 and len(read[False].inputFiles()) < 7
    assert sorted(read[True].collect()) == sorted(read[False].collect())


def test_store_rows_of_shipments_stay_dealt_over_a_fixed_number_of_parts(spark):
    """Each store row becomes hundreds of rows: the engine must not gather the few store rows in one task before that."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        j = job_for(spark, SF)
        j.shipment_plan_level, j.store_attributes
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        stores = "hashpartitioning(plan_to_nbr#"
        p = j.shipment_rows_with_stores()._jdf.queryExecution().executedPlan().toString()
        assert [x for x in p.splitlines() if stores in x and "_salt" in x and "REPARTITION_BY_NUM" in x], p
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
