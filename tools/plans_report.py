"""Write PLANS.md: physical-plan summaries of the key stages.

Sources are first written as Parquet tables (as in production) so that the scans,
pushed filters and read schemas are those a cluster run would see.

usage: python tools/plans_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfscope.plans.job import MartJob  # noqa: E402
from shelfscope.session import get_spark, use_local_checkpoint_dir  # noqa: E402
from shelfscope.sources.tables import SOURCE_NAMES, read_sources  # noqa: E402
from shelfscope.sources.testviews import adapter_params, build_sources  # noqa: E402

def stages(job):
    """(title, builder) pairs; each builder makes the stage unmaterialised from its
    (materialised) inputs, so the plan shown is the stage's own work."""
    from shelfscope.operators import drivers, key_brand, pos, shipment, visits

    j = job
    return [
        ("POS base, the one scan of the weekly fact (P15-P16)", lambda: pos.pos_base(
            j.src.pos_weekly, j.pos_frames + j.pos_weekly_frames, j.spr_stores)),
        ("POS roll-up with IC category (P15)", lambda: pos.pos_rollup_ic(
            j.pos_base, j.pos_frames + j.pos_weekly_frames, j.grid_catgs, j.params)),
        ("POS share / growth, zero rows last (P21-P23)", lambda: j.pos_metrics),
        ("POS time-frame rows (P24-P27)", lambda: j.pos_rows),
        ("Shipment detail (P11)", lambda: shipment.shipment_detail(
            j.src.shipments, j.src.cal_wk, j.cust_hier, j.matrl_hier, j.pos_frames)),
        ("Shipment summary (P14)", lambda: j.shipment_summary),
        ("Key-brand base (P17)", lambda: key_brand.key_brand_base(
            j.spr_stores, j.products, j.pos_frames, j.pos_ic, j.params)),
        ("Visit audit detail (P30)", lambda: visits.visit_audit_detail(
            j.src.visit_audit, j.cal_day, j.src.prod_matrl, j.covered_stores, j.psd_frames)),
        ("Driver store facts (P41-P43)", lambda: drivers.store_facts(
            j.drv_store_lists, j.drv_chain_lists, j.drv_active, j.drv_event_facts, j.oos, j.pos_plain, j.params)),
        ("Mart assembly (P49-P53)", lambda: j.mart_final),
    ]


def tree(plan: str) -> str:
    keep = []
    for line in plan.splitlines():
        m = re.match(r"^([\s:+\-|*()0-9]*)([A-Za-z][A-Za-z ]+?)(?:\s\[|\(|$|\s)", line)
        if m:
            keep.append((m.group(1) + m.group(2)).rstrip())
    return "\n".join(keep)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = get_spark()
    use_local_checkpoint_dir(spark)
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    root = tempfile.mkdtemp(prefix="plans-src-", dir="/tmp")
    src = build_sources(spark, sf_dir)
    for n in SOURCE_NAMES:
        getattr(src, n).write.mode("overwrite").parquet(f"{root}/{n}")
    job = MartJob(spark, read_sources(spark, root), adapter_params())
    lines = [f"# Physical plans of the key stages ({os.path.basename(sf_dir)}, local[8], AQE on)", "",
             "Generated by `tools/plans_report.py` from Parquet-written sources. Each stage is",
             "built from its materialised inputs, so a plan shows that stage's own work.",
             "AQE may still turn a sort-merge join into a broadcast join at run time.", ""]
    for title, build in stages(job):
        plan = build()._jdf.queryExecution().executedPlan().toString()
        exchanges = re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", plan)
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)))
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
        lines += [f"## {title}", "",
                  f"* shuffle exchanges: {len(exchanges)}; broadcasts: {plan.count('BroadcastExchange')}; "
                  f"cartesian products: {plan.count('CartesianProduct')}",
                  *[f"* pushed filters: `{p[:300]}`" for p in pushed if p],
                  *[f"* read schema: `{s[:300]}`" for s in schemas], "", "```", tree(plan), "```", ""]
    with open(out, "w") as fh:
        fh.write("\n".join(lines))
    print(f"wrote {out}")


if __name__ == "__main__":
    main()
