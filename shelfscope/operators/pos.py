"""Point-of-sale families: roll-ups, share & growth, weekly rows, category share.

P15-P16 (roll-ups), P21-P28 (POS time-frame and weekly rows), P29 (category share).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.functions.columns import (
    growth_or_zero, hundred, is_filled, money, share_or_null, typed_null,
)
from shelfscope.functions.joins import join_back
from shelfscope.functions.ranking import rank_within
from shelfscope.operators.calendar import FrameSet
from shelfscope.operators.mart import STORE_STRUCT, category_totals, with_store_struct, zero_totals
from shelfscope.params import (
    CATG_ALL, CATG_EVENT, COMPETITOR_EXCLUDED_CATG, EXCLUDED_POS_PLAN_TOS, EXTRA_PLAIN_CATG,
    FRAME_DESCRIPTIONS, HIER_COVERED, HIER_NON_COVERED, IC_LABEL, WEEKLY_LABELS, MartParams,
)
from shelfscope.plans.stages import grid_partitions, materialize, meet_chunks

MEASURES = ["sale_val", "sale_yr_ago_val", "sale_qty", "sale_yr_ago_qty"]
ALL_MEASURES = MEASURES + ["sale_vol_lb_val", "sale_yr_ago_vol_lb_val"]
ROLLUP_KEYS = ["tmfrm_cd", "pd_end_yr_wk", "pd_end_dt", "sold_to_nbr", "chain_nbr"]


def _frame_desc(c: str = "tmfrm_cd"):
    expr = None
    for k, v in FRAME_DESCRIPTIONS.items():
        expr = (F.when(F.col(c) == k, F.lit(v)) if expr is None else expr.when(F.col(c) == k, F.lit(v)))
    return expr


def _non_covered_stores(spr_stores: DataFrame) -> DataFrame:
    # Duplicated store rows are kept on purpose: facts join the store list directly.
    return spr_stores.filter(F.col("hier_type_cd") == HIER_NON_COVERED).select("sold_to_nbr", "chain_nbr")


def _sums():
    return [F.sum(m).alias(m) for m in ALL_MEASURES] + [
        F.max(c).alias(c) for c in ("kortex_upld_ts", "kortex_dprct_ts")]


BASE_KEYS = ["fisc_yr_wk", "sold_to_nbr", "chain_nbr", "catg_nm", "brand_nm", "corp_nm", "src_nm"]


def _immediate():
    return F.coalesce(is_filled("immed_cnsmptn_prod_type_cd"), F.lit(False)).alias("ic_ind")


def week_rollup(pos: DataFrame) -> DataFrame:
    """POS by week, store, category, brand, corporation, source and immediate-consumption flag.

    It depends on the fact alone (no frame, no store list), so a week's roll-up holds
    until the week's fact rows change.
    """
    pos = pos.filter(~F.col("plan_to_nbr").isin(*EXCLUDED_POS_PLAN_TOS))
    return pos.groupBy(*[k for k in BASE_KEYS if k != "chain_nbr"], _immediate()).agg(*_sums())


def pos_base(pos: DataFrame, frames: FrameSet, spr_stores: DataFrame) -> DataFrame:
    """POS by week, non-covered store, category, brand, corporation, source and
    immediate-consumption flag: the one scan of the weekly fact that both roll-ups start from.

    ``pos`` is the fact or its kept week roll-ups.
    """
    lo, hi = frames.week_bounds()
    pos = pos.filter(F.col("fisc_yr_wk").between(F.lit(lo), F.lit(hi)))
    if "ic_ind" not in pos.columns:
        pos = pos.filter(~F.col("plan_to_nbr").isin(*EXCLUDED_POS_PLAN_TOS)).withColumn("ic_ind", _immediate())
    return pos.join(_non_covered_stores(spr_stores), "sold_to_nbr").groupBy(*BASE_KEYS, "ic_ind").agg(*_sums())


def _framed(kept: DataFrame, frames: FrameSet, keys: list) -> DataFrame:
    """Sums per frame, and the largest source name: by its number in the sorted list of names, so that all
    is one hash aggregation. Rows are dealt by store before the frames multiply them."""
    # The names sort in one task: a source system each, not a row each.
    names = kept.select("src_nm").where(F.col("src_nm").isNotNull()).distinct().withColumn("_src", F.row_number().over(Window.orderBy("src_nm")))
    numbered = kept.join(F.broadcast(names), "src_nm", "left").drop("src_nm").repartition("sold_to_nbr")
    sums = frames.by_week(numbered, "fisc_yr_wk").groupBy(*ROLLUP_KEYS, *keys, "brand_nm", "corp_nm").agg(
        *_sums(), F.max("_src").alias("_src"))
    return sums.join(F.broadcast(names), "_src", "left").drop("_src").select(
        *ROLLUP_KEYS, *keys, "brand_nm", "corp_nm", *ALL_MEASURES, "src_nm", "kortex_upld_ts", "kortex_dprct_ts")


def _flagged(base: DataFrame, grid_catgs: DataFrame) -> DataFrame:
    """``_in_grid``: the ``IN (sub-query)`` under ``OR`` as a left join to the category list."""
    j = base.join(grid_catgs.select("catg_nm", F.lit(True).alias("_in_grid")), "catg_nm", "left")
    return j.withColumn("_in_grid", F.coalesce(F.col("_in_grid"), F.lit(False)))


def pos_rollup_ic(base: DataFrame, frames: FrameSet, grid_catgs: DataFrame, params: MartParams) -> DataFrame:
    """POS by frame (rolling + weekly), store, IC category, brand and corporation.

    Competitors count only in the rolling frames; own rows only for grid
    categories; competitor rows not in 'Others'.
    """
    own = F.col("corp_nm") == params.own_corp
    kept = _flagged(base, grid_catgs).filter(
        (own & F.col("_in_grid"))
        | ((F.col("corp_nm") != params.own_corp) & (F.col("catg_nm") != COMPETITOR_EXCLUDED_CATG)))
    kept = kept.withColumn("ic_catg_nm", F.when(F.col("ic_ind"), F.lit(IC_LABEL)).otherwise(F.col("catg_nm")))
    # Weekly frames hold own rows only: one frame list per corporation, no row is made and dropped.
    rolling = FrameSet(tuple(f for f in frames.frames if not f.tmfrm_cd.startswith("WEEKLY")))
    return _framed(kept.filter(own), frames, ["ic_catg_nm"]).unionByName(
        _framed(kept.filter(F.col("corp_nm") != params.own_corp), rolling, ["ic_catg_nm"]))


def pos_rollup_plain(base: DataFrame, frames: FrameSet, grid_catgs: DataFrame) -> DataFrame:
    """POS by rolling frame, store, category, brand, corporation (all corporations)."""
    kept = _flagged(base, grid_catgs).filter(F.col("_in_grid") | (F.col("catg_nm") == EXTRA_PLAIN_CATG))
    return _framed(kept, frames, ["catg_nm"])


FACT_COLUMNS = ["hier_type_cd", "corp_nm", "sold_to_nbr", "chain_nbr", "ic_catg_nm", "brand_nm",
                "tmfrm_cd", "pd_end_yr_wk", *MEASURES, "src_nm"]


FRAME_KEYS = ["tmfrm_cd", "pd_end_yr_wk"]
STORE_KEYS = ["hier_type_cd", "sold_to_nbr", "corp_nm", *FRAME_KEYS]
CHAIN_KEYS = ["hier_type_cd", "chain_nbr", "corp_nm", *FRAME_KEYS]
LEVEL_KEYS = [k for k in STORE_KEYS if k != "sold_to_nbr"]
CATG_TOTALS = ["total_catg_sale_val", "total_catg_sale_yr_ago_val"]


def pos_sparse_facts(spr_stores: DataFrame, products: DataFrame, frames: FrameSet,
                     pos_ic: DataFrame, params: MartParams) -> DataFrame:
    """The fact rows that have POS: own rows of grid products on every distinct store
    key, competitor rows on every row of the store list."""
    rolling = pos_ic.filter(F.col("tmfrm_cd").isin(*frames.codes()))
    store_keys = spr_stores.select("hier_type_cd", "sold_to_nbr", "chain_nbr", "src_nm").distinct()
    own = rolling.filter(F.col("corp_nm") == params.own_corp).join(
        products.select("ic_catg_nm", "brand_nm").distinct(), ["ic_catg_nm", "brand_nm"], "left_semi")
    own = own.drop("chain_nbr", "src_nm").join(store_keys, "sold_to_nbr")
    own = own.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in MEASURES else F.col(c) for c in FACT_COLUMNS])
    competitors = rolling.filter(F.col("corp_nm") != params.own_corp).join(
        spr_stores.select("sold_to_nbr", "hier_type_cd"), "sold_to_nbr").select(*FACT_COLUMNS)
    return own.unionByName(competitors)


def pos_totals(sparse: DataFrame) -> dict[str, DataFrame]:
    """Store and chain totals per corporation, and category totals, of the sparse rows:
    the rows without POS are zeros and add nothing. All are hash aggregations."""
    def total(keys, prefix, measures):
        return sparse.groupBy(*keys).agg(*[F.sum(m).alias(f"{prefix}{m}") for m in measures])

    return {
        "store": total(STORE_KEYS, "store_", MEASURES),
        "chain": total(CHAIN_KEYS, "chain_", MEASURES),
        "catg": total(["hier_type_cd", "sold_to_nbr", "ic_catg_nm", *FRAME_KEYS], "total_catg_", MEASURES[:2]),
    }


#: Products of a chunk of the POS grid: as many as a long has bits.
CHUNK_PRODUCTS = 64


def product_ordinals(products: DataFrame) -> DataFrame:
    """ic_catg_nm, brand_nm, _chunk, _bit: every product of the grid with its place in a chunk.

    A chunk holds products of one category, so that a chunk row needs one category
    total, and at most as many as a bitmap has bits.
    """
    pairs = products.select("ic_catg_nm", "brand_nm").distinct()
    by_catg = Window.partitionBy("ic_catg_nm").orderBy("brand_nm")
    placed = pairs.withColumn("_n", F.row_number().over(by_catg) - 1)
    placed = placed.select("ic_catg_nm", "brand_nm", F.floor(F.col("_n") / CHUNK_PRODUCTS).cast("int").alias("_part"),
                           (F.col("_n") % CHUNK_PRODUCTS).alias("_bit"))
    chunks = placed.groupBy("ic_catg_nm", "_part").agg(F.count(F.lit(1)).alias("_size"))
    numbered = chunks.withColumn("_chunk", F.dense_rank().over(Window.orderBy("ic_catg_nm", "_part")) - 1)
    return join_back(placed, numbered.drop("_size"), ["ic_catg_nm", "_part"], "inner", ["ic_catg_nm"]).drop("_part")


def product_chunks(ordinals: DataFrame) -> DataFrame:
    """_chunk, ic_catg_nm and the chunk's members (_bit, brand_nm), in the order of their bits."""
    return ordinals.groupBy("_chunk", "ic_catg_nm").agg(F.array_sort(F.collect_list(F.struct("_bit", "brand_nm"))).alias("_members"))


def pos_store_level(spr_stores: DataFrame, products: DataFrame, frames: FrameSet, pos_ic: DataFrame,
                    sparse: DataFrame, totals: dict[str, DataFrame], params: MartParams) -> DataFrame:
    """One row per store key and rolling frame, for the own corporation, with its totals.

    ``_has_rows``: the store has own rows at all (POS rows or zero rows).
    """
    store_keys = spr_stores.select("hier_type_cd", "sold_to_nbr", "chain_nbr", "src_nm").distinct()
    level = frames.with_each(store_keys).drop("pd_start_dt", "pd_start_yr_wk", "pd_end_dt").withColumn("corp_nm", F.lit(params.own_corp))
    level = level.join(totals["store"], STORE_KEYS, "left")
    level = join_back(level, totals["chain"], CHAIN_KEYS, "left", ["chain_nbr"])
    rolling = pos_ic.filter(F.col("tmfrm_cd").isin(*frames.codes()))
    pairs = products.select("ic_catg_nm", "brand_nm").distinct()
    # Only products of the grid can be among its rows.
    present = rolling.join(pairs, ["ic_catg_nm", "brand_nm"], "left_semi").groupBy(
        "sold_to_nbr", *FRAME_KEYS, "ic_catg_nm", "brand_nm").agg(F.max((F.col("corp_nm") == params.own_corp).cast("int")).alias("_own"))
    present = present.groupBy("sold_to_nbr", *FRAME_KEYS).agg(F.count(F.lit(1)).alias("_n"), F.max("_own").alias("_own"))
    level = level.join(present, ["sold_to_nbr", *FRAME_KEYS], "left")
    level = level.join(_competitor_stores(rolling, params), "sold_to_nbr", "left")
    has_rows = (F.coalesce(F.col("_n"), F.lit(0)) < F.lit(pairs.count())) | (F.col("_own") == 1)
    zero = [F.coalesce(F.col(f"{p}_{m}"), F.lit(0)).alias(f"{p}_{m}") for p in ("store", "chain") for m in MEASURES]
    return level.select("hier_type_cd", "corp_nm", "sold_to_nbr", "chain_nbr", *FRAME_KEYS, "src_nm", *zero,
                        "_has_cmp", has_rows.alias("_has_rows"))


def present_bitmaps(rolling: DataFrame, ordinals: DataFrame) -> DataFrame:
    """sold_to_nbr, frame, _chunk, _bits: a bitmap of the chunk's products that have POS of any corporation.

    One partial aggregation (a bitwise or); a store has rows for the chunks that it sells of.
    """
    return rolling.join(ordinals, ["ic_catg_nm", "brand_nm"]).groupBy("sold_to_nbr", *FRAME_KEYS, "_chunk").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit").cast("int"))).alias("_bits"))


def per_store(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
    """sold_to_nbr and the list ``name`` of its rows' other columns: what a store has meets other rows of
    the store by its number alone, so that these are dealt by store once for all such joins."""
    return rows.groupBy("sold_to_nbr").agg(F.collect_list(F.struct(*columns)).alias(name))


def _of_row(name: str, keys: list[str]):
    """The entries of the store list ``name`` that agree with the row in ``keys`` (a NULL agrees with nothing)."""
    return F.filter(name, lambda e: reduce(lambda x, y: x & y, [e[k] == F.col(k) for k in keys]))


def chunk_rows(level: DataFrame, bitmaps: DataFrame, catg_totals: DataFrame, chunks: DataFrame, n_chunks: int) -> DataFrame:
    """Every store row with every chunk: the chunk's bitmap of present products and its category's totals.

    What a store has is gathered once per store and turned into maps from the chunk for
    each frame; a chunk row takes its own entries along and nothing of the rest.
    """
    bits = per_store(bitmaps, [*FRAME_KEYS, "_chunk", "_bits"], "_bit_list")
    sums = per_store(catg_totals.join(chunks.select("ic_catg_nm", "_chunk"), "ic_catg_nm"),
                     ["hier_type_cd", *FRAME_KEYS, "_chunk", *CATG_TOTALS], "_sum_list")
    rows = level.join(bits, "sold_to_nbr", "left").join(sums, "sold_to_nbr", "left")
    rows = rows.select(
        *level.columns,
        F.map_from_entries(F.transform(_of_row("_bit_list", FRAME_KEYS), lambda e: F.struct(e["_chunk"], e["_bits"]))).alias("_bit_map"),
        F.map_from_entries(F.transform(_of_row("_sum_list", ["hier_type_cd", *FRAME_KEYS]), lambda e: F.struct(
            e["_chunk"], F.struct(*[e[c].alias(c) for c in CATG_TOTALS])))).alias("_sum_map"))
    own = F.transform(F.sequence(F.lit(0), F.lit(n_chunks - 1)), lambda c: F.struct(
        c.alias("chunk"), F.coalesce(F.element_at("_bit_map", c), F.lit(0).cast("bigint")).alias("bits"), F.element_at("_sum_map", c).alias("sums")))
    rows = rows.select(*level.columns, F.explode(own).alias("_c"))
    return rows.select(*level.columns, F.col("_c.chunk").alias("_chunk"), F.col("_c.bits").alias("_bits"),
                       *[F.col(f"_c.sums.{c}").alias(c) for c in CATG_TOTALS])


def _competitor_stores(rolling: DataFrame, params: MartParams) -> DataFrame:
    return rolling.filter(F.col("corp_nm") != params.own_corp).select("sold_to_nbr").distinct().withColumn("_has_cmp", F.lit(True))


METRIC_COLUMNS = [
    "total_catg_sale_val", "total_catg_sale_yr_ago_val", "sale_val_share_pct",
    "sale_yr_ago_val_share_pct", "store_sale_val", "store_sale_yr_ago_val", "store_sale_qty",
    "store_sale_yr_ago_qty", "store_sale_vs_yr_ago_val_pct", "store_sale_vs_yr_ago_qty_pct",
    "chain_sale_val", "chain_sale_yr_ago_val", "chain_sale_qty", "chain_sale_yr_ago_qty",
    "chain_sale_vs_yr_ago_val_pct", "chain_sale_vs_yr_ago_qty_pct",
]
CALC_COLUMNS = ["agg_type", "hier_type_cd", "corp_nm", "sold_to_nbr", "chain_nbr", "ic_catg_nm",
                "brand_nm", "tmfrm_cd", "pd_end_yr_wk", *MEASURES, *METRIC_COLUMNS, "src_nm"]


RANK_COLUMNS = ["chain_store_sale_val_rank", "chain_store_sale_qty_rank", "chain_store_cnt"]


def pos_share_growth(spr_stores: DataFrame, products: DataFrame, frames: FrameSet, pos_ic: DataFrame,
                     sparse: DataFrame, totals: dict[str, DataFrame], level: DataFrame,
                     ranks: DataFrame, params: MartParams, attrs: DataFrame | None = None) -> DataFrame:
    """The dense fact rows with category share, store and chain totals and growth.

    Totals, ranks and counts are attached to the sparse rows and to one row per
    store and frame. The zero rows of the store x product grid come last, as a
    projection of those store rows (each times the product chunks, whose bitmaps say
    which products have POS), so no grid row is ever shuffled, sorted or windowed,
    and no growth, share or conversion is computed a grid row at a time.

    Sparse rows and store rows are dealt by store once each: what they need of it comes as
    one row a store. ``attrs`` (sold_to_nbr and other columns, one row a store) adds the
    struct ``STORE_STRUCT`` of the store's row.
    """
    extra = [*RANK_COLUMNS, *([STORE_STRUCT] if attrs is not None else [])]
    rolling = pos_ic.filter(F.col("tmfrm_cd").isin(*frames.codes()))
    of_rank = [k for k in RANK_KEYS if k != "sold_to_nbr"]
    rank_list = per_store(ranks, of_rank + RANK_COLUMNS[:2], "_rank_list")
    counts = chain_store_count(spr_stores)

    def with_store(rows: DataFrame) -> DataFrame:
        """Rows dealt by store with P25's ranks, P26's counts (a NULL chain has neither) and the store's attributes."""
        rows = rows.join(rank_list, "sold_to_nbr", "left")
        rows = rows.withColumn("_rank", F.get(_of_row("_rank_list", of_rank), F.lit(0))).drop("_rank_list")
        rows = rows.select(*[c for c in rows.columns if c != "_rank"], *[F.col(f"_rank.{c}").alias(c) for c in RANK_COLUMNS[:2]])
        if attrs is not None:
            rows = with_store_struct(rows, attrs)
        return rows.join(counts, ["hier_type_cd", "chain_nbr"], "left")

    own = F.col("corp_nm") == params.own_corp
    in_grid = products.select("ic_catg_nm").distinct().withColumn("_grid", F.lit(True))
    rows = sparse.join(totals["catg"], ["hier_type_cd", "sold_to_nbr", "ic_catg_nm", *FRAME_KEYS], "left")
    sums = totals["store"].withColumnsRenamed({f"store_{m}": m for m in MEASURES})
    rows = with_store(rows.repartition("sold_to_nbr").join(per_store(sums, [*LEVEL_KEYS, *MEASURES], "_totals"), "sold_to_nbr", "left"))
    rows = rows.withColumn("_of", F.get(_of_row("_totals", LEVEL_KEYS), F.lit(0))).drop("_totals")
    rows = rows.select(*[c for c in rows.columns if c != "_of"], *[F.col(f"_of.{m}").alias(f"store_{m}") for m in MEASURES])
    rows = rows.join(_competitor_stores(rolling, params), "sold_to_nbr", "left")
    rows = join_back(rows, totals["chain"], CHAIN_KEYS, "left", ["chain_nbr"]).join(in_grid, "ic_catg_nm", "left")
    # A total is 0, not NULL, where its group also has zero rows: own groups, and categories of the grid.
    rows = rows.select(
        *FACT_COLUMNS, "_has_cmp",
        *[F.when(own, F.coalesce(F.col(c), F.lit(0))).otherwise(F.col(c)).alias(c) for p in ("store", "chain") for c in [f"{p}_{m}" for m in MEASURES]],
        *[F.when(F.col("_grid"), F.coalesce(F.col(c), F.lit(0))).otherwise(F.col(c)).alias(c) for c in CATG_TOTALS], *extra)

    def cat_share(v: str, t: str):
        return F.when(F.col("_has_cmp").isNull() | (F.col(t) == 0), F.lit(0.0)).otherwise(
            hundred() * (money(v) / money(t)))

    shares = [cat_share("sale_val", "total_catg_sale_val").alias("sale_val_share_pct"),
              cat_share("sale_yr_ago_val", "total_catg_sale_yr_ago_val").alias("sale_yr_ago_val_share_pct")]
    of_levels = [c for p in ("store", "chain") for c in [*[money(f"{p}_{m}").alias(f"{p}_{m}") for m in MEASURES], *_growths(p)]]
    out = ["agg_type", *FACT_COLUMNS[:-1], *METRIC_COLUMNS, "src_nm", *extra]
    facts = F.lit("facts").alias("agg_type")
    rows = rows.select(facts, *FACT_COLUMNS, *[money(c).alias(c) for c in CATG_TOTALS], *shares, *of_levels, *extra).select(*out)

    ordinals = materialize(product_ordinals(products), params)
    chunks = materialize(product_chunks(ordinals), params)
    n_chunks = chunks.count()
    if not n_chunks:
        return rows
    # A fixed number of parts: the few store rows of a small input must not meet in one task before they multiply.
    level = with_store(level.repartition(grid_partitions(level.sparkSession), "sold_to_nbr"))
    level = level.select("hier_type_cd", "corp_nm", "sold_to_nbr", "chain_nbr", *FRAME_KEYS, "src_nm", "_has_cmp", *of_levels, *extra)
    dense = chunk_rows(level, present_bitmaps(rolling, ordinals), totals["catg"], chunks, n_chunks)
    measure_type = {f.name: f.dataType for f in sparse.schema.fields}
    zeros = [F.lit(0).cast(measure_type[m]).alias(m) for m in MEASURES]
    dense = dense.select(*[c for c in dense.columns if c not in CATG_TOTALS], *zeros,
                         *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in CATG_TOTALS])
    dense = dense.select(*[c for c in dense.columns if c not in [*CATG_TOTALS, *MEASURES]], *[money(c).alias(c) for c in CATG_TOTALS], *shares)
    dense = meet_chunks(dense, chunks, ["sold_to_nbr"])
    absent = F.filter("_members", lambda m: F.call_function("shiftright", F.col("_bits"), m["_bit"].cast("int")).bitwiseAND(F.lit(1).cast("bigint")) == 0)
    dense = dense.withColumn("brand_nm", F.explode(F.transform(absent, lambda m: m["brand_nm"])))
    return rows.unionByName(dense.select("*", facts, *zeros).select(*out))


def _growths(level: str):
    return [growth_or_zero(money(f"{level}_sale_{m}"), money(f"{level}_sale_yr_ago_{m}")).alias(f"{level}_sale_vs_yr_ago_{m}_pct")
            for m in ("val", "qty")]


def pos_placeholder_rows(spr_stores: DataFrame, frames: FrameSet, params: MartParams) -> DataFrame:
    """P24: '(All)' and '(Event Categories)' rows per store row and frame, measures NULL."""
    base = frames.with_each(spr_stores.select("hier_type_cd", "sold_to_nbr", "chain_nbr", "src_nm"))
    base = base.withColumn("ic_catg_nm", F.explode(F.array(F.lit(CATG_ALL), F.lit(CATG_EVENT))))
    return base.select(
        F.lit("mstr").alias("agg_type"), "hier_type_cd", F.lit(params.own_corp).alias("corp_nm"),
        "sold_to_nbr", "chain_nbr", "ic_catg_nm", typed_null("string").alias("brand_nm"),
        "tmfrm_cd", "pd_end_yr_wk",
        *[typed_null("double").alias(c) for c in MEASURES + METRIC_COLUMNS], "src_nm",
    )


RANK_KEYS = ["hier_type_cd", "sold_to_nbr", "chain_nbr", "corp_nm", "tmfrm_cd", "pd_end_yr_wk"]


def pos_chain_rank(level: DataFrame, sparse: DataFrame, totals: dict[str, DataFrame], params: MartParams) -> DataFrame:
    """P25: rank of each store's growth within its chain (NULL growth ranks first).

    Ranked on one row per store, chain, corporation and frame, made from the
    store level and the sparse competitor rows; ``rank_within`` never ranks a
    whole chain in one task.
    """
    own = level.filter("_has_rows").select(*RANK_KEYS, *[f"store_{m}" for m in MEASURES])
    others = sparse.filter(F.col("corp_nm") != params.own_corp).select(*RANK_KEYS).distinct().join(totals["store"], STORE_KEYS, "left")
    per_store = own.unionByName(others.select(*own.columns)).distinct().select(*RANK_KEYS, *_growths("store"))
    per_store = materialize(per_store, params)
    groups = CHAIN_KEYS
    ranked = rank_within(per_store, groups, F.col("store_sale_vs_yr_ago_val_pct"), "chain_store_sale_val_rank",
                         descending=True, nulls_first=True)
    ranked = rank_within(ranked, groups, F.col("store_sale_vs_yr_ago_qty_pct"), "chain_store_sale_qty_rank",
                         descending=True, nulls_first=True)
    return materialize(ranked.select(*RANK_KEYS, "chain_store_sale_val_rank", "chain_store_sale_qty_rank"), params)


def chain_store_count(spr_stores: DataFrame) -> DataFrame:
    """Distinct stores per hierarchy type and chain."""
    return spr_stores.groupBy("hier_type_cd", "chain_nbr").agg(
        F.countDistinct("sold_to_nbr").cast("bigint").alias("chain_store_cnt"))


def pos_summary_rows(metrics: DataFrame, placeholders: DataFrame, ranks: DataFrame, spr_stores: DataFrame,
                     attrs: DataFrame | None = None) -> DataFrame:
    """Fact rows (ranks attached) and placeholder rows with ranks and counts (``pos_tmfrm_sumry_final``).

    With ``attrs``, as in ``pos_share_growth``, every row has its store's attributes.
    """
    p = placeholders.select(*CALC_COLUMNS).join(ranks, RANK_KEYS, "left").join(
        chain_store_count(spr_stores), ["hier_type_cd", "chain_nbr"], "left")
    extra = list(RANK_COLUMNS)
    if attrs is not None:
        p, extra = with_store_struct(p, attrs), [*extra, STORE_STRUCT]
    return metrics.select(*CALC_COLUMNS, *extra).unionByName(p.select(*CALC_COLUMNS, *extra))


def pos_category_totals(sparse: DataFrame, products: DataFrame) -> DataFrame:
    """The POS family's category totals without its zero rows: the rows that have POS, and every
    category of the grid and of the placeholder rows at zero."""
    held = category_totals(sparse.select(F.col("ic_catg_nm").alias("catg_nm"), money("sale_val").alias("sale_val")))
    named = products.select(F.col("ic_catg_nm").alias("catg_nm")).distinct()
    for label in (CATG_ALL, CATG_EVENT):
        named = named.unionByName(products.limit(1).select(F.lit(label).alias("catg_nm")))
    return held.unionByName(zero_totals(named))


def pos_summary_emit(final: DataFrame) -> DataFrame:
    """Time-frame POS rows of the mart."""
    return final.select(
        "hier_type_cd", F.lit("POS").alias("metrc_nm"), typed_null("string").alias("sub_metrc_nm"),
        "tmfrm_cd", _frame_desc().alias("tmfrm_desc"), "corp_nm", "sold_to_nbr", "chain_nbr",
        F.col("ic_catg_nm").alias("catg_nm"), "brand_nm", *[money(m).alias(m) for m in MEASURES],
        "sale_val_share_pct", "sale_yr_ago_val_share_pct",
        *[money(f"store_{m}").alias(f"store_{m}") for m in MEASURES],
        "store_sale_vs_yr_ago_val_pct", "store_sale_vs_yr_ago_qty_pct",
        *[money(f"chain_{m}").alias(f"chain_{m}") for m in MEASURES], "chain_sale_vs_yr_ago_val_pct",
        "chain_sale_vs_yr_ago_qty_pct", "chain_store_sale_val_rank", "chain_store_sale_qty_rank",
        "chain_store_cnt", "src_nm", *[c for c in final.columns if c == STORE_STRUCT],
    )


def pos_weekly_rows(spr_stores: DataFrame, products: DataFrame, weekly: FrameSet,
                    pos_ic: DataFrame, params: MartParams) -> DataFrame:
    """Own weekly POS on the store x product grid (repeats when several categories
    share an IC category and brand, as the grid is not de-duplicated there).

    The left join to the grid followed by ``corp = own`` is an inner join, so the
    grid is never materialised: POS rows join the store rows and the product rows.
    """
    own_weekly = pos_ic.filter(
        F.col("tmfrm_cd").isin(*weekly.codes()) & (F.col("corp_nm") == params.own_corp)
    ).select("sold_to_nbr", "ic_catg_nm", "brand_nm", "tmfrm_cd", "pd_end_yr_wk", "corp_nm", *MEASURES)
    store_rows = spr_stores.select(
        "sold_to_nbr", "sold_to_nm", "tdlinx_nbr", "plan_to_nbr", "plan_to_nm", "chain_nbr",
        "hier_type_cd", "src_nm").distinct()
    j = own_weekly.join(store_rows, "sold_to_nbr").join(
        products.select("catg_nm", "ic_catg_nm", "brand_nm"), ["ic_catg_nm", "brand_nm"])
    wk = F.col("pd_end_yr_wk")
    sub = None
    for k, v in WEEKLY_LABELS.items():
        sub = F.when(F.col("tmfrm_cd") == k, F.lit(v)) if sub is None else sub.when(F.col("tmfrm_cd") == k, F.lit(v))
    return j.select(
        "hier_type_cd", F.lit("POS").alias("metrc_nm"), sub.alias("sub_metrc_nm"),
        F.substring(wk, 1, 4).cast("int").alias("fisc_yr"),
        F.expr("right(pd_end_yr_wk, 2)").cast("int").cast("string").alias("tmfrm_cd"),
        F.date_format(weekly.start_date_of("tmfrm_cd", "pd_end_yr_wk"), "MMM dd, yyyy").alias("tmfrm_desc"),
        "corp_nm", "sold_to_nbr", "chain_nbr", F.col("ic_catg_nm").alias("catg_nm"), "brand_nm",
        *[money(m).alias(m) for m in MEASURES], "src_nm",
    )


def category_share(pos_plain: DataFrame, spr_stores: DataFrame, frames: FrameSet,
                   params: MartParams) -> DataFrame:
    """Own vs competitor share per covered store, category and frame.

    Only stores and categories that have competitor data take part; the share
    is NULL (not 0) when the category total is 0 or NULL.
    """
    comp = pos_plain.filter(F.col("corp_nm") != params.own_corp)
    covered = spr_stores.filter(F.col("hier_type_cd") == HIER_COVERED).select("sold_to_nbr")
    base = (
        pos_plain.filter(F.col("tmfrm_cd").isin(*FRAME_DESCRIPTIONS.keys()))
        .join(comp.select("sold_to_nbr").distinct(), "sold_to_nbr", "left_semi")
        .join(comp.select("catg_nm").distinct(), "catg_nm", "left_semi")
        .join(covered, "sold_to_nbr")
    )
    agg = base.groupBy("tmfrm_cd", "sold_to_nbr", "catg_nm", "corp_nm").agg(
        F.sum("sale_val").alias("sale_val"), F.sum("sale_yr_ago_val").alias("sale_yr_ago_val"),
        F.array_max(F.collect_set("src_nm")).alias("src_nm"),
    )
    w = Window.partitionBy("sold_to_nbr", "catg_nm", "tmfrm_cd")
    out = agg.select(
        "*", F.sum("sale_val").over(w).alias("total_catg_sale_val"),
        F.sum("sale_yr_ago_val").over(w).alias("total_catg_sale_yr_ago_val"),
    )
    return out.select(
        "tmfrm_cd", "sold_to_nbr", "catg_nm", "corp_nm", money("sale_val").alias("sale_val"),
        money("sale_yr_ago_val").alias("sale_yr_ago_val"), "src_nm",
        money("total_catg_sale_val").alias("total_catg_sale_val"),
        money("total_catg_sale_yr_ago_val").alias("total_catg_sale_yr_ago_val"),
        share_or_null(money("sale_val"), money("total_catg_sale_val")).alias("sale_val_share_pct"),
        share_or_null(money("sale_yr_ago_val"), money("total_catg_sale_yr_ago_val")).alias("sale_yr_ago_val_share_pct"),
    )


def category_share_emit(shares: DataFrame) -> DataFrame:
    return shares.select(
        F.lit(HIER_COVERED).alias("hier_type_cd"), F.lit("POS_CATG_AMPS").alias("metrc_nm"),
        "tmfrm_cd", _frame_desc().alias("tmfrm_desc"), "corp_nm", "sold_to_nbr", "catg_nm",
        "sale_val", "sale_yr_ago_val", "sale_val_share_pct", "sale_yr_ago_val_share_pct", "src_nm",
    )
