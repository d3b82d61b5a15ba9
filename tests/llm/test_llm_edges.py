"""Nulls in any column, empty and long texts, repeated rows, empty tables, clashing column names."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from shelfscope.llm import decontam, html_text, lines, lm, mixing, quality, simhash, substring, token_counts, topk  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, root string, words string, k_id int, size int, n int, taken string, fp string, component_id string"
LONG = "word " * 30_000 + "\n" + "x" * 50_000 + "\n" + "same line again and again here\n" * 200
ROWS = [
    (1, "a plain text of some words", "en", "a", 26), (1, "a plain text of some words", "en", "a", 26), (2, None, None, None, None), (None, "no id here at all", "en", None, 3),
    (None, None, None, None, None), (3, "", "en", "b", 0), (4, " \t\n\x0b ", "de", "b", 5), (5, LONG, "en", "a", len(LONG)), (6, LONG, "en", "a", len(LONG)),
    (1, "another text under a known id", "en", "c", 9), (7, "été naïve ÀÉ     x", None, "b", None), (8, "\n\n\n", "en", "b", 3),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, i, "r", "w", i, i, i, "t", "f", "c") for i, r in enumerate(ROWS)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def ratings(spark):
    return spark.createDataFrame([(1, 2), (5, 1), (None, 0), (6, 0), (999, 2), (7, None)], "doc_id long, grade int")


def bench(spark):
    return spark.createDataFrame([(1, "plain text of some words"), (None, "plain text of some words"), (2, None), (3, "")], "item_id long, text string")


PER_ROW = {
    "mix": lambda s, d: mixing.mix_plan(d),
    "lines": lambda s, d: lines.dedup_lines(d),
    "quality": lambda s, d: quality.score_documents(d, quality.fit(d, ratings(s))),
    "substring": lambda s, d: substring.dedup_substrings(d),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "lm": lambda s, d: lm.score(d, rounds=1),
}


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_one_row_each_for_odd_rows(spark, odd, name):
    got = PER_ROW[name](spark, odd).collect()
    assert len(got) == len(ROWS)
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_empty_documents(spark, none, name):
    assert PER_ROW[name](spark, none).collect() == []


def test_odd_rows_in_detail(spark, odd):
    mixed = {(r["doc_id"], r["size"]): r for r in mixing.mix_plan(odd).collect()}
    assert mixed[2, 0]["taken"] == 0 and mixed[3, 0]["taken"] == 0
    kept = lines.dedup_lines(odd)
    by_id = {r["doc_id"]: r for r in kept.where("doc_id > 2").collect()}
    assert kept.columns[:len(odd.columns)] == odd.columns
    assert by_id[5]["text"].count("same line") == 1 and by_id[6]["text"] == "" and by_id[8]["text"] == "\n\n\n"
    assert kept.where("doc_id = 2").first()["text"] is None
    scores = {r["doc_id"]: r for r in quality.score_documents(odd, quality.fit(odd, ratings(spark))).where("doc_id > 1").collect()}
    assert not scores[3]["kept"] and not scores[4]["kept"] and scores[4]["expected_grade"] == 0
    near = {r["doc_id"]: r for r in simhash.near_duplicates(odd).where("doc_id > 1").collect()}
    assert near[3]["fp"] == 0 and near[4]["component_id"] == near[3]["component_id"] == near[8]["component_id"] == 2
    assert near[6]["component_id"] == 5
    stay = simhash.representatives(odd)
    assert stay.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in stay.collect()) == sorted(["1", "1", "2", "5", "7", "None"])


def test_quality_without_ratings_keeps_all(spark, odd):
    empty = spark.createDataFrame([], "doc_id long, grade int")
    assert quality.filter_documents(odd, quality.fit(odd, empty)).count() == len(ROWS)


def test_decontamination_of_odd_rows(spark, odd, none):
    hits = sorted((r["doc_id"], str(r["item_id"])) for r in decontam.contaminated(odd, bench(spark)).collect())
    assert hits == [(1, "1"), (1, "1"), (1, "None"), (1, "None")]
    assert decontam.clean_documents(odd, bench(spark)).count() == len(ROWS) - 2
    assert decontam.clean_documents(odd, bench(spark).limit(0)).count() == len(ROWS)
    assert decontam.contaminated(none, bench(spark)).count() == 0


def test_pages_and_vectors(spark):
    pages = spark.createDataFrame([(1, None, None, 1), (None, "u", "<p>x", 2), (1, "u", "", 3), (1, "u", "", 3)], "page_id long, url string, html string, text int")
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in html_text.extract_pages(pages).collect()) == [("1", "", 0)] * 3 + [("None", "x", 1)]
    assert html_text.extract_pages(pages.limit(0)).collect() == []
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, score int")
    assert topk.top_k(vectors).collect() == []


def test_rollup_of_odd_rows(spark, odd, scratch):
    from pyspark.sql import functions as F

    store = token_counts.Rollup(spark, f"{scratch}/rollup-odd")
    assert store.apply("x", odd.withColumn("op", F.lit("insert")), token_counts.VERSIONS)
    assert sum(r["n_docs"] for r in store.totals().collect()) == 20  # eight ids and two rows without, by two versions


def test_stages_on_odd_and_empty_tables(spark, odd, none, scratch):
    folder = f"{scratch}/stages"
    spark.createDataFrame([(1, 1, 0), (5, 0, 0), (6, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    bench(spark).write.parquet(f"{folder}/benchmark.parquet")
    for docs in (odd, none):
        for name, function in corpus_pipeline.STAGES:
            out = function(spark, docs, folder)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
            out.collect()


def test_representatives_of_ids_with_several_texts(spark):
    rows = [(1, "alpha beta gamma delta epsilon zeta"), (1, "one two three four five six seven"), (2, "one two three four five six seven"),
            (None, "no id in this group at all"), (None, "no id in this group at all"), (None, None)]
    kept = simhash.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept) == sorted([
        ("1", rows[0][1]), ("1", rows[1][1]), ("None", rows[3][1]), ("None", "None")])
