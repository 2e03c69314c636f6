"""Columns of any name, and string ids of any length, for operators that return their input's rows."""

import pytest
from pyspark.sql import functions as F

from tilewright.llm import exact_dedup, mixing, near_dup, pipeline, quality, url_filter

CLASHING = ("_key", "_may", "_row", "_salt", "_salts", "_slot", "_bucket", "_bitmap", "_passes", "_n", "_h", "_skey", "_limit", "_copies", "_host", "_verdict", "_bad", "_id", "_text", "_survives", "_keep", "_size", "row", "key", "may", "kept", "n", "nth", "copies", "verdict", "host", "passes", "limit", "digest", "a.b", "id", "text_hash", "size")


@pytest.fixture(scope="module")
def clashing(spark):
    """Documents with a column of each name that an operator uses itself, each with a value of its own."""
    texts = ["one two three four five six seven eight"] * 3 + [f"w{i} some other text of its own, {i} and {i * i}" for i in range(20)] + [None, "", ""]
    rows = [(i, t, "s" if i % 3 else None, "en", *(f"{c}{i}" for c in CLASHING)) for i, t in enumerate(texts)]
    names = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, lang string, {names}").cache()


def same_rows(out, docs):
    """Each row of out is one of docs, as it was."""
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = [tuple(r) for r in out.collect()]
    assert set(rows) <= {tuple(r) for r in docs.collect()}
    return rows


def test_rows_stay_as_they_are(spark, clashing, labels):
    assert len(same_rows(exact_dedup.drop_copies(clashing), clashing)) == 22
    assert len(same_rows(near_dup.drop_near_duplicates(clashing), clashing)) == 24
    assert same_rows(mixing.apply_mix(clashing), clashing)
    assert len(same_rows(quality.keep_good(clashing, labels.limit(0)), clashing)) == 26
    pages = clashing.withColumn("url", F.concat(F.lit("http://a.org/"), F.col("doc_id"))).withColumn("html", F.lit(""))
    assert len(same_rows(url_filter.keep_allowed(pages), pages)) == 26


def test_stages_keep_columns(spark, clashing, tmp_path, labels):
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    docs = clashing
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert same_rows(docs, clashing), name
    assert pipeline.packing(spark, docs, str(tmp_path)).count()


def test_string_ids_of_any_length(spark):
    """An id that is as long as a digest, or becomes so with a prefix, is no digest."""
    rows = [("x" * n, f"text {k} of {n}") for n in range(1, 41) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert {r["group_size"] for r in exact_dedup.exact_dedup(docs).collect()} == {1}
    assert exact_dedup.drop_copies(docs).count() == 80
    twice = exact_dedup.exact_dedup(docs.union(docs)).collect()
    assert {r["group_size"] for r in twice} == {2} and all(r["kept"] for r in twice)
