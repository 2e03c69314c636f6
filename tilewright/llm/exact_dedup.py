"""Exact dedup by progressive refinement: length and prefix hash first, full hash only for groups that survive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KeyFilter, one_of_each, text_of, with_group


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 256, filter_bits: int = 1 << 28, salts: int = 64, digest_all: bool = False) -> DataFrame:
    """One row for each row of docs: the id, keep_id, group_size, kept and digest (SHA-256, binary).

    First pass: rows are counted by (length, hash of the first prefix_chars characters), one aggregate with map-side
    combine over two numbers a row. Groups of two or more survive; their keys go into a bitmap (16 bits each, filter_bits
    at most), which is broadcast. Second pass: only rows that the bitmap lets through are hashed in full, and
    grouped by that hash; text is never shuffled. A false positive of the bitmap costs one hash and changes no result.
    A group's rows are dealt over `salts` tasks, so a group with a third of all rows is no hot spot.

    digest_all also fills the digest of rows whose group did not survive (else null), for callers that report it.
    Null text counts as empty; equal means equal code points; long texts are hashed whole, where they are read. The row with the largest id stays. A null id is below
    every other; a group with null ids alone keeps all its rows, and so does one in which the same id and text repeat
    (these rows are one document). An empty table gives an empty result. Other columns are not read."""
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    coarse = F.struct(F.length("_text").alias("n"), F.xxhash64(F.substring("_text", 1, prefix_chars)).alias("h"))
    survivors = rows.groupBy(coarse.alias("k")).count().filter("count > 1")
    marked = KeyFilter(survivors, F.col("k"), filter_bits).mark(rows.withColumn("_k", coarse), F.col("_k"), "_survives")
    digest = F.unhex(F.sha2(F.col("_text").cast("binary"), 256))
    narrow = marked.select(
        "_id",
        (digest if digest_all else F.when(F.col("_survives"), digest)).alias("digest"),
        # a row that stands alone gets a key that no group has (longer than a digest), so that outer joins don't gather nulls in one task
        F.when(F.col("_survives"), digest).otherwise(F.concat(F.lit("-" * 33), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary")).alias("_key"),
    )
    grouped = with_group(
        narrow, "_key", "_id", {"_keep": (F.max("_id"), F.max("_keep")), "_size": (F.count("*"), F.sum("_size"))}, salts,
        where=(F.col("_size") > 1) & (F.octet_length("_key") == 32),
    )
    single = F.col("_size").isNull()
    keep = F.when(single, F.col("_id")).otherwise(F.col("_keep"))
    return grouped.select(
        F.col("_id").alias(id_col), keep.alias("keep_id"), F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"), "digest",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with one row of each text, one with the largest id; all columns stay as they are.

    Rows with the same id and text are copies too: of these, and of rows with null ids alone, one stays, chosen by a hash of
    its columns (see one_of_each). Null text counts as empty, as in exact_dedup. Texts are read where they lie, however long;
    only rows that may go are shuffled. An empty table stays empty."""
    key = lambda i, digest: F.struct(F.col(i).alias("id"), digest.alias("digest"))
    out = exact_dedup(docs, id_col, text_col, **options).filter("group_size > 1")
    found = out.groupBy(key(id_col, F.col("digest")).alias("key"), "kept").agg(F.count("*").alias("n"))
    return one_of_each(docs, key(id_col, F.unhex(F.sha2(text_of(text_col).cast("binary"), 256))), found)


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    found = exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest_all=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP1_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, CAST(count(*) OVER (PARTITION BY h) AS BIGINT) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
"""
