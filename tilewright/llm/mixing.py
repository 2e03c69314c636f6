"""Mixing sources to target weights: histograms of token sums over hash buckets, refined at the boundary only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.steps import cut, in_order
from .common import count_words, join_dimension, packed, text_of

HASH_BITS = 60


def unit_hash(col: str, seed: int = 0) -> Column:
    """60 bits of the MD5 of id and seed, as long: every SQL engine can repeat it."""
    key = F.concat(F.coalesce(F.col(col).cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """sources (source, source_size) with target: shares of the total by weight, cut at most times the source's size.

    Sources by code point, null last, get the weights in turn. What the cut leaves is shared again by weight: sources are
    sorted by the level at which they fill up, and running sums tell which of them do. Both orders are kept by ranges of
    sources (see in_order), so no task holds all of them; two rows of totals come to the driver."""
    named = in_order(sources, F.col("source").isNull(), "source")
    at = (F.col("place") % len(weights) + 1).cast("int")
    listed = named.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), at).cast("long")).drop("place").withColumn("_fills", F.col("source_size") * most / F.col("w"))
    run = in_order(listed, "_fills", F.col("source").isNull(), "source", sums={"_size": "source_size", "_w": "w"})
    total, w_total = (x or 0 for x in listed.agg(F.sum("source_size"), F.sum("w")).first())
    level = run.withColumn("left", F.lit(total).cast("long") - most * F.col("_size")).withColumn("w_left", F.lit(w_total).cast("long") - F.col("_w"))
    level = cut(level.withColumn("full", most * F.col("source_size") * F.col("w_left") <= F.col("left") * F.col("w")))
    left, w_left = level.filter("not full").agg(F.max("left"), F.max("w_left")).first()  # both nulls if all are full
    share = (F.lit(left).cast("long") * F.col("w")).cast("double") / F.lit(w_left).cast("double")
    return level.select("source", "source_size", F.when(F.col("full"), (most * F.col("source_size")).cast("double")).otherwise(share).alias("target"))


def source_key(source: Column) -> Column:
    """A source as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("null"))


def sized(docs: DataFrame, seed: int, id_col: str, size: Column | None, source_col: str) -> DataFrame:
    """id, source, size, hash and source key of each row, written once: all that the thresholds are found from."""
    size = count_words(text_of("text")) if size is None else size
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.cast("long").alias("size"), unit_hash(id_col, seed).alias("h"))
    return cut(rows.withColumn("skey", source_key(F.col("source"))))


def thresholds(rows: DataFrame, weights: tuple[int, ...], most: int, bits: int) -> DataFrame:
    """(skey, source_size, target, passes, limit), a row a source, from what sized() gives: each document is taken
    passes times, and once more if its hash is below limit."""
    plan = cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most).withColumn("skey", source_key(F.col("source"))))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = plan.withColumn("passes", passes).withColumn("budget", F.col("target") - F.col("passes") * F.col("source_size"))
    # edge: the first hash of the boundary bucket, width: its hashes, below: what lies before it
    edge = plan.select("skey", "budget", F.lit(0).cast("long").alias("edge"), F.lit(1 << HASH_BITS).alias("width"), F.lit(0).cast("long").alias("below"))
    open_ = edge
    done: list[DataFrame] = []
    for level in range(HASH_BITS // bits):
        shift = HASH_BITS - bits * (level + 1)
        inside = join_dimension(rows.filter("size > 0"), open_, "skey", "id").filter((F.col("h") >= F.col("edge")) & (F.col("h") < F.col("edge") + F.col("width")))
        sums = inside.groupBy("skey", "budget", "below", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("n"), F.count("*").alias("rows"))
        run = Window.partitionBy("skey").orderBy("bucket")
        after = F.col("below") + F.sum("n").over(run)
        at = (
            sums.withColumn("after", after).filter(F.col("after") > F.col("budget"))
            .groupBy("skey").agg(F.min_by(F.struct("bucket", "budget", "n", "rows", "after"), "bucket").alias("b")).select("skey", "b.*")
        )
        at = cut(at.select("skey", "budget", F.shiftleft("bucket", shift).alias("edge"), F.lit(1 << shift).alias("width"), (F.col("after") - F.col("n")).alias("below"), "n", "rows"))
        last = F.col("rows") == 1 if level < HASH_BITS // bits - 1 else F.lit(True)
        done.append(at.filter(last))
        open_ = at.filter(~last).drop("n", "rows")
        if open_.isEmpty():
            break
    found = done[0]
    for x in done[1:]:
        found = found.unionByName(x)
    # all hashes below the limit are taken once more; the boundary bucket, one document or one hash, too if that is nearer
    nearer = F.col("below") + F.col("n") - F.col("budget") < F.col("budget") - F.col("below")
    limits = found.select("skey", F.when(nearer, F.col("edge") + F.col("width")).otherwise(F.col("edge")).alias("limit"))
    return cut(plan.join(limits, "skey", "left").select("skey", "source_size", "target", "passes", F.coalesce("limit", F.lit(0)).alias("limit")))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 0, bits: int = 10, id_col: str = "doc_id", size: Column | None = None, source_col: str = "source") -> DataFrame:
    """One row for each row of docs: the id, source, size, source_size, target, copies and taken = size * copies.

    A source's target is whole passes over it plus a part of one. The part is the documents whose hash lies below the
    source's threshold. To find it, sizes are summed by source and the next `bits` bits of the hash; the bucket in which
    the running sum passes the budget is split again by the next bits, other buckets are done with. Nothing is sorted
    but the bucket sums (1024 a source). The document at the boundary is taken if that brings the sum nearer.

    Sizes are computed once and checkpointed; each level reads three numbers a row. The hash hangs on the id alone, so
    reruns agree, and rows with one id share their fate. Null text has size 0; a null source is a source, the last;
    null ids share one hash; a long text is counted whole; an empty table gives an empty result. Sources and their buckets
    are broadcast only while they are few, else joined with salt."""
    rows = sized(docs, seed, id_col, size, source_col)
    copies = F.col("passes") + F.when(F.col("h") < F.col("limit"), 1).otherwise(0)
    return join_dimension(rows, thresholds(rows, weights, most, bits), "skey", "id").select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", copies.cast("long").alias("copies"), (F.col("size") * copies).cast("long").alias("taken")
    )


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 0, bits: int = 10, id_col: str = "doc_id", size: Column | None = None, source_col: str = "source") -> DataFrame:
    """docs as mixed: each row as often as mix takes it, none at all included; the columns stay as they are.

    A row's own id and source tell how often it is taken, so texts are only filtered and repeated where they are read;
    they meet no more than a row a source. Nulls and repeated ids fare as in mix; an empty table stays empty."""
    limits = thresholds(sized(docs, seed, id_col, size, source_col), weights, most, bits).select("skey", "passes", "limit")
    keyed = packed(docs, id=F.col(id_col), skey=source_key(F.col(source_col)), h=unit_hash(id_col, seed))
    copies = F.col("passes") + F.when(F.col("h") < F.col("limit"), 1).otherwise(0)
    taken = join_dimension(keyed, limits, "skey", "id").withColumn("copies", copies.cast("int")).filter("copies > 0")
    return taken.withColumn("nth", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(concat('0x', substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), 'null'), ':0')), 1, 15)) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
l AS (
  SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER p, 0) AS lft, sum(w) OVER () - coalesce(sum(w) OVER p, 0) AS w_left
  FROM w WINDOW p AS (ORDER BY source_size * 3 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, 3 * source_size * w_left <= lft * w AS full_ FROM l),
t AS (
  SELECT source, source_size, CASE WHEN full_ THEN CAST(3 * source_size AS DOUBLE)
         ELSE CAST((max(CASE WHEN NOT full_ THEN lft END) OVER ()) * w AS DOUBLE) / CAST(max(CASE WHEN NOT full_ THEN w_left END) OVER () AS DOUBLE) END AS target
  FROM f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
b AS (SELECT *, target - passes * source_size AS budget FROM p),
r AS (
  SELECT d.doc_id, d.size, d.h, b.*, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS own
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (passes + CASE WHEN upto <= budget OR upto - budget < budget - (upto - own) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
