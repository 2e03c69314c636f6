"""Helpers that several operators share: checkpoints, bitmap filters and salted group joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.steps import cut

#: A word is a run of anything but these six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = "\t\n\x0b\x0c\r"


def text_of(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def words_of(text: Column) -> Column:
    """The words of a text as an array; blanks are mapped to one character first, for which split() needs no regular expression."""
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")


def host_of(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, with A-Z lower-cased; empty without ://."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def crc_mod(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % n


class KeyFilter:
    """A one-hash Bloom filter over keys, in native bitmaps: 16 bits a key, at most `most` bits.

    So its broadcast never exceeds most / 8 bytes, 32 MiB by default, whatever the number of keys. It lets no key of the
    set through as absent; a full filter only costs time, as more rows pass."""

    WIDTH = 32768  # bits in one of Spark's bitmaps

    def __init__(self, keys: DataFrame, key: Column, most: int = 1 << 28):
        hashes = cut(keys.select(F.xxhash64(key).alias("h")))
        self.bits = self.WIDTH * min(1 + hashes.count() // (self.WIDTH // 16), max(1, most // self.WIDTH))
        at = hashes.select((F.pmod("h", F.lit(self.bits)) + F.lit(1)).alias("slot"))  # bucket numbers start at slot 1
        self.maps = cut(
            at.groupBy(F.bitmap_bucket_number("slot").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_bitmap"))
        )

    def _slot(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.bits)) + F.lit(1)

    def mark(self, df: DataFrame, key: Column, flag: str) -> DataFrame:
        """df with a boolean column flag: the key may be in the set. No shuffle of df."""
        slot = self._slot(key)
        with_slot = df.withColumn("_slot", slot).withColumn("_bucket", F.bitmap_bucket_number(F.col("_slot")))
        joined = with_slot.join(F.broadcast(self.maps), "_bucket", "left")
        position = F.bitmap_bit_position(F.col("_slot"))
        byte = F.conv(F.hex(F.substring(F.col("_bitmap"), F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
        return joined.withColumn(flag, hit).drop("_slot", "_bucket", "_bitmap")


def salt_of(col: str | Column, salts: int) -> Column:
    return F.pmod(F.xxhash64(col, F.lit(17)), F.lit(salts)).cast("int")


def with_group(rows: DataFrame, key: str, salt_by: str, aggs: dict[str, tuple[Column, Column]], salts: int = 64, where: Column | None = None) -> DataFrame:
    """rows, each with the aggregates of its key's group, without bringing a group together in one task.

    aggs: name -> (aggregate of rows, aggregate of those partial results, which the name stands for).
    A key's rows are dealt to `salts` tasks; partial aggregates meet per key as at most `salts` rows.
    where: a condition on the aggregated groups; rows of other groups get nulls."""
    rows = rows.withColumn("_salt", salt_of(salt_by, salts))
    partial = rows.filter(F.col(key).isNotNull()).groupBy(key, "_salt").agg(*(a.alias(n) for n, (a, _) in aggs.items()))
    groups = partial.groupBy(key).agg(*(b.alias(n) for n, (_, b) in aggs.items()), F.collect_set("_salt").alias("_salts"))
    if where is not None:
        groups = groups.filter(where)
    spread = groups.withColumn("_salt", F.explode("_salts")).drop("_salts")
    return rows.join(spread, [key, "_salt"], "left").drop("_salt")


def attach(rows: DataFrame, table: DataFrame, key: str, salt_by: str, salts: int = 64) -> DataFrame:
    """rows left-joined to a table of unique keys of which any may be hot: a key's rows are dealt to `salts` tasks, and
    the table's row is copied to those of them that have some."""
    rows = rows.withColumn("_salt", salt_of(salt_by, salts))
    spread = rows.select(key, "_salt").distinct().join(table, key)
    return rows.join(spread, [key, "_salt"], "left").drop("_salt")


def join_dimension(rows: DataFrame, dimension: DataFrame, key: str, salt_by: str, most: int = 100_000, salts: int = 64, how: str = "inner") -> DataFrame:
    """Joins rows to a checked dimension: broadcast up to `most` rows, else a salted shuffle join (the dimension is copied `salts` times)."""
    if dimension.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(dimension), key, how)
    spread = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", salt_of(salt_by, salts)).join(spread, [key, "_salt"], how).drop("_salt")


def packed(docs: DataFrame, **beside: Column) -> DataFrame:
    """docs with each row in one column, row, and others beside it, so that no name of docs can clash with them."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(v.alias(k) for k, v in beside.items()))


def one_of_each(docs: DataFrame, key: Column, found: DataFrame) -> DataFrame:
    """docs without rows whose key is to go, and with one row of each key that repeats; columns stay as they are.

    found (key, kept, n): keys of the rows that go (kept false) and of those that stay but occur n > 1 times; other keys need
    not be listed. Only rows that a bitmap of the listed keys lets through are shuffled, and these are collapsed by key where
    they are read, so no key is hot. Of rows with one key the one with the least hash of its columns stays."""
    listed = cut(found.filter("not kept or n > 1").select("key", "kept").distinct())
    marked = KeyFilter(listed, F.col("key")).mark(packed(docs, key=key), F.col("key"), "may")
    hashed = [F.col("row").getField(c) for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    some = marked.filter("may").groupBy("key").agg(F.min_by("row", F.xxhash64(*hashed)).alias("row"))
    stay = some.join(listed.filter("not kept").select("key"), "key", "left_anti").select("row.*")
    return marked.filter("not may").select("row.*").unionByName(stay)
