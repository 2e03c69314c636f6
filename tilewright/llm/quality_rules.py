"""Quality rules whose cutoffs come from labelled holdouts, with exact binomial bounds on false rejection."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.steps import cut
from .common import BLANKS, join_dimension, text_of

#: feature -> (what is counted, what it is counted per); its value is the count a thousand, rounded down
FEATURES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),  # words in repeated windows
    "shouting": ("n_upper", "word_chars"),  # A-Z
    "long_words": ("word_chars", "n_words"),
}
QUANTILES = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95)  # of the bad documents' values: the cutoffs to test


def let(value: Column, then) -> Column:
    """then(value) with value computed once a row: as the variable of a lambda over an array of one."""
    return F.element_at(F.transform(F.array(value), then), 1)


def repeated_words(words: Column) -> Column:
    """How many words lie in windows of eight words that occur twice or more in the text, the first occurrence included.

    Windows are compared by 64-bit hashes. Only texts with a repeat at all sort theirs: (hash, place) pairs whose
    neighbour has the same hash give the places, and the gaps between sorted places how many words they cover."""

    def windows(h: Column) -> Column:  # hashes of two words, of four, of eight
        joined = lambda a, k: F.transform(a, lambda x, i: F.xxhash64(x, F.get(a, i + k)))
        return F.slice(let(joined(h, 1), lambda b: let(joined(b, 2), lambda c: joined(c, 4))), 1, F.size(h) - 7)

    def places(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda s, i, j: F.get(s, j)["h"] == F.get(s, i)["h"]
        hits = let(pairs, lambda s: F.filter(F.transform(s, lambda x, i: F.when(same(s, i, i - 1) | same(s, i, i + 1), x["i"])), lambda p: p.isNotNull()))
        return let(F.sort_array(hits), lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(8), F.coalesce(F.get(p, i + 1) - x, F.lit(8)))), F.lit(0).cast("long"), lambda a, b: a + b))

    counted = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(windows(h), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(places(w))))
    return F.when(F.size(words) <= 8, F.lit(0).cast("long")).otherwise(counted)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """id, stratum and the counts the rules are made of. One scan, no shuffle; texts stay in their task."""
    text = F.col("_t")
    base = docs.select(F.col(id_col).alias("id"), F.col(stratum_col).cast("string").alias("stratum"), text_of(text_col).alias("_t"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^ {BLANKS}]"))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    split = base.select(
        "id", "stratum", F.array_remove(F.split(text, f"[ {BLANKS}]+"), "").alias("_w"), count("[#*$%&|<>]").alias("n_symbols"), count("[A-Z]").alias("n_upper"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("_l"),
    )
    return split.select(
        "id", "stratum", F.size("_w").cast("long").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"), "n_symbols", "n_upper", F.col("_l.dup").alias("n_dup_lines"),
        repeated_words(F.col("_w")).alias("n_repeat_words"), F.col("_l.n").alias("n_lines"),
    ).withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def values() -> dict[str, Column]:
    """Each feature's value, a whole number."""
    return {name: F.when(F.col(per) > 0, F.floor(1000 * F.col(n) / F.col(per))).otherwise(0).cast("long") for name, (n, per) in FEATURES.items()}


def cutoffs_to_test(bad: DataFrame) -> dict[str, list[int]]:
    """Of each feature its quantiles among the bad documents, a few numbers: they say where a cutoff would catch many, and
    tell nothing about the good ones on which it is tested. Without bad documents there is none."""
    quantile = lambda v, q: F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {v})")
    row = bad.select(*(v.alias(name) for name, v in values().items())).agg(*(F.array(*(quantile(name, q) for q in QUANTILES)).alias(name) for name in FEATURES)).first()
    return {name: sorted({x for x in row[name] if x is not None}) for name in FEATURES}


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), exactly: terms are added as logarithms, each from the one before.

    Only k < n * p is summed; from there on the tail is over any level used here and 1 is returned."""
    odds = F.lit(math.log(p / (1 - p)))
    start = F.struct((n * F.lit(math.log1p(-p))).cast("double").alias("t"), (n * F.lit(math.log1p(-p))).cast("double").alias("sum"))

    def add(s: Column, i: Column) -> Column:
        t = s["t"] + F.log((n - i + 1).cast("double") / i.cast("double")) + odds
        return F.struct(t.alias("t"), (F.greatest(t, s["sum"]) + F.log1p(F.exp(-F.abs(t - s["sum"])))).alias("sum"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(F.aggregate(terms, start, add)["sum"]))


def cutoffs(labelled: DataFrame, grid: dict[str, list[int]], alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """(stratum, rule, cutoff): the boldest cutoff of each rule and stratum whose false rejection is provably small.

    labelled: features of the good documents (label 1); grid: the cutoffs to test, none of them chosen by these documents. A
    cutoff passes if the number k of n good documents above it has P(Binomial(n, alpha / rules) <= k) <= delta / (groups *
    rules), that is, if the exact (Clopper-Pearson) upper bound on its false rejection is alpha / rules at that level. The
    cutoffs of a rule are tested in a fixed sequence, the mildest first, and the first that fails ends it, so all of them
    share one level; as a bolder cutoff never rejects fewer, the last one to pass is simply the least that does.
    A group is a stratum, or all strata together whose labels are too few to pass a cutoff even without any false
    rejection; the number of labels alone decides which. So with probability 1 - delta every group loses at most alpha of
    its good documents to all rules; within the pooled group that holds for its labelled strata as a whole, not for each.
    Counts are aggregated map-side: one row a stratum, rule and cutoff. Strata without labels get no cutoff, and none do
    where even the pool is too small."""
    found, bound = values(), alpha / len(FEATURES)
    each = [F.struct(F.lit(name).alias("rule"), F.lit(c).cast("long").alias("cutoff"), (found[name] > c).alias("hit")) for name, cs in grid.items() for c in cs]
    if not each:
        return labelled.select("stratum", F.lit("").alias("rule"), F.lit(0).cast("long").alias("cutoff")).limit(0)
    counts = cut(labelled.select("stratum", F.explode(F.array(*each)).alias("e")).groupBy("stratum", "e.rule", "e.cutoff").agg(F.count("*").alias("n"), F.sum(F.col("e.hit").cast("long")).alias("k")))
    level = lambda groups: delta / len(FEATURES) / max(groups, 1)
    strata = counts.groupBy("stratum").agg(F.max("n").alias("labels"))
    few = F.col("labels") * math.log1p(-bound) > math.log(level(strata.count()))
    grouped = cut(strata.select("stratum", F.when(few, F.lit("few")).otherwise(F.concat(F.lit("s"), F.coalesce("stratum", F.lit("")))).alias("group")))
    pooled = counts.join(grouped, "stratum").groupBy("group", "rule", "cutoff").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    passed = pooled.filter(binomial_tail(F.col("k"), F.col("n"), bound) <= level(grouped.select("group").distinct().count())).join(grouped, "group")
    return passed.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def apply_rules(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05, id_col: str = "doc_id", label_col: str = "quality", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """One row a document: id, counts, base_failed, kept and the first rule that rejected it (null: none).

    All labelled rows that pass the base rules are used, as no cutoff decides on the others: the bad ones tell which cutoffs
    to test, the good ones, to which nothing is fitted, are the holdout they are tested on. Strata: stratum_col, null being
    one. Null text has no words and fails the base rules; long texts are read whole. A label that repeats counts once; ids
    that repeat are judged each by their text. An empty table gives an empty result. Other columns are not read."""
    f = cut(features(docs, id_col, text_col, stratum_col).withColumn("skey", F.coalesce(F.concat(F.lit("s"), "stratum"), F.lit("null"))))
    with_label = lambda y: f.filter(~F.col("base_failed")).join(labels.filter(F.col(label_col) == y).select(F.col(id_col).alias("id")).distinct(), "id", "left_semi").withColumn("stratum", F.col("skey"))
    chosen = cut(cutoffs(with_label(1), cutoffs_to_test(with_label(0)), alpha, delta))
    wide = cut(chosen.groupBy(F.col("stratum").alias("skey")).agg(*(F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"max_{r}") for r in FEATURES)))
    reason = F.coalesce(*(F.when(v > F.col(f"max_{r}"), F.lit(r)) for r, v in values().items()))
    judged = join_dimension(f, wide, "skey", "id", how="left").withColumn("reason", reason)
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("reason").isNull()).alias("kept"), "reason",
    )


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return apply_rules(docs, labels).drop("reason")


def oracle(alpha: float = 0.02, delta: float = 0.05) -> str:
    """The same in DuckDB SQL; the binomial tail is a sum of its terms by log-gamma."""
    bound, rules = alpha / len(FEATURES), len(FEATURES)
    value = {name: f"CAST(CASE WHEN {per} > 0 THEN floor(1000 * {n} / {per}) ELSE 0 END AS BIGINT)" for name, (n, per) in FEATURES.items()}
    long_form = lambda source: " UNION ALL ".join(f"SELECT skey, '{name}' AS rule, {v} AS v FROM {source}" for name, v in value.items())
    tail = f"list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * {math.log(bound)} + (n - i) * {math.log1p(-bound)})))"
    rejected = " OR ".join(f"v.{name} > m.{name}" for name in FEATURES)
    return rf"""
WITH d AS (SELECT doc_id, coalesce('s' || lang, 'null') AS skey, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
w AS MATERIALIZED (SELECT doc_id, skey, rid, t, regexp_extract_all(t, '[^ 	-
]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS l FROM d),
win AS (SELECT rid, i, w[i : i + 7] AS x FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) > 7)),
rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, x) > 1),
hit AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS j FROM rep) GROUP BY rid),
f AS MATERIALIZED (
  SELECT doc_id, skey, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(l) - list_unique(l) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(regexp_extract_all(t, '[A-Z]')) AS n_upper, len(l) AS n_lines,
    len(w) < 20 OR 100 * coalesce(n, 0) > 30 * len(w) AS base_failed
  FROM w LEFT JOIN hit USING (rid)),
bad AS (SELECT * FROM f WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)),
good AS (SELECT * FROM f WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
b AS (SELECT rule, list_sort(list(v)) AS vs FROM ({long_form("bad")}) GROUP BY rule),
grid AS (SELECT DISTINCT rule, vs[greatest(1, CAST(ceil(CAST(len(vs) * q AS DECIMAL(20, 6))) AS INT))] AS cutoff FROM b, (SELECT unnest({list(QUANTILES)}) AS q)),
g AS (SELECT * FROM ({long_form("good")})),
k AS (SELECT skey, rule, cutoff, count(*) AS n, CAST(sum(CASE WHEN v > cutoff THEN 1 ELSE 0 END) AS BIGINT) AS k FROM g JOIN grid USING (rule) GROUP BY 1, 2, 3),
s AS (SELECT skey, max(n) AS labels, count(*) OVER () AS strata FROM k GROUP BY skey),
p AS (SELECT skey, CASE WHEN labels * {math.log1p(-bound)} > ln({delta / rules} / strata) THEN 'few' ELSE skey END AS grp FROM s),
pooled AS (SELECT grp, rule, cutoff, CAST(sum(n) AS BIGINT) AS n, CAST(sum(k) AS BIGINT) AS k FROM k JOIN p USING (skey) GROUP BY 1, 2, 3),
passed AS (SELECT grp, rule, min(cutoff) AS cutoff FROM pooled WHERE k < n * {bound} AND {tail} <= {delta / rules} / (SELECT count(DISTINCT grp) FROM p) GROUP BY 1, 2),
m AS (SELECT skey, {", ".join(f"max(CASE WHEN rule = '{name}' THEN cutoff END) AS {name}" for name in FEATURES)} FROM passed JOIN p USING (grp) GROUP BY skey),
v AS (SELECT *, {", ".join(f"{v} AS {name}" for name, v in value.items())} FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce({rejected}, false) AS kept FROM v LEFT JOIN m USING (skey)
"""


OP3_SQL = oracle()
