import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tilewright.llm import queries
from tilewright.llm.exact_dedup import drop_copies, exact_dedup
from tilewright.llm.mixing import apply_mix, mix
from tilewright.llm.quality_rules import apply_rules, binomial_tail, cutoffs, features
from tilewright.llm.url_filter import judge_urls, keep_allowed

from .conftest import documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    got = queries.queries()[name](spark, SF).toPandas()
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda d: sorted(map(tuple, d[cols].astype(str).values.tolist()))
    assert key(got) == key(want)


def test_exact_dedup(spark, odd, none):
    got = exact_dedup(odd, digest_all=True).collect()
    assert len(got) == 12 and exact_dedup(none).isEmpty()
    texts = {(r.doc_id, r.text or "") for r in odd.collect()}
    by = defaultdict(list)
    for r in odd.collect():
        by[r.text or ""].append(r.doc_id)
    for r in got:
        text = next(t for i, t in texts if hashlib.sha256(t.encode()).digest() == bytes(r.digest))
        ids = [i for i in by[text] if i is not None]
        assert r.group_size == len(by[text]) and r.keep_id == max(ids) and r.kept == (r.doc_id == max(ids))
    kept = drop_copies(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6, 7, 8, 9]


def test_drop_copies_leaves_one_of_each_text(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c"), (None, "b"), (2, None), (2, ""), (3, "d")]
    assert sorted((r.doc_id or 0, r.text) for r in drop_copies(documents(spark, rows)).collect() if r.text) == [(0, "c"), (1, "a"), (1, "b"), (3, "d")]
    assert drop_copies(documents(spark, rows)).count() == 5


def test_a_group_with_most_rows_is_no_hot_spot(spark):
    docs = documents(spark, [(i % 3, "same") for i in range(3000)] + [(i, f"text {i}") for i in range(100)])
    assert drop_copies(docs).count() == 101 and {r.group_size for r in exact_dedup(docs).collect()} == {1, 3000}


def test_exact_dedup_with_a_tiny_filter(spark):
    rng = random.Random(0)
    rows = [(i, prose(rng, 3, 4)) for i in range(300)]
    got = {r.doc_id: r.keep_id for r in exact_dedup(documents(spark, rows), filter_bits=32768, prefix_chars=2, salts=3).collect()}
    best = {}
    for i, t in rows:
        best[t] = i
    assert got == {i: best[t] for i, t in rows}


PAGES = "page_id long, url string, html string, verdict string"


def test_urls(spark):
    rows = [(1, "http://A.Org", ""), (2, "http://a.org/", None), (3, None, None), (4, "nothing", ""), (5, "http://x.example.org/es/1?q", ""), (6, "http://notexample.org/es/1", ""), (7, "http://b.com/de/", '<a href="/x">'), (8, "http://b.com/zz", ""), (9, "http://c.com/q", '<a href="http://b.com/de/1">x</a>')]
    pages = spark.createDataFrame([(*r, "block") for r in rows], PAGES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages).collect()}
    assert got[1] == ("a.org", "", None, "allow") and got[2] == ("a.org", "/", "org/", "allow") and got[3] == got[4] == ("", "", None, "allow")
    assert got[5][2:] == ("example.org/es/", "block") and got[6][2:] == ("org/", "allow") and got[7][2:] == ("com/de/", "block") and got[8][3] == "block"
    assert got[9][3] == "block"  # it links to the blocked host: distrust runs back along the link
    assert judge_urls(pages.limit(0)).isEmpty() and keep_allowed(pages.limit(0)).isEmpty()
    kept = keep_allowed(pages.unionByName(pages))
    assert kept.columns == pages.columns and sorted(r.page_id for r in kept.collect()) == [1, 1, 2, 2, 3, 3, 4, 4, 6, 6]


LINKED = [
    (1, "http://bad.com/de/", ""), (2, "http://bad.com/zz", ""),
    (3, "http://one.net/", "<a href=http://bad.com/x>"), (4, "http://two.net/", "<A class=a\nHREF = 'HTTP://BAD.com'>"),
    (5, "http://far.net/", '<a href="//one.net/">'),  # two links away
    (6, "http://go.net/", '<a href="/go?u=http://bad.com/q"> <a data-href="http://bad.com/">'),  # redirects and other attributes are no links
    (7, "http://mixed.com/fr/", '<a href="http://bad.com/">'), (8, "http://mixed.com/zz", ""),  # trusted by a rule
    (9, "http://self.net/", '<a href="http://self.net/a"> <a href="http://nowhere.net/">'),
]


def test_distrust_runs_over_links_between_hosts(spark):
    pages = spark.createDataFrame([(*r, "x") for r in LINKED], PAGES)
    got = {r.page_id: r for r in judge_urls(pages).collect()}
    assert {i for i, r in got.items() if r.verdict == "block"} == {1, 2, 3, 4, 5}
    # bad.com is half blocked; three hosts link to it, each gets a third of what it passes on
    assert got[4].distrust == pytest.approx(0.85 * 0.5 / 3, abs=1e-6) and got[5].distrust == pytest.approx(0.85**2 * 0.5 / 3, abs=1e-6)
    con = duckdb.connect()
    con.sql("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", LINKED)
    assert sorted(con.sql(queries.oracle_sql()["op2_url_filter"]).fetchall()) == sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.values())


def test_distrust_of_a_popular_host_is_shared(spark):
    rows = [(0, "http://bad.com/de/", "")] + [(i, f"http://h{i}.net/", '<a href="http://bad.com/">') for i in range(1, 40)]
    got = {r.page_id: r for r in judge_urls(spark.createDataFrame([(*r, "x") for r in rows], PAGES)).collect()}
    assert got[0].verdict == "block" and got[1].distrust == pytest.approx(0.85 / 39, abs=1e-6) and got[1].verdict == "allow"


def brute_features(text):
    words = WORD.findall(text)
    n, hit = len(words), set()
    seen = defaultdict(list)
    for i in range(n - 7):
        seen[tuple(words[i : i + 8])].append(i)
    for places in seen.values():
        if len(places) > 1:
            hit.update(j for i in places for j in range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_features(spark, odd, none):
    rng = random.Random(1)
    rows = [(i, "\n".join(" ".join(rng.choice(["a", "b#", "c|"]) for _ in range(rng.randrange(0, 30))) for _ in range(rng.randrange(1, 5)))) for i in range(150)]
    for df in (documents(spark, rows), odd):
        texts = defaultdict(set)
        for r in df.collect():
            texts[r.doc_id].add(brute_features(r.text or ""))
        for r in features(df).collect():
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) in texts[r.id]
    assert features(none).isEmpty()


def test_binomial_tail(spark):
    cases = [(k, n, p) for p in (0.005, 0.1) for n in (5, 200, 3000) for k in (0, 1, 3) if k < n * p]
    for k, n, p in cases:
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p).alias("x")).first().x
        assert got == pytest.approx(want, rel=1e-9)
    assert spark.range(1).select(binomial_tail(F.lit(9).cast("long"), F.lit(10).cast("long"), 0.1).alias("x")).first().x == 1.0


def test_rules_reject_within_the_bound(spark):
    rng = random.Random(2)
    good = [(i, prose(rng, 60, 4000)) for i in range(4500)]
    bad = [(10_000 + i, " ".join(w + "###" for w in prose(rng, 60, 4000).split())) for i in range(100)]
    docs = documents(spark, good + bad)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad[:30]], "doc_id long, quality int")
    got = {r.doc_id: r for r in apply_rules(docs, labels).collect()}
    assert sum(not got[i].kept for i, _ in good) <= 0.02 * len(good) and not any(got[i].kept for i, _ in bad)
    assert {r.reason for i, r in got.items() if i >= 10_000} <= {"symbols", "long_words"}  # the words of bad ones are longer, too
    few = apply_rules(docs, labels.limit(5))
    assert few.filter("kept").count() == len(good) + len(bad)  # too few labels prove nothing
    assert cutoffs(features(docs).limit(0), {"symbols": [1]}).isEmpty() and cutoffs(features(docs), {}).isEmpty()


def test_rules_pool_small_strata(spark):
    rng = random.Random(5)
    langs = ("de", "fr", "es")
    good = [(i, prose(rng, 60, 4000)) for i in range(2400)]
    bad = [(10_000 + i, " ".join(w + "###" for w in prose(rng, 60, 4000).split())) for i in range(80)]
    lang = F.element_at(F.array(*map(F.lit, (*langs, "it"))), F.when(F.col("doc_id") >= 10_000, F.col("doc_id") % 4 + 1).otherwise(F.col("doc_id") % 3 + 1).cast("int"))
    docs = documents(spark, good + bad).withColumn("lang", lang)
    got = {r.doc_id: r for r in apply_rules(docs, spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad if i % 4 < 3], "doc_id long, quality int")).collect()}
    assert sum(not got[i].kept for i, _ in good) <= 0.02 * len(good)
    assert all(got[i].kept == (i % 4 == 3) for i, _ in bad)  # no label tells about the fourth language


def test_rules_on_odd_rows(spark, odd, none, labels):
    assert apply_rules(odd, labels).count() == 12 and apply_rules(none, labels).isEmpty()


def test_mixing(spark, odd, none):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(1, 60)), "abc"[min(2, i % 8 // 3)]) for i in range(900)] + [(5000 + i, prose(rng, 9), None) for i in range(30)]
    got = mix(documents(spark, rows)).collect()
    total = sum(r.size for r in got)
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert r.taken <= 3 * r.size and r.taken == r.size * r.copies
    assert sum(v[0].target for v in by.values()) == pytest.approx(total)
    for v in by.values():
        assert v[0].source_size == sum(r.size for r in v) and v[0].target <= 3 * v[0].source_size + 1e-6
        assert abs(sum(r.taken for r in v) - v[0].target) <= max(r.size for r in v)
    again = {r.doc_id: r.taken for r in mix(documents(spark, rows[::-1])).collect()}
    assert again == {r.doc_id: r.taken for r in got}
    copies = Counter(r.doc_id for r in apply_mix(documents(spark, rows)).collect())
    assert copies == Counter({r.doc_id: r.copies for r in got if r.copies})
    assert mix(none).isEmpty() and mix(odd).count() == 12 and apply_mix(odd).columns == odd.columns
