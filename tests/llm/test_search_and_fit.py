"""Best-fit packing and ranked search against brute-force versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tilewright.llm import best_fit as bf
from tilewright.llm import packing, ranked_search
from tilewright.llm.queries import oracle_sql

from .conftest import documents, prose

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ASCII = {c: c + 32 for c in range(65, 91)}


# ---- op11
def check_pieces(docs, pieces, window):
    """Each row's ids lie whole in its pieces, and sequences have no gaps and no more than window."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    wanted = Counter()
    for key, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for i, a in enumerate(range(0, len(ids), window)):
            some = np.array(ids[a : a + window], "<u4").tobytes()
            wanted[key, i, a, len(some) // 4, some] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in pieces) == wanted
    by = {}
    for r in pieces:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= window
    return by


@pytest.mark.parametrize("parts, window, most", [(1, 64, 4), (7, 64, 8), (70, 128, 8)])
def test_best_fit(spark, parts, window, most):
    rng = random.Random(parts)
    rows = [(i, prose(rng, rng.choice([0, 1, 3, 8, 20, 50, 200]))) for i in range(400)]
    got = bf.best_fit(documents(spark, rows).repartition(parts), window, most).collect()
    by = check_pieces(rows, got, window)
    total = sum(r["length"] for r in got)
    assert len(by) <= total / window * 1.05 + most


def test_best_fit_odd_rows(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check_pieces(rows, bf.best_fit(odd).collect(), 4096)
    assert bf.best_fit(none).collect() == []


def test_open_bins():
    bins = bf.OpenBins(10, 2)
    assert bins.put("a", 6) == [] and bins.put("b", 7) == []
    assert bins.put("c", 3) == [[("b", 0), ("c", 7)]]  # fills b, though a has room
    assert bins.put("d", 5) == []
    assert bins.put("e", 8) == [[("a", 0)]]  # no room in either: the fullest closes
    assert [[p for p, _ in b] for b in bins.rest()] == [["e"], ["d"]]


def test_digests(spark, tmp_path):
    documents(spark, [(1, "one two"), (2, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["ids_crc32"] for r in bf.op11_best_fit(spark, str(tmp_path)).collect()}
    assert got[2] == zlib.crc32(np.array([1], "<u4").tobytes())


# ---- op12
def terms(text):
    return TERM.findall((text or "").translate(ASCII))


def brute(docs, items, k=10):
    each = [(d, Counter(terms(t))) for d, t in docs]
    each = [(d, c, sum(c.values())) for d, c in each if c]
    n, total = len(each), sum(x[2] for x in each)
    df = Counter(t for _, c, _ in each for t in c)
    out = Counter()
    for key, text in items:
        asked = Counter(terms(text))
        found = []
        for d, c, size in each:
            m = 25 + 75 * size * n // total
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t, q in asked.items() if t in c)
            if score > 0:
                found.append((-score, d is not None, d or 0))
        out.update((key, i + 1, d if known else None, -s) for i, (s, known, d) in enumerate(sorted(found)[:k]))
    return out


def ranked(spark, docs, items, **options):
    asked = spark.createDataFrame([(i, t, 1.0, 2) for i, t in items], "item_id long, text string, score double, rank int")
    return Counter(map(tuple, ranked_search.search(docs, asked, **options).select("item_id", "rank", "doc_id", "score").collect()))


@pytest.mark.parametrize("options", [{}, {"k": 3, "most_items": 7, "most_terms": 60}, {"sample": 1}])
def test_search(spark, options):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.choice([1, 5, 40, 300]), 90 + 40 * (i % 3)).replace("w1", rng.choice(["É", "W1", "w1"]))) for i in range(700)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)] + [(2000, "x" * 3_000_000), (2001, "w3, w4;w5_w6 w7 \x7fW8 ÀÉ")]
    items = [(i, prose(rng, rng.choice([1, 4, 30]), 200)) for i in range(40)] + [(100, rows[5][1]), (101, "w3 " * 50), (102, "none here"), (103, ""), (104, None), (None, "w9"), (1, "w8"), (1, "w8")]
    assert ranked(spark, documents(spark, rows).repartition(5), items, **options) == brute(rows, items, options.get("k", 10))


def test_search_odd_rows(spark, odd, none):
    items = [(1, "a B one"), (2, "é w1 w2 w3"), (3, "w1 " * 20)]
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert ranked(spark, odd, items) == brute(rows, items)
    assert not ranked(spark, none, items)
    assert not ranked(spark, odd, [])
    assert "op12_ranked_search" in oracle_sql()


def test_large_weights_stay_exact():
    """Beyond 2**53 whole numbers take the place of doubles."""
    items = ranked_search.Items(np.array([[10**8, 3]]), 10**6, 10**8, np.array([1, 2]), 10)
    assert items.kind is np.int64
    assert items.products(np.array([[999_999, 7]], np.float32), np.array([0, 1]), items.x[0])[0] == 999_999 * 10**8 * items.weight[0] + 21 * items.weight[1]
