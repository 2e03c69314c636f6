import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tilewright.llm.packing import tokenizer_path
from tilewright.llm.quality import score_quality

from .conftest import documents, prose
from .test_free import brute_links

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars", "score")


def written(spark, tmp_path, rows, marks):
    documents(spark, rows).select(*COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def corpus():
    rng = random.Random(21)
    rows = [(i, prose(rng, rng.randrange(20, 90), 900), "abc"[min(2, i % 7 // 3)]) for i in range(160)]
    rows += [(200 + i, rows[i][1], "b") for i in range(15)]  # exact copies
    rows += [(300 + i, rows[i][1] + " tail", "c") for i in range(40, 60)]  # near copies
    rows += [(400 + i, " ".join(w.upper() + "!!" for w in prose(rng, 40).split()), "a") for i in range(60)]  # junk
    rows += [(500, None, "a"), (501, "", None), (502, prose(rng, 4000), "b"), (503, "one"), (503, "one"), (None, "two words")]
    marks = [(i, 1, 0) for i in range(160)] + [(400 + i, 0, 0) for i in range(60)]
    return rows, marks


def plain(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_stages_against_brute_force(spark, tmp_path):
    sf_dir = written(spark, tmp_path, *corpus())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "n-gram Jaccard join", "mixing", "packing"]

    def after(i, before):
        made = corpus_pipeline.STAGES[i][1](spark, before, sf_dir)
        assert i == 4 or made.columns == docs.columns
        made.write.parquet(str(tmp_path / f"s{i}"))
        return spark.read.parquet(str(tmp_path / f"s{i}"))

    good = after(0, docs)
    scores = {(r.doc_id, r.score) for r in score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    low = {i for i, s in scores if s < 0.5}
    assert sorted(r.doc_id or -1 for r in good.collect()) == sorted(r.doc_id or -1 for r in docs.collect() if r.doc_id not in low)
    assert not any(r.doc_id is not None and 400 <= r.doc_id < 460 for r in good.collect()) and good.filter("doc_id < 160").count() == 160

    single = after(1, good)
    best = {}
    for i, t in plain(good):
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    assert Counter((i, t or "") for i, t in plain(single).elements()) == Counter((None if i < 0 else i, t) for t, i in best.items())

    apart = after(2, single)
    texts = [(r.doc_id if r.doc_id is not None else 10**9, r.text) for r in single.collect()]
    roots = brute_links(texts)
    assert sorted(r.doc_id if r.doc_id is not None else 10**9 for r in apart.collect()) == sorted(i for i, (root, _) in roots.items() if root == i)

    mixed = after(3, apart)
    size = lambda t: len((t or "").split())
    have, taken = defaultdict(int), defaultdict(int)
    for r in apart.collect():
        have[r.source] += size(r.text)
    for r in mixed.collect():
        taken[r.source] += size(r.text)
    assert set(plain(mixed)) <= set(plain(apart)) and max(plain(mixed).values()) <= 3
    order = sorted(have, key=lambda s: (s is None, s))
    weight, full, total = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, set(), sum(have.values())
    while True:
        left, w = total - sum(3 * have[s] for s in full), sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and left * weight[s] / w > 3 * have[s]}
        if not more:
            break
        full |= more
    for s in order:
        target = 3 * have[s] if s in full else left * weight[s] / w
        assert abs(taken[s] - target) <= max(size(r.text) for r in apart.collect() if r.source == s)

    pieces = after(4, mixed).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter(tuple([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in mixed.collect())
    assert sum(r.length for r in pieces) == sum(len(ids) * n for ids, n in want.items())
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:], strict=False)) and sum(n for _, n in parts) <= 2048
    whole = Counter(tuple(np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in pieces if r.length == r.doc_tokens)
    assert all(want[ids] >= n for ids, n in whole.items()) and sum(whole.values()) > 50


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "odd", "none"])
def test_run(spark, odd, none, tmp_path, sf_dir):
    if sf_dir in ("odd", "none"):
        (odd if sf_dir == "odd" else none).write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame([(i, i % 2, 0) for i in range(9)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
        sf_dir, empty = str(tmp_path), sf_dir == "none"
    else:
        empty = False
    made = corpus_pipeline.run(spark, sf_dir)
    assert made.isEmpty() == empty and {"doc_id", "ids", "sequence_id", "offset"} <= set(made.columns)
