"""The quality classifier against a plain version: features by loops, an exact decomposition, every cosine on its own."""

import math
import random
import zlib

import numpy as np
import pytest

from tilewright.llm import quality

FOLD, FOLDS = 2, 4
GOOD = "the river runs past old houses and people walk there in the evening when rain has stopped".split()


def text_of(pick, good):
    words = [pick.choice(GOOD) for _ in range(pick.randrange(20, 60))]
    if good:
        return " ".join(words).capitalize() + "."
    return pick.choice(["BUY NOW!!! ", "$$ %% ", "click | here | "]) * pick.randrange(2, 9) + " ".join(words[:8]) + "\n" * pick.randrange(3) + " ".join(words[:8])


def plain_features(text):
    """(name -> share or figure): trigrams of byte classes, 4-grams of bytes without case, figures."""
    data = text.encode()
    marks = {ord(m): min(5 + i, 23) for i, m in enumerate(".,|!*#$%&<>{}[]()=/\\\"':;?-_@+~^`")}

    def kind(b):
        if b == 10:
            return 4
        if b in b" \t\x0b\x0c\r":
            return 3
        if b in marks:
            return marks[b]
        return 1 if 65 <= b <= 90 or 0x80 <= b < 0xA0 else 2 if 48 <= b <= 57 else 0

    kinds, low, out = [kind(b) for b in data], data.lower(), {}
    for i in range(len(kinds) - 2):
        name = ("t", *kinds[i : i + 3])
        out[name] = out.get(name, 0) + 1 / (len(kinds) - 2)
    for i in range(len(low) - 3):
        name = ("l", (int.from_bytes(low[i : i + 4], "little") * 0x9E3779B1 % 2**32) >> 20)
        out[name] = out.get(name, 0) + 1 / (len(low) - 3)
    words, n = data.split(), len(data.split())
    if n:
        lines = [v for v in data.split(b"\n") if v.strip()]
        triples = len({tuple(words[i : i + 3]) for i in range(n - 2)}) / max(1, n - 2) if n > 2 else 1
        figures = (
            sum(words[i] == words[i + 1] for i in range(n - 1)) / n, 1 - min(1, triples), 1 - len(set(words)) / n, 1 - len(set(lines)) / len(lines),
            kinds.count(1) / len(kinds), sum(k >= 5 for k in kinds) / len(kinds), min(2, (len(data) - n) / n / 10), math.log1p(n) / 10,
        )
        out |= {("f", i): v for i, v in enumerate(figures)}
    return out


def brute(docs, labels, k, power):
    """id -> score"""
    learnt = [(i, labels[i]) for i, _ in docs if i in labels and zlib.crc32(str(i).encode()) % FOLDS != FOLD]
    texts = dict(docs)
    raw = {i: plain_features(texts[i]) for i in texts}
    counts = {}
    for i, _ in learnt:
        for name in raw[i]:
            counts[name] = counts.get(name, 0) + 1
    names = sorted((n for n, c in counts.items() if c >= 2 and n[0] != "f"), key=str)
    weight = {n: math.log(1 + len(learnt) / counts[n]) * (0.5 if n[0] == "l" else 1) for n in names}
    vector = lambda r: np.array([math.sqrt(r.get(n, 0)) * weight[n] for n in names] + [2 * r.get(("f", i), 0) for i in range(8)])
    x = np.stack([vector(raw[i]) for i, _ in learnt])
    mean = x.mean(axis=0)
    axes = np.linalg.svd(x - mean, full_matrices=False)[2][:48].T
    unit = lambda v: v / max(np.linalg.norm(v), 1e-9)
    known = [(unit((v - mean) @ axes), label) for v, (_, label) in zip(x, learnt, strict=True)]
    out = {}
    for i in texts:
        v = unit((vector(raw[i]) - mean) @ axes)
        near = sorted(((float(v @ u), label) for u, label in known), reverse=True)[:k]
        w = [max(c, 1e-3) ** power for c, _ in near]
        out[i] = sum(a * label for a, (_, label) in zip(w, near, strict=True)) / sum(w)
    return out


@pytest.mark.parametrize("k", [1, 5])
def test_against_brute_force(spark, k):
    pick = random.Random(5)
    docs = [(i, text_of(pick, i % 3 > 0)) for i in range(110)] + [(110, ""), (111, "cafÉ été " * 9), (112, "x")]
    labels = {i: int(i % 3 > 0) for i in range(75)}
    want = brute(docs, labels, k, 8.0)
    table = spark.createDataFrame([(i, v) for i, v in labels.items()], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score_quality(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), table, k=k).collect()}
    assert set(got) == set(want)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % FOLDS == FOLD) for i, r in got.items())
    near = [abs(got[i].score - want[i]) for i in want]
    assert max(near) < 2e-3, [(i, got[i].score, want[i]) for i in want if abs(got[i].score - want[i]) >= 2e-3][:5]
    held = [i for i in range(75, 110)]
    assert all((got[i].score >= 0.7) == (i % 3 > 0) for i in held)
