"""Conversation repair against a brute-force version."""

import hashlib
import random
import zlib

import pytest

from tilewright.llm import conversation as cv

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, key string, place long, code int, fault string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def repaired(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, hash of one conversation's rows, by all paths that could be cheapest."""
    digest = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), digest(r)))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(BLANKS)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = {r[1] for r in rows if r[1] is not None}
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {s: ((0, "", ()) if s in ("", "a") else None) for s in ("", "s", "u", "a")}

    def with_inserts(best):
        for _ in range(4):
            for s in best:
                for new in "ua":
                    t = after.get((s, new))
                    if t and best[t]:
                        found = (best[t][0] + 5, "I" + best[t][1], (({"u": "user", "a": "assistant"}[new], ""), *best[t][2]))
                        best[s] = found if best[s] is None else min(best[s], found)
        return best

    best = with_inserts(best)
    for (_, _, role, text), fault in reversed(list(zip(rows, faults, strict=True))):
        new = {}
        for s in best:
            options = [(best[s][0] + 2, "D" + best[s][1], best[s][2])] if best[s] else []
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault else 0
                for letter, cost, named in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                    t = after.get((s, named[:1]))
                    if t and best[t]:
                        options.append((best[t][0] + cost + extra, letter + best[t][1], ((named, text), *best[t][2])))
            new[s] = min(options) if options else None
        best = with_inserts(new)
    cost, audit, lines = best[""]
    text = "\n".join(f"{r}:{t}" for r, t in lines)
    count = lambda f: faults.count(f)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def brute(rows):
    by = {r[0]: [] for r in rows}
    for r in damaged(rows):
        by[r[0]].append(r)
    return {c: repaired(rs) if rs else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, rs in by.items()}


def asked(spark, rows, tmp_path):
    extra = (None, "k", 1, 2, "f")
    spark.createDataFrame([(*r, *extra[1:]) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = cv.op13_conversations(spark, str(tmp_path)).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in got}


def conversations(rng, convs, length, roles, ends):
    return [(c, t, rng.choice(roles), rng.choice(["", " ", "One", "Two words", "Three of them", "é ß", *(f"w{i}" for i in range(length))]) + rng.choice(ends)) for c in range(convs) for t in rng.sample(range(3 * length), rng.randrange(length + 1))]


def test_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = conversations(rng, 150, 9, ["system", "user", "user", "assistant", "assistant", "tool", "", None, "User", "a", "s"], ["", ".", "!", "?  \n", "...x"])
    rows += [(900, None, None, None), (900, None, "user", None), (None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (901, 1, "user", None), (902, 3, "user", "x" * 100_000 + "."), (902, 3, "user", "x" * 100_000 + "."), (902, 4, "assistant", "y.")]
    assert asked(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("chunk, fan", [(2, 2), (3, 2), (5, 32)])
def test_chunks_agree(spark, chunk, fan):
    """Chunks of a few rows, and long runs over which costs do not converge."""
    rng = random.Random(chunk)
    rows = conversations(rng, 20, 60, ["system", "user", "assistant"], ["", "."])
    rows += [(100, t, "user", f"t{t}") for t in range(200)] + [(101, t, "user", "same.") for t in range(100)]
    rows += [(102, t, "user" if t % 2 else "assistant", f"t{t}" + "." * (t > 150)) for t in range(180)]
    every, lines = cv.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), chunk, fan)
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    got = {r["key"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in cv.summaries(every).collect()}
    assert got == {f":{c}": repaired(rs) for c, rs in by.items()}
    some = [(r["role"], r["text"]) for r in lines.filter("key = ':102'").orderBy("place", "nth").collect()]
    assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in some).encode()).hexdigest() == got[":102"][-1]
    assert "".join(a[0] for a, _ in some) in ("", "ua" * (len(some) // 2), "s" + "ua" * (len(some) // 2))


def test_empty_table(spark, tmp_path):
    assert asked(spark, [], tmp_path) == {}
