"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.steps import cut
from .arrays import slices
from .common import crc_mod, text_of

ODD = np.uint64(0x9E3779B97F4A7C15)
END = np.uint64(xxhash.xxh64_intdigest(b"\n"))  # no word has a line end in it
MAX_LEVEL = 50
SLICE = 6_000_000  # bytes of text worked on at a time: the more, the fewer n-grams are sent twice
LOCAL, LOW = np.uint64(28), np.uint64((1 << 28) - 1)  # bits of an n-gram's hash within its shard
WORD_BYTES, CODE_BYTES = 6, 3  # of a word's hash, and of its number in a slice
SHARD_TOKENS = 1 << 20
BITS_A_TOKEN = 8  # for a pair and a triple


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def tokenized(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the different words, which of them each token is, tokens a text): A-Z lower-cased words, then one end."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    each = parts.flatten().dictionary_encode()
    words = each.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    code = each.indices.to_numpy(zero_copy_only=False)
    real = np.array([w != "" for w in words], bool)[code] if len(code) else np.empty(0, bool)  # blanks at a text's ends part off empty words
    rows = np.r_[0, np.cumsum(real)][parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()]
    sizes = np.diff(rows) + 1
    out = np.full(int(sizes.sum()), len(words), np.int32)
    body = np.ones(len(out), bool)
    body[np.cumsum(sizes) - 1] = False
    out[body] = code[real]
    return np.r_[hashes, END], out, sizes


def ngrams(words: np.ndarray, code: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token the hash of (token before, token), and that of the two before and it; before a text stand ends. A
    text's first token has no triple: 0 stands for none."""
    flat = words[code]
    before = np.r_[END, flat[:-1]]
    before[starts] = END
    pairs = mixed(before * np.uint64(3) + np.uint64(1)) ^ mixed(flat + ODD)
    triples = mixed(np.r_[np.uint64(0), pairs[:-1]] * np.uint64(5) + np.uint64(7)) ^ mixed(flat * np.uint64(3) + ODD)
    triples[starts] = 0
    return pairs, triples


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> LOCAL) % np.uint64(shards)).astype(np.int64)


def by_shard(keys: np.ndarray, hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys with those of a shard together, the order that brings them there, where each shard begins and the last ends)."""
    shard = shard_of(hashes, shards)
    order = np.argsort(shard, kind="stable")
    return keys[order], order, np.r_[0, np.cumsum(np.bincount(shard, minlength=shards))]


def packed(x: np.ndarray, size: int) -> np.ndarray:
    """The low bytes of numbers of eight, a row each."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :size]


def unpacked(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size)
    return out.view(np.uint64).ravel()


def level_of(counts: np.ndarray) -> np.ndarray:
    """The quantised count: 0 for none, else 1 + floor(log2(count))."""
    return np.frexp(counts.astype(np.float64))[1] * (counts > 0)


def count_of(level: np.ndarray) -> np.ndarray:
    """The middle of the counts that a level stands for."""
    return np.where(level > 1, 1.5 * 2.0 ** (level - 1) - 0.5, level)


class LogBloom:
    """A Bloom filter in pieces of equal size, a piece a shard. An n-gram is in at each level from `lowest` to its own; its
    count is read back by asking for level after level, the last one found tells it."""

    def __init__(self, bits: np.ndarray, piece: int, probes: int, lowest: int = 1):
        self.bits, self.piece, self.probes, self.lowest = bits, np.uint64(piece), probes, lowest

    @staticmethod
    def seeds(h: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each n-gram at a level the first place (before it is taken modulo the piece) and the step to the next ones."""
        x = mixed(h + np.uint64(level * 0xD6E8FEB86659FD93 % (1 << 64)))
        return x, mixed(x) | np.uint64(1)

    @classmethod
    def piece_of(cls, h: np.ndarray, level: np.ndarray, piece: int, probes: int, lowest: int = 1, highest: int = MAX_LEVEL) -> bytes:
        """A piece that holds n-grams (their local hashes) at their levels from lowest on, highest at most."""
        bits = np.zeros(piece, np.uint8)
        for k in range(lowest, min(int(level.max(initial=0)), highest) + 1):
            x, step = cls.seeds(h[level >= k], k)
            for _ in range(probes):
                bits[x % np.uint64(piece)] = 1
                x = x + step
        return np.packbits(bits, bitorder="little").tobytes()

    def levels(self, h: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """The last level found from lowest on; 0 if not even that one is."""
        out, base, left = np.zeros(len(h), np.uint8), shard.astype(np.uint64) * self.piece, np.arange(len(h))
        for k in range(self.lowest, MAX_LEVEL + 1):
            x, step = self.seeds(h[left], k)
            for _ in range(self.probes):
                at = x % self.piece + base[left]
                hit = (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                left, x, step = left[hit], x[hit] + step[hit], step[hit]
            out[left] = k
            if not len(left):
                break
        return out


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """values cut at bounds, as an array of bytes."""
    offsets = (bounds * values.itemsize * (values.shape[1] if values.ndim > 1 else 1)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def numbers(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(data, kind)


def shrunk(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + (pa.compress(data, "zstd", asbytes=True) if data else b"")


def shrunk_back(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""


def grams_packed(grams: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Local hashes, in order between bounds: their low byte as it is, and the steps between what is above it, compressed."""
    low, high = (grams & np.uint64(0xFF)).astype(np.uint8), (grams >> np.uint64(8)).astype(np.int64)
    steps = np.diff(high, prepend=0)
    first = bounds[:-1][np.diff(bounds) > 0]
    steps[first] = high[first]
    steps = steps.astype(np.uint32)
    return pa.array([low[a:b].tobytes() + shrunk(steps[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.binary())


def grams_unpacked(data: bytes, n: int) -> np.ndarray:
    steps = np.frombuffer(shrunk_back(data[n:]), np.uint32).astype(np.uint64)
    return (np.cumsum(steps, dtype=np.uint64) << np.uint64(8)) | np.frombuffer(data[:n], np.uint8)


def counts_packed(n: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Counts cut at bounds: a byte each, then eight for those of 255 or more; compressed, as most are small."""
    small, often = np.minimum(n, 255).astype(np.uint8), n >= 255
    big, at = n[often].astype(np.uint64), np.r_[0, np.cumsum(often)][bounds]
    return pa.array([shrunk(small[a:b].tobytes() + big[c:d].tobytes()) for a, b, c, d in zip(bounds[:-1].tolist(), bounds[1:].tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())


def counts_unpacked(data: bytes, n: int) -> np.ndarray:
    whole = shrunk_back(data)
    out = np.frombuffer(whole[:n], np.uint8).astype(np.int64)
    out[out == 255] = np.frombuffer(whole[n:], np.uint64)
    return out


class Slice:
    """What scoring keeps of a slice of documents: who is held out, tokens a text, the words' hashes and the tokens."""

    COLUMNS = ("key", "ids", "held", "sizes", "words", "code", "trained")

    def __init__(self, row: dict, shards: int):
        self.held, self.sizes = np.frombuffer(row["held"], np.bool_), np.frombuffer(row["sizes"], np.int32).astype(np.int64)
        words = unpacked(row["words"], WORD_BYTES)
        planes = np.frombuffer(shrunk_back(row["code"]), np.uint8).reshape(CODE_BYTES, -1)
        self.code = sum(p.astype(np.int64) << 8 * i for i, p in enumerate(planes))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pairs, self.triples = ngrams(mixed(words), self.code, self.starts)
        self.words, self.word_order, self.word_at = by_shard(words, mixed(words), shards)
        # different n-grams (shard, then local hash), and which of them each token's pair and triple are
        self.deep = np.flatnonzero(self.triples)
        h = np.concatenate([self.pairs, self.triples[self.deep]])
        grams, self.place = np.unique((shard_of(h, shards).astype(np.uint64) << LOCAL) | (h & LOW), return_inverse=True)
        self.grams, self.gram_at = grams & LOW, np.searchsorted(grams, np.arange(shards + 1, dtype=np.uint64) << LOCAL)

    def learnt(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the words and of the n-grams, in their order."""
        tokens = np.repeat(~self.held, self.sizes)
        words = np.bincount(self.code[tokens], minlength=len(self.words))[self.word_order]
        return words, np.bincount(self.place[np.r_[tokens, tokens[self.deep]]], minlength=len(self.grams))


def slices_of(rows: DataFrame, kind: str) -> DataFrame:
    """rows (id, text, held_out) as slices, written once: a row for each few megabytes of text, under a random key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE):
                part = batch.slice(a, b - a)
                words, code, sizes = tokenized(part.column(1))
                held = part.column(2).to_numpy(zero_copy_only=False)
                key = int.from_bytes(os.urandom(8), "little", signed=True)
                ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(0))
                tokens = shrunk(packed(code.astype(np.uint64), CODE_BYTES).T.tobytes())  # byte by byte: the high ones repeat
                blobs = [pa.array([x], pa.binary()) for x in (held.tobytes(), sizes.astype(np.int32).tobytes(), packed(words, WORD_BYTES).tobytes(), tokens)]
                yield pa.RecordBatch.from_arrays([pa.array([key]), ids, *blobs, pa.array([int(sizes[~held].sum())])], list(Slice.COLUMNS))

    return cut(rows.mapInArrow(run, f"key long, ids array<{kind}>, held binary, sizes binary, words binary, code binary, trained long"))


def messages(state: DataFrame, shards: int) -> DataFrame:
    """What each slice sends to the shards, a row for each that it touches: its words and n-grams with their training counts
    (0 where only held-out texts have them), of which it wants to know the counts in all slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            part = Slice(row, shards)
            n_words, n_grams = part.learnt()
            touched = np.flatnonzero((np.diff(part.word_at) > 0) | (np.diff(part.gram_at) > 0))
            sizes = pa.array(np.diff(part.gram_at))
            whole = [lists(packed(part.words, WORD_BYTES), part.word_at), counts_packed(n_words, part.word_at), grams_packed(part.grams, part.gram_at), counts_packed(n_grams, part.gram_at), sizes]
            yield pa.RecordBatch.from_arrays([pa.array(touched.astype(np.int32)), pa.array(np.full(len(touched), row["key"])), *(x.take(pa.array(touched)) for x in whole)], ["shard", "key", "w", "wn", "g", "gn", "n"])

    return state.select("key", "held", "sizes", "words", "code").mapInArrow(run, "shard int, key long, w binary, wn binary, g binary, gn binary, n long")


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sums of their counts, without those that sum to nothing."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
    return keys[counts > 0], counts[counts > 0]


def answers(sent: DataFrame, often_bits: int, rest_bits: int, probes: int, lowest: int) -> DataFrame:
    """A row a message: key, shard, exact counts of its words (wn), how many (n) and, where lowest is above 1, the levels of its
    n-grams by the shard's own filter, that of n-grams below level `lowest`; all in the message's order. And a row a shard,
    with a null key: `often`, its piece of the filter of n-grams of that level or more, and how many words it has (kinds)."""

    def build(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        words = [unpacked(r["w"], WORD_BYTES) for r in rows]
        grams = [grams_unpacked(r["g"], r["n"]) for r in rows]
        known, n = summed(np.concatenate(words), np.concatenate([counts_unpacked(r["wn"], len(w)) for r, w in zip(rows, words, strict=True)]))
        g, c = summed(np.concatenate(grams), np.concatenate([counts_unpacked(r["gn"], r["n"]) for r in rows]))
        level = level_of(c)
        own = LogBloom(np.frombuffer(LogBloom.piece_of(g, np.minimum(level, lowest - 1), rest_bits, probes), np.uint8), rest_bits, probes) if lowest > 1 else None
        shard = table.column("shard")[0].as_py()
        out = [(None, shard, b"", 0, b"", LogBloom.piece_of(g, level, often_bits, probes, lowest), len(known))]
        for r, w, x in zip(rows, words, grams, strict=True):
            at = np.minimum(np.searchsorted(known, w), max(len(known) - 1, 0))
            found = np.where(known[at] == w, n[at], 0) if len(known) else np.zeros(len(w), np.int64)
            levels = shrunk(own.levels(x, np.zeros(len(x), np.int64)).tobytes()) if own else b""
            out.append((r["key"], shard, counts_packed(found, np.array([0, len(found)]))[0].as_py(), len(found), levels, b"", 0))
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
        return pa.table([pa.array(column, k) for column, k in zip(zip(*out, strict=True), kinds, strict=True)], ["key", "shard", "wn", "n", "levels", "often", "kinds"])

    return cut(sent.groupBy("shard").applyInArrow(build, "key long, shard int, wn binary, n long, levels binary, often binary, kinds long"))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: int = 0, folds: int = 10, max_bits: int = 1 << 28, probes: int = 3, pair_prior: float = 40.0, triple_prior: float = 10.0, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row a document: id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    The model learns from rows with crc32(id as text) mod folds other than held_out. With q for a quantised count,
    P(w | u v) = (q(u v w) + triple_prior * P(w | v)) / (q(u v) + triple_prior), P(w | v) = (q(v w) + pair_prior * P(w)) /
    (c(v) + pair_prior), P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)); c is exact. No q is above the count of its context.

    Texts are read once: slices of a few megabytes keep their words and tokens. A slice sends its different words and
    n-grams to shards by hash, of about shard_tokens training tokens each, so no key is hot; the shards sum the counts and
    answer. N-grams of the least power of two on for which the filter fits into max_bits (8 bits a token, 32 MiB at most
    by default) go into the filter that is broadcast; rarer ones into a filter of their shard, which it asks for the
    slices. So work and memory grow with the tokens, and no n-gram is left out. Words are told apart by 48 bits of hash
    and their shard, n-grams by 28 bits and their shard.

    Null text is empty, its one token is the end; long texts are a slice each; rows with a null id are trained on; repeated
    rows are scored each. An empty table gives an empty result. Other columns are not read."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), F.coalesce(crc_mod(id_col, folds) == held_out, F.lit(False)).alias("held_out"))
    state = slices_of(rows, kind)
    total = state.agg(F.coalesce(F.sum("trained"), F.lit(0))).first()[0]
    lowest = 1
    while BITS_A_TOKEN * total > max_bits << (lowest - 1):
        lowest += 1
    shards = max(1, -(-total // shard_tokens))
    rest_bits = -(-BITS_A_TOKEN * total // shards // 8) * 8 + 512
    often_bits = -(-rest_bits >> (lowest - 1) + 3) * 8 + 64
    told = answers(messages(state, shards), often_bits, rest_bits, probes, lowest)
    kinds = told.agg(F.coalesce(F.sum("kinds"), F.lit(0))).first()[0]
    bits = np.zeros(shards * often_bits // 8, np.uint8)
    for row in told.filter("key is null").select("shard", "often").toLocalIterator():
        at = row["shard"] * often_bits // 8
        bits[at : at + often_bits // 8] = np.frombuffer(row["often"], np.uint8)
    often = docs.sparkSession.sparkContext.broadcast(LogBloom(bits, often_bits, probes, lowest))
    size = total + 0.1 * (kinds + 1)

    def finish(own: pa.Table, replies: pa.Table) -> pa.Table:
        part = Slice(own.select(["held", "sizes", "words", "code"]).to_pylist()[0], shards)
        got = replies.sort_by("shard").to_pylist()
        levels = often.value.levels(part.grams, np.repeat(np.arange(shards), np.diff(part.gram_at)))
        if lowest > 1:
            rare = levels == 0
            levels[rare] = np.frombuffer(b"".join(shrunk_back(r["levels"]) for r in got), np.uint8)[rare]
        c = np.zeros(len(part.words), np.int64)
        c[part.word_order] = np.concatenate([counts_unpacked(r["wn"], r["n"]) for r in got])
        q_all = count_of(levels.astype(np.float64))[part.place]
        n, code, deep = len(part.sizes), part.code, part.deep
        c_word = c[code].astype(np.float64)
        c_before = np.r_[0.0, c_word[:-1]]
        c_before[part.starts] = c[code[-1]]  # each text ends with the end
        p = (c_word + 0.1) / size
        owner = np.repeat(np.arange(n), part.sizes)
        base = np.bincount(owner, np.log10(p), n)
        q_pair = np.minimum(q_all[: len(code)], np.minimum(c_before, c_word))
        p = (q_pair + pair_prior * p) / (c_before + pair_prior)
        q_context = np.r_[0.0, q_pair[:-1]][deep]
        q = np.minimum(q_all[len(code) :], np.minimum(q_context, q_pair[deep]))
        p[deep] = (q + triple_prior * p[deep]) / (q_context + triple_prior)
        ids = own.column("ids").combine_chunks().flatten()
        known = np.bincount(owner, c_word > 0, n).astype(np.int64)
        return pa.table([ids, *map(pa.array, (part.held, part.sizes, known, base, np.bincount(owner, np.log10(p), n)))], ["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    replies = told.filter("key is not null").select("key", "shard", "wn", "n", "levels")
    found = state.drop("trained").groupBy("key").cogroup(replies.groupBy("key")).applyInArrow(finish, f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return found.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op6_lm_score(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
