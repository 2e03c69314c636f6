"""Packing: documents fill windows of tokens in the order in which a BM25 index finds them alike."""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.steps import cut
from .arrays import slices, spans
from .common import text_of

ENCODE_CHARS = 3_000_000  # bytes of text encoded at a time
REMEMBERED = 100_000  # words that an encoder keeps with their ids
BATCH = 1024  # documents that a task encodes at a time at most
SHORT = 64  # bytes that such a word has at most


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


WORD_MARKS = ".,!*#%&$|"  # may end a part, after its word
NEVER = np.int32(1 << 30)  # the rank of a pair that doesn't merge


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class WordMerger:
    """Token ids of many words at once by byte-pair merges in numpy: words lie side by side as rows of symbols, and each
    step merges the first of the lowest-ranked pairs of every row. A pair that a merge makes never ranks below the merge,
    so this is the order in which a single word's merges are done."""

    def __init__(self, model: dict, number: type):
        vocab, self.number = model["vocab"], number
        letters = byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[letters[b] + model["end_of_word_suffix"]] for b in range(256)], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = np.r_[keys[order], np.int64(1 << 62)], np.r_[order, NEVER].astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.first = np.hstack([self.rank(self.inner[:, None], second) for second in (self.inner, self.last)])  # of two bytes, the second within a word or its last

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        asked = (a.astype(np.int64) << 32) | b
        at = np.searchsorted(self.keys, asked)
        return np.where(self.keys[at] == asked, self.ranks[at], NEVER)

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words (an array of strings, none of them empty) in one row, and how many each word has."""
        offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4).astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        sizes = np.diff(offsets)
        widths = -(-sizes // 4) * 4
        found = []
        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            end = sizes[rows] - 1
            x = data[np.minimum(offsets[rows, None] + np.arange(width), len(data) - 1)]
            symbols = np.where(np.arange(width) <= end[:, None], self.inner[x], -1)  # -1 is no symbol
            at = np.arange(len(rows))
            symbols[at, end] = self.last[x[at, end]]
            ranks = np.full(symbols.shape, NEVER, np.int32)
            some = np.arange(1, width)
            ranks[:, :-1] = np.where(some <= end[:, None], self.first[x[:, :-1], x[:, 1:] + 256 * (some == end[:, None])], NEVER)
            found += [(rows[done], final) for done, final in self._merge(symbols, ranks)]
        count = np.zeros(len(words), np.int64)
        for rows, final in found:
            count[rows] = (final >= 0).sum(1)
        starts = np.cumsum(count) - count
        flat = np.empty(int(count.sum()), self.number)
        for rows, final in found:
            flat[spans(starts[rows], count[rows])] = final[final >= 0]
        return flat, count

    def _merge(self, symbols: np.ndarray, ranks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, their symbols) of those that have no pair left to merge, from the least merges to the most."""
        rows, width = np.arange(len(symbols)), symbols.shape[1]
        while True:
            best = ranks.argmin(1)
            low = ranks[np.arange(len(rows)), best]
            done = low == NEVER
            if done.any():
                yield rows[done], symbols[done]
                symbols, ranks, rows, best, low = symbols[~done], ranks[~done], rows[~done], best[~done], low[~done]
                if not len(rows):
                    return
            width -= 1
            moved = np.arange(width) > best[:, None]
            symbols = np.where(moved, symbols[:, 1:], symbols[:, :-1])
            ranks = np.where(moved, ranks[:, 1:], ranks[:, :-1])
            at = np.arange(len(rows))
            symbols[at, best] = self.made[low]
            before = np.flatnonzero(best > 0)
            i, j = at[before], best[before]
            ranks[i, j - 1] = self.rank(symbols[i, j - 1], symbols[i, j])
            ranks[at, best] = NEVER
            after = np.flatnonzero(best < width - 1)
            i, j = at[after], best[after]
            ranks[i, j] = self.rank(symbols[i, j], symbols[i, j + 1])


#: fixed value: how a tokenizer file parts a text into words that end in a mark of their own
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class ChunkEncoder:
    """Token ids of whole texts. A tokenizer of word ends never joins characters over a blank, nor letters and marks, and
    lower-cases first. So a text's ids are those of its parts between blanks, and those of a part are its word's and its
    marks'. Different parts are encoded once a call, words all at once (see WordMerger); parts of another make go to the
    tokenizer, and so do whole texts if the file parts them in any other way. Up to REMEMBERED short words are kept with their
    ids between calls; beyond that, those of the last call."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.number = np.uint32 if self.size > 1 << 16 else np.uint16
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        steps = (layout.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        parted = steps[0].get("pattern") == {"Regex": WORD_SPLIT} and [x.get("type") for x in steps[1:]] == ["ByteLevel"]
        folded = [x.get("type") for x in (layout.get("normalizer") or {}).get("normalizers") or []] == ["NFC", "Replace", "Lowercase"]
        self.merger = WordMerger(layout["model"], self.number) if parted and folded and layout["model"].get("end_of_word_suffix") else None

        self.known, self.known_ids, self.known_count = pa.array([], pa.string()), np.empty(0, self.number), np.empty(0, np.int64)

    def _by_memory(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As _ids_of, for different words: only those that aren't remembered are merged."""
        at = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        at[new] = len(self.known) + np.arange(len(new))
        fresh = words.take(pa.array(new))
        new_ids, new_count = self.merger(fresh) if len(new) else (self.known_ids[:0], self.known_count[:0])
        ids, count = np.concatenate([self.known_ids, new_ids]), np.concatenate([self.known_count, new_count])
        start = np.cumsum(count) - count
        every = pa.concat_arrays([self.known, fresh])
        stay = np.arange(len(every)) if len(every) <= REMEMBERED else np.sort(at)[:REMEMBERED]
        stay = stay[pc.binary_length(every).to_numpy()[stay] <= SHORT]
        if len(new):
            self.known, self.known_count, self.known_ids = every.take(pa.array(stay)), count[stay], ids[spans(start[stay], count[stay])]
        return ids, start[at], count[at]

    def _by_tokenizer(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        each = [e.ids for e in self.tokenizer.encode_batch_fast(parts.to_pylist(), add_special_tokens=False)]
        count = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter((i for ids in each for i in ids), self.number, int(count.sum())), count

    def _ids_of(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A row of ids, and for each part where its own begin there and how many they are."""
        bare = pc.ascii_rtrim(parts, characters=WORD_MARKS)
        is_word = pc.utf8_is_alpha(bare).to_numpy(zero_copy_only=False).copy()
        foreign = np.flatnonzero(is_word & ~pc.string_is_ascii(bare).to_numpy(zero_copy_only=False))
        is_word[foreign] = [unicodedata.is_normalized("NFC", w) and "\u03a3" not in w and "\u0130" not in w for w in bare.take(pa.array(foreign)).to_pylist()]
        some = np.flatnonzero(is_word)
        words = pc.utf8_lower(bare.take(pa.array(some))).dictionary_encode()
        cut_off = pc.binary_length(bare).to_numpy()[some]
        offsets = np.frombuffer(parts.buffers()[1], np.int32, len(parts) + 1, parts.offset * 4).astype(np.int64)
        data = np.frombuffer(parts.buffers()[2] or b"", np.uint8)
        has_marks = offsets[some + 1] - offsets[some] > cut_off
        marked = some[has_marks]
        begin = offsets[marked] + cut_off[has_marks]
        size = offsets[marked + 1] - begin
        edges = np.r_[0, np.cumsum(size)].astype(np.int32)
        marks = pa.Array.from_buffers(pa.string(), len(marked), [None, pa.py_buffer(edges), pa.py_buffer(data[spans(begin, size)])]).dictionary_encode()
        word_ids, word_start, word_count = self._by_memory(words.dictionary)
        mark_ids, mark_count = self._by_tokenizer(marks.dictionary)
        odd = np.flatnonzero(~is_word)
        odd_ids, odd_count = self._by_tokenizer(parts.take(pa.array(odd)))
        # each part has two spans: its word's (or, of another make, the tokenizer's) and its marks'
        start, count = np.zeros((2, 2 * len(parts)), np.int64)
        at = words.indices.to_numpy()
        start[2 * some], count[2 * some] = word_start[at], word_count[at]
        at = marks.indices.to_numpy()
        start[2 * marked + 1], count[2 * marked + 1] = (np.cumsum(mark_count) - mark_count)[at] + len(word_ids), mark_count[at]
        start[2 * odd], count[2 * odd] = np.cumsum(odd_count) - odd_count + len(word_ids) + len(mark_ids), odd_count
        both = count[0::2] + count[1::2]
        return np.concatenate([word_ids, mark_ids, odd_ids])[spans(start, count)], np.cumsum(both) - both, both

    def encode(self, texts: pa.Array, end: int) -> pa.Array:
        """The ids of each text (an array of strings without nulls) and the end id, as little-endian unsigned numbers of two
        bytes, or four for large vocabularies."""
        if self.merger is None:
            ids, count = self._by_tokenizer(texts)
            code, rows, start = np.arange(len(texts)), np.arange(len(texts) + 1), np.cumsum(count) - count
        else:
            parts = pc.ascii_split_whitespace(texts)
            each = parts.flatten().dictionary_encode()
            ids, start, count = self._ids_of(each.dictionary)
            code, rows = each.indices.to_numpy(), parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()
        sizes = count[code]
        ends = np.r_[0, np.cumsum(sizes)][rows[1:]] + np.arange(1, len(texts) + 1)  # ids up to and with each text's end
        flat = np.full(int(sizes.sum()) + len(texts), end, self.number)
        body = np.ones(len(flat), bool)
        body[ends - 1] = False
        flat[body] = ids[spans(start[code], sizes)]
        offsets = (np.r_[0, ends] * self.number().itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


#: of this process, by path: a worker that runs one task after the other reads the file once
ENCODERS: dict[str, ChunkEncoder] = {}


def encoder_for(path: str) -> ChunkEncoder:
    if path not in ENCODERS:
        ENCODERS[path] = ChunkEncoder(path)
    return ENCODERS[path]


def distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids in order and how often each occurs, as np.unique does; small numbers are sorted by their digits."""
    ordered = np.sort(ids, kind="stable")
    last = np.flatnonzero(ordered[1:] != ordered[:-1])
    edges = np.empty(len(last) + 2, np.int64)
    edges[0], edges[-1] = 0, len(ordered)
    np.add(last, 1, out=edges[1:-1])
    return ordered[edges[:-1]], edges[1:] - edges[:-1]


class Corpus:
    """What BM25 needs to know of all documents: in how many each term is, how many there are and their mean length."""

    def __init__(self, df: np.ndarray, n: int, tokens: int):
        self.df, self.n, self.mean = df, n, tokens / max(n, 1)
        self.idf = np.log((n - df + 0.5) / (df + 0.5)).astype(np.float32)

    @classmethod
    def of(cls, docs: list[np.ndarray], size: int) -> Corpus:
        return cls(np.bincount(np.concatenate([distinct(d)[0] for d in docs]), minlength=size), len(docs), sum(map(len, docs)))

    def weight(self, tf: np.ndarray, size: np.ndarray, k1: float = 1.2, b: float = 0.75) -> np.ndarray:
        return tf * (k1 + 1) / (tf + k1 * (1 - b + b * (size / self.mean)))


class Bm25:
    """An inverted index over the token ids of one shard's documents, weighted by the whole corpus. Terms in half of all
    documents or more tell nothing (their inverse frequency is not positive) and are left out."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus):
        n = len(docs)
        each = [distinct(d) for d in docs]
        self.terms = [t for t, _ in each]
        owner = np.repeat(np.arange(n), [len(t) for t in self.terms])
        term = np.concatenate(self.terms).astype(np.int64)
        tf = np.concatenate([c for _, c in each]).astype(np.float32)
        weight = corpus.weight(tf, np.array([len(d) for d in docs], np.float32)[owner])
        order = np.argsort(term, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        self.start = np.r_[0, np.cumsum(np.bincount(term, minlength=int(term.max()) + 1))]
        self.idf = corpus.idf
        self.n = n

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of all documents for the terms of one."""
        t = self.terms[doc].astype(np.int64)
        t = t[self.idf[t] > 0]
        sizes = self.start[t + 1] - self.start[t]
        at = np.repeat(self.start[t] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        return np.bincount(self.owner[at], self.weight[at] * np.repeat(self.idf[t], sizes), self.n)


DIMENSIONS = 64
SAMPLE = 32_768  # about so many documents at most are drawn to lay out the shards
LEAF = 8  # of them stand for a leaf of the tree at least


def sketches(docs: list[np.ndarray], corpus: Corpus) -> np.ndarray:
    """Random projections of the documents' BM25 vectors, of length one: documents that share rare terms lie close."""
    signs = projection(len(corpus.idf))
    out = np.zeros((len(docs), DIMENSIONS), np.float32)
    squares = np.where(corpus.idf > 0, corpus.idf**2, 0).astype(np.float32)
    for i, d in enumerate(docs):
        term, tf = distinct(d)
        out[i] = (corpus.weight(tf.astype(np.float32), np.float32(len(d))) * squares[term]) @ signs[term]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


PROJECTIONS: dict[int, np.ndarray] = {}


def projection(size: int) -> np.ndarray:
    if size not in PROJECTIONS:
        PROJECTIONS[size] = np.random.default_rng(0).standard_normal((size, DIMENSIONS), np.float32)
    return PROJECTIONS[size]


class ShardTree:
    """Splits the space of sketches into shards of about as many tokens each, close documents together.

    sample: sketches of some documents, weight: their tokens. Each node cuts its part at the direction in which it spreads
    most, its shards in proportion to the tokens. A part of few samples is a leaf; if it stands for more than one shard,
    these are stretches along its widest direction, as the samples lie there. A part that doesn't
    spread (copies, or one sample) is dealt to its shards by salt, so that none of them grows."""

    def __init__(self, sample: np.ndarray, weight: np.ndarray, shards: int, leaf: int = LEAF):
        self.leaf = leaf
        self.vectors, self.limits, self.kids, self.spans, self.marks = [], [], [], [], []
        self._grow(sample.astype(np.float32), weight.astype(np.float64), 0, shards)
        self.vectors, self.limits = np.array(self.vectors, np.float32), np.array(self.limits, np.float32)
        self.kids, self.spans, self.marks = np.array(self.kids, np.int64), np.array(self.spans, np.int64), np.array(self.marks, np.float32)

    def _grow(self, x: np.ndarray, weight: np.ndarray, low: int, shards: int) -> int:
        node = len(self.limits)
        self.vectors.append(np.zeros(DIMENSIONS))
        self.limits.append(0.0)
        self.kids.append((-1, -1))
        self.spans.append((low, shards))
        self.marks.append(np.full(self.leaf, np.inf))
        if shards == 1 or len(x) < 2:
            return node
        away = x - x.mean(0)
        vector = np.linalg.eigh(away.T @ away)[1][:, -1].astype(np.float32)
        at = (x * vector).sum(1)
        order = np.argsort(at, kind="stable")
        some = at[order]
        if some[-1] - some[0] < 1e-4:
            return node
        upto = np.cumsum(weight[order]) / weight.sum()
        if len(x) < 2 * self.leaf:
            self.vectors[node], self.marks[node] = vector, np.interp((np.arange(self.leaf) + 0.5) / self.leaf, upto, some)
            return node
        limit = some[max(1, min(np.searchsorted(upto, (shards // 2) / shards), len(x) - 1))]
        if limit - some[0] < 1e-4:  # many alike at the lower end stay together
            limit = some[np.searchsorted(some, limit + 1e-4)]
        left = at < limit
        n = min(max(round(shards * weight[left].sum() / weight.sum()), 1), shards - 1)
        self.vectors[node], self.limits[node] = vector, limit - 1e-6
        self.kids[node] = (self._grow(x[left], weight[left], low, n), self._grow(x[~left], weight[~left], low + n, shards - n))
        return node

    def shard(self, x: np.ndarray, salt: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while (inner := np.flatnonzero(self.kids[node, 0] >= 0)).size:
            here = node[inner]
            node[inner] = self.kids[here, ((x[inner] * self.vectors[here]).sum(1) >= self.limits[here]).astype(np.int64)]
        low, many = self.spans[node].T
        leaves = np.flatnonzero((many > 1) & np.isfinite(self.marks[node, 0]))
        place = salt % many
        marks, value = self.marks[node[leaves]], (x[leaves] * self.vectors[node[leaves]]).sum(1)[:, None]
        below, upto = (marks < value - 1e-4).sum(1), (marks <= value + 1e-4).sum(1)  # alike ones are dealt between the two
        low_end, high_end = np.maximum(below - 0.5, 0), np.minimum(upto + 0.5, self.leaf)
        share = (low_end + (salt[leaves] >> 8 & 0xFFFFF) / (1 << 20) * (high_end - low_end)) / self.leaf
        place[leaves] = (share * many[leaves]).astype(np.int64)
        return low + place


def fill_order(docs: list[np.ndarray], window: int, corpus: Corpus) -> list[int]:
    """The order in which a shard's documents are laid: a seed (the first unused), then its unused neighbours by falling
    score until its window is full. The document that overflows is cut there, and seeds the window that it begins."""
    index = Bm25(docs, corpus)
    free = np.ones(len(docs), bool)
    order: list[int] = []
    used, seed, at = 0, -1, 0
    while len(order) < len(docs):
        if seed < 0:
            while not free[at]:
                at += 1
            seed = at
            free[seed] = False
            order.append(seed)
            used = (used + len(docs[seed])) % window
        ranked = index.scores(seed)
        ranked[~free] = -1
        left = window - used
        best = np.argsort(-ranked, kind="stable")
        seed = -1
        for d in best[: int(free.sum())]:
            free[d] = False
            order.append(int(d))
            if len(docs[d]) >= left:
                used = (len(docs[d]) - left) % window
                seed = int(d) if used else -1
                break
            left -= len(docs[d])
        else:
            break
    return order


def cuts(total: int, window: int) -> list[int]:
    """Lengths of the sequences that a shard's tokens fill: whole windows, and the rest in powers of two, without padding."""
    rest = total % window
    return [window] * (total // window) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, window: int = 2048, shard_tokens: int = 1 << 19, end: int = 1, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: id, start, length, ids (bytes of unsigned 32-bit little-endian), doc_tokens, sequence_id, offset.

    Texts are encoded once, where they are read, and their ids kept in the checkpoint folder as numbers of two bytes.
    Document frequencies and the mean length are those of all documents (two numbers a task and one a term, at most the
    vocabulary). A tree over the sketches of about SAMPLE documents at most (those of the least hashes, collected: 136
    bytes each) cuts the space of BM25 vectors into shards of about shard_tokens tokens, so that documents that share rare
    terms meet, and copies are dealt to several; see ShardTree. Each shard has an inverted index of its own, in one task,
    with the weights of the whole corpus; see fill_order and cuts. Neighbours on the other side of a cut are not found;
    README gives the share. Every id lies in one piece; only the last sequences of a shard are shorter than the window,
    and each of those is a power of two long.

    sequence_id is shard * 2**32 + place. Null text is empty: one id, the end. Repeated rows are packed each, and their
    salts differ; null ids are passed through. Texts are encoded whole, however long, and a long one is cut into as many
    pieces as it needs. An empty table gives an empty result. Other columns are not read. window must be a power of two.
    tokenizer: a file for the tokenizers library, there on each worker."""
    path = tokenizer or tokenizer_path()
    kind = dict(docs.dtypes)[id_col]
    spark = docs.sparkSession
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.col(id_col)), F.lit(1 << 40))  # stays as it is once written

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        for batch in batches:
            for a, b in slices(batch.column(2), ENCODE_CHARS):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), encoder.encode(part.column(2), end)], ["salt", "id", "ids"])

    number, size = encoder_for(path).number, encoder_for(path).size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, tokens = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                ids = np.frombuffer(blob, number)
                df[distinct(ids)[0]] += 1
                n, tokens = n + 1, tokens + len(ids)
        if n:
            term = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[-2, -1, term]), pa.array(np.r_[n, tokens, df[term]])], ["term", "n"])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = [np.frombuffer(b, number) for b in batch.column(1).to_pylist()]
            x = sketches(docs, corpus.value).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([len(d) for d in docs], pa.int64())], ["salt", "x", "n"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = sketches([np.frombuffer(b, number) for b in batch.column(2).to_pylist()], corpus.value)
            yield pa.RecordBatch.from_arrays([pa.array(tree.value.shard(x, batch.column(0).to_numpy())), batch.column(1), batch.column(2)], ["shard", "id", "ids"])

    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def lay(key: tuple, table: pa.Table) -> pa.Table:
        ids_type = table.schema.field("id").type
        blobs = table.column("ids").to_pylist()
        order0 = sorted(range(len(blobs)), key=lambda i: (zlib.crc32(blobs[i]), len(blobs[i]), blobs[i]))
        tokens = [np.frombuffer(blobs[i], number) for i in order0]
        rows: dict[str, list] = {n: [] for n in names}
        lengths = cuts(sum(map(len, tokens)), window)
        seq, at = 0, 0
        source = []
        for d in fill_order(tokens, window, corpus.value):
            begun = 0
            while begun < len(tokens[d]):
                n = min(len(tokens[d]) - begun, lengths[seq] - at)
                source.append(order0[d])
                for name, value in zip(names[1:], (begun, n, tokens[d][begun : begun + n].astype("<u4").tobytes(), len(tokens[d]), (key[0].as_py() << 32) + seq, at), strict=True):
                    rows[name].append(value)
                begun += n
                at += n
                if at == lengths[seq]:
                    seq, at = seq + 1, 0
        ids = table.column("id").combine_chunks().take(pa.array(source, pa.int64()))
        return pa.table([ids.cast(ids_type), *(pa.array(rows[n], pa.binary() if n == "ids" else pa.int64()) for n in names[1:])], names)

    schema = f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    encoded = cut(docs.select(salt.alias("salt"), F.col(id_col).alias("id"), text_of(text_col)).mapInArrow(encode, f"salt long, id {kind}, ids binary"), BATCH)
    found = dict(encoded.select("ids").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    n, total = found.pop(-2, 0), found.pop(-1, 0)
    df = np.zeros(size, np.int64)
    df[list(found)] = list(found.values())
    corpus = spark.sparkContext.broadcast(Corpus(df, n, total))
    drawn = encoded.filter(F.pmod(F.xxhash64("salt"), F.lit(1 << 40)) < (1 << 40) * min(1.0, SAMPLE / max(n, 1))).select("salt", "ids").mapInArrow(draw, "salt long, x binary, n long").toArrow()
    sample = sorted(zip(*(drawn.column(c).to_pylist() for c in ("salt", "x", "n")), strict=True))
    points = np.frombuffer(b"".join(x for _, x, _ in sample), np.float16).reshape(-1, DIMENSIONS)
    tree = spark.sparkContext.broadcast(ShardTree(points, np.array([k for _, _, k in sample]), max(1, -(-total // shard_tokens))))
    sent = encoded.mapInArrow(route, f"shard long, id {kind}, ids binary")
    return sent.groupBy("shard").applyInArrow(lay, schema).withColumnRenamed("id", id_col)


def digest_pieces(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return digest_pieces(pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
