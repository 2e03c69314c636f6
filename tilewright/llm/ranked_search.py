"""Ranked lexical search: the k best documents of each item, exactly, by two trees that are descended together.

A document's score for an item is an inner product: the item's term weights times the document's impacts. A node of either
tree holds the largest number of each coordinate below it, so the product of two nodes bounds every pair under them, and a
pair of nodes goes if that is less than what the items below have already."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.steps import cut
from .arrays import slices, spans
from .common import text_of

STEP_BYTES = 1_000_000  # of terms hashed at a time
BLOCK_DOCS, BLOCK_CELLS, BLOCK_ENTRIES = 1024, 16_000_000, 400_000  # documents searched at a time, times terms, and their terms
LEAF_DOCS, LEAF_ITEMS = 16, 4
SKETCH = 16

#: Of each byte of UTF-8: 0 for what parts terms (ASCII other than letters and digits), else itself, A-Z lower-cased.
FOLDED = np.array([b if b > 127 or chr(b).isalnum() else 0 for b in range(256)], np.uint8)
FOLDED[65:91] += 32


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the terms of texts that lie side by side begin and how long they are. data: folded bytes."""
    inside = data != 0
    begins = np.zeros(len(data), bool)
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | begins[1:]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | begins[1:]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts


def hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, factor: int) -> np.ndarray:
    """A polynomial of each term's bytes."""
    powers = np.cumprod(np.full(int(sizes.max(initial=1)), factor, np.uint64))
    before = np.cumsum(sizes) - sizes
    values = (data[spans(starts, sizes)].astype(np.uint64) + np.uint64(1)) * powers[np.arange(int(sizes.sum())) - np.repeat(before, sizes)]
    return np.add.reduceat(values, before) if len(before) else np.empty(0, np.uint64)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The folded bytes of an array of strings without nulls, and where each text begins and the last ends."""
    width, kind = (8, np.int64) if pa.types.is_large_string(column.type) else (4, np.int32)
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * width).astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return FOLDED[data], offsets - offsets[0]


class Vocabulary:
    """The terms of a block of items, found in texts by hash and then held against their bytes."""

    def __init__(self, terms: list[bytes]):
        self.sizes = np.array([len(t) for t in terms], np.int64)
        self.data = np.frombuffer(b"".join(terms), np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes
        for factor in range(0x9E3779B97F4A7C15, 0x9E3779B97F4A7C15 + 200, 2):  # two of them may share a hash
            self.factor = factor
            keys = hashes(self.data, self.starts, self.sizes, factor)
            if len(np.unique(keys)) == len(keys):
                break
        else:
            raise ValueError("no hash tells the terms apart")
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def __len__(self) -> int:
        return len(self.sizes)

    def find(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(how many terms each text has; then the text, the term and the count of each pair that occurs), by text and term."""
        data, offsets = texts_of(column)
        starts, sizes = term_spans(data, offsets)
        upto = np.searchsorted(starts, offsets)
        found_at, found = [], []
        edges = np.searchsorted(np.cumsum(sizes), np.arange(STEP_BYTES, int(sizes.sum()) + STEP_BYTES, STEP_BYTES))
        low = 0
        for high in [*edges.tolist(), len(starts)]:
            if high > low:
                s, n = starts[low:high], sizes[low:high]
                keys = hashes(data, s, n, self.factor)
                at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                term = self.order[at]
                hit = np.flatnonzero((self.keys[at] == keys) & (self.sizes[term] == n))
                if len(hit):
                    term, s, n = term[hit], s[hit], n[hit]
                    same = data[spans(s, n)] == self.data[spans(self.starts[term], n)]
                    real = np.logical_and.reduceat(same, np.cumsum(n) - n)
                    found_at.append(s[real])
                    found.append(term[real])
                low = high
        if not found:
            none = np.empty(0, np.int64)
            return np.diff(upto), none, none, none
        text = np.searchsorted(offsets, np.concatenate(found_at), side="right") - 1
        pairs, count = np.unique(text * len(self) + np.concatenate(found), return_counts=True)
        return np.diff(upto), pairs // len(self), pairs % len(self), count


def tree_order(points: np.ndarray, leaf: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(the points in order of the leaves of a balanced tree, the edges of its nodes level by level). A node is halved along
    the line between two points that lie far apart."""
    order = np.arange(len(points))
    levels = [np.array([0, len(points)])]
    while len(points) / (len(levels[-1]) - 1) > leaf:
        edges = levels[-1]
        middle = (edges[:-1] + edges[1:]) // 2
        for a, m, b in zip(edges[:-1].tolist(), middle.tolist(), edges[1:].tolist(), strict=True):
            here = points[order[a:b]]
            if len(here) > 1:
                far = here[((here - here.mean(0)) ** 2).sum(1).argmax()]
                line = here[((here - far) ** 2).sum(1).argmax()] - far
                order[a:b] = order[a:b][np.argpartition(here @ line, m - a)]
        levels.append(np.sort(np.r_[edges, middle]))
    return order, levels


def maxima(rows: np.ndarray, levels: list[np.ndarray]) -> list[np.ndarray]:
    """For each level the largest coordinates of each node's rows."""
    if len(rows) == 0:
        return [np.zeros((len(e) - 1, rows.shape[1]), rows.dtype) for e in levels]
    edges = levels[-1]
    low = np.maximum.reduceat(rows, np.minimum(edges[:-1], len(rows) - 1), axis=0)
    low[edges[:-1] == edges[1:]] = 0
    out = [low]
    for _ in levels[1:]:
        out.append(np.maximum(out[-1][0::2], out[-1][1::2]))
    return out[::-1]


class Items:
    """A block of items: weights by term, and a tree over them."""

    def __init__(self, counts: np.ndarray, n_docs: int, n_terms: int, df: np.ndarray, k: int):
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for f in df.tolist()], np.int64)
        self.n_docs, self.n_terms, self.weight, self.k = n_docs, n_terms, weight, k
        self.x = counts * weight
        # sums of whole numbers below 2**53 are exact in doubles, whatever the order
        self.kind = np.float64 if int(self.x.sum(1).max(initial=0)) * 1_000_000 < 1 << 53 else np.int64
        self.x = self.x.astype(self.kind)
        signs = np.random.default_rng(0).choice(np.array([-1.0, 1.0], np.float32), (len(weight), SKETCH))
        self.signs = signs * np.sqrt(weight.astype(np.float32))[:, None]
        self.order, self.levels = tree_order(self.x.astype(np.float32) @ signs, LEAF_ITEMS)
        self.x = self.x[self.order]
        self.terms = [np.flatnonzero(r) for r in self.x]
        self.nodes = maxima(self.x, self.levels)
        self.node_terms = [[np.flatnonzero(r) for r in level] for level in self.nodes]

    def impacts(self, n: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """tf of terms in documents of n terms."""
        m = 25 + (75 * n * self.n_docs) // max(self.n_terms, 1)
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)

    def products(self, rows: np.ndarray, terms: np.ndarray, x: np.ndarray) -> np.ndarray:
        return rows[:, terms].astype(self.kind) @ x[terms]


class Best:
    """The k best documents of each item so far, and the least score that another one must reach."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.copy()
        self.rows: list[list] = [[] for _ in floors]

    def add(self, item: int, scores: np.ndarray, ids: list) -> None:
        rows = self.rows[item]
        rows += [(-int(s), d is not None, 0 if d is None else d) for s, d in zip(scores.tolist(), ids, strict=True)]
        rows.sort()
        del rows[self.k :]
        if len(rows) == self.k:
            self.floors[item] = max(self.floors[item], -rows[-1][0])


def search_block(items: Items, best: Best, ids: list, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
    """Searches some documents, given by (document, term, impact) triples in order of document, for all items."""
    n = len(ids)
    sketch = np.zeros((n, SKETCH), np.float32)
    begins = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.empty(0, np.int64)
    if not len(begins):
        return
    sketch[doc[begins]] = np.add.reduceat(items.signs[term] * impact[:, None].astype(np.float32), begins, axis=0)
    order, levels = tree_order(sketch, LEAF_DOCS)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    rows = np.zeros((n, len(items.weight)), np.float32)  # impacts are less than a million: exact
    rows[place[doc], term] = impact
    nodes = maxima(rows, levels)
    pairs = [(0, np.array([0]))]  # a node of items, and the nodes of documents that it may meet
    depth = max(len(levels), len(items.levels))
    for level in range(depth):
        i, d = min(level, len(items.levels) - 1), min(level, len(levels) - 1)
        item_edges, deeper = items.levels[i], []
        for q, met in pairs:
            a, b = item_edges[q], item_edges[q + 1]
            if a == b:
                continue
            terms = items.node_terms[i][q]
            bounds = items.products(nodes[d][met], terms, items.nodes[i][q])
            met = met[bounds >= max(1, best.floors[a:b].min())]
            if not len(met):
                continue
            if level + 1 == depth:
                deeper.append((q, met))
            else:
                met = (2 * met[:, None] + np.arange(2)).ravel() if d + 1 < len(levels) else met
                deeper += [(2 * q + side, met) for side in (0, 1)] if i + 1 < len(items.levels) else [(q, met)]
        pairs = deeper
    leaves, edges = nodes[-1], levels[-1]
    for q, met in pairs:
        for item in range(items.levels[-1][q], items.levels[-1][q + 1]):
            terms, x = items.terms[item], items.x[item]
            bounds = items.products(leaves[met], terms, x)
            by_bound = np.argsort(-bounds, kind="stable")
            for some in (by_bound[:4], by_bound[4:]):  # the most promising leaves first: they raise the floor
                some = met[some[bounds[some] >= max(1, best.floors[item])]]
                at = spans(edges[some], edges[some + 1] - edges[some])
                if len(at):
                    scores = items.products(rows[at], terms, x)
                    good = np.flatnonzero(scores >= max(1, best.floors[item]))
                    if len(good) > best.k:
                        good = good[scores[good] >= np.partition(scores[good], -best.k)[-best.k]]
                    best.add(item, scores[good], [ids[order[p]] for p in at[good].tolist()])


def find_best(batches: Iterator[pa.RecordBatch], items: Items, floors: np.ndarray, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The best documents of a task's: batches (id, n, terms, tf) as rows item, id, score."""
    best = Best(floors, items.k)
    for batch in batches:
        low = 0
        sizes = np.array([len(t) // 4 for t in batch.column(2).to_pylist()], np.int64)
        most = max(LEAF_DOCS, min(BLOCK_DOCS, BLOCK_CELLS // len(items.weight)))
        runs = np.arange(len(sizes)) // most + np.cumsum(sizes) // BLOCK_ENTRIES
        for high in [*(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(sizes)]:
            part = batch.slice(low, high - low)
            term, tf = (np.frombuffer(b"".join(part.column(c).to_pylist()), "<u4").astype(np.int64) for c in (2, 3))
            doc = np.repeat(np.arange(high - low), sizes[low:high])
            search_block(items, best, part.column(0).to_pylist(), doc, term, items.impacts(part.column(1).to_numpy()[doc], tf))
            low = high
    rows = [(int(items.order[i]), d if known else None, -s) for i, found in enumerate(best.rows) for s, known, d in found]
    if rows:
        item, ids, score = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, id_type), pa.array(score, pa.int64())], ["item", "id", "score"])


def item_blocks(items: DataFrame, most_items: int, most_terms: int) -> Iterator[tuple[list, list[dict[bytes, int]]]]:
    """Blocks of (ids, term counts) with so many items and pairs at most, or one longer item."""
    ids, counts, size = [], [], 0
    for key, text in items.toLocalIterator(prefetchPartitions=False):
        data, offsets = texts_of(pa.array([text], pa.large_string()))
        starts, sizes = term_spans(data, offsets)
        raw, own = data.tobytes(), {}
        for s, n in zip(starts.tolist(), sizes.tolist(), strict=True):
            term = raw[s : s + n]
            own[term] = own.get(term, 0) + 1
        if ids and (len(ids) == most_items or size + len(own) > most_terms):
            yield ids, counts
            ids, counts, size = [], [], 0
        ids.append(key)
        counts.append(own)
        size += len(own)
    if ids:
        yield ids, counts


def best_by(found: DataFrame, k: int, *order: Column) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)


def search_items(docs: DataFrame, ids: list, counts: list[dict[bytes, int]], id_kind: T.DataType, k: int, sample: int) -> DataFrame | None:
    """One block of items over all documents."""
    spark = docs.sparkSession
    terms = sorted({t for own in counts for t in own})
    if not terms:
        return None
    number = {t: i for i, t in enumerate(terms)}
    table = np.zeros((len(counts), len(terms)), np.int64)
    for i, own in enumerate(counts):
        for t, n in own.items():
            table[i, number[t]] = n
    vocabulary = spark.sparkContext.broadcast(Vocabulary(terms))
    doc_kind = docs.schema["id"].dataType.simpleString()

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low, high in slices(whole.column(1), 4 * STEP_BYTES):
                part = whole.slice(low, high - low)
                n, doc, term, tf = vocabulary.value.find(part.column(1))
                edges = (np.searchsorted(doc, np.arange(high - low + 1)) * 4).astype(np.int32)
                packed = [pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(edges), pa.py_buffer(v.astype("<u4"))]) for v in (term, tf)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), *packed], ["id", "n", "terms", "tf"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, n_terms = np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            n = batch.column(0).to_numpy()
            df += np.bincount(np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4"), minlength=len(terms))
            n_docs, n_terms = n_docs + int((n > 0).sum()), n_terms + int(n.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-2, -1, some]), pa.array(np.r_[n_docs, n_terms, df[some]])], ["term", "n"])

    found = cut(docs.mapInArrow(vectors, f"id {doc_kind}, n long, terms binary, tf binary"))
    sums = dict(found.select("n", "terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    df = np.array([sums.get(i, 0) for i in range(len(terms))], np.int64)
    items = spark.sparkContext.broadcast(Items(table, sums.get(-2, 0), sums.get(-1, 0), df, k))

    def search(rows: DataFrame, floors: np.ndarray) -> DataFrame:
        told = spark.sparkContext.broadcast(floors)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = next(batches, None)
            if first is not None:
                yield from find_best((x for each in ([first], batches) for x in each), items.value, told.value, first.schema.field(0).type)

        return best_by(rows.mapInArrow(run, f"item int, id {doc_kind}, score long"), k, F.desc("score"), F.col("id").asc_nulls_first())

    some = found.filter((F.col("n") > 0) & (F.pmod(F.xxhash64("id", "n", "terms"), F.lit(sample)) == 0))
    place = np.argsort(items.value.order)
    floors = np.zeros(len(ids), np.int64)
    for row in search(some, floors).filter(F.col("rank") == k).select("item", "score").collect():  # one row an item
        floors[place[row["item"]]] = row["score"]
    names = spark.createDataFrame([Row(item=i, item_id=v) for i, v in enumerate(ids)], T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", id_kind)]))
    ranked = search(found.filter(F.octet_length("terms") > 0), floors)
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, most_items: int = 256, most_terms: int = 16_384, sample: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents (id_col, text_col) of each item (item_id, text), by falling score,
    then rising id. The score is BM25 in whole numbers; only scores above 0 count.

    Items come to the driver and to tasks in blocks of most_items, and of most_terms different terms together, so what is
    broadcast is bounded; each block is one pass over the documents. Their texts are read in one scan, which keeps of each the
    number of its terms and the counts of those that some item has. Document frequencies and mean length are those of
    all documents. Of one in `sample` documents, by a hash, the kth best scores are found first: lower bounds that let the
    search of all documents prune. That search is exact, each task descending the items' tree and one over a block of its
    documents (see search_block), and returns at most k rows an item.

    Null texts have no terms, and items without terms have no rows. Long texts are read whole. Each row is an item or a document of
    its own: ids may repeat, null ids are passed through, and null document ids rank before others. Empty tables give an
    empty result; other columns are not read."""
    kind = items.schema["item_id"].dataType
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    asked = items.select("item_id", text_of("text"))
    found = [r for r in (search_items(rows, ids, counts, kind, k, sample) for ids, counts in item_blocks(asked, most_items, most_terms)) if r is not None]
    if not found:
        doc_kind = rows.schema["id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id {doc_kind}, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: fixed value: what a term is
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP12_SQL = f"""WITH words AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '{TERM}') AS ts FROM documents),
    d AS (SELECT r, doc_id, len(ts)::BIGINT AS n, ts FROM words WHERE len(ts) > 0),
    q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS t FROM benchmark) GROUP BY 1, 2),
    p AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY 1, 2, 3, 4),
    s AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM d), f AS (SELECT t, count(*) AS df FROM p GROUP BY t),
    w AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM f, s),
    g AS (SELECT item_id, doc_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // l))))::BIGINT AS score FROM p JOIN q USING (t) JOIN w USING (t), s GROUP BY 1, 2, 3)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM g WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10"""
