"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets verify them, links make classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.steps import cut
from .common import KeyFilter, attach, one_of_each, text_of

ODD = np.uint64(0x9E3779B97F4A7C15)
BATCH = 1024  # documents whose texts a task has at a time at most
WIDTH = 1024  # n-grams in a block of the incidence matrix
GRAMS = 2048  # n-grams that a node has on average at most, where blocks are sized


def choose_bands(threshold: float, recall: float, stray: float = 0.4, most_stray: float = 0.1) -> tuple[int, int]:
    """(bands, rows): the fewest hash functions with which a pair at the threshold shares a band with probability recall
    at least, and a pair of similarity stray does with probability most_stray at most."""
    best = None
    for rows in range(1, 33):
        bands = int(np.ceil(np.log(1 - recall) / np.log1p(-(threshold**rows))))
        if 1 - (1 - stray**rows) ** bands <= most_stray and (best is None or bands * rows < best[0] * best[1]):
            best = bands, rows
    if best is None:
        raise ValueError("no number of bands reaches this recall")
    return best


def ngrams(text: str, n: int) -> np.ndarray:
    """The sorted set of a text's n-word shingles as 64-bit hashes; a shorter text is one shingle, one without words none."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(n, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for i in range(size):
        out = (out + h[i : len(h) - size + 1 + i]) * ODD
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(grams: np.ndarray, factors: np.ndarray) -> np.ndarray:
    out = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 512):
        np.minimum(out, (grams[at : at + 512, None] * factors[None, :]).min(axis=0), out=out)
    return out


def sketch(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """id, hash of the text, digest of the n-gram set and a hash for each band (both null for a text without words), and how
    many n-grams there are."""
    factors = np.random.default_rng(7).integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 1024) for b in batches for at in range(0, b.num_rows, 1024)):
            digests, hashes, sizes = [], [], []
            for text in batch.column(2).to_pylist():
                grams = ngrams(text, n)
                sizes.append(len(grams))
                if len(grams):
                    s = signature(grams, factors).reshape(bands, rows)
                    digests.append(xxhash.xxh128_digest(grams.tobytes()))
                    hashes.append([xxhash.xxh64_intdigest(s[b].tobytes(), seed=b) - (1 << 63) for b in range(bands)])
                else:
                    digests.append(None)
                    hashes.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.int64())], ["id", "text_hash", "digest", "bands", "grams"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)), text_of(text_col)).mapInArrow(run, f"id {kind}, text_hash long, digest binary, bands array<bigint>, grams long")


def gram_sets(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """digest and the n-gram set as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                sets = [g.tobytes() for t in batch.column(0).slice(at, 256).to_pylist() if len(g := ngrams(t, n))]
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh128_digest(g) for g in sets], pa.binary()), pa.array(sets, pa.binary())], ["digest", "grams"])

    return docs.select(text_of(text_col)).mapInArrow(run, "digest binary, grams binary")


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements sets[i] and sets[j] share, i of left and j of right, by products of incidence blocks."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, counts = np.unique(flat, return_inverse=True, return_counts=True)
    often = counts > 1
    rank = np.cumsum(often) - 1
    keep = often[code]
    code, owner = rank[code[keep]], owner[keep]
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    for at in range(0, int(often.sum()), WIDTH):
        lo, hi = np.searchsorted(code, (at, at + WIDTH))
        grid = np.zeros((len(sets), WIDTH), np.float32)
        grid[owner[lo:hi], code[lo:hi] - at] = 1
        out += grid[left] @ grid[right].T
    return out


def links_in_block(group: pd.DataFrame, threshold: float) -> list[tuple[bytes, bytes, int]]:
    """Verified links of one bucket's block, or pair of blocks: (node, root of its tree of links here, documents linked).

    A pair counts only in the first band that it shares, so that no link counts twice."""
    group = group.drop_duplicates("digest")
    if len(group) < 2:
        return []
    names, copies, band = group["digest"].tolist(), group["copies"].to_numpy(), int(group["band"].iloc[0])
    sets = [np.frombuffer(g, np.uint64) for g in group["grams"]]
    sizes = np.array([len(s) for s in sets])
    bands = np.stack(group["bands"].to_numpy())
    one = int(group["pi"].iloc[0]) == int(group["pj"].iloc[0])
    left = np.arange(len(group)) if one else np.flatnonzero(group["block"] == group["pi"])
    right = left if one else np.flatnonzero(group["block"] != group["pi"])
    if not len(left) or not len(right):
        return []
    fresh = ~(bands[left][:, None, 0] == bands[right][None, :, 0]) if band else np.ones((len(left), len(right)), bool)
    for b in range(1, band):
        fresh &= ~(bands[left][:, None, b] == bands[right][None, :, b])
    if one:
        fresh &= np.tri(len(left), k=-1, dtype=bool)
    fresh &= np.minimum(sizes[left][:, None], sizes[right][None, :]) >= threshold * np.maximum(sizes[left][:, None], sizes[right][None, :]) - 1e-9
    i, j = np.nonzero(fresh)
    if not len(i):
        return []
    if len(i) <= 64:
        shared = np.array([len(np.intersect1d(sets[left[a]], sets[right[b]], assume_unique=True)) for a, b in zip(i, j, strict=True)])
    else:
        shared = overlaps(sets, left, right)[i, j]
    i, j = left[i], right[j]
    linked = shared >= threshold * (sizes[i] + sizes[j] - shared) - 1e-9
    i, j = i[linked], j[linked]
    links = np.zeros(len(group), np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    root = np.arange(len(group))
    while True:  # the least number on either side of each link, until nothing changes
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            break
        root = low
    return [(names[x], names[root[x]], int(links[x])) for x in np.flatnonzero(links)]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for the nodes of edges. Each round a node joins its least neighbour and edges are drawn between what
    they became; nodes are hashes, so about half of them go each round. No component is ever gathered."""
    edges, maps = cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct()), []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
        low = both.groupBy(F.col("a").alias("node")).agg(F.min(ranked("b")).alias("low"))
        least = cut(low.select("node", F.least(ranked("node"), "low")["n"].alias("root")))
        maps.append(least)
        x, y = least.toDF("a", "ra"), least.toDF("b", "rb")
        edges = cut(edges.join(x, "a").join(y, "b").filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0]
    for m in maps[1:]:
        out = out.join(m.toDF("root", "up"), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return cut(out)


def classes(docs: DataFrame, id_col: str, text_col: str, n: int, threshold: float, recall: float, block: int, filter_bits: int, salts: int) -> DataFrame:
    """What near_duplicates tells of each row, with its text_hash and `kept`: is it the first of its class by id and hash?
    n_links is null for a row that is alone."""
    bands, rows = choose_bands(threshold, recall)
    base = cut(sketch(docs, id_col, text_col, n, bands, rows), BATCH)
    first = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    nodes = cut(base.filter("digest is not null").groupBy("digest").agg(F.min(first).alias("rep"), F.count("*").alias("copies"), F.any_value("bands").alias("bands"), F.any_value("grams").alias("grams")))
    met = nodes.select("digest", "grams", F.posexplode("bands").alias("band", "h")).select("digest", "grams", "band", F.xxhash64("band", "h").alias("key"))
    size = F.xxhash64("digest").cast("decimal(38,0)")
    buckets = met.groupBy("key").agg(F.min("band").alias("band"), F.count("*").alias("m"), F.sum("grams").alias("all_grams"), F.sum(size).alias("members")).filter("m > 1")
    blocks = F.greatest(F.ceil(F.col("m") / block), F.ceil(F.col("all_grams") / (block * GRAMS))).cast("int").alias("blocks")
    buckets = cut(buckets.groupBy("members", "m", "all_grams").agg(F.min(F.struct("band", "key")).alias("first")).select("first.key", "m", "all_grams", blocks))
    near = KeyFilter(buckets, F.col("key"), filter_bits).mark(met.drop("grams"), F.col("key"), "_may").filter("_may").drop("_may")
    shared = cut(near.join(buckets, "key"))
    used = cut(nodes.join(shared.select("digest").distinct(), "digest", "left_semi"))
    key = F.struct("id", "text_hash")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    marked = KeyFilter(used, F.struct("rep.id", "rep.text_hash"), filter_bits).mark(texts, key, "_may").filter("_may").drop("_may")
    repeated = base.groupBy(key.alias("key")).agg(F.lit(True).alias("kept"), F.count("*").alias("n"))
    sets = gram_sets(one_of_each(marked, key, repeated), "id", "text", n).join(used.drop("grams"), "digest")

    mine = F.pmod(F.xxhash64("digest", F.lit(3)), "blocks").cast("int")
    dealt = shared.withColumn("block", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("digest", "band", "key", "block", F.least("block", "other").alias("pi"), F.greatest("block", "other").alias("pj"))
    amount = buckets.agg(F.coalesce(F.sum(F.col("m") * F.col("blocks")), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("all_grams") * F.col("blocks")), F.lit(0)).alias("grams")).first()
    bins = max(1, -(-amount["rows"] // block), -(-amount["grams"] // (block * GRAMS)))
    dealt = dealt.withColumn("bin", F.pmod(F.xxhash64("key", "pi", "pj"), F.lit(bins)))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [x for _, g in pdf.groupby(["key", "pi", "pj"], sort=False) for x in links_in_block(g, threshold)]
        return pd.DataFrame(found, columns=["node", "root", "links"])

    verified = cut(dealt.join(sets, "digest").groupBy("bin").applyInPandas(verify, "node binary, root binary, links long"), BATCH)
    links = verified.groupBy(F.col("node").alias("digest")).agg(F.sum("links").alias("links"))
    roots = components(verified, "node", "root").withColumnRenamed("node", "digest")
    known = nodes.select("digest", "rep", "copies")
    firsts = roots.join(known, "digest").groupBy("root").agg(F.min("rep").alias("first"))
    linked = cut(roots.join(firsts, "root").join(links, "digest", "left").select("digest", "first", "links"))
    own = cut(known.join(linked, "digest", "left").filter("copies > 1 or first is not null").select("digest", F.coalesce("first", "rep").alias("first"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    alone = F.concat(F.lit("id:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary")  # no group has this key
    told = attach(base.select("id", "text_hash", F.coalesce("digest", alone).alias("digest")), own, "digest", "id", salts)
    is_first = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash"))
    return told.select("id", "text_hash", F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("class_id"), "n_links", (F.col("n_links").isNull() | is_first).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, recall: float = 0.999, block: int = 1024, filter_bits: int = 1 << 28, salts: int = 64) -> DataFrame:
    """One row a document: the id, class_id (least id of its class) and n_links (other documents with similarity >= threshold).

    Similarity is Jaccard's on sets of n-word shingles. Documents with equal sets are copies: one node, however many.
    Each node has `bands` band hashes, bands and rows being chosen for recall at the threshold (higher above it). Nodes
    meet in a bucket by band hash; buckets with the same members are compared once (found by sums of member hashes, so no
    bucket is listed). Only nodes that share a bucket have their n-gram sets made; they are dealt, in blocks of about
    `block` nodes and block * GRAMS n-grams at most, to bins of that size, in which numpy verifies each pair that meets
    there for the first time. What leaves a bin is a row for each node with links: how many, and the root of its tree of
    links. Pairs are never rows, and a bucket with a third of all rows is spread over many bins; every pair in it is still
    compared, since links are counted. Classes are the connected components of links.

    Null text counts as empty. A text without words has no link and is its own class; one with fewer than n words is one
    shingle; a long text is one set, whole. Null ids stay null, their class is that of their text. Repeated rows are
    copies. An empty table gives an empty result. Other columns are not read."""
    found = classes(docs, id_col, text_col, n, threshold, recall, block, filter_bits, salts)
    return found.select(F.col("id").alias(id_col), "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def op5_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, recall: float = 0.999, block: int = 1024, filter_bits: int = 1 << 28, salts: int = 64) -> DataFrame:
    """docs with one document of each class, that of the least id; all columns stay as they are.

    Of several rows with that id (or of a class with null ids alone) the one with the least hash of its text stays, and of
    equal rows one (see one_of_each). Texts without words all stay, null ones too. Only rows that may go are shuffled. An
    empty table stays empty."""
    told = cut(classes(docs, id_col, text_col, n, threshold, recall, block, filter_bits, salts).filter("n_links is not null"))
    found = told.groupBy(F.struct("id", "text_hash").alias("key"), "kept").agg(F.count("*").alias("n"))
    return one_of_each(docs, F.struct(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash")), found)
