"""Best-fit packing: whole documents go into sequences, each into the open one that it fills best."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.steps import cut
from .arrays import slices
from .common import text_of
from .packing import digest_pieces, encoder_for, tokenizer_path

ENCODE_BYTES = 3_000_000  # of text encoded at a time
EMIT_ROWS, EMIT_BYTES = 4096, 4_000_000  # in a batch of results
FAN_IN = 32  # tasks whose open sequences meet in the next round

COLUMNS = ("id", "piece", "start", "length", "ids", "sequence_id", "offset", "open", "part")


class OpenBins:
    """At most `most` open bins. Bit f of a bitset says that some open bin has f left, so the best fit for a piece of n is the
    lowest bit from n on. Where none fits, a new bin is opened; if there are too many, the fullest one, which is the lowest
    bit of all, closes first."""

    def __init__(self, window: int, most: int):
        self.window, self.most = window, most
        self.bits, self.count = 0, 0
        self.by_free: dict[int, list[list]] = {}

    def _take(self, free: int) -> list:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            del self.by_free[free]
            self.bits ^= 1 << free
        self.count -= 1
        return found

    def put(self, piece: tuple, size: int) -> list[list]:
        """Puts a piece of 1 to window in its bin; returns the bins that this closes."""
        closed = []
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            held = self._take(free)
        else:
            if self.count == self.most:
                closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            free, held = self.window, []
        held.append((piece, self.window - free))
        left = free - size
        if left:
            self.by_free.setdefault(left, []).append(held)
            self.bits |= 1 << left
            self.count += 1
        else:
            closed.append(held)
        return closed

    def rest(self) -> list[list]:
        return [b for _, bins in sorted(self.by_free.items()) for b in bins]


def laid(pieces: Iterable[tuple], window: int, most: int, first_id: int, part: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """pieces (id, piece, start, length, ids) in the order in which they come, as batches of COLUMNS: those of a bin when it
    closes, and at the end those of the bins that are still open."""
    bins, rows, size, number = OpenBins(window, most), [], 0, first_id

    def out(held: list, is_open: bool) -> int:
        nonlocal number
        rows.extend((*piece, number, offset, is_open, part) for piece, offset in held)
        number += 1
        return sum(len(piece[4]) for piece, _ in held)

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        rows.clear()
        return made

    for piece in pieces:
        for held in bins.put(piece, piece[3]):
            size += out(held, False)
        if len(rows) >= EMIT_ROWS or size >= EMIT_BYTES:
            yield batch()
            size = 0
    for held in bins.rest():
        out(held, True)
        if len(rows) >= EMIT_ROWS:
            yield batch()
    if rows:
        yield batch()


def best_fit(docs: DataFrame, window: int = 4096, open_bins: int = 64, end: int = 1, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: id, piece (from 0), start, length, ids (bytes of unsigned 32-bit little-endian), sequence_id, offset.

    A document is its text's token ids and the end id. Only one of more than window ids is cut, into pieces of window ids and
    a last one that may be shorter; every other one is one piece. Each task puts its documents, in the order in which it
    reads them, into at most open_bins open sequences; see OpenBins. Sequences that are still open when a task ends give
    their pieces to the next round, where those of FAN_IN tasks meet, the longest first; rounds go on until one task is left.
    So texts are never shuffled, a task of a round holds FAN_IN * open_bins sequences at most, and the number of rounds is
    the logarithm of that of tasks. Only the sequences open at the very end are less full than they could be.

    sequence_id is unique, without further meaning. Null and empty texts are one id, the end. Long texts are encoded whole.
    Repeated rows are packed each; null ids are passed through; other columns are not read. Among equal fits the bin that
    was touched last is taken. An empty table gives an empty result. tokenizer: a file for the tokenizers library, there on
    each worker."""
    path = tokenizer or tokenizer_path()
    kind = dict(docs.dtypes)[id_col]

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encoder = encoder_for(path)
        for whole in batches:
            for a, b in slices(whole.column(1), ENCODE_BYTES):
                part = whole.slice(a, b - a)
                for key, blob in zip(part.column(0).to_pylist(), encoder.encode(part.column(1), end).to_pylist(), strict=True):
                    ids = np.frombuffer(blob, encoder.number).astype("<u4")
                    for i, start in enumerate(range(0, len(ids), window)):
                        some = ids[start : start + window]
                        yield key, i, start, len(some), some.tobytes()

    def schema_of(id_type: pa.DataType) -> pa.Schema:
        types = (id_type, pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.int64())
        return pa.schema(list(zip(COLUMNS, types, strict=True)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            part = TaskContext.get().partitionId()
            again = (x for each in ([first], batches) for x in each)
            yield from laid(pieces_of(again), window, open_bins, part << 32, part, schema_of(first.schema.field(0).type))

    def meet_in(turn: int):
        def meet(key: tuple, table: pa.Table) -> pa.Table:
            rows = table.sort_by([("length", "descending"), ("part", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")])
            pieces = zip(*(rows.column(c).to_pylist() for c in COLUMNS[:5]), strict=True)
            part = key[0].as_py()
            kinds = schema_of(table.schema.field("id").type)
            return pa.Table.from_batches(laid(pieces, window, open_bins, turn << 56 | part << 32, part, kinds), kinds)

        return meet

    schema = f"id {kind}, piece int, start long, length long, ids binary, sequence_id long, offset long, open boolean, part long"
    found = cut(docs.select(F.col(id_col).alias("id"), text_of(text_col)).mapInArrow(encode, schema))
    done = found.filter("not open")
    tasks, turn = (found.agg(F.max("part")).first()[0] or 0) + 1, 0
    while True:
        turn, tasks = turn + 1, -(-tasks // FAN_IN)
        rest = found.filter("open").withColumn("_group", F.expr(f"part div {FAN_IN}"))
        found = cut(rest.groupBy("_group").applyInArrow(meet_in(turn), schema))
        if tasks <= 1:
            break
        done = done.unionByName(found.filter("not open"))
    return done.unionByName(found).drop("open", "part").withColumnRenamed("id", id_col)


def op11_best_fit(spark, sf_dir: str) -> DataFrame:
    return digest_pieces(best_fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
