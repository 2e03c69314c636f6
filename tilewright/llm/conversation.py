"""Conversation structure repair: the cheapest edits that leave a system message at most, then user and assistant in turn.

The edits of a conversation are a shortest path through states (what came last) and rows. Costs to the end are computed
backwards in chunks of rows that run side by side, from a guess of what follows; a chunk is run again where the guess was
wrong by more than a constant. Edits are then traced forwards, each the least letter that stays on a cheapest path."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.steps import cut, in_order

BLANKS = " \t\n\x0b\x0c\r"
CHUNK = 1024  # rows
FAN = 32

#: States: nothing yet, after system, after user, after assistant. What an inserted or re-roled row leads to, by state.
TURN = (2, 2, 3, 2)
#: What a kept row leads to, by its role's initial (s, u, a, any other) and state; None if it can't be kept.
KEPT = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None), (None, None, None, None))
ENDS = (True, False, False, True)  # a conversation may be empty, or end after an assistant
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5

Vector = tuple[int, int, int, int]


def with_inserts(costs: list[float]) -> list[float]:
    """Costs from each state when rows may be inserted first."""
    start, system, user, assistant = costs
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return [min(start, INSERT + user), min(system, INSERT + user), user, assistant]


def relative(costs: list[float]) -> Vector:
    """Vectors that differ by a constant have one form."""
    return tuple(c - costs[0] for c in costs)


def from_row(after: Vector, code: int) -> list[float]:
    """Costs from before a row, given those from after it. code: initial + 4 if truncated + 8 if it must go."""
    costs = []
    extra = TRUNCATED if code & 4 else 0
    for state in range(4):
        best = DELETE + after[state]
        if not code & 8:
            kept = KEPT[code & 3][state]
            best = min(best, REROLE + extra + after[TURN[state]], best if kept is None else extra + after[kept])
        costs.append(best)
    return with_inserts(costs)


#: What follows the last row; also the guess of what follows a chunk.
END: Vector = relative(with_inserts([0 if e else 1e9 for e in ENDS]))


class Steps:
    """Both directions, remembered: relative vectors are few, so a row is a lookup."""

    def __init__(self):
        self.back: dict[tuple[Vector, int], Vector] = {}
        self.forth: dict[tuple[Vector, int, int], tuple[str, int]] = {}

    def before(self, after: Vector, code: int) -> Vector:
        key = (after, code)
        if key not in self.back:
            self.back[key] = relative(from_row(after, code))
        return self.back[key]

    def vectors(self, codes: list[int], after: Vector) -> list[Vector]:
        """The vector after each row, and at last the one before all: from the last row to the first."""
        out = [after]
        for code in reversed(codes):
            out.append(self.before(out[-1], code))
        return out

    def rerun(self, codes: list[int], old: Vector, new: Vector, left: Vector) -> Vector:
        """The vector before all rows for what truly follows. As soon as it differs from the old run by a constant only, the rest
        of that run, and so left, holds."""
        for code in reversed(codes):
            if old == new:
                return left
            old, new = self.before(old, code), self.before(new, code)
        return new

    def edit(self, after: Vector, code: int, state: int) -> tuple[str, int]:
        """The edits at a row from a state, and the state after: inserts (u, a), then D, K, or U or A for a new role."""
        key = (after, code, state)
        if key not in self.forth:
            costs, extra, edits, at = from_row(after, code), TRUNCATED if code & 4 else 0, "", state
            while True:
                turn = TURN[at]
                kept = None if code & 8 else KEPT[code & 3][at]
                if costs[at] == DELETE + after[at]:
                    edits += "D"
                elif costs[at] == INSERT + costs[turn]:
                    edits, at = edits + ".?ua"[turn], turn
                    continue
                elif kept is not None and costs[at] == extra + after[kept]:
                    edits, at = edits + "K", kept
                else:
                    edits, at = edits + "..UA"[turn], turn
                break
            self.forth[key] = (edits, at)
        return self.forth[key]

    def trace(self, codes: list[int], after: Vector, state: int, last: bool) -> tuple[list[str], int]:
        vectors = self.vectors(codes, after)
        edits = []
        for i, code in enumerate(codes):
            done, state = self.edit(vectors[len(codes) - 1 - i], code, state)
            edits.append(done)
        while last and not ENDS[state]:
            state = TURN[state]
            edits[-1] += ".?ua"[state]
        return edits, state


STEPS = Steps()  # of this process


def numbers(vector: Vector) -> list[int]:
    return [int(v) for v in vector]


def batch_of(old: pa.RecordBatch, **new: pa.Array) -> pa.RecordBatch:
    """A batch with columns replaced or added."""
    columns = dict(zip(old.schema.names, old.columns, strict=True)) | new
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


INTS = pa.list_(pa.int32())


def run_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first run of each chunk, from the guess."""
    for b in batches:
        lefts = [numbers(STEPS.vectors(codes, END)[-1]) for codes in b.column("codes").to_pylist()]
        yield batch_of(b, after=pa.array([numbers(END)] * len(lefts), INTS), before=pa.array(lefts, INTS))


def fix_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of groups from right to left: each one is run again from what its right neighbour says."""
    group, told = None, None
    for b in batches:
        after, before = [], []
        for key, block, part, codes, old, left, given in zip(*(b.column(c).to_pylist() for c in ("key", "block", "part", "codes", "after", "before", "given")), strict=True):
            if group != (key, part, block + 1):
                told = given
            new = tuple(old if told is None else told)
            told = numbers(STEPS.rerun(codes, tuple(old), new, tuple(left)))
            after.append(numbers(new))
            before.append(told)
            group = (key, part, block)
        yield batch_of(b, after=pa.array(after, INTS), before=pa.array(before, INTS))


def exits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To which state each state at a chunk's begin leads."""
    for b in batches:
        each = zip(b.column("codes").to_pylist(), b.column("after").to_pylist(), strict=True)
        exits = [[STEPS.trace(codes, tuple(after), state, False)[1] for state in range(4)] for codes, after in each]
        yield batch_of(b.select(["key", "block"]), exits=pa.array(exits, INTS))


def entries_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state at each chunk's begin, from the first chunk of a conversation on."""
    at, state = None, 0
    for b in batches:
        entries = []
        for key, exits in zip(b.column("key").to_pylist(), b.column("exits").to_pylist(), strict=True):
            state = state if key == at else 0
            entries.append(state)
            at, state = key, exits[state]
        yield batch_of(b.select(["key", "block"]), entry=pa.array(entries, pa.int32()))


def trace_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        each = zip(*(b.column(c).to_pylist() for c in ("codes", "after", "entry", "last")), strict=True)
        edits = [STEPS.trace(codes, tuple(after), entry, last)[0] for codes, after, entry, last in each]
        yield pa.RecordBatch.from_arrays([b.column("first"), pa.array(edits, pa.list_(pa.string()))], ["first", "edits"])


def key_of(conv: str) -> Column:
    """A conversation's id as text that is never null."""
    return F.coalesce(F.concat(F.lit(":"), F.col(conv).cast("string")), F.lit(""))


def placed_rows(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) with key, place and code; see from_row. Nulls in role and text are one space."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    named = rows.select(key_of("conv_id").alias("key"), "turn", role.alias("role"), text.alias("text"))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    copy = F.xxhash64(F.monotonically_increasing_id())  # equal rows of a conversation are spread, too
    return in_order(named.withColumns({"digest": digest, "_copy": copy}), F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("_copy")).drop("_copy")


def faults(placed: DataFrame) -> DataFrame:
    """key, place, turn, initial, fault (blank, duplicate, truncated or null) and illegal of each row: no texts. Rows meet the first
    ones of their kind, and the ones before them, by place, which is unique: no key is hot."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    narrow = placed.select("key", "place", "turn", F.substring("role", 1, 1).alias("initial"), (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("open_end"))
    firsts = placed.groupBy("key", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("is_first"))
    before = narrow.select((F.col("place") + 1).alias("place"), F.col("key").alias("_key"), F.col("initial").alias("_initial"))
    joined = narrow.join(firsts, "place", "left").join(before, "place", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("is_first").isNull(), "duplicate").when(F.col("open_end"), "truncated")
    illegal = (F.col("_key") == F.col("key")) & ~F.concat("_initial", "initial").isin("su", "ua", "au")
    return joined.select("key", "place", "turn", "initial", fault.alias("fault"), F.coalesce(illegal, F.lit(False)).alias("illegal"))


def edits_of(found: DataFrame, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """place and edits of each row; see Steps.edit. Inserts behind a conversation's last row stand with it.

    A chunk is a conversation's rows among `chunk` places. Where a conversation has several, fix-up passes compare what each
    was run with to what its right neighbour says now, and run the chunks again until no vector differs by more than a
    constant. A pass goes through groups of fan, then fan**2, ... chunks, so passes are few even where costs don't converge,
    as in a long run of truncated rows; what a pass moves is a byte a row."""
    letter = F.col("initial")
    code = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3) + F.when(F.col("fault") == "truncated", 4).when(F.col("fault").isNotNull(), 8).otherwise(0)
    listed = found.select("key", F.expr(f"place div {chunk}").alias("block"), "place", code.alias("code"))
    packed = listed.groupBy("key", "block").agg(F.min("place").alias("first"), F.sort_array(F.collect_list(F.struct("place", "code")))["code"].alias("codes"))
    kinds = "key string, block long, first long, codes array<int>, after array<int>, before array<int>"
    chunks = cut(packed.mapInArrow(run_chunks, kinds))
    ends = chunks.groupBy("key").agg(F.min("block").alias("low"), F.max("block").alias("high"))
    ends = cut(ends)
    many = ends.filter("low < high")
    alone = chunks.join(ends.filter("low = high").select("key"), "key", "left_semi").select("first", "codes", "after", F.lit(0).alias("entry"), F.lit(True).alias("last"))
    several = cut(chunks.join(many, "key").withColumn("last", F.col("block") == F.col("high")).drop("low", "high"))
    if not several.isEmpty():
        size = fan
        while True:
            given = several.select("key", (F.col("block") - 1).alias("block"), F.col("before").alias("given"))
            told = several.join(given, ["key", "block"], "left")
            if told.filter("given <> after").isEmpty():
                break
            part = F.expr(f"block div {size}")
            dealt = told.withColumn("part", part).repartition("key", "part").sortWithinPartitions("key", F.col("block").desc())
            several = cut(dealt.mapInArrow(fix_chunks, f"{kinds}, last boolean, given array<int>, part long").drop("given", "part"))
            size *= fan
        exits = several.mapInArrow(exits_of, "key string, block long, exits array<int>")
        entries = exits.repartition("key").sortWithinPartitions("key", "block").mapInArrow(entries_of, "key string, block long, entry int")
        alone = alone.unionByName(several.join(entries, ["key", "block"]).select("first", "codes", "after", "entry", "last"))
    traced = alone.mapInArrow(trace_chunks, "first long, edits array<string>")
    return traced.select("first", F.posexplode("edits").alias("i", "edits")).select((F.col("first") + F.col("i")).alias("place"), "edits")


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation and place as one a conversation. A conversation's text passes by batches and is not kept."""
    key = sha = None
    audit: list[str] = []
    cost, empty = 0, True
    schema = pa.schema([("key", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    for b in batches:
        done = []
        for k, letters, c, lines in zip(*(b.column(n).to_pylist() for n in ("key", "letters", "cost", "lines")), strict=True):
            if k != key:
                if sha is not None:
                    done.append((key, cost, "".join(audit), sha.hexdigest()))
                key, sha, audit, cost, empty = k, hashlib.sha256(), [], 0, True
            audit.append(letters)
            cost += c
            if lines:
                sha.update(lines[1:] if empty else lines)  # each line begins with its newline
                empty = False
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((key, cost, "".join(audit), sha.hexdigest()), schema, strict=True)], schema=schema)


def repair(rows: DataFrame, chunk: int = CHUNK, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """rows (conv_id, turn, role, text): (faults and edits by row: key, place, turn, role, text, fault, illegal, edits; the repaired
    lines: key, place, nth, role, text). key is ':' and the id as text, or empty for a null id.

    A conversation's rows are in order of turn (nulls first), role and a hash of role and text. blank: no character but the six ASCII
    blanks; duplicate: an earlier row has its role and text; truncated: its last other character is none of .!?; the first
    of these counts. Nulls in role and text are one space. A role counts by its first character, and only s, u and a can
    be kept; an empty role has none. Costs: keep 0, a new role 1, delete 2 (blank and duplicate rows must go), insert 5, and 5
    for each truncated row that stays. Of cheapest repairs the one with the ASCII-least letters is taken. Long texts are
    read whole, and rows that repeat are duplicates; an empty table gives empty results, and other columns are not read.

    A conversation of any length is spread over tasks by place; see edits_of."""
    placed = placed_rows(rows)
    found = cut(faults(placed))
    edits = cut(edits_of(found, chunk, fan))
    every = placed.select("key", "place", "role", "text").join(found.select("place", "turn", "fault", "illegal"), "place").join(edits, "place")
    steps = every.select("key", "place", "role", "text", F.posexplode(F.split("edits", "")).alias("nth", "step")).filter("step not in ('D', '')")
    new_role = F.when(F.lower("step") == "u", "user").when(F.lower("step") == "a", "assistant").otherwise(F.col("role"))
    lines = steps.select("key", "place", "nth", new_role.alias("role"), F.when(F.col("step").isin("u", "a"), "").otherwise(F.col("text")).alias("text"))
    return every, lines


def summaries(every: DataFrame) -> DataFrame:
    """One row a conversation: key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A hash over a whole conversation can't be cut, so one task reads a conversation's lines in order, batch by batch; it
    keeps only the letters."""
    count = lambda c: F.count_if(c).alias
    sums = every.groupBy("key").agg(count(F.col("fault") == "blank")("blank"), count(F.col("fault") == "duplicate")("duplicate"), count(F.col("fault") == "truncated")("truncated"), count(F.col("illegal"))("illegal"))
    turns = every.filter("turn is not null").groupBy("key", "turn").agg(F.lit(1).alias("one")).groupBy("key").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    letters = F.translate("edits", "uaUA", "IIRR")
    many = lambda x: F.length("letters") - F.length(F.replace("letters", F.lit(x)))
    stays = (F.col("fault") == "truncated") & ~F.contains("letters", F.lit("D"))
    cost = many("D") * DELETE + many("I") * INSERT + many("R") * REROLE + F.when(stays, TRUNCATED).otherwise(0)
    line = lambda x: F.when(x == "u", "\nuser:").when(x == "a", "\nassistant:").when(x == "K", F.concat(F.lit("\n"), "role", F.lit(":"), "text")).when(x == "U", F.concat(F.lit("\nuser:"), "text")).when(x == "A", F.concat(F.lit("\nassistant:"), "text")).otherwise("")
    lines = F.array_join(F.transform(F.split("edits", ""), line), "").cast("binary")
    told = every.withColumn("letters", letters).select("key", "place", "letters", cost.cast("long").alias("cost"), lines.alias("lines"))
    audits = told.repartition("key").sortWithinPartitions("key", "place").mapInArrow(digests, "key string, cost long, audit string, repaired_sha256 string")
    return sums.join(turns, "key", "left").join(audits, "key").withColumn("gaps", F.coalesce("gaps", F.lit(0)))


def damage(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text), some of them damaged by crc32 of 'conv_id:turn' modulo 20, in which nulls are one space:
    0 drops a row, 1 empties its text, 2 takes .!? out of it, 3 repeats it, 4 makes it the user's."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(space("role"))
    left = rows.select("conv_id", "turn", "role", "text", kind.alias("_kind")).filter("_kind <> 0")
    return left.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def op13_conversations(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    every, _ = repair(damage(rows))
    ids = rows.groupBy(key_of("conv_id").alias("key")).agg(F.first("conv_id").alias("conv_id"))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in counts}
    joined = ids.join(summaries(every), "key", "left").withColumns(zero | {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))})
    return joined.select("conv_id", *counts, "audit", "repaired_sha256")


#: crc32 of an ASCII text {s}, bit by bit
CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, 8 * strlen({s})), lambda i: CAST(CASE WHEN i % 8 = 0 THEN ascii(substr({s}, i // 8 + 1, 1)) ELSE 0 END AS BIGINT))),
      lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384)), 4294967295)"""
#: Costs before a row, from those after it (c, by state from 1 on); what a kept row leads to.
ROW_COSTS = ", ".join(
    f"least(2 + c[{s}], CASE WHEN must THEN 1000000 ELSE 1 + extra + c[{t}] END, CASE WHEN must THEN 1000000 {kept} ELSE 1000000 END) AS e{s}"
    for s, t, kept in ((1, 3, "WHEN ini = 's' THEN extra + c[2] WHEN ini = 'u' THEN extra + c[3]"), (2, 3, "WHEN ini = 'u' THEN extra + c[3]"), (3, 4, "WHEN ini = 'a' THEN extra + c[4]"), (4, 3, "WHEN ini = 'u' THEN extra + c[3]"))
)
OP13_SQL = f"""WITH RECURSIVE raw AS (SELECT coalesce(':' || CAST(conv_id AS VARCHAR), '') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
    hit AS (SELECT *, {CRC.format(s='s')} % 20 AS kind FROM raw),
    dmg AS (SELECT k, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM hit WHERE kind <> 0),
    num AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY k) AS n FROM dmg WINDOW w AS (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text))),
    bare AS (SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t, row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 AS again, lag(role[1:1]) OVER (PARTITION BY k ORDER BY i) AS before FROM num),
    flt AS (SELECT *, CASE WHEN t = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM bare),
    r AS MATERIALIZED (SELECT k, i, n, role, text, turn, fault, role[1:1] AS ini, fault IN ('blank', 'duplicate') AS must, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra, before IS NOT NULL AND before || role[1:1] NOT IN ('su', 'ua', 'au') AS illegal FROM flt),
    b AS (SELECT DISTINCT k, n + 1 AS i, [0, 10, 5, 0] AS c FROM r UNION ALL SELECT k, i, [least(e1, 5 + e3, 10 + e4), least(e2, 5 + e3, 10 + e4), least(e3, 5 + e4), least(e4, 5 + e3)] FROM (SELECT b.k, r.i, {ROW_COSTS} FROM b JOIN r ON r.k = b.k AND r.i = b.i - 1)),
    p AS MATERIALIZED (SELECT b.k, b.i, b.c AS v, z.c AS z, r.role, r.text, ini, must, extra FROM b LEFT JOIN r ON r.k = b.k AND r.i = b.i LEFT JOIN b z ON z.k = b.k AND z.i = b.i + 1),
    f(k, i, s, audit, lines) AS (SELECT k, CAST(1 AS BIGINT), 1, '', '' FROM b WHERE i = 1
      UNION ALL SELECT k, CASE WHEN step = 'I' THEN i ELSE i + 1 END, CASE step WHEN 'D' THEN s WHEN 'K' THEN kept ELSE turn END, audit || step,
        lines || CASE step WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text ELSE chr(10) || CASE turn WHEN 3 THEN 'user:' ELSE 'assistant:' END || CASE WHEN step = 'R' THEN text ELSE '' END END
      FROM (SELECT *, CASE WHEN z IS NOT NULL AND v[s] = 2 + z[s] THEN 'D' WHEN v[s] = 5 + v[turn] THEN 'I' WHEN z IS NULL THEN NULL WHEN NOT must AND kept IS NOT NULL AND v[s] = extra + z[kept] THEN 'K' ELSE 'R' END AS step
        FROM (SELECT f.*, v, z, role, text, must, extra, CASE s WHEN 3 THEN 4 ELSE 3 END AS turn, CASE WHEN s = 1 AND ini = 's' THEN 2 WHEN s <> 3 AND ini = 'u' THEN 3 WHEN s = 3 AND ini = 'a' THEN 4 END AS kept FROM f JOIN p ON p.k = f.k AND p.i = f.i)) WHERE step IS NOT NULL),
    ended AS (SELECT k, audit, lines FROM f JOIN (SELECT DISTINCT k, n FROM r) USING (k) WHERE i = n + 1 AND s IN (1, 4)),
    sums AS (SELECT k, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM r GROUP BY k),
    ids AS (SELECT DISTINCT conv_id, coalesce(':' || CAST(conv_id AS VARCHAR), '') AS k FROM conversations)
    SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(c[1] AS BIGINT), 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(lines[2:], '')) AS repaired_sha256
    FROM ids LEFT JOIN sums USING (k) LEFT JOIN ended USING (k) LEFT JOIN (SELECT k, c FROM b WHERE i = 1) USING (k)"""
