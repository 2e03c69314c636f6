"""Personal data: an automaton finds anchors, local parsers expand them to validated spans."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "login", "key", "secret")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")  # begins where its digits do, so that long numbers are read once
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+(?<=[0-9])")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
LOGIN = re.compile(r"[^\s/@:\"'<>]+:[^\s/@\"'<>]+@(?=[A-Za-z0-9])")
KEY = re.compile(r"A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])")
SECRET = re.compile(r"\s*[=:]\s*(?:\"([^\s\"]{12,})\"|'([^\s']{12,})'|([A-Za-z0-9+/_.-]{12,}))")

#: anchor -> the parsers it calls; anchors with letters stand in lower case, as the automaton reads a lower-cased text
ANCHORS = {
    "@": ("email",), "+": ("phone",), **{d: ("number",) for d in "0123456789"}, "://": ("login",), "akia": ("key",), "asia": ("key",), "iban": ("iban",),
    **{cue: ("secret",) for cue in ("password", "passwd", "secret", "token", "api_key", "apikey", "access_key")},
}


def lower(text: str) -> str:
    """A-Z alone in lower case: one code point for one, so that places are those of the text."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for anchor, parsers in ANCHORS.items():
        out.add_word(anchor, (anchor, parsers[0]))
    out.make_automaton()
    return out


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def run_around(text: str, at: int, chars: frozenset, least: int) -> tuple[int, int]:
    """The maximal run of chars around place at, from least on."""
    a, b = at, at
    while a > least and text[a - 1] in chars:
        a -= 1
    while b < len(text) and text[b] in chars:
        b += 1
    return a, b


NUMBER_IP, NUMBER_CARD, PHONE_CHARS = DIGITS | {"."}, DIGITS | {" ", "-"}, DIGITS | frozenset(" ().-")


def find(text: str, machine: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """Spans (start, end) by kind, in code points.

    Each anchor is expanded to the maximal run of characters of its kind; the kind's grammar then cuts the run from the
    left. No match can leave its run, so this finds what a scan of the whole text would, in time linear in the text. Cues
    of words are found in upper and lower case; the parsers read the text as it is."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(("email", "ip", "card", "phone", "login", "key", "secret", "iban"), 0)
    for end, (anchor, parser) in machine.iter(text.lower() if text.isascii() else lower(text)):
        at = end - len(anchor) + 1
        if parser == "number":
            if at >= done["ip"]:
                a, b = run_around(text, at, NUMBER_IP, done["ip"])
                done["ip"] = b
                for m in IP.finditer(text, a, b):
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                        out["ip"].append(m.span())
            if at >= done["card"]:
                a, b = run_around(text, at, NUMBER_CARD, done["card"])
                done["card"] = b
                for m in CARD.finditer(text, a, b):
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        out["card"].append(m.span())
        elif parser == "email":
            a = at
            while a > done["email"] and text[a - 1] in LOCAL:
                a -= 1
            if a < at and (m := DOMAIN.match(text, at + 1)):
                out["email"].append((a, m.end()))
                done["email"] = m.end()
        elif parser == "phone":
            if at >= done["phone"]:
                b = at + 1
                while b < len(text) and text[b] in PHONE_CHARS:
                    b += 1
                while b > at and text[b - 1] not in DIGITS:
                    b -= 1
                if b - at >= 4 and text[at + 1] in DIGITS:
                    done["phone"] = b
                    if 9 <= sum(c in DIGITS for c in text[at:b]) <= 15:
                        out["phone"].append((at, b))
        elif at >= done[parser]:
            found = None
            if parser == "login":
                found = (m := LOGIN.match(text, end + 1)) and (m.start(), m.end() - 1)
            elif parser == "key" and not (at and text[at - 1].isalnum()):
                found = (m := KEY.match(text, at)) and m.span()
            elif parser == "secret" and not (at and text[at - 1].isalpha()):
                m = SECRET.match(text, end + 1)
                found = m and m.span(m.lastindex)
                if found and not any(c in DIGITS for c in text[found[0] : found[1]]):
                    found = None
            elif parser == "iban":
                m = IBAN.match(text, at) or re.compile(r"[\s:#.]*").match(text, end + 1)
                m = m if m.re is IBAN else IBAN.match(text, m.end())
                found = m and iban_ok(m.group()) and m.span()
            if found:
                out[parser].append(found)
                done[parser] = found[1]
    return out


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id and spans, an array of (kind, start, end) in code points, end exclusive, by kind and start.

    Kinds: email, ip, card (Luhn), phone; and iban (checksum, after its cue), login (user:password in a url), key (cloud
    access key ids) and secret (a value with a digit after password=, token = and the like). Null text counts as empty,
    a long one is read whole, in time linear in it; ids are passed through, nulls and repeats too; other columns are not
    read; an empty table gives an empty result. Each row stands alone: no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            each = [[{"kind": k, "start": a, "end": b} for k, xs in find(t, machine).items() for a, b in xs] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(each, kind)], ["id", "spans"])

    kind = dict(docs.dtypes)[id_col]
    found = docs.select(F.col(id_col).alias("id"), text_of(text_col)).mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")
    return found.withColumnRenamed("id", id_col)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with each span's text replaced by [kind]; where spans overlap, the one that begins first (then the longest) counts.

    Null texts stay null, empty ones empty, long ones are read whole; rows with null or repeated ids go by their own text;
    other columns stay as they are, and an empty table stays empty."""

    def clean(text: str | None, machine: ahocorasick.Automaton) -> str | None:
        spans = sorted((a, -b, k) for k, xs in find(text or "", machine).items() for a, b in xs)
        parts, at = [], 0
        for a, b, k in spans:
            if a >= at:
                parts += [text[at:a], f"[{k}]"]
                at = -b
        return text if text is None else "".join([*parts, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            yield batch.set_column(at, text_col, pa.array([clean(t, machine) for t in batch.column(at).to_pylist()], pa.string()))

    return docs.mapInArrow(run, docs.schema)


def op9_pii(spark, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
