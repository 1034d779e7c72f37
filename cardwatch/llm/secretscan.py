"""Secrets in texts, and credentials whose parts stand apart.

Strong patterns (``assign``, ``access``, ``hex``) are reported wherever they match.  Weak candidates, which alone would
mostly be false alarms, are reported only when their complement stands near them: an identifier next to a secret or an
endpoint, a secret next to an identifier or an endpoint, an endpoint next to both an identifier and a secret.

Near means in one scope, a stretch of a text without an empty line, and at most ``REACH`` code points apart.  The join of
these intervals is a Spark join of cells: a scope is cut into cells as wide as the reach, each cell keeps the outermost
ends of the parts of each role, and a candidate looks at its own cells and their neighbours.  So no pairs are made, and a text
with very many parts is spread over its cells.

Positions are code points of the whole text, ends are exclusive.  A null or empty text has no span; rows are told apart by a row
number, so repeated ids and rows without id are scanned one by one.  An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardwatch.llm.store import written

# The strong patterns, their least lengths, and the order of kinds in reports.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST_ACCESS = 18
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")

REACH = 256
IDENTIFIER_KEY = re.compile(
    r"""(?<![A-Za-z0-9])(?:access_?key(?:_?id)?|client_?id|account|user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""",
    re.I | re.A)
IDENTIFIER_WORDS = ("accesskey", "access_key", "clientid", "client_id", "account", "user", "login")
SHORT_ACCESS = re.compile(r"(?:AKIA|ASIA|AIDA|AROA)[A-Z0-9]{8,}")
ACCESS_WORDS = ("AKIA", "ASIA", "AIDA", "AROA")
ENDPOINT_KEY = re.compile(
    r"""(?<![A-Za-z0-9])(?:host(?:name)?|endpoint|server|url)["']?\x20*[:=]\x20*["']?([A-Za-z0-9][A-Za-z0-9:/._-]{3,})""", re.I | re.A)
ENDPOINT_WORDS = ("host", "endpoint", "server", "url")
ADDRESS = re.compile(r"(?<![A-Za-z0-9])[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s\"'<>]+")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
LEAST_SHORT_VALUE = 6
EMPTY_LINE = re.compile(r"\n[ \t\r]*\n")

Span = tuple[int, int]
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret"}


def base_spans(text: str) -> tuple[dict[str, list[Span]], list[Span]]:
    """The strong spans by kind, and the assignments whose value is too short for one."""
    small = text.lower()
    assigns = [m for m in ASSIGN.finditer(text)] if any(w in small for w in ASSIGN_WORDS) else []
    strong = {
        "assign": [m.span() for m in assigns if m.end(2) - m.start(2) >= LEAST_VALUE],
        "access": [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS] if "AKIA" in text else [],
        "hex": [m.span() for m in HEX.finditer(text)],
    }
    return strong, [m.span() for m in assigns if LEAST_SHORT_VALUE <= m.end(2) - m.start(2) < LEAST_VALUE]


def _opaque(text: str) -> list[Span]:
    """Long tokens of mixed letters and digits."""
    mixed = (re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[0-9]"))
    return [m.span() for m in OPAQUE.finditer(text) if all(c.search(m[0]) for c in mixed)]


def weak_spans(text: str, strong: dict[str, list[Span]], short: list[Span]) -> list[tuple[str, int, int]]:
    """(role, start, end) of candidates that overlap neither a strong span nor an earlier candidate.

    Long tokens are looked for only where the text has anything that they could go with.
    """
    small = text.lower()
    roles = {"identifier": [], "secret": list(short), "endpoint": []}
    if any(w in text for w in ACCESS_WORDS):
        roles["identifier"] += [m.span() for m in SHORT_ACCESS.finditer(text)]
    if any(w in small for w in IDENTIFIER_WORDS):
        roles["identifier"] += [m.span() for m in IDENTIFIER_KEY.finditer(text)]
    if "://" in text:
        roles["endpoint"] += [m.span() for m in ADDRESS.finditer(text)]
    if any(w in small for w in ENDPOINT_WORDS):
        roles["endpoint"] += [m.span() for m in ENDPOINT_KEY.finditer(text)]
    if strong["access"] or roles["identifier"] or roles["endpoint"]:
        roles["secret"] += _opaque(text)
    taken, out = merged(s for spans in strong.values() for s in spans), []
    for role in ("identifier", "secret", "endpoint"):
        mine = []
        for span in sorted(roles[role]):
            if not overlaps(taken, span) and not (mine and mine[-1][1] > span[0]):
                mine.append(span)
        out += [(role, *s) for s in mine]
        taken = merged([*taken, *mine])
    return out


def merged(spans: Iterable[Span]) -> list[Span]:
    """Sorted spans that do not overlap and cover the same."""
    out: list[Span] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def overlaps(disjoint: list[Span], span: Span) -> bool:
    at = bisect.bisect_left(disjoint, (span[1],))
    return at > 0 and disjoint[at - 1][1] > span[0]


def joined(spans: list[tuple[str, int, int]]) -> str:
    """Spans as kind:start:end by start, then kind as listed."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


SPAN = "struct<start: long, rank: int, end: long>"
PART = "struct<role: string, start: long, end: long, scope: long, weak: boolean>"
SCANNED = (f"row long, doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, base array<{SPAN}>, "
           f"parts array<{PART}>")


def scan_text(text: str | None) -> dict:
    """The strong spans of a text and, where it has weak candidates, all its parts with their scopes."""
    strong, short = base_spans(text or "")
    base = [(k, *s) for k, spans in strong.items() for s in spans]
    weak = weak_spans(text or "", strong, short)
    parts = []
    if weak:
        scopes = [m.start() for m in EMPTY_LINE.finditer(text)]
        for kind, start, end, loose in [(ROLES[k], a, b, False) for k, a, b in base] + [(*w, True) for w in weak]:
            parts.append({"role": kind, "start": start, "end": end, "scope": bisect.bisect_right(scopes, start), "weak": loose})
    spans = sorted((a, KINDS.index(k), b) for k, a, b in base)
    return {
        **{f"n_{k}": len(spans) for k, spans in strong.items()},
        "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(),
        "base": [{"start": a, "rank": r, "end": b} for a, r, b in spans], "parts": parts,
    }


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct({"start": pa.int64(), "rank": pa.int32(), "end": pa.int64()})
    part = pa.struct({"role": pa.string(), "start": pa.int64(), "end": pa.int64(), "scope": pa.int64(), "weak": pa.bool_()})
    schema = pa.schema({
        "row": pa.int64(), "doc_id": pa.int64(), "n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(),
        "base_sha256": pa.string(), "base": pa.list_(span), "parts": pa.list_(part)})
    for batch in batches:
        found = [scan_text(text.as_py()) for text in batch.column("text")]
        columns = [batch.column("row"), batch.column("doc_id")]
        columns += [pa.array([f[name] for f in found], schema.field(name).type) for name in schema.names[2:]]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: its strong spans, and its parts if any of them is weak; no text."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scan, SCANNED)


def linked(parts: DataFrame) -> DataFrame:
    """(row, role, start, end) of the weak candidates near which complementary parts stand.

    A part that starts within the reach behind a candidate's end, or ends within the reach before its start, starts in a
    cell between the candidate's first less one and its last plus one; parts longer than a cell are entered in all their
    cells.  Equal parts of a document count once.
    """
    cells = F.sequence(F.expr(f"start div {REACH}"), F.expr(f"(end - 1) div {REACH}"))
    entered = parts.select("row", "scope", "role", "start", "end", F.explode(cells).alias("cell"))
    nearest = entered.groupBy("row", "scope", "cell", "role").agg(F.min("start").alias("low"), F.max("end").alias("high"))
    around = F.sequence(F.expr(f"start div {REACH} - 1"), F.expr(f"(end - 1) div {REACH} + 1"))
    weak = parts.filter("weak").select("row", "scope", F.col("role").alias("mine"), "start", "end").distinct()
    met = (
        weak.withColumn("cell", F.explode(around)).join(nearest, ["row", "scope", "cell"])
        .filter("role <> mine").filter((F.col("low") <= F.col("end") + REACH) & (F.col("high") >= F.col("start") - REACH))
    )
    other = {role: F.max(F.col("role") == role).alias(f"by_{role}") for role in ("identifier", "secret", "endpoint")}
    found = met.groupBy("row", "mine", "start", "end").agg(*other.values())
    enough = F.when(F.col("mine") == "endpoint", F.col("by_identifier") & F.col("by_secret")).otherwise(F.lit(True))
    return found.filter(enough).select("row", F.col("mine").alias("role"), "start", "end")


def _text(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    texts = F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_linked of every row."""
    scanned = written(scan(docs), "secrets")
    parts = scanned.filter(F.size("parts") > 0).select("row", F.explode("parts").alias("part")).select("row", "part.*")
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("role")).cast("int") - 1
    span = F.struct(F.col("start"), rank.alias("rank"), F.col("end"))
    added = linked(parts).groupBy("row").agg(F.collect_list(span).alias("added"))
    spans = F.concat("base", F.coalesce("added", F.array().cast(f"array<{SPAN}>")))
    return scanned.join(added, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", _text(F.array_sort(spans)).alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_linked"),
    )
