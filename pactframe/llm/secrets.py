"""Secrets in text: three fixed patterns, and windows of high entropy.

The patterns find assignments, access keys and hex strings. The entropy scan then takes candidate
strings of one character class at a time, slides a window over each and keeps stretches whose Shannon entropy
reaches the class's threshold. The entropy of a window follows from that of the one before by the counts of the
two characters that change. An allow-list suppresses harmless candidates; it never touches what
the patterns found.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, id_and_text

# The base patterns, and the least length of what counts in each.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a maximal run of 16 or more: shorter runs never count
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharacterClass:
    """Candidate strings of one class, and the entropy in bits that makes a window of them a secret."""

    kind: str
    candidate: str
    bits: float
    mixed: bool = False  # a window must hold letters and digits
    cased: bool = False  # ... or letters of both cases


CLASSES = (
    CharacterClass("entropy_hex", r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{20,}", 3.0, mixed=True),
    CharacterClass("entropy_base64", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", 3.75, mixed=True, cased=True),
)
ALLOWED = (
    r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",  # UUIDs
    r".*(?i:example|placeholder|changeme).*",
    r"(?:[a-z]+[-_/])+[a-z]+\d*",  # slugs and paths of words
)


@dataclass(frozen=True)
class EntropyScan:
    """Settings of the entropy scan: window length, classes in order of precedence, allow-list."""

    window: int = 20
    classes: tuple[CharacterClass, ...] = CLASSES
    allowed: tuple[str, ...] = field(default=ALLOWED)

    @property
    def kinds(self) -> tuple[str, ...]:
        return (*BASE_KINDS, *(c.kind for c in self.classes))


def high_windows(text: str, window: int, bits: float, mixed: bool, cased: bool = False) -> Iterator[tuple[int, int]]:
    """Stretches of `text` covered by windows of at least `bits` entropy, by incremental counts."""
    cost = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, digits, letters, upper, start, end = 0.0, 0, 0, 0, -1, -1
    for place, new in enumerate(text):
        if place >= window:
            old = text[place - window]
            n = counts[old]
            counts[old] = n - 1
            total += cost[n - 1] - cost[n]
            digits -= old.isdigit()
            letters -= old.isalpha()
            upper -= old.isupper()
        n = counts.get(new, 0)
        counts[new] = n + 1
        total += cost[n + 1] - cost[n]
        digits += new.isdigit()
        letters += new.isalpha()
        upper += new.isupper()
        if place + 1 < window:
            continue
        entropy = math.log2(window) - total / window
        if entropy >= bits - 1e-9 and (not mixed or digits and letters or cased and 0 < upper < letters):
            first = place + 1 - window
            if first > end:
                if end >= 0:
                    yield start, end
                start = first
            end = place + 1
    if end >= 0:
        yield start, end


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return spans


class Scanner:
    """Finds all spans of a text: (start, end, kind), by start, then kind as listed, then end."""

    def __init__(self, settings: EntropyScan):
        self.settings = settings
        self.patterns = [(c, re.compile(c.candidate)) for c in settings.classes]
        self.allowed = re.compile("|".join(f"(?:{p})" for p in settings.allowed)) if settings.allowed else None
        self.rank = {kind: place for place, kind in enumerate(settings.kinds)}

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        found = base_spans(text)
        for kind, pattern in self.patterns:
            # Candidates come in order and do not overlap, so what earlier kinds cover is swept once: of the spans
            # that begin up to a candidate's start, the furthest end tells.
            earlier, place, reached = sorted(found), 0, -1
            for match in pattern.finditer(text):
                start, end = match.span()
                while place < len(earlier) and earlier[place][0] <= start:
                    reached = max(reached, earlier[place][1])
                    place += 1
                if end <= reached or self.allowed and self.allowed.fullmatch(match.group()):
                    continue
                # One window gives the whole candidate away.
                if any(high_windows(match.group(), self.settings.window, kind.bits, kind.mixed, kind.cased)):
                    found.append((start, end, kind.kind))
        return sorted(found, key=lambda x: (x[0], self.rank[x[2]], x[1]))


SPANS = "array<struct<start:int,end:int,kind:string>>"


def secret_spans(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: EntropyScan | None = None
) -> DataFrame:
    """`id, spans` for every row of `df`; offsets are code points, `end` exclusive.

    Whole texts are scanned, in time that grows with their length. A null or empty text has no spans; ids may be
    null or repeat; an empty table gives no rows. A long text is held whole by one task, with its spans.
    """
    settings = settings or EntropyScan()
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    schema = pa.schema([("id", pa.int64()), ("spans", kind)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(settings)
        for batch in batches:
            found = [
                [{"start": s, "end": e, "kind": k} for s, e, k in scanner.spans(text)]
                for text in batch.column(1).to_pylist()
            ]
            yield batch_of(schema, batch.column(0), found)

    return id_and_text(df, id_col, text_col).mapInArrow(scan, f"id long, spans {SPANS}")


def redacted(text: str, spans: list[tuple[int, int, str]], mask: str) -> str:
    """`text` with each stretch of overlapping spans replaced by `mask`."""
    parts, at = [], 0
    for start, end, _ in spans:
        if start > at or start == at == 0:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redact_secrets(
    df: DataFrame, text_col: str = "text", mask: str = "[SECRET]", settings: EntropyScan | None = None
) -> DataFrame:
    """`df` with the secrets in one column masked; all rows and columns stay. A null stays null."""
    settings = settings or EntropyScan()
    place = df.columns.index(text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(settings)
        for batch in batches:
            texts = [
                None if text is None else redacted(text, scanner.spans(text), mask)
                for text in batch.column(place).to_pylist()
            ]
            columns = batch.columns
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(scan, df.schema)


def span_list(spans: str, only: tuple[str, ...] | None = None):
    """The spans of column `spans` as `kind:start:end`, comma-joined."""
    held = F.col(spans)
    if only:
        held = F.filter(held, lambda s: s["kind"].isin(*only))
    return F.array_join(
        F.transform(held, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
