"""Secret scans: patterns for known shapes, windows of high entropy for the rest.

Candidate strings are the maximal runs of token characters.  Over each of them a
window slides one character at a time; the counts of its characters, and the sum of
``c * log2(c)`` that their entropy needs, are kept up by adding one character and
taking one away.  Windows at or above the threshold of the candidate's character
class are joined into spans, unless the allow-list knows the candidate.  The parts of a
candidate between separators are candidates too.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import ship
from rosterflow.llm.batches import byte_slices, texts

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: What parts the names, paths and keys of one candidate.
SEPARATOR = re.compile(r"[+/_=-]")
KINDS = ("assign", "access", "hex", "entropy")
ORDER = {kind: i for i, kind in enumerate(KINDS)}

# What is known not to be secret.  The digests are those of the empty input.
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"d41d8cd98f00b204e9800998ecf8427e",
    r"da39a3ee5e6b4b0d3255bfef95601890afd80709",
    r"e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
    r".*(?i:example|placeholder|changeme|dummy|sample).*",
    r"[0-9]{4}-[0-9]{2}-[0-9]{2}T.*",
)


@dataclass(frozen=True)
class EntropyRule:
    """What counts as a high-entropy string; entropies are in bits for each character of the window.

    A random window of 20 hex digits has 3.3 bits in the mean, one of 20 letters and
    digits 4.1; prose without spaces seldom passes 3.4, and has one case and no digits.
    """

    window: int = 20
    hex_bits: float = 3.0
    mixed_bits: float = 3.7
    allowed: tuple[str, ...] = ALLOWED


_TOKEN = np.zeros(256, dtype=bool)
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-":
    _TOKEN[_c] = True
_HEX = np.zeros(256, dtype=bool)
for _c in b"0123456789abcdef":
    _HEX[_c] = True


def base_spans(text: str, hex_spans: Iterable[tuple[int, int]] | None = None) -> list[tuple[str, int, int]]:
    """The pattern's spans as (kind, start, end), by kind.  ``hex_spans``: where they are known already."""
    spans: list[tuple[str, int, int]] = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if hex_spans is None:
        hex_spans = [m.span() for m in HEX.finditer(text)]
    return spans + [("hex", a, b) for a, b in hex_spans]


def character_class(candidate: str) -> str:
    """``hex``, ``mixed`` or, where a single kind of character says nothing, the empty text."""
    digits = any("0" <= c <= "9" for c in candidate)
    lower = any("a" <= c <= "z" for c in candidate)
    upper = any("A" <= c <= "Z" for c in candidate)
    if digits and lower != upper and all(c in "0123456789abcdefABCDEF" for c in candidate):
        return "hex"
    return "mixed" if digits + lower + upper >= 2 and (digits or (lower and upper)) else ""


def entropy_windows(candidate: str, window: int, bits: float) -> list[tuple[int, int]]:
    """The unions of the windows with an entropy of ``bits`` at least, as (start, end)."""
    n = len(candidate)
    if n < window:
        return []
    weight = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    limit = window * (math.log2(window) - bits) + 1e-9
    counts: dict[str, int] = {}
    total, found = 0.0, []
    for i, c in enumerate(candidate):
        k = counts.get(c, 0)
        counts[c] = k + 1
        total += weight[k + 1] - weight[k]
        if i >= window:
            gone = candidate[i - window]
            k = counts[gone]
            counts[gone] = k - 1
            total -= weight[k] - weight[k - 1]
        if i >= window - 1 and total <= limit:
            start = i - window + 1
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


def entropy_spans(text: str, start: int, end: int, rule: EntropyRule, allowed: re.Pattern) -> list[tuple[str, int, int]]:
    """High-entropy spans of the candidate ``text[start:end]``: as a whole, and of its parts between separators.

    Each has a character class and an allow-list of its own, so that a name or a path in front of
    a key neither raises what the key needs nor silences it.
    """
    cuts = [start - 1, *(start + m.start() for m in SEPARATOR.finditer(text[start:end])), end]
    parts = [(a + 1, b) for a, b in pairwise(cuts) if b - a > rule.window]
    found: list[tuple[int, int]] = []
    for a, b in dict.fromkeys([(start, end), *parts]):
        candidate = text[a:b]
        kind = character_class(candidate)
        if kind and not allowed.fullmatch(candidate):
            bits = rule.hex_bits if kind == "hex" else rule.mixed_bits
            found += [(a + x, a + y) for x, y in entropy_windows(candidate, rule.window, bits)]
    joined: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if joined and a <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
        else:
            joined.append((a, b))
    return [("entropy", a, b) for a, b in joined]


def _runs(data: np.ndarray, table: np.ndarray, cuts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes in ``table``, of ``least`` bytes or more, none across a cut."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = table[data]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    # a run over a cut is rare: it ends there and begins anew
    at = cuts[(cuts > 0) & (cuts < len(data))]
    at = np.unique(at[(inside[at] == 1) & (inside[at + 1] == 1)]) if len(at) else at
    starts, ends = np.sort(np.concatenate([starts, at])), np.sort(np.concatenate([ends, at]))
    keep = ends - starts >= least
    return starts[keep], ends[keep]


def _by_text(starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """Runs as byte ranges within their texts."""
    found: dict[int, list[tuple[int, int]]] = {}
    owners = np.searchsorted(offsets, starts, side="right") - 1
    for i, a, b in zip(owners.tolist(), starts.tolist(), ends.tolist(), strict=True):
        found.setdefault(i, []).append((a - int(offsets[i]), b - int(offsets[i])))
    return found


def scan_texts(values: list[str], rule: EntropyRule = EntropyRule()) -> list[list[tuple[str, int, int]]]:
    """All spans of each text, by start, then kind.  Offsets are code points, the end exclusive."""
    allowed = re.compile("|".join(rule.allowed or (r"(?!)",)), re.DOTALL)
    raw = [v.encode("utf-8", "surrogatepass") for v in values]
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) for r in raw], out=offsets[1:])
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    hexes = _by_text(*_runs(data, _HEX, offsets, 24), offsets)
    candidates = _by_text(*_runs(data, _TOKEN, offsets, rule.window), offsets)
    found = []
    for i, text in enumerate(values):
        ascii_only = len(raw[i]) == len(text)
        chars = lambda at, i=i, same=ascii_only: at if same else len(raw[i][:at].decode("utf-8", "surrogatepass"))
        spans = base_spans(text, [(chars(a), chars(b)) for a, b in hexes.get(i, ())])
        base = list(spans)
        for a, b in candidates.get(i, ()):
            for span in entropy_spans(text, chars(a), chars(b), rule, allowed):
                if not any(s <= span[1] and span[2] <= e for _, s, e in base):
                    spans.append(span)
        found.append(sorted(spans, key=lambda s: (s[1], ORDER[s[0]])))
    return found


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """The text with each union of spans replaced by ``mark``."""
    parts, at, end = [], 0, -1
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if a > end or end < 0:
            parts.append(text[at:a])
            parts.append(mark)
            at = end = b
        elif b > end:
            at = end = b
    return "".join(parts) + text[at:]


SPANS_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def secret_spans(
    df: DataFrame, key: str = "doc_id", text: str = "text", rule: EntropyRule = EntropyRule(), mark: str | None = None
) -> DataFrame:
    """``key`` (as it is), ``secrets``: the spans of every whole text; with ``mark`` also ``redacted``.

    A null text is empty and has no spans; its redacted form is empty.  Rows are
    handled one by one, so repeated rows give equal results; an empty frame gives none.
    Spans are ordered by start, then kind; a high-entropy span inside a pattern's span is
    left out.  Memory is bounded by a slice of the batch, or by one text.
    """
    ship(df.sparkSession)
    picked = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text"):
            values = texts(part, "text")
            spans = scan_texts(values, rule)
            listed = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans], type=_SPANS)
            columns, names = [part.column("key"), listed], ["key", "secrets"]
            if mark is not None:
                clean = [redacted(v, s, mark) if s else v for v, s in zip(values, spans, strict=True)]
                columns.append(pa.array(clean, type=pa.string()))
                names.append("redacted")
            yield pa.RecordBatch.from_arrays(columns, names)

    more = ", redacted string" if mark is not None else ""
    return picked.mapInArrow(scan, f"key {kind}, secrets {SPANS_TYPE}{more}")


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[secret]", length: str = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced by ``mark`` in ``text``, and ``length`` counted anew where it is a column.

    Every row stays; a text without secrets is as it was, null included.
    """
    whole = F.struct(*[F.col(c) for c in docs.columns])
    found = secret_spans(docs.select(whole.alias("row"), F.col(text).alias("body")), "row", "body", mark=mark)
    changed = F.size("secrets") > 0
    columns = []
    for name in docs.columns:
        value = F.col(f"key.`{name}`")
        if name == text:
            value = F.when(changed, F.col("redacted")).otherwise(value)
        elif name == length:
            value = F.when(changed, F.length("redacted").cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return found.select(*columns)
