"""Secret scans: three fixed patterns, and sliding-window Shannon entropy per character class.

Candidates are long runs of key characters. For each class (hexadecimal, mixed) a window slides over
the class's stretches; entering and leaving characters change the counts and the running sum of
c * log2(c), so a step costs the same whatever the window. Windows at or above the class's threshold
merge into a span. An allow-list drops what is dense but no secret: words, numbers, dates, UUIDs,
paths and addresses whose segments are made of names, and spans that hold an alphabet or a
placeholder themselves. The allow-list never touches the fixed patterns.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import released

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_RUN = re.compile(r"[0-9a-f]{16,}")  # the runs of HEX that are long enough

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{20,}")
#: Class name, its stretches, bits per character from which a window counts.
CLASSES = (("hex", re.compile(r"[0-9a-fA-F]{20,}"), 3.0), ("mixed", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.9))
ALLOWED = (
    re.compile(r"[A-Za-z_.=+/-]+"),  # no digit: words, identifiers
    re.compile(r"[0-9_.=+/-]+"),  # no letter: numbers, dates, rules
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"[a-z0-9-]{1,19}(\.[a-z0-9-]{1,19})+"),  # host names
)
PATH = re.compile(r"[A-Za-z0-9_-]*(/[A-Za-z0-9_.-]{1,19})+/?")
PLACEHOLDER = re.compile(r"example|placeholder|xxxx|0123456789|abcdefghij", re.IGNORECASE | re.ASCII)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
NAME_LENGTH = 2.5  # characters of a name in the mean; those of random keys have 1.6
PART = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def dense_windows(text: str, threshold: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Spans of merged windows whose entropy is at least ``threshold`` bits, by counts that slide."""
    part = PART if window == WINDOW else [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    for i, c in enumerate(text):
        if i >= window:
            old = text[i - window]
            n = counts[old]
            total += part[n - 1] - part[n]
            counts[old] = n - 1
        n = counts.get(c, 0)
        total += part[n + 1] - part[n]
        counts[c] = n + 1
        if i >= window - 1 and math.log2(window) - total / window >= threshold - 1e-9:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def named(text: str) -> bool:
    """Whether a path is made of words and numbers, as a whole and in each segment long enough to be a key."""
    def mean(part: str) -> bool:
        names = NAME.findall(part)
        return sum(map(len, names)) >= NAME_LENGTH * len(names)
    return mean(text) and all(mean(s) for s in re.split("[/=.]", text) if len(s) >= WINDOW)


def allowed(text: str, before: str) -> bool:
    """Whether the candidate is on the allow-list; addresses are known by what stands before them."""
    if any(p.fullmatch(text) for p in ALLOWED):
        return True
    return bool(before.endswith(("://", "@", "www.")) or PATH.fullmatch(text)) and named(text)


def placeholder(span: str) -> bool:
    """Whether a dense span is an alphabet or a placeholder itself, whatever name is joined to it by ``=``."""
    long = [part for part in span.split("=") if len(part) >= WINDOW] or [span]
    return all(PLACEHOLDER.search(part) for part in long)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", *m.span()) for m in HEX_RUN.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def entropy_spans(text: str) -> list[tuple[str, int, int]]:
    found: list[tuple[int, int]] = []
    for m in CANDIDATE.finditer(text):
        if allowed(m[0].strip("."), text[max(0, m.start() - 4):m.start()]):
            continue
        spans = sorted((m.start() + s.start() + a, m.start() + s.start() + b)
                       for _, stretch, threshold in CLASSES for s in stretch.finditer(m[0])
                       if re.search("[0-9]", s[0]) and re.search("[A-Za-z]", s[0])
                       for a, b in dense_windows(s[0], threshold) if not placeholder(s[0][a:b]))
        for a, b in spans:
            if found and a <= found[-1][1]:
                found[-1] = (found[-1][0], max(b, found[-1][1]))
            else:
                found.append((a, b))
    return [("entropy", a, b) for a, b in found]


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """Kind, start, end (code points, end exclusive) by start, then kind; an entropy span inside a fixed one adds nothing."""
    base, more = base_spans(text), []
    starts, at, reach = sorted((b[1], b[2]) for b in base), 0, 0
    for e in sorted(entropy_spans(text), key=lambda s: s[1]):
        while at < len(starts) and starts[at][0] <= e[1]:
            reach = max(reach, starts[at][1])  # the farthest end of a fixed span that begins at or before this one
            at += 1
        if reach < e[2]:
            more.append(e)
    return sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


FINDINGS = "findings array<struct<kind: string, start: int, end: int>>"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and findings of every row, in one pass without a shuffle.

    A null text is empty and has no findings. Ids may be null or repeat; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t or "")] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], names=[id_col, "findings"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, f"{id_col} long, {FINDINGS}")


def digest(findings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, hash of the fixed patterns' spans and all spans as text."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def n(kind: str):
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda s: s["kind"] != "entropy")
    return findings.select(F.col(id_col), n("assign"), n("access"), n("hex"), n("entropy"),
                           F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; all rows and columns stay, the length follows the text.

    A null text stays null. Overlapping spans are replaced together.
    """
    at = docs.columns.index(text_col)
    length = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old = b.column(at).to_pylist()
            new = [None if t is None else _masked(t, mark) for t in old]
            columns = b.columns
            columns[at] = pa.array(new, b.schema.field(at).type)
            if length is not None:
                columns[length] = pa.array([n if t == o else len(t) for n, t, o in zip(b.column(length).to_pylist(), new, old, strict=True)],
                                           b.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return docs.mapInArrow(released("secrets", run), docs.schema)


def _masked(text: str, mark: str) -> str:
    out, at = [], 0
    for _, start, end in find_secrets(text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def sha256_of(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
