"""Secret scans: fixed patterns, and character entropy over sliding windows."""

from __future__ import annotations

import re
from hashlib import sha256
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame

from shelfline.llm.common import over_batches

# Fixed patterns of the base kinds, in their order; the least length of a hit beside each.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_LENGTH = 12
# Greedy runs, so the least length may stand in the pattern: a shorter run never matches.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "entropy")

# Strings that may hold keys.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
# Runs of each character class, with the bits per character that a window of a random string
# of the class exceeds.
CLASSES = (
    (re.compile(r"[0-9a-f]{20,}"), 3.0),
    (re.compile(r"[0-9A-F]{20,}"), 3.0),
    (re.compile(r"[0-9A-Za-z]{20,}"), 3.6),
    (re.compile(r"[0-9A-Za-z+/=_-]{20,}"), 3.7),
)
# A window has a digit and a letter, or so many letters of either case.
MIXED_CASE = 5
# Parts of high entropy that are no secrets; windows that overlap one are left out.
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # identifiers in UUID form
    re.compile(r"(?i)example|sample|placeholder|changeme|your[_-]?"),
    re.compile(r"(sha(1|256|384|512)|md5)-[A-Za-z0-9+/=]+"),  # integrity checksums
)
# Whole strings that are none: paths.
PATH = re.compile(r"/?([a-z0-9_-]+/)+[a-z0-9_-]*")


def hot_windows(text: str, bits: float, window: int = WINDOW) -> list[int]:
    """Starts of the windows of a string that hold more than ``bits`` per character.

    The window moves one character at a time; only the counts that change are updated. Only
    windows with letters and digits, or with letters of both cases, count.
    """
    # What a character seen c times takes from the entropy of a window.
    terms = [0.0, *(c / window * log2(c / window) for c in range(1, window + 1))]
    counts: dict[str, int] = {}
    kinds = {"digit": 0, "upper": 0, "lower": 0, "other": 0}
    entropy, found = 0.0, []
    for i, c in enumerate(text):
        if i >= window:
            old = text[i - window]
            n = counts[old]
            entropy += terms[n] - terms[n - 1]
            counts[old] = n - 1
            kinds[_kind(old)] -= 1
        n = counts.get(c, 0)
        entropy += terms[n] - terms[n + 1]
        counts[c] = n + 1
        kinds[_kind(c)] += 1
        if i >= window - 1 and entropy > bits + 1e-9:
            letters = kinds["upper"] + kinds["lower"]
            if kinds["digit"] and letters or min(kinds["upper"], kinds["lower"]) >= MIXED_CASE:
                found.append(i - window + 1)
    return found


def _kind(c: str) -> str:
    return "digit" if "0" <= c <= "9" else "lower" if "a" <= c <= "z" else "upper" if "A" <= c <= "Z" else "other"


def allowed(text: str) -> list[tuple[int, int]]:
    """Parts of a candidate that are known to be harmless."""
    if PATH.fullmatch(text):
        return [(0, len(text))]
    return [m.span() for p in ALLOWED for m in p.finditer(text)]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind number and end of the hits of the fixed patterns, in order."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def entropy_spans(text: str, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """Stretches of candidate strings with the entropy of a random string of their class.

    Windows move over the runs of every character class within a candidate. Those that
    overlap an allowed part are left out; the others are joined where they overlap or touch.
    """
    spans = []
    for m in CANDIDATE.finditer(text):
        word = m.group()
        harmless = allowed(word)
        if harmless == [(0, len(word))]:
            continue
        starts = {run.start() + at for runs, bits in CLASSES for run in runs.finditer(word) for at in hot_windows(run.group(), bits, window)}
        stretches: list[list[int]] = []
        for a in sorted(starts):
            if any(a < y and x < a + window for x, y in harmless):
                continue
            if stretches and a <= stretches[-1][1]:
                stretches[-1][1] = a + window
            else:
                stretches.append([a, a + window])
        spans += [(m.start() + a, 3, m.start() + b) for a, b in stretches]
    return spans


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def secret_scan(docs: DataFrame) -> DataFrame:
    """Secrets in every whole text.

    Returns ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``: hits of the fixed
    patterns by kind, a digest of them, and all spans, those of high entropy included, as
    ``kind:start:end`` in code points. Overlapping spans of several kinds are all listed;
    the allow-list holds back entropy spans only. A null or empty text has no spans (the
    digest is that of an empty string); repeated rows are scanned one by one, an empty table
    gives no rows, other columns are ignored.
    """

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text) if text else []
                kinds = [k for _, k, _ in base]
                every = sorted(base + entropy_spans(text)) if text else []
                digest = sha256(listed(base).encode()).hexdigest()
                out.append((kinds.count(0), kinds.count(1), kinds.count(2), digest, listed(every)))
            columns = list(zip(*out))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

        return run

    kind = dict(docs.dtypes)["doc_id"]
    return over_batches(
        docs.select("doc_id", "text"), make,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )
