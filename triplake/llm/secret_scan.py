"""Secret scan: rule matches plus windows of high Shannon entropy, minus an allow-list.

Rules find assignments, access keys and long hex strings. Beyond them, every candidate string (a run of token
characters) is scanned with a sliding window for each character class: the window's counts are updated by one character
in and one out, and so is the sum that its entropy comes from. Windows above the class's threshold merge into spans,
unless the string is on the allow-list (words, counters, identifiers of a known form); rulers and alphabets written out
split a string, and what stands beside them is scanned. A text that holds no keyword and
no long run of token characters, found with array operations, is done without a regular expression.

Defined results: null text counts as empty (no spans); spans are code points of the whole text, the end excluded;
repeated rows are scanned each; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.llm import store
from triplake.llm import textarrays as ta

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# Character classes: name, characters, least entropy (bits a character) of a window.
CLASSES = (
    ("hex", "0123456789abcdefABCDEF", 3.0),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9),
)
# Strings that are of these forms as a whole are no secrets: words, words joined by marks, numbers, UUIDs.
ALLOW = tuple(re.compile(p) for p in (
    r"[A-Za-z]+", r"[A-Za-z]+(?:[-_/+=][A-Za-z]*)+", r"[0-9+/_=-]+",
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"))


def _onwards(start: str, letters: str) -> str:
    """Pattern of ``start`` and as many of the letters after it as follow in their order."""
    rest = letters[letters.index(start[-1]) + 1:]
    return start + "".join(f"(?:{c}" for c in rest) + ")?" * len(rest)


# Parts that no window may touch: alphabets written out and runs of one character. What stands beside them is scanned.
FILLER = re.compile("|".join((_onwards("0123456789ab", string.ascii_lowercase), _onwards("abcdefghij", string.ascii_lowercase),
                              _onwards("ABCDEFGHIJ", string.ascii_uppercase), r"(.)\1{7,}")))

_TOKEN = np.zeros(256, bool)
_TOKEN[[ord(c) for c in CLASSES[1][1]]] = True
_NLOGN = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"


def entropy_spans(s: str, characters: str, least: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged windows of ``s`` whose entropy reaches ``least``; a window never holds a character outside the class."""
    inside = set(characters)
    floor = window * math.log2(window) - least * window  # entropy = log2(window) - sum(n log n) / window
    table = _NLOGN if window == WINDOW else [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    spans: list[tuple[int, int]] = []
    counts: dict[str, int] = {}
    total, run = 0.0, 0
    for i, c in enumerate(s):
        if c not in inside:
            counts, total, run = {}, 0.0, 0
            continue
        if run == window:
            out = s[i - window]
            n = counts[out]
            total += table[n - 1] - table[n]
            counts[out] = n - 1
        else:
            run += 1
        n = counts.get(c, 0)
        total += table[n + 1] - table[n]
        counts[c] = n + 1
        if run == window and total <= floor + 1e-9:
            if spans and spans[-1][1] >= i + 1 - window:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((i + 1 - window, i + 1))
    return spans


def scan_text(text: str, allow: frozenset[str] = frozenset()) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(rule spans, entropy spans) of a text as (start, end, kind), in order."""
    base = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    base += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    base += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    kinds = ("assign", "access", "hex")
    base.sort(key=lambda x: (x[0], kinds.index(x[2])))
    added = set()
    for m in CANDIDATE.finditer(text):
        s, at = m.group(), m.start()
        if s in allow or any(p.fullmatch(s) for p in ALLOW):
            continue
        cuts = [0, *(x for f in FILLER.finditer(s) for x in f.span()), len(s)]
        for lo, hi in zip(cuts[::2], cuts[1::2]):
            part = s[lo:hi]
            if len(part) < WINDOW or len(part) < len(s) and (part in allow or any(p.fullmatch(part) for p in ALLOW)):
                continue
            for _, characters, least in CLASSES:
                for a, b in entropy_spans(part, characters, least):
                    piece = part[a:b]
                    if piece not in allow and not any(p.fullmatch(piece) for p in ALLOW):
                        added.add((at + lo + a, at + lo + b, "entropy"))
    found = sorted(x for x in added if not any(b[0] <= x[0] and x[1] <= b[1] for b in base))
    return base, found


def _written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def secret_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: frozenset[str] = frozenset()) -> DataFrame:
    """One row per document; see ``SCHEMA``. ``allow`` are strings that are known to be harmless."""

    def suspects(data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Rows with a keyword or a run of at least 20 token characters."""
        n = len(off) - 1
        found = np.zeros(n, bool)
        outside = np.flatnonzero(np.concatenate([[True], ~_TOKEN[data], [True]])) - 1
        long = np.flatnonzero(np.diff(outside) > WINDOW)
        at = np.searchsorted(off, outside[long] + 1, side="right") - 1
        found[at[at < n]] = True
        cut = (np.diff(outside) > WINDOW).nonzero()[0]
        for k in cut[np.searchsorted(off, outside[cut] + 1, "right") != np.searchsorted(off, outside[cut + 1], "left")]:
            a, b = np.searchsorted(off, outside[k] + 1, "right") - 1, np.searchsorted(off, outside[k + 1], "left")
            found[max(a, 0):b] = True  # a run over several rows: all of them are looked at
        low = data.tobytes().lower()
        for word in KEYWORDS:
            i = low.find(word)
            while i >= 0:
                row = int(np.searchsorted(off, i, side="right")) - 1
                found[row] = True
                i = low.find(word, int(off[row + 1]))
        return found

    def scan(batches):
        empty = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            data, off = ta.flat(batch.column("text"))
            n = batch.num_rows
            out = [[0] * n, [0] * n, [0] * n, [empty] * n, [""] * n, [0] * n]
            for k in np.flatnonzero(suspects(data, off)).tolist():
                base, more = scan_text(data[off[k]:off[k + 1]].tobytes().decode("utf-8", "replace"), allow)
                for c, kind in enumerate(("assign", "access", "hex")):
                    out[c][k] = sum(x[2] == kind for x in base)
                out[3][k] = hashlib.sha256(_written(base).encode()).hexdigest()
                out[4][k] = _written(sorted(base + more, key=lambda x: (x[0], ("assign", "access", "hex", "entropy").index(x[2]))))
                out[5][k] = len(more)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, t) for v, t in zip(out, kinds))],
                                             names=[x.split()[0] for x in SCHEMA.split(", ")])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return store.map_arrow(rows, scan, SCHEMA)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and entropy spans of every document."""
    return secret_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op4_secret_scan": op4_secret_scan}
ORACLE: dict[str, str] = {}
