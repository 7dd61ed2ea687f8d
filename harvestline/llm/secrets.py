"""Secret scans: fixed patterns plus sliding-window entropy over candidate strings.

Base spans come from three fixed patterns. The method then adds spans: every
maximal run of secret-like characters that is as long as the window or longer
is a candidate; a window slides over it, character counts are kept
incrementally (one in, one out), and the Shannon entropy of the window is
compared with a threshold per character class (hex digits, lower-case letters
and digits, upper-case letters and digits, base64). A threshold is the entropy
that all but ``MISS`` of the windows of random strings over the class's alphabet
reach, computed exactly. A candidate with a window over its threshold is a span
as a whole, so that no part of a secret is left; candidates on the allow-list
are suppressed. Base spans always stay. A window of letters alone is never over
the threshold (words look like that): of random base62 windows 3 % are so.

Null text is empty text and has no spans. Positions are code points, end
exclusive. Repeated rows give repeated results; column names other than
``doc_id`` and ``text`` are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import factorial, log2, prod

import pyarrow as pa
from pyspark.sql import DataFrame

from harvestline.llm.common import drop_worker_state

KINDS = ("assign", "access", "hex", "entropy")

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

# A cheap test that rules out most texts before the alternation runs.
ASSIGN_HINT = re.compile(r"[:=]")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")

# Parameters of the method: window, share of random windows that a threshold may
# miss, and the size of each class's alphabet (base32 is the smaller one of
# letters of one case with digits).
WINDOW = 20
MISS = 0.01
ALPHABETS = {"hex": 16, "alnum": 32, "upper": 32, "base64": 62}


def partitions(n: int, most: int) -> Iterator[tuple[int, ...]]:
    """The ways to write ``n`` as a sum of parts of at most ``most``, largest first."""
    if n == 0:
        yield ()
    for first in range(min(n, most), 0, -1):
        for rest in partitions(n - first, first):
            yield (first, *rest)


def random_entropy(alphabet: int, miss: float = MISS, window: int = WINDOW) -> float:
    """The entropy that random windows over ``alphabet`` characters miss at a rate of ``miss`` at most."""
    weights = []
    for counts in partitions(window, window):
        if len(counts) <= alphabet:
            repeats = prod(factorial(counts.count(c)) for c in {*counts})
            ways = factorial(alphabet) // factorial(alphabet - len(counts)) // repeats
            ways *= factorial(window) // prod(map(factorial, counts))
            weights.append((log2(window) - sum(c * log2(c) for c in counts) / window, ways))
    below = 0
    for entropy, ways in sorted(weights):
        below += ways
        if below > miss * alphabet**window:
            return entropy - 1e-6  # windows of just this entropy pass, however they are summed
    raise ValueError(miss)


# Least entropy in bits per class.
THRESHOLDS = {name: random_entropy(n) for name, n in ALPHABETS.items()}
# Strings that look random but are no secrets: prefixes of public identifiers.
ALLOW = (
    re.compile(r"^(?:sha1|sha256|sha512|md5)[-_=]", re.IGNORECASE),
    re.compile(r"^[A-Za-z]+$"),
    re.compile(r"^[0-9]+$"),
    re.compile(r"^[-_=+/]*$"),
    re.compile(r"^(?:[A-Za-z]+[-_/+=]+)*[A-Za-z]*$"),
    re.compile(r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"),
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base matches, by start, then kind as listed."""
    out = []
    if ASSIGN_HINT.search(text):
        out += [
            (m.start(), m.end(), "assign")
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= LEAST["assign"]
        ]
    if "AKIA" in text:
        out += [
            (m.start(), m.end(), "access")
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= LEAST["access"]
        ]
    # A run of 24 is at least one run of 24: the pattern with a least length
    # finds the same maximal runs as filtering all runs does.
    out += [(m.start(), m.end(), "hex") for m in HEX_LONG.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


HEX_LONG = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % LEAST["hex"])
CANDIDATE_LONG = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % WINDOW)


def char_class(window_counts: dict[str, int]) -> str:
    """Smallest class that holds every character of the window."""
    chars = window_counts.keys()
    if all(c in "0123456789abcdefABCDEF" for c in chars):
        return "hex"
    if all(c.isdigit() or c.islower() for c in chars):
        return "alnum"
    if all(c.isdigit() or c.isupper() for c in chars):
        return "upper"
    return "base64"


def entropy_runs(s: str, window: int = WINDOW, thresholds: dict[str, float] | None = None):
    """Merged (start, end) of windows of ``s`` whose entropy reaches their class's threshold.

    Counts change by one character in and one out; the sum of c*log2(c) is
    kept along, so each step costs O(1) besides the class test.
    """
    limits = thresholds or THRESHOLDS
    least = min(limits.values())
    xlogx = [0.0] + [c * log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    runs: list[list[int]] = []
    top = log2(window)
    for i, ch in enumerate(s):
        if i >= window:
            gone = s[i - window]
            c = counts[gone]
            total += xlogx[c - 1] - xlogx[c]
            if c == 1:
                del counts[gone]
            else:
                counts[gone] = c - 1
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += xlogx[c + 1] - xlogx[c]
        if i + 1 >= window:
            entropy = top - total / window
            # Mixed windows only: letters and digits both, as keys have.
            if (
                entropy >= least
                and any(x.isdigit() for x in counts)
                and any(x.isalpha() for x in counts)
                and entropy >= limits[char_class(counts)]
            ):
                start = i + 1 - window
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = i + 1
                else:
                    runs.append([start, i + 1])
    return [(a, b) for a, b in runs]


def entropy_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans that the method adds, each a whole candidate; allow-listed ones are left out."""
    out = []
    for m in CANDIDATE_LONG.finditer(text):
        s = m.group()
        if not any(a.match(s) for a in ALLOW) and entropy_runs(s):
            out.append((m.start(), m.end(), "entropy"))
    return out


def all_spans(text: str) -> tuple[list, list]:
    """(base spans, base and added spans), each by start, then kind as listed."""
    base = base_spans(text)
    both = sorted(base + entropy_spans(text), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return base, both


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


SCAN_SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, digest of the base spans, all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for batch in batches:
            rows = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for text in batch.column(1).to_pylist():
                base, both = all_spans(text or "")
                for k in ("assign", "access", "hex"):
                    rows[f"n_{k}"].append(sum(1 for s in base if s[2] == k))
                rows["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                rows["spans"].append(joined(both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)]
                + [pa.array(rows[k], pa.int64()) for k in ("n_assign", "n_access", "n_hex")]
                + [pa.array(rows[k], pa.string()) for k in ("base_sha256", "spans")],
                names=["doc_id", *rows],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(
        run, SCAN_SCHEMA
    )


def masked(text: str, mark: str = "[SECRET]") -> str:
    """``text`` with every maximal union of spans replaced by ``mark``."""
    _, spans = all_spans(text)
    if not spans:
        return text
    out, at, end = [], 0, -1
    for a, b, _ in spans:
        if a > end:
            if end >= 0:
                out.append(mark)
                at = end
            out.append(text[at:a])
            end = b
        end = max(end, b)
    return "".join([*out, mark, text[end:]])


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns; secrets in ``text`` masked, ``n_chars`` brought up to date.

    Null texts stay null. A text without secrets stays as it is, with its row.
    """
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        t = names.index("text")
        for batch in batches:
            old = batch.column(t).to_pylist()
            new = [None if x is None else masked(x, mark) for x in old]
            cols = [batch.column(i) for i in range(batch.num_columns)]
            cols[t] = pa.array(new, cols[t].type)
            if "n_chars" in names:
                n = names.index("n_chars")
                was = cols[n].to_pylist()
                cols[n] = pa.array(
                    [w if a == b else len(b) for w, a, b in zip(was, old, new)], cols[n].type
                )
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, schema)
