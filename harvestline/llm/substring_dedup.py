"""Substring dedup: words covered by a window of words that also starts anywhere else.

Level-wise doubling. The lengths are about a quarter, half and the whole of
``window`` (9, 18, 35), each at most twice the one before. Windows that repeat at
one length alone are extended to the next; the work ends at ``window``, as every
longer repeat consists of repeated windows, or when no candidate survives.

- *Quarter.* Of all quarter windows inside a window, the one with the least
  hash is its anchor (the leftmost of equals). Equal windows have equal anchors
  at equal places, and neighbouring windows share theirs, so that about one
  place in fourteen is an anchor. Anchors whose hash occurs once are dropped.
- *Half.* What is left of a window around its anchor has room for the anchor's
  extension to half the window, forwards or backwards. Anchors are dropped
  unless one of the two repeats.
- *Whole.* The windows of each anchor left follow one another; their hashes are
  the anchor's run. Equal runs are counted as one thing; only anchors with runs
  that differ have their windows counted one by one.

Hashes are built the same way: that of a window is mixed from those of its first and
last halves. A window goes by 128 bits, its anchor's hash and its own; texts
are not compared again.

Hot passages: counts combine before each shuffle. Rows go back to their counts
through ``matching``, where frequent keys are broadcast; these are few by
their very frequency. Texts move twice, by the key (doc_id, hash of the text): to meet
their anchors that are left, and to be cut.

Words are runs of anything but ASCII white space, unchanged. A null or empty
text, or one without words, gives no words and keeps an empty text. Texts of
fewer than ``window`` words lose nothing. Very long texts are taken whole.
Repeated rows, and rows of one doc_id, null ones too, are judged as separate
texts; equal ones count as copies. Without rows the result is empty. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestline.llm.common import BROADCAST_BYTES, discard, written
from harvestline.llm.word_arrays import NOT_SPACE, Words, doubled, ladder, text_slices, word_hashes

WINDOW = 35
HOT_ROWS = 1000  # of a key whose rows are not shuffled to one task
KEY = ["doc_id", "text_key"]
SPANS = "array<struct<start: long, stop: long>>"


class Levels:
    """Hashes of the windows of some texts, their anchors, and the runs of starts that share one."""

    def __init__(self, words: Words, window: int):
        quarter, half = levels(window)[:2]
        hashes, at = word_hashes(words), 1
        self.by_length = {1: hashes}
        for length in ladder(window)[1:]:
            hashes, at = doubled(hashes, length - at), length
            self.by_length[length] = hashes
        self.words, self.quarter, self.half, self.window = words, quarter, half, window
        # the leftmost least quarter window of every window
        low = self.by_length[quarter]
        place = np.arange(len(low))
        wide = 1
        for span in ladder(window - quarter + 1)[1:]:
            apart, wide = span - wide, span
            if len(low) <= apart:
                low, place = low[:0], place[:0]
                break
            right = low[apart:] < low[:-apart]
            place = np.where(right, place[apart:], place[:-apart])
            low = np.where(right, low[apart:], low[:-apart])
        left = words.left()[: len(place)]
        self.starts = np.flatnonzero(left >= window)  # of windows inside one text
        self.anchor_of = place[self.starts]
        new = np.ones(len(self.starts), bool)
        new[1:] = self.anchor_of[1:] != self.anchor_of[:-1]
        self.run_starts = np.flatnonzero(new)
        self.anchors = self.anchor_of[self.run_starts]

    def rows(self) -> np.ndarray:
        """The text of each anchor."""
        return np.searchsorted(self.words.bounds, self.anchors, "right") - 1

    def halves(self) -> tuple[pa.Array, pa.Array]:
        """Hashes of the half windows that end and begin with each anchor; null where the text has no room."""
        a, bounds, rows = self.anchors, self.words.bounds, self.rows()
        hashes, out = self.by_length[self.half], []
        back = a - (self.half - self.quarter)
        for start, inside in ((back, back >= bounds[:-1][rows]), (a, a + self.half <= bounds[1:][rows])):
            values = hashes[np.where(inside, start, 0)] if len(a) else hashes[:0]
            out.append(pa.array(values.view(np.int64), mask=~inside))
        return out[0], out[1]


def levels(window: int) -> list[int]:
    """The lengths of the levels: about a quarter, half and the whole of ``window``."""
    half = (window + 1) // 2
    return [(half + 1) // 2, half, window]


def keyed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, text)"""
    text = F.col(text_col).cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def anchors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, at, quarter, before, after) of every anchor; ``at`` counts words from 0."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(2)):
                found = Levels(Words(data, offsets, NOT_SPACE), window)
                if not len(found.anchors):
                    continue
                rows = found.rows()
                at = found.anchors - found.words.bounds[rows]
                part = pa.array(rows + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(part),
                        batch.column(1).take(part),
                        pa.array(at.astype(np.int32)),
                        pa.array(found.by_length[found.quarter][found.anchors].view(np.int64)),
                        *found.halves(),
                    ],
                    names=["doc_id", "text_key", "at", "quarter", "before", "after"],
                )

    return docs.mapInArrow(find, "doc_id long, text_key long, at int, quarter long, before long, after long")


def runs(marked: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, quarter, first, hashes) of the anchors in ``at`` of texts (doc_id, text_key, text, at).

    ``first`` is the first of the anchor's windows, ``hashes`` are those of the windows.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted_at = batch.column(3)
            for a, b, data, offsets in text_slices(batch.column(2)):
                found = Levels(Words(data, offsets, NOT_SPACE), window)
                asked = wanted_at.slice(a, b - a)
                base = np.repeat(found.words.bounds[:-1], np.diff(_offsets(asked)))
                wanted = np.zeros(len(found.words) + 1, bool)
                wanted[base + asked.flatten().to_numpy()] = True
                of_run = np.flatnonzero(wanted[found.anchors])
                if not len(of_run):
                    continue
                stops = np.append(found.run_starts[1:], len(found.starts))[of_run]
                first = found.run_starts[of_run]
                sizes = stops - first
                each = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
                hashes = found.by_length[window][found.starts[each]].view(np.int64)
                rows = found.rows()[of_run]
                part = pa.array(rows + a)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(hashes)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(part),
                        batch.column(1).take(part),
                        pa.array(found.by_length[found.quarter][found.anchors[of_run]].view(np.int64)),
                        pa.array((found.starts[first] - found.words.bounds[rows]).astype(np.int32)),
                        lists,
                    ],
                    names=["doc_id", "text_key", "quarter", "first", "hashes"],
                )

    return marked.mapInArrow(find, "doc_id long, text_key long, quarter long, first int, hashes array<long>")


def _offsets(lists: pa.Array) -> np.ndarray:
    return lists.offsets.to_numpy().astype(np.int64)


def repeated(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, n) of the keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def matching(rows: DataFrame, found: DataFrame, keys: Sequence[str], width: int = 48, how: str = "left_semi") -> DataFrame:
    """``rows`` joined to ``found``, which has each key once with the number ``n`` of its rows.

    Keys of ``HOT_ROWS`` rows or more, or of so many more that not over
    ``BROADCAST_BYTES`` of them can exist, are broadcast; the others are shuffled, and
    none of them has more rows than that. It is so at every size.
    """
    n_rows = found.agg(F.sum("n")).first()[0] or 0
    many = max(HOT_ROWS, -(-n_rows * width // BROADCAST_BYTES))
    hot = F.broadcast(found.where(F.col("n") >= many).drop("n"))
    cold = found.where(F.col("n") < many).drop("n")
    return rows.join(hot, list(keys), how).union(rows.join(hot, list(keys), "left_anti").join(cold, list(keys), how))


def candidates(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, at) of the anchors that survive the quarter and the half level."""
    found = written(anchors(docs, window), "anchors")
    counted = written(repeated(found, ["quarter"]), "quarters")
    alive = written(matching(found, counted, ["quarter"]), "quarter-level")
    discard(found, counted)
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("before").alias("half")),
        F.struct(F.lit(1).alias("side"), F.col("after").alias("half")),
    )
    halves = alive.select(*KEY, "at", F.inline(sides)).where("half is not null")
    counted = written(repeated(halves, ["side", "half"]), "halves")
    out = written(matching(halves, counted, ["side", "half"]).groupBy(*KEY).agg(F.collect_set("at").alias("at")), "half-level")
    discard(alive, counted)
    return out


def by_key(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the row's key, whose doc_id may be null; ``right`` has each key once."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in KEY})
    on = (F.col("text_key") == F.col("_text_key")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    return left.join(right, on, how).drop(*[f"_{k}" for k in KEY])


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, found): the starts of the repeated windows of each text, as (first, size, offsets).

    ``offsets`` are those of the repeated windows from ``first`` on, null if all ``size`` are.
    """
    alive = candidates(docs, window)
    marked = by_key(docs, alive, "inner").select(*KEY, "text", "at")
    all_runs = written(runs(marked, window).withColumn("digest", F.xxhash64("hashes")), "runs")
    discard(alive)
    distinct = written(
        all_runs.groupBy("quarter", "digest").agg(F.count(F.lit(1)).alias("n"), F.first("hashes").alias("hashes")), "distinct-runs"
    )
    several = written(repeated(distinct, ["quarter"]), "several")
    differing = written(
        matching(distinct, several, ["quarter"]).select(
            "quarter", "digest", "n", F.posexplode("hashes").alias("offset", "hash")
        ),
        "windows",
    )
    # a window repeats if its runs occur more than once in all
    again = written(
        differing.groupBy("quarter", "hash").agg(F.sum("n").alias("times"), F.count(F.lit(1)).alias("n")).where("times > 1").drop("times"),
        "repeated-windows",
    )
    partly = (
        matching(differing.select("quarter", "digest", "n", "offset", "hash"), again, ["quarter", "hash"])
        .groupBy("quarter", "digest")
        .agg(F.max("n").alias("n"), F.collect_set("offset").alias("offsets"))
    )
    wholly = distinct.where("n > 1").select("quarter", "digest", "n", F.lit(None).cast("array<int>").alias("offsets"))
    outcome = written(partly.where("n = 1").unionByName(wholly), "outcome")
    result = written(
        matching(all_runs.withColumn("size", F.size("hashes")).drop("hashes"), outcome, ["quarter", "digest"], 96 + 4 * window, "inner")
        .groupBy(*KEY)
        .agg(F.collect_set(F.struct("first", "size", "offsets")).alias("found")),
        "found",
    )
    discard(all_runs, distinct, several, differing, again, outcome)
    return result


def covered(n_words: int, found: list[dict], window: int) -> np.ndarray:
    """Which of a text's words lie in a repeated window."""
    change = np.zeros(n_words + 1, np.int64)
    for f in found:
        first = f["first"]
        starts = range(f["size"]) if f["offsets"] is None else f["offsets"]
        for s in starts:
            change[first + s] += 1
            change[first + s + window] -= 1
    return np.cumsum(change[:-1]) > 0


def deduplicated(docs: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) of every row of docs.

    ``spans`` are the removed runs of words, in order, from 0, end exclusive;
    ``kept`` holds the other words, joined by one space.
    """
    texts = keyed(docs, text_col)
    found = repeated_windows(texts, window)
    rows = by_key(texts, found, "left").select("doc_id", "text", "found")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, spans, kept = [], [], [], []
            # a text at a time: Python holds one text and its words
            for text, where in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode().split()
                counts.append(len(words))
                out = []
                if where.is_valid:
                    gone = covered(len(words), where.as_py(), window)
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                    out = edges.reshape(-1, 2).tolist()
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                spans.append([{"start": a, "stop": b} for a, b in out])
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words).decode())
            kinds = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kinds), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    return rows.mapInArrow(cut, f"doc_id long, n_words long, n_removed long, spans {SPANS}, kept string")
