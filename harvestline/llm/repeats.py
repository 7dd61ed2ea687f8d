"""Suffix-array dedup: repeated byte strings by merging shard Burrows-Wheeler transforms.

A byte is removed if a ``LENGTH``-byte string that covers it also starts
anywhere else, in the same document or another; matches never cross documents
and are judged on the input.

Texts are parsed into phrases first, so that the transforms are short: a
boundary is where a hash of ``HASHED`` bytes is strictly the least within
``REACH`` positions on both sides. A boundary depends on the bytes around it
alone, so equal strings have equal boundaries inside. Each shard (documents of
about ``SHARD_BYTES``) gets the suffix array and Burrows-Wheeler transform of its
phrase sequences, sorted by phrase hash, an order that all shards share.

Merging in rounds, with hashed prefix blocks in place of an interleave of ranks: a
round takes every shard's blocks of suffixes with a common prefix of h phrases
to h + 1 phrases, by the suffix before in the text and the phrase that the
transform holds. A shard tells only its distinct blocks and their sizes; summed
over the shards they say which blocks of the merged array hold more than one
suffix. Blocks of one suffix are finished, h is its longest common prefix; the
others go on until their common prefix covers ``CORE`` bytes. No suffix is sorted
again. What remains are the repeated intervals.

An exact check on bytes follows. All windows of ``LENGTH`` bytes whose first inner
boundary starts a repeated interval form a stretch. Windows that have no inner
interval (too few boundaries, as in periodic texts) form stretches by the place
of their least hash. A stretch whose whole content occurs twice is repeated at
once. A label with any other stretch has its distinct stretches compared: up to
``GROUP_KINDS`` in one task, side by side from the place that they share; more by
128-bit hashes of their windows.

Null text is empty text. Rows are identified by doc_id and text, so equal rows
get equal results, and are copies of each other. Long texts are parsed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline.llm.common import discard, drop_worker_state, hinted, written

LENGTH = 400
REACH = 20
HASHED = 8
CORE = 150  # bytes that a repeated interval's common prefix covers at least
SHARD_BYTES = 6 << 20  # a shard is a row of a few MB, of which a task holds some at a time
DEPTH = 8  # phrases by which suffixes are sorted: CORE / (REACH + 1), a power of two
GROUP_KINDS = 4096  # contents of an interval (2 MB) that one task compares; more are compared by window
# A boundary at i is decided by the bytes i - REACH .. i + AFTER - 1.
AFTER = REACH + HASHED

_U = np.uint64
_SPREAD = _U(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(0xB17E)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_STEP = _U(int(_RNG.integers(1 << 40, 1 << 62)) * 2 + 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return (x ^ (x >> _U(29))) * _U(0xFF51AFD7ED558CCD)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for every i that has them all."""
    out, have = x, 1
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    if have < width:
        gap = width - have
        out = np.minimum(out[:-gap], out[gap:])
    return out


def place_hashes(b: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the HASHED bytes from each place on."""
    x = b[:-1].astype(np.uint16) | (b[1:].astype(np.uint16) << 8)
    x = x[:-2].astype(np.uint32) | (x[2:].astype(np.uint32) << 16)
    x = x[:-4].astype(_U) | (x[4:].astype(_U) << _U(32))
    return ((x * _SPREAD) >> _U(32)).astype(np.uint32)


def boundaries(b: np.ndarray) -> np.ndarray:
    """Places of the content-defined boundaries of one text's bytes."""
    n = len(b) - HASHED + 1
    if n < 2 * REACH + 1:
        return np.zeros(0, np.int64)
    h = place_hashes(b)
    side = _least(h, REACH)
    at = h[REACH : n - REACH]
    return np.flatnonzero((at < side[: len(at)]) & (at < side[REACH + 1 : REACH + 1 + len(at)])) + REACH


def phrase_hashes(b: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes between each boundary and the next."""
    if len(bounds) < 2:
        return np.zeros(0, _U)
    sizes = np.diff(bounds)
    place = np.arange(bounds[0], bounds[-1]) - np.repeat(bounds[:-1], sizes)
    longest = int(sizes.max())
    powers = np.cumprod(np.full(longest, _STEP, _U))
    terms = _BYTE[b[bounds[0] : bounds[-1]]] * powers[place]
    return _mix(np.add.reduceat(terms, bounds[:-1] - bounds[0]) + sizes.astype(_U)) | _U(1)


class Shard:
    """Suffix order of the phrase sequences of some documents."""

    def __init__(self, docs: list[np.ndarray]):
        n = np.array([len(d) for d in docs])
        self.phrases = np.concatenate([*docs, np.zeros(0, _U)])
        m = len(self.phrases)
        ends = np.repeat(np.cumsum(n), n)  # of each place: where its document ends
        _, rank = np.unique(self.phrases, return_inverse=True)
        rank = rank.astype(np.int64) + 1
        step = 1
        while step < DEPTH:
            far = np.arange(m) + step
            tail = np.where(far < ends, rank[np.minimum(far, m - 1)], 0) if m else rank
            _, rank = np.unique(rank * (m + 2) + tail, return_inverse=True)
            rank = rank.astype(np.int64) + 1
            step *= 2
        self.order = np.argsort(rank, kind="stable").astype(np.int64)


def transform(phrases: np.ndarray, order: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The Burrows-Wheeler transform: each sorted suffix's phrase before it, 0 where a document starts."""
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.where(order > starts[order], phrases[np.maximum(order - 1, 0)], _U(0))


PARSE = (
    "shard long, docs array<binary>, steps binary, n_bounds binary, n_bytes binary, "
    "phrases binary, order binary"
)
STATE = (
    "shard long, place binary, label binary, cover binary, before binary, width binary, "
    "keys array<long>, counts array<int>"
)


def _distinct(labels: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Distinct neighbours in sorted-suffix order with their counts: the blocks."""
    if not len(labels):
        return [], []
    first = np.flatnonzero(np.concatenate([[True], labels[1:] != labels[:-1]]))
    return labels[first].view(np.int64), np.diff(np.append(first, len(labels))).astype(np.int32)


def parsed(docs: DataFrame) -> DataFrame:
    """One row per shard: its documents' boundaries, and its suffixes with one-phrase blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        keys, bounds, hashes, sizes, held = [], [], [], [], 0

        def flush():
            nonlocal keys, bounds, hashes, sizes, held, number
            shard = Shard(hashes)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([keys], pa.list_(pa.binary())),
                    *_blobs(
                        # boundaries as steps: small numbers, that pack well
                        (np.concatenate([np.diff(x, prepend=0) for x in bounds]), np.int32),
                        (np.array([len(x) for x in bounds]), np.int32),
                        (np.array(sizes), np.int32),
                        (shard.phrases, _U),
                        (shard.order, np.int32),
                    ),
                ],
                names=[c.split()[0] for c in PARSE.split(", ")],
            )
            keys, bounds, hashes, sizes, held = [], [], [], [], 0
            number += 1
            return out

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                b = np.frombuffer(text.as_py().encode(), np.uint8)
                if len(b) < LENGTH:
                    continue
                at = boundaries(b)
                keys.append(key.as_py())
                bounds.append(at)
                hashes.append(phrase_hashes(b, at))
                sizes.append(len(b))
                held += len(b)
                if held >= SHARD_BYTES:
                    yield flush()
        if keys:
            yield flush()

    return docs.select("key", "text").mapInArrow(run, PARSE)


def _blobs(*arrays) -> list[pa.Array]:
    return [pa.array([np.ascontiguousarray(x, t).tobytes()], pa.binary()) for x, t in arrays]


def _read(batch: pa.RecordBatch, row: int, names_types: dict) -> dict[str, np.ndarray]:
    at = {n: i for i, n in enumerate(batch.schema.names)}
    return {n: np.frombuffer(batch.column(at[n])[row].as_py(), t) for n, t in names_types.items()}


SUFFIXES = {"place": np.int32, "label": _U, "cover": np.int32, "before": _U, "width": np.int32}


def initial(parse: DataFrame) -> DataFrame:
    """The first state: every suffix in the block of its first phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for batch in batches:
            for i in range(batch.num_rows):
                d = _read(batch, i, {"steps": np.int32, "n_bounds": np.int32, "phrases": _U, "order": np.int32})
                sizes = np.maximum(d["n_bounds"] - 1, 0)
                first = np.cumsum(d["n_bounds"]) - d["n_bounds"]
                inner = np.ones(len(d["steps"]), bool)
                inner[first[d["n_bounds"] > 0]] = False
                width, order, phrases = d["steps"][inner], d["order"], d["phrases"]
                before = transform(phrases, order, sizes)
                s = {
                    "place": order,
                    "label": phrases[order],
                    "cover": width[order],
                    "before": before,
                    "width": np.where(before != 0, width[np.maximum(order - 1, 0)], 0),
                }
                yield _state(batch.column(0).slice(i, 1), s)

    return parse.select("shard", "steps", "n_bounds", "phrases", "order").mapInArrow(run, STATE)


def _state(shard: pa.Array, s: dict[str, np.ndarray]) -> pa.RecordBatch:
    blocks, counts = _distinct(s["label"][s["cover"] > 0])
    return pa.RecordBatch.from_arrays(
        [
            shard,
            *_blobs(*((s[n], t) for n, t in SUFFIXES.items())),
            pa.array([blocks], pa.list_(pa.int64())),
            pa.array([counts], pa.list_(pa.int32())),
        ],
        names=[c.split()[0] for c in STATE.split(", ")],
    )


def lone_blocks(state: DataFrame) -> DataFrame:
    """(shard, found): the labels that one suffix alone has in the merged array, by its shard.

    Blocks are pre-aggregated by shard, so the most frequent phrase costs a row
    per shard; a lone suffix's shard is the only one that tells of its label.
    """
    blocks = state.select("shard", F.explode(F.arrays_zip("keys", "counts")).alias("b")).select(
        "shard", F.col("b.keys").alias("label"), F.col("b.counts").cast("long").alias("n")
    )
    return (
        blocks.groupBy("label")
        .agg(F.sum("n").alias("n"), F.min("shard").alias("shard"))
        .where("n = 1")
        .groupBy("shard")
        .agg(F.collect_list("label").alias("found"))
    )


def refined(state: DataFrame, found: DataFrame, first: bool) -> DataFrame:
    """The next round's state: finished suffixes go, the others' prefixes grow by a phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                s = _read(batch, i, SUFFIXES)
                labels = batch.column(at["found"])[i].values
                labels = np.sort(labels.to_numpy()) if labels is not None else np.zeros(0, np.int64)
                # suffixes of this round's blocks; those that reached CORE earlier are settled
                settled = s["cover"] < 0
                own = s["label"].view(np.int64)
                live = np.ones(len(own), bool)
                if len(labels):
                    k = np.minimum(np.searchsorted(labels, own), len(labels) - 1)
                    live = settled | (labels[k] != own)
                s = {n: x[live] for n, x in s.items()}
                settled, cover = settled[live], s["cover"]
                # last-to-first: the suffix before, if its own prefix is to grow
                by_place = np.argsort(s["place"])
                places = s["place"][by_place]
                grown = np.flatnonzero(~settled & (s["before"] != 0))
                want = s["place"][grown] - 1
                k = np.minimum(np.searchsorted(places, want), max(0, len(places) - 1))
                there = places[k] == want if len(places) else np.zeros(0, bool)
                target, source = by_place[k[there]] if len(places) else k, grown[there]
                open_ = (cover[target] >= 0) & (cover[target] < CORE)
                target, source = target[open_], source[open_]
                label, next_cover = s["label"].copy(), np.full(len(cover), 0, np.int32)
                done = settled | (cover >= CORE)
                next_cover[done] = -np.abs(cover[done])
                label[target] = _mix(s["before"][source] + _mix(s["label"][source]))
                next_cover[target] = s["width"][source] + cover[source]
                keep = next_cover != 0
                s = {n: x[keep] for n, x in (s | {"label": label, "cover": next_cover}).items()}
                yield _state(batch.column(at["shard"]).slice(i, 1), s)

    columns = ["shard", *SUFFIXES]
    if not first:  # most labels are found alone in the first round
        found = hinted(found, 8 * F.size("found"))
    return state.select(columns).join(found, "shard", "left").mapInArrow(run, STATE)


def intervals(parse: DataFrame) -> DataFrame:
    """(shard, place, label, cover) of the suffixes in repeated intervals that cover CORE bytes."""
    state, first = initial(parse), True
    while True:
        found = written(lone_blocks(state), "blocks")
        grown, first = written(refined(state, found, first), "merge"), False
        discard(state, found)
        state = grown
        if not state.where(F.size("keys") > 0).limit(1).count():
            return state


STRETCHES = "key binary, label array<long>, low array<long>, high array<long>, anchor array<long>, loose_low array<long>, loose_high array<long>"


def stretches(parse: DataFrame, found: DataFrame) -> DataFrame:
    """Per document: its stretches (label, first and last window start) and loose window starts.

    A window start p belongs to the first boundary j with b_j >= p + REACH if
    the CORE prefix of j ends within the window's inner part; then it is in a
    stretch if that prefix is repeated, and in no repeat if it isn't. Other
    windows are loose. Documents with neither get no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for batch in batches:
            for i in range(batch.num_rows):
                s = _read(batch, i, {"place": np.int32, "label": _U, "cover": np.int32})
                d = _read(batch, i, dict.fromkeys(("steps", "n_bounds", "n_bytes"), np.int32))
                d = {n: x.astype(np.int64) for n, x in d.items()}
                keys = batch.column(batch.schema.names.index("docs"))[i].as_py()
                at = np.argsort(s["place"])
                places, labels = s["place"][at], s["label"][at].view(np.int64)
                rows: dict[str, list] = {c.split()[0]: [] for c in STRETCHES.split(", ")}
                first_bound = np.cumsum(d["n_bounds"]) - d["n_bounds"]
                n_phrases = np.maximum(d["n_bounds"] - 1, 0)
                first_phrase = np.cumsum(n_phrases) - n_phrases
                los = np.searchsorted(places, first_phrase)
                his = np.searchsorted(places, first_phrase + n_phrases)
                for key, n, fb, nb, fp, lo, hi in zip(
                    keys, d["n_bytes"].tolist(), first_bound.tolist(), d["n_bounds"].tolist(),
                    first_phrase.tolist(), los.tolist(), his.tolist(),
                ):
                    b = np.cumsum(d["steps"][fb : fb + nb])
                    got = _document_stretches(b, n, places[lo:hi] - fp, labels[lo:hi])
                    if got is not None:
                        rows["key"].append(key)
                        for name, x in zip(list(rows)[1:], got):
                            rows[name].append(x)
                if rows["key"]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows["key"], pa.binary())]
                        + [pa.array(x, pa.list_(pa.int64())) for x in list(rows.values())[1:]],
                        names=list(rows),
                    )

    docs = parse.select("shard", "docs", "steps", "n_bounds", "n_bytes")
    return docs.join(found.select("shard", "place", "label", "cover"), "shard").mapInArrow(run, STRETCHES)


def _document_stretches(b: np.ndarray, n: int, places: np.ndarray, labels: np.ndarray):
    """(labels, lows, highs, anchors, loose lows, loose highs) of one document, or None."""
    last = n - LENGTH  # last window start
    if not len(b):
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.array([0]), np.array([last])
    # window starts by first boundary j: b_(j-1) - REACH + 1 .. b_j - REACH
    low = np.concatenate([[0], b[:-1] - REACH + 1])
    high = b - REACH
    # where the prefix of j ends: the first boundary CORE bytes on
    end_at = np.searchsorted(b, b + CORE)
    end = np.where(end_at < len(b), b[np.minimum(end_at, len(b) - 1)], n + LENGTH)
    # the window holds that end with the bytes that decide it from here on
    inner = end + AFTER - LENGTH
    high = np.minimum(high, last)
    low = np.maximum(low, 0)
    tight_low = np.maximum(low, inner)
    repeated = np.zeros(len(b), bool)
    label = np.zeros(len(b), np.int64)
    repeated[places], label[places] = True, labels
    use = repeated & (tight_low <= high)
    loose_high = np.minimum(high, inner - 1)
    loose = low <= loose_high
    loose_lows, loose_highs = low[loose], loose_high[loose]
    rest = max(0, int(b[-1]) - REACH + 1)  # after the last boundary
    if rest <= last:
        loose_lows, loose_highs = np.append(loose_lows, rest), np.append(loose_highs, last)
    if not use.any() and not len(loose_lows):
        return None
    return label[use], tight_low[use], high[use], b[use], loose_lows, loose_highs


MARKED = "key binary, no long, text string, label array<long>, low array<long>, high array<long>, anchor array<long>"


def loose_stretches(b: np.ndarray, low: int, high: int):
    """(labels, lows, highs, anchors) of the window starts low .. high that have no inner interval.

    A window's anchor is the first place of the least hash in its inner part;
    neighbours with one anchor form a stretch, labelled by the bytes around it.
    """
    inner = place_hashes(b[low + REACH : high + LENGTH - AFTER + HASHED]).astype(_U)
    ranked = (inner << _U(32)) | np.arange(len(inner), dtype=_U)
    least = _least(ranked, LENGTH - AFTER - REACH + 1) & _U(0xFFFFFFFF)
    anchors = least.astype(np.int64) + low + REACH
    first = np.flatnonzero(np.diff(anchors, prepend=-1))
    lows, anchors = first + low, anchors[first]
    highs = np.append(lows[1:] - 1, high)
    view = memoryview(b)
    labels = [xxhash.xxh3_64_intdigest(view[a - REACH : a + AFTER]) for a in anchors.tolist()]
    return np.array(labels, _U).view(np.int64), lows, highs, anchors


def with_loose(marked: DataFrame) -> DataFrame:
    """Marked documents with stretches for their loose windows, too."""
    columns = ["key", "no", "text", "label", "low", "high", "anchor"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for batch in batches:
            lists: list[list] = [[] for _ in range(4)]
            for i in range(batch.num_rows):
                found = [[batch.column(c)[i].values.to_numpy()] for c in range(3, 7)]
                lows, highs = (batch.column(c)[i].as_py() for c in (7, 8))
                if lows:
                    b = np.frombuffer(batch.column(2)[i].as_py().encode(), np.uint8)
                    for low, high in zip(lows, highs):
                        for x, more in zip(found, loose_stretches(b, low, high)):
                            x.append(more)
                for x, parts in zip(lists, found):
                    x.append(np.concatenate(parts))
            arrays = [pa.array(x, pa.list_(pa.int64())) for x in lists]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(3)), *arrays], names=columns)

    return marked.select(*columns, "loose_low", "loose_high").mapInArrow(run, MARKED)


def contents(marked: DataFrame) -> DataFrame:
    """(no, at, label, content): each stretch with a hash of all its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for batch in batches:
            for i in range(batch.num_rows):
                no, text, label, low, high = (batch.column(c)[i].as_py() for c in range(5))
                if not label:
                    continue
                b = memoryview(text.encode())
                found = [xxhash.xxh3_128_digest(b[x : y + LENGTH]) for x, y in zip(low, high)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([no] * len(label), pa.int64()),
                        pa.array(range(len(label)), pa.int32()),
                        pa.array(label, pa.int64()),
                        pa.array(found, pa.binary()),
                    ],
                    names=["no", "at", "label", "content"],
                )

    return marked.select("no", "text", "label", "low", "high").mapInArrow(
        run, "no long, at int, label long, content binary"
    )


def distinct_contents(found: DataFrame) -> DataFrame:
    """(label, content, n, one): the distinct stretches, how often they are there, and one of them."""
    return found.groupBy("label", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("no", "at")).alias("one")
    )


def planned(distinct: DataFrame) -> DataFrame:
    """(no, at, label, lone, kinds): stretches whose windows are still to be compared.

    Of each distinct content one stretch stands for all. Those of a content
    that is there once are ``lone``; an interval that has any is compared, all
    its distinct contents (``kinds`` of them) with one another.
    """
    kinds = (
        distinct.groupBy("label")
        .agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("kinds"))
        .where("least = 1")
        .select("label", "kinds")
    )
    return distinct.join(kinds, "label").select("one.no", "one.at", "label", (F.col("n") == 1).alias("lone"), "kinds")


def lone_stretches(plan: DataFrame) -> DataFrame:
    return plan.where("lone").groupBy("no").agg(F.collect_list("at").alias("lone"))


PIECES = "no long, label long, many boolean, lone boolean, low long, high long, anchor long, bytes binary"


def pieces(marked: DataFrame, plan: DataFrame) -> DataFrame:
    """The bytes of each stretch to compare, with its place in its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for batch in batches:
            for i in range(batch.num_rows):
                no, text, label, low, high, anchor, wanted = (batch.column(c)[i].as_py() for c in range(7))
                b = memoryview(text.encode())
                rows = [
                    (label[k], bool(w & 1), bool(w & 2), low[k], high[k], anchor[k], bytes(b[low[k] : high[k] + LENGTH]))
                    for w in wanted
                    for k in [w >> 2]
                ]
                types = [pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([no] * len(rows), pa.int64())]
                    + [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    names=[c.split()[0] for c in PIECES.split(", ")],
                )

    # a number per stretch: its place, whether it is lone, whether its contents are many
    flags = 4 * F.col("at") + F.when(F.col("lone"), 2).otherwise(0) + F.when(F.col("kinds") > GROUP_KINDS, 1).otherwise(0)
    wanted = plan.where("kinds > 1").groupBy("no").agg(F.collect_list(flags.cast("int")).alias("wanted"))
    wanted = hinted(written(wanted, "wanted"), 64 + 4 * F.size("wanted"))
    columns = ["no", "text", "label", "low", "high", "anchor", "wanted"]
    return marked.join(wanted, "no").select(columns).mapInArrow(run, PIECES)


ROWS_AT_ONCE = 4096  # contents that are laid out side by side, beyond a whole interval's
PAIRS_AT_ONCE = 1 << 18


def _common_next(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray, step: int) -> np.ndarray:
    """Length of the common prefix of each row with the next; a row is read from ``first`` on by ``step``."""
    out = np.zeros(max(0, len(first) - 1), np.int64)
    for at in range(0, len(out), 1024):
        n = sizes[at : at + 1025]
        along = np.arange(max(1, int(n.max())))
        grid = flat[np.clip(first[at : at + 1025, None] + step * along, 0, len(flat) - 1)]
        shorter = np.minimum(n[:-1], n[1:])
        differs = (grid[:-1] != grid[1:]) | (along >= shorter[:, None])
        out[at : at + len(shorter)] = np.where(differs.any(axis=1), differs.argmax(axis=1), shorter)
    return out


def _range_least(x: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minima of x over 2 ** k neighbours."""
    levels = [x]
    while len(levels[-1]) > 1 << (len(levels) - 1):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


class Prefixes:
    """Common prefixes of any two rows of a group, from the rows' sorted order.

    Rows sorted within their group have, with any other, the least of the common
    prefixes between neighbours on the way.
    """

    def __init__(self, rows: list[bytes], groups: list[tuple[int, int]], flat, first, sizes, step: int):
        order = [i for a, b in groups for i in sorted(range(a, b), key=rows.__getitem__)]
        at = np.array(order, np.int64)
        self.sizes, self.rank = sizes, np.empty(len(at), np.int64)
        self.rank[at] = np.arange(len(at))
        self.levels = _range_least(_common_next(flat, first[at], sizes[at], step))

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of rows i with rows j, each of i's group; a row with itself has its length."""
        low, high = np.minimum(self.rank[i], self.rank[j]), np.maximum(self.rank[i], self.rank[j])
        out = self.sizes[i].copy()
        level = np.frexp(np.maximum(high - low, 1).astype(np.float64))[1] - 1
        for k in np.unique(level[high > low]).tolist():
            own = np.flatnonzero((level == k) & (high > low))
            x = self.levels[k]
            out[own] = np.minimum(x[low[own]], x[high[own] - (1 << k)])
        return out


def _shared_ranges(no, lone, low, high, anchor, found: pa.Array, groups: list[tuple[int, int]]):
    """(no, low, high) arrays: window starts of lone stretches that another one of their group holds."""
    rows = found.to_pylist()
    sizes = np.array([len(r) for r in rows], np.int64)
    flat = np.frombuffer(b"".join(rows), np.uint8)
    at = np.cumsum(sizes) - sizes
    cuts = anchor - low
    right = Prefixes([r[c:] for r, c in zip(rows, cuts.tolist())], groups, flat, at + cuts, sizes - cuts, 1)
    left = Prefixes([r[:c][::-1] for r, c in zip(rows, cuts.tolist())], groups, flat, at + cuts - 1, cuts, -1)
    start = np.concatenate([np.full(b - a, a) for a, b in groups])
    kinds = np.concatenate([np.full(b - a, b - a) for a, b in groups])
    open_ = np.flatnonzero(lone)
    upto = np.cumsum(kinds[open_])
    begin = 0
    while begin < len(open_):
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + PAIRS_AT_ONCE, "right")))
        part, begin = open_[begin:end], end
        i = np.repeat(part, kinds[part])
        j = np.arange(len(i)) - np.repeat(np.cumsum(kinds[part]) - kinds[part], kinds[part]) + start[i]
        x = np.maximum(low[i], anchor[i] - left.of(i, j))
        y = np.minimum(high[i], anchor[i] - LENGTH + right.of(i, j))
        own = np.flatnonzero((x <= y) & (i != j))
        i, x, y = np.unique(np.stack([i[own], x[own], y[own]]), axis=1)
        yield no[i], x, y


RANGES = "no long, low long, high long"


def compared_in_groups(few: DataFrame) -> DataFrame:
    """(no, low, high): repeated window starts of lone stretches, from intervals of few contents.

    Two contents are aligned at their anchor. The window at d bytes before it
    is common to both if they agree on d bytes to the left and LENGTH - d to the
    right. How far two agree on a side comes from the sorted order of all on that
    side (``Prefixes``), so bytes are compared between neighbours alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for batch in batches:
            group = batch.column(0)
            # intervals side by side until they have ROWS_AT_ONCE contents
            begin, held = 0, 0
            for end in range(1, len(group) + 1):
                held += len(group[end - 1])
                if held < ROWS_AT_ONCE and end < len(group):
                    continue
                part = group.slice(begin, end - begin)
                edges = np.append(0, np.cumsum(pc.list_value_length(part).to_numpy(zero_copy_only=False)))
                rows = part.flatten()
                no, lone, low, high, anchor = (rows.field(k).to_numpy(zero_copy_only=False) for k in range(5))
                groups = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
                for found in _shared_ranges(no, lone, low, high, anchor, rows.field(5), groups):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()) for x in found], names=["no", "low", "high"]
                    )
                begin, held = end, 0

    groups = few.groupBy("label").agg(
        F.collect_list(F.struct("no", "lone", "low", "high", "anchor", "bytes")).alias("group")
    )
    return groups.select("group").mapInArrow(run, RANGES)


def single_windows(many: DataFrame) -> DataFrame:
    """(content, no, starts, open): the distinct windows of intervals with many contents.

    A window that a stretch holds several times is repeated already; it stays
    one row.
    """

    def batches_of(rows):
        for i in range(0, len(rows), 20_000):
            part = rows[i : i + 20_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in part], pa.binary()),
                    pa.array([r[1] for r in part], pa.int64()),
                    pa.array([r[2] for r in part], pa.list_(pa.int64())),
                    pa.array([r[3] for r in part], pa.bool_()),
                ],
                names=["content", "no", "starts", "open"],
            )

    def windows_in(no, b, spans, open_):
        places: dict[bytes, list[int]] = {}
        for low, high in spans:
            for p in range(low, high + 1):
                places.setdefault(xxhash.xxh3_128_digest(b[p : p + LENGTH]), []).append(p)
        return [(c, no, x, open_) for c, x in places.items()]

    def of_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                no, lone, low, high, b = (batch.column(c)[i].as_py() for c in range(5))
                rows = windows_in(no, memoryview(b), [(0, high - low)], lone)
                yield from batches_of([(c, n, [low + p for p in x], o) for c, n, x, o in rows])

    schema = "content binary, no long, starts array<long>, open boolean"
    return many.select("no", "lone", "low", "high", "bytes").mapInArrow(of_pieces, schema)


def compared_singly(found: DataFrame) -> DataFrame:
    """(no, low, high): the open windows whose content occurs again."""
    twice = (
        found.groupBy("content")
        .agg(F.sum(F.size("starts").cast("long")).alias("n"))
        .where("n > 1")
        .select("content")
    )
    starts = found.where("open").join(twice, "content", "left_semi").select("no", F.explode("starts").alias("low"))
    return starts.select("no", "low", F.col("low").alias("high"))


def runs_of(low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the half-open ranges low .. high."""
    out: list[list[int]] = []
    for a, b in sorted(zip(low, high)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


REMOVED = "key binary, spans array<struct<start: long, stop: long>>, n_removed long, n_spans long, kept_sha256 string"


def removed(marked: DataFrame, lone: DataFrame, again: DataFrame) -> DataFrame:
    """Per document with repeats: the removed runs and the digest of what stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                key, text, low, high, lone, again = (batch.column(c)[i].as_py() for c in range(6))
                alone = set(lone or ())
                ranges = [(x, y + LENGTH) for k, (x, y) in enumerate(zip(low, high)) if k not in alone]
                ranges += [(r["low"], r["high"] + LENGTH) for r in again or ()]
                if not ranges:
                    continue
                spans = runs_of(*zip(*ranges))
                b, digest, at = memoryview(text.encode()), hashlib.sha256(), 0
                for x, y in spans:
                    digest.update(b[at:x])
                    at = y
                digest.update(b[at:])
                rows.append((key, [{"start": x, "stop": y} for x, y in spans], sum(y - x for x, y in spans), len(spans), digest.hexdigest()))
            if rows:
                span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                types = [pa.binary(), span, pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    names=["key", "spans", "n_removed", "n_spans", "kept_sha256"],
                )

    return (
        marked.join(hinted(lone, 64 + 4 * F.size("lone")), "no", "left")
        .join(hinted(again, 64 + 32 * F.size("again")), "no", "left")
        .select("key", "text", "low", "high", "lone", "again")
        .mapInArrow(run, REMOVED)
    )


def repeats_removed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row of docs (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")
    ).withColumn("key", F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text"))))
    parse = written(parsed(keyed), "parse")
    merged = intervals(parse)
    marks = written(stretches(parse, merged).dropDuplicates(["key"]), "stretches")
    discard(parse, merged)
    # texts of documents with repeated intervals alone go through a shuffle
    own = keyed.select("key", "text").join(hinted(marks.select("key"), F.lit(48)), "key", "left_semi")
    marked = written(
        own.dropDuplicates(["key"])
        .join(marks, "key")
        .withColumn("no", F.monotonically_increasing_id()),
        "texts",
    )
    texts, marked = marked, written(with_loose(marked), "marked")
    discard(texts)
    discard(marks)
    distinct = written(distinct_contents(contents(marked)), "contents")
    plan = written(planned(distinct), "plan")
    discard(distinct)
    parts = written(pieces(marked, plan), "pieces")
    windows = written(single_windows(parts.where("many")), "windows")
    again = compared_in_groups(parts.where("not many")).union(compared_singly(windows))
    again = again.groupBy("no").agg(F.collect_set(F.struct("low", "high")).alias("again"))
    again, lone = written(again, "again"), written(lone_stretches(plan), "lone")
    found = written(removed(marked, lone, again), "removed")
    discard(marked, plan, parts, windows, again, lone)
    base = keyed.select(
        "key", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")
    )
    # equal rows are copies of each other, whole
    again = base.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("n_bytes").alias("m")).where(
        f"n > 1 and m >= {LENGTH}"
    ).select("key", F.lit(True).alias("copied"))
    copied = F.col("copied").isNotNull()
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    no_spans = F.array().cast("array<struct<start: long, stop: long>>")
    return base.join(found, "key", "left").join(again, "key", "left").select(
        "doc_id",
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copied, whole).otherwise(F.coalesce("spans", no_spans)).alias("spans"),
    )
