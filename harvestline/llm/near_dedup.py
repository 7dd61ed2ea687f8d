"""MinHash near-dedup with sequential Bayesian verification.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a document's set is its
distinct k-word shingles (fewer words: the whole sequence as one; none: empty).

1. Sketch: one scan gives each document its set size, a key of its set, MinHash
   values and band keys. Documents with equal sets form a class; only a class's
   smallest doc_id goes on.
2. Candidates: documents that share a band's bucket. A bucket is compared as a
   star around a pivot, its most central member, not in all pairs.
3. Verification of a star's pairs: signatures are compared in batches; a pair
   is dropped as soon as the posterior probability of reaching the threshold,
   given the matches so far and a uniform prior, falls below ``MISS``. Survivors
   are verified exactly on the full sets of the whole texts. Members that miss
   the threshold with the pivot meet the rest of the family by an exact join on
   what sets them apart from the pivot; members far from it get another pivot,
   then are compared in blocks. No link is lost to the shortcut.
4. Components of the verified links, joined back to all documents.

Null and word-free texts have empty sets, are linked with nothing and stay.
Rows that repeat a doc_id with equal text are members of one class; rows of one doc_id
with different texts are one document, linked with whatever any of its texts is like. A null
doc_id takes no part in linking and stays with a null component. Long texts are
sketched whole, in slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harvestline.llm.common import drop_worker_state, hinted, written
from harvestline.llm.components import components

THRESHOLD = 80  # per cent of the union
BANDS, ROWS = 36, 5  # chance to miss a pair of similarity 0.8: (1 - 0.8^5)^36 = 6e-7
BATCH = 20  # signature values compared at a time
MISS = 1e-7  # chance, by the posterior, that a pruned pair reaches the threshold
LEVELS = 2  # times a bucket gets a pivot before its far members are compared in blocks
CHUNK = 512  # members of a bucket in a block
BROADCAST_BYTES = 32 << 20

_RNG = np.random.default_rng(0x5EED)
_MULT = _RNG.integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 62, BANDS * ROWS, dtype=np.uint64)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = int(_RNG.integers(1 << 40, 1 << 62)) * 2 + 1
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POWERS = np.cumprod(np.full(64, _STEP, np.uint64))
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, vectorised over the whole text."""
    b = _FOLD[np.frombuffer(text, np.uint8)]
    inside = ~_GAP[b]
    edge = np.diff(inside, prepend=False)
    starts = np.flatnonzero(edge & inside)
    if not len(starts):
        return np.zeros(0, np.uint64)
    stops = np.flatnonzero(edge & ~inside)
    if len(stops) < len(starts):
        stops = np.append(stops, len(b))
    sizes = stops - starts
    at = np.flatnonzero(inside)
    place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    if (longest := int(sizes.max())) > len(_POWERS):
        powers = np.cumprod(np.full(longest, _STEP, np.uint64))
    else:
        powers = _POWERS
    terms = _mix(_BYTE[b[at]] * powers[place])
    sums = np.add.reduceat(terms, np.cumsum(sizes) - sizes)
    return _mix(sums + sizes.astype(np.uint64))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a whole text."""
    words = word_hashes((text or "").encode())
    if not len(words):
        return words
    n = max(1, len(words) - k + 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(k, len(words))):
        h = _mix(h * _PAIR + words[i : i + n])
    return np.unique(h)


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits each) of a non-empty set."""
    out = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(shingles), 2048):
        part = shingles[i : i + 2048]
        h = (part[None, :] * _MULT[:, None] + _ADD[:, None]) >> np.uint64(32)
        np.minimum(out, h.min(axis=1), out=out)
    return out.astype(np.uint32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band; the band's number is part of it."""
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * _PAIR
    for i in range(ROWS):
        h = _mix(h * _PAIR + rows[:, i])
    return h.view(np.int64)


SKETCH = "doc_id long, text_key long, n_shingles long, set_key binary, buckets array<long>, sig binary"


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """One row per document; empty sets have neither key, buckets nor signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                rows = batch.slice(i, 512)
                sizes, keys, buckets, sigs = [], [], [], []
                for text in rows.column(2):
                    s = shingle_set(text.as_py(), k)
                    sizes.append(len(s))
                    if len(s):
                        sig = signature(s)
                        keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                        buckets.append(band_keys(sig))
                        # 16 bits of each value are enough to compare by
                        sigs.append(sig.astype(np.uint16).tobytes())
                    else:
                        keys.append(None)
                        buckets.append(None)
                        sigs.append(None)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        rows.column(1),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(buckets, pa.list_(pa.int64())),
                        pa.array(sigs, pa.binary()),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "set_key", "buckets", "sig"],
                )

    return keyed(docs).mapInArrow(run, SKETCH)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text)"""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def least_matches(threshold: int = THRESHOLD, miss: float = MISS) -> list[tuple[int, int]]:
    """(values compared, fewest matches that keep a pair) after each batch.

    With a uniform prior, m matches of n give Beta(m + 1, n - m + 1); its mass
    above t is the chance of at most m successes in n + 1 trials at t.
    """
    t = threshold / 100
    out = []
    for n in [*range(BATCH, BANDS * ROWS, BATCH), BANDS * ROWS]:
        mass, m = 0.0, 0
        while (mass := mass + comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)) < miss:
            m += 1
        out.append((n, m))
    return out


def prune(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, bounds) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (a[x], b[y]) of signatures those that sequential comparison leaves."""
    matches, done = np.zeros(len(x), np.int64), 0
    for n, least in bounds:
        matches = matches + (a[x, done:n] == b[y, done:n]).sum(axis=1)
        stay = matches >= least
        x, y, matches, done = x[stay], y[stay], matches[stay], n
    return x, y


def _signatures(blobs) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint16).reshape(-1, BANDS * ROWS)


def likely(pairs: DataFrame, threshold: int) -> DataFrame:
    """(a, b) of the pairs (a, b, sig_a, sig_b) that sequential pruning leaves."""
    bounds = least_matches(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for batch in batches:
            if batch.num_rows:
                a, b = (_signatures(batch.column(i).to_pylist()) for i in (2, 3))
                every = np.arange(batch.num_rows)
                yield batch.select([0, 1]).take(pa.array(prune(a, b, every, every, bounds)[0]))

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def likely_in_blocks(entries: DataFrame, reps: DataFrame, threshold: int) -> DataFrame:
    """Distinct (a, b) of a bucket's pairs with a far member that sequential pruning leaves.

    A bucket's members are dealt into chunks of about ``CHUNK``; each two chunks
    are compared in a task, signature against signature, and only pairs that
    are left become rows.
    """
    bounds = least_matches(threshold)
    sizes = entries.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    dealt = (
        entries.join(sizes, "bucket")
        .join(reps.select(F.col("node").alias("rep"), F.col("n_shingles").alias("n"), "sig"), "rep")
        .select("bucket", "rep", "far", "n", "sig", own.alias("own"), F.explode(F.expr("sequence(0, chunks - 1)")).alias("other"))
    )
    blocks = dealt.groupBy("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).agg(
        F.collect_list(F.struct("rep", "own", "far", "n", "sig")).alias("members")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        for batch in batches:
            for i, j, members in zip(*(batch.column(c).to_pylist() for c in range(3))):
                x, y = ([m for m in members if m["own"] == side] for side in (i, j))
                if not x or not y:
                    continue
                nx, ny = (np.array([m["n"] for m in side]) for side in (x, y))
                fx, fy = (np.array([m["far"] for m in side]) for side in (x, y))
                mask = (fx[:, None] | fy[None, :]) & (
                    100 * np.minimum(nx[:, None], ny) >= threshold * np.maximum(nx[:, None], ny)
                )
                if i == j:
                    mask &= np.triu(np.ones(mask.shape, bool), 1)
                left, right = prune(
                    _signatures(m["sig"] for m in x), _signatures(m["sig"] for m in y), *np.nonzero(mask), bounds
                )
                if len(left):
                    rx, ry = (np.array([m["rep"] for m in side]) for side in (x, y))
                    a, b = rx[left], ry[right]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
                    )

    return blocks.select("i", "j", "members").mapInArrow(run, "a long, b long").distinct()


def compared(pairs: DataFrame, k: int, near: int) -> DataFrame:
    """(a, b, n_a, n_b, common, apart) of pairs (a, text_a, b, text_b), on the full sets.

    ``apart`` is what either set has alone, where the similarity is ``near`` per cent or more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        last, held = None, None
        for batch in batches:
            sizes, apart = [], []
            for a, ta, _, tb in zip(*(batch.column(i) for i in range(4))):
                if (a := a.as_py()) != last:
                    last, held = a, shingle_set(ta.as_py(), k)
                other = shingle_set(tb.as_py(), k)
                odd = np.setxor1d(held, other, assume_unique=True)
                common = (len(held) + len(other) - len(odd)) // 2
                sizes.append((len(held), len(other), common))
                alike = 100 * common >= near * (common + len(odd))
                apart.append(odd.view(np.int64) if alike else None)
            n_a, n_b, common = zip(*sizes) if sizes else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    *(pa.array(x, pa.int64()) for x in (n_a, n_b, common)),
                    pa.array(apart, pa.list_(pa.int64())),
                ],
                names=["a", "b", "n_a", "n_b", "common", "apart"],
            )

    return pairs.select("a", "text_a", "b", "text_b").mapInArrow(
        run, "a long, b long, n_a long, n_b long, common long, apart array<long>"
    )


class Linker:
    """Verifies candidate pairs of class representatives, which go by their class's ``node``.

    ``own`` has (node, doc_id, text_key) of each.
    """

    def __init__(self, docs: DataFrame, own: DataFrame, reps: DataFrame, k: int):
        self.docs, self.own, self.reps, self.k = docs, own, reps, k

    def verified(self, pairs: DataFrame, threshold: int) -> DataFrame:
        """``compared`` rows, as a written table, of the distinct pairs (a, b) that pruning at ``threshold`` leaves."""
        a = self.reps.selectExpr("node a", "n_shingles n_a", "sig sig_a")
        b = self.reps.selectExpr("node b", "n_shingles n_b", "sig sig_b")
        sized = (
            pairs.join(a, "a")
            .join(b, "b")
            .where(f"100 * least(n_a, n_b) >= {threshold} * greatest(n_a, n_b)")
        )
        return self.confirmed(likely(sized, threshold), threshold)

    def confirmed(self, survivors: DataFrame, threshold: int) -> DataFrame:
        """``compared`` rows of the pairs (a, b), as a written table."""
        survivors = written(survivors, "survivors")
        nodes = survivors.select(F.col("a").alias("node")).union(survivors.select("b")).distinct()
        ids = written(self.own.join(nodes, "node", "left_semi"), "ids")
        if ids.count() * 32 <= BROADCAST_BYTES:
            ids = F.broadcast(ids)
        # texts of the documents in survivors alone go through a shuffle
        texts = written(
            keyed(self.docs).join(ids, ["doc_id", "text_key"]).groupBy("node").agg(F.max("text").alias("text")), "texts"
        )
        both = (
            survivors.join(texts.selectExpr("node b", "text text_b"), "b")
            .join(texts.selectExpr("node a", "text text_a"), "a")
        )
        return written(compared(both, self.k, threshold), "compared")


def linked(rows: DataFrame, threshold: int) -> DataFrame:
    return rows.where(f"100 * common >= {threshold} * (n_a + n_b - common)")


def with_pivots(entries: DataFrame) -> DataFrame:
    """Entries (bucket, rep) with their bucket's pivot: the member with the most company in all its buckets.

    That is the member most like the others, the source of a family of near copies.
    """
    sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    company = entries.join(sizes, "bucket").groupBy("rep").agg(F.sum("n").alias("company"))
    # equal company: the smaller id
    rank = F.struct("company", (-F.col("rep")).alias("order"), "rep")
    pivots = entries.join(company, "rep").groupBy("bucket").agg(F.max(rank).alias("p"))
    return written(
        entries.join(pivots.select("bucket", F.col("p.rep").alias("pivot")), "bucket").where("rep <> pivot"),
        "pivots",
    )


def overlapping(pairs: DataFrame, rows: DataFrame, threshold: int) -> DataFrame:
    """(pivot, x, y) of the pairs of a family's members that reach the threshold, on their whole difference sets."""
    x = rows.selectExpr("pivot", "rep x", "w w_x", "slack", "apart apart_x")
    y = rows.selectExpr("pivot", "rep y", "w w_y", "apart apart_y")
    return (
        pairs.join(x, ["pivot", "x"])
        .join(y, ["pivot", "y"])
        .where(f"{100 + threshold} * size(array_intersect(apart_x, apart_y)) >= w_x + w_y - slack")
        .select("pivot", "x", "y")
    )


def family_links(near: DataFrame, threshold: int) -> DataFrame:
    """(a, b) links among the members of a pivot's family, from what sets them apart from the pivot.

    ``near`` has (pivot, rep, size of the pivot's set, n, common, apart). With P
    shingles in the pivot and a member that lacks r of them and adds s, let
    d = 100 - t and w = 100 r + t s for threshold t (in per cent; t of the union).
    Two members with o elements common to their difference sets reach the
    threshold just if (100 + t) o >= w + w' - d P. Members with w <= d P are
    linked to the pivot itself, and need no links with one another. Any other
    member (an open one) needs common elements with whom it is linked to: (w + 1) / (100 + t)
    with an open one, and (w - d P) / 100 with any, as w' >= t o. So a join on the
    rarest elements of the difference sets (as many as may not all be missed)
    finds all its partners, however large the family is.

    Elements that one member alone has are common to no two. Members' other
    elements (``shared`` of them) are ranked in one order in the whole family, so at the
    first one that two members have in common, as many can be common as follow in
    either ranking, and it; pairs that do not reach the threshold by that are
    not made. A pair that does reach it is found at its first common element.

    The members that share such an element with an open one are compared with
    one of them, their hub, first. Those linked to it are connected by that; only
    pairs with a member that is not go on, so that a family beside the pivot's own
    costs a few links a member and not all its pairs.
    """
    t, d, both = threshold, 100 - threshold, 100 + threshold
    rows = near.select(
        "pivot",
        "rep",
        (F.lit(d) * F.col("n_pivot")).alias("slack"),
        (100 * (F.col("n_pivot") - F.col("common")) + t * (F.col("n") - F.col("common"))).alias("w"),
        "apart",
    )
    # a small side by its measured size, so that one pivot's members need not meet in a task
    with_open = hinted(written(rows.where("w > slack").select("pivot").distinct(), "open-pivots"), F.lit(16))
    rows = written(rows.join(with_open, "pivot", "left_semi"), "families")
    elements = rows.select("pivot", "rep", "w", "slack", F.explode("apart").alias("e"))
    often = elements.groupBy("pivot", "e").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    own = Window.partitionBy("pivot", "rep")
    asks = "w > slack and rank <= shared - ceil((w - slack) / 100) + 1"
    ranked = written(
        elements.join(often, ["pivot", "e"])
        .withColumn("rank", F.row_number().over(own.orderBy("often", "e")))
        .withColumn("shared", F.count(F.lit(1)).over(own))
        .where(f"rank <= shared - ceil((w + 1) / {both}) + 1 or {asks}")
        .select("pivot", "rep", "e", "rank", "often", "w", "slack", "shared"),
        "ranked",
    )
    ranked = ranked.join(ranked.where(asks).select("pivot", "e").distinct(), ["pivot", "e"], "left_semi")
    company = ranked.groupBy("pivot", "rep").agg(F.sum("often").alias("company"))
    first = F.max_by(
        F.struct("rep", "rank", "w", "shared"), F.struct("company", (-F.col("rep")).alias("order"))
    ).alias("h")
    hubs = (
        ranked.join(company, ["pivot", "rep"])
        .groupBy("pivot", "e")
        .agg(first)
        .selectExpr("pivot", "e", "h.rep hub", "h.rank hub_rank", "h.w hub_w", "h.shared hub_shared")
    )
    ranked = written(ranked.join(hubs, ["pivot", "e"]), "asked")
    stars = (
        ranked.where("rep <> hub and (w > slack or hub_w > slack)")
        .where(f"{both} * (1 + least(shared - rank, hub_shared - hub_rank)) >= w + hub_w - slack")
        .select("pivot", F.col("hub").alias("x"), F.col("rep").alias("y"))
        .distinct()
    )
    stars = written(overlapping(stars, rows, t), "hub-links")
    to_hub = stars.select("pivot", F.col("x").alias("hub"), F.col("y").alias("rep"), F.lit(True).alias("linked"))
    # members linked to the pivot are connected by that
    connected = F.expr("w <= slack and hub_w <= slack")
    told = written(
        ranked.where("rep <> hub")
        .join(to_hub, ["pivot", "hub", "rep"], "left")
        .select("pivot", "e", "rep", "rank", "w", "slack", "shared", F.coalesce("linked", connected).alias("joined")),
        "told",
    )
    pairs = (
        told.where(asks)
        .selectExpr("pivot", "e", "rep x", "rank rank_x", "w w_x", "slack", "shared shared_x", "joined joined_x")
        .join(told.selectExpr("pivot", "e", "rep y", "rank rank_y", "w w_y", "shared shared_y", "joined joined_y"), ["pivot", "e"])
        # those with the hub are told, those of its links connected
        .where("x <> y and not (joined_x and joined_y)")
        .where(f"{both} * (1 + least(shared_x - rank_x, shared_y - rank_y)) >= w_x + w_y - slack")
        .select("pivot", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        .distinct()
    )
    return stars.union(overlapping(pairs, rows, t)).select(F.col("x").alias("a"), F.col("y").alias("b"))


def all_links(docs: DataFrame, own: DataFrame, reps: DataFrame, k: int, threshold: int) -> DataFrame | None:
    """Links (a, b) that connect all representatives with equal buckets whose similarity reaches the threshold."""
    # Two distances to a third set bound the distance of two sets: a member under
    # this similarity cannot reach the threshold with one that is linked to the pivot.
    near_t = max(0, 2 * threshold - 100)
    spread = reps.select(F.explode("buckets").alias("bucket"), F.col("node").alias("rep"))
    shared = (
        spread.groupBy("bucket")
        .agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
        .where("low <> high")
        .select("bucket")
    )
    entries = written(spread.join(shared, "bucket", "left_semi"), "entries")
    linker = Linker(docs, own, reps.drop("buckets"), k)
    found = None
    for _ in range(LEVELS):
        if entries.isEmpty():
            return found
        entries = with_pivots(entries)
        stars = entries.select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
        rows = linker.verified(stars, near_t)
        near = rows.where("apart is not null").select(
            F.col("a").alias("pivot"), F.col("b").alias("rep"), F.col("n_a").alias("n_pivot"),
            F.col("n_b").alias("n"), "common", "apart",
        )
        close = linked(rows, threshold).select("a", "b")
        links = close.union(family_links(near, threshold))
        found = links if found is None else found.union(links)
        # Members linked to the pivot are settled. What is far from it still has
        # to meet the others.
        settled = close.select(F.col("a").alias("pivot"), F.col("b").alias("rep"), F.lit(True).alias("settled"))
        known = near.select("pivot", "rep", F.lit(True).alias("near"))
        rest = (
            entries.join(settled, ["pivot", "rep"], "left_anti")
            .join(known, ["pivot", "rep"], "left")
            .select("bucket", "rep", F.col("near").isNull().alias("far"))
        )
        open_ = (
            rest.groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("any_far"))
            .where("n > 1 and any_far")
            .select("bucket")
        )
        entries = written(rest.join(open_, "bucket", "left_semi"), "entries")
    if entries.isEmpty():
        return found
    rest = linker.confirmed(likely_in_blocks(entries, reps, threshold), threshold)
    return found.union(linked(rest, threshold).select("a", "b"))


def clustered(
    spark: SparkSession, docs: DataFrame, k: int, threshold: int = THRESHOLD
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    sketch = written(sketches(docs, k), "sketches")
    told = sketch.where("doc_id is not null and set_key is not null")
    classes = written(
        told.groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("r"))
        .select("set_key", "r.doc_id", "r.text_key", F.monotonically_increasing_id().alias("node")),
        "classes",
    )
    reps = told.join(classes, ["set_key", "doc_id", "text_key"]).select("node", "n_shingles", "sig", "buckets")
    reps = written(reps.dropDuplicates(["node"]), "reps")
    own = classes.drop("set_key")
    links = all_links(docs, own, reps, k, threshold)
    # documents with several texts connect the classes of these
    several = told.groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("low <> high")
    several = written(told.join(several, "doc_id").select("set_key", "low").where("set_key <> low").distinct(), "several")
    if not several.isEmpty():
        node = classes.select("set_key", "node")
        same = several.join(node.withColumnRenamed("node", "a"), "set_key").join(
            node.select(F.col("set_key").alias("low"), F.col("node").alias("b")), "low"
        )
        links = same.select("a", "b") if links is None else links.union(same.select("a", "b"))
    if links is None:
        rooted = classes.select("set_key", F.col("doc_id").alias("component_id"))
    else:
        roots = written(components(links).join(own.select("node", "doc_id"), "node"), "roots")
        least = roots.groupBy("component").agg(F.min("doc_id").alias("least"))
        rooted = classes.join(roots.join(least, "component").select("node", "least"), "node", "left").select(
            "set_key", F.coalesce("least", "doc_id").alias("component_id")
        )
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    return (
        sketch.select("doc_id", "n_shingles", "set_key")
        .join(rooted, "set_key", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def deduplicated(spark: SparkSession, docs: DataFrame, k: int, threshold: int = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each group of near copies, with all its columns.

    Rows without a doc_id stay. Of equal rows one stays; rows that share a
    doc_id but not a text stay unless all of them are copies. Texts are not
    shuffled, unless there are too many removed ids to broadcast.
    """
    found = written(clustered(spark, docs, k, threshold).where("doc_id is not null"), "clusters")
    ids = found.groupBy(F.col("doc_id").alias("own_id")).agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")
    )
    own = docs["doc_id"].cast("long")

    def listed(condition: str) -> DataFrame:
        some = written(ids.where(condition).select("own_id"), "ids")
        return F.broadcast(some) if some.count() * 16 <= BROADCAST_BYTES else some

    removed, again = listed("not kept"), listed("kept and n > 1")
    out = docs.join(removed, own == F.col("own_id"), "left_anti")
    if again.isEmpty():
        return out
    repeated = docs.join(again, own == F.col("own_id"), "left_semi").dropDuplicates(["doc_id", "text"])
    return out.join(again, own == F.col("own_id"), "left_anti").unionByName(repeated)
