"""Importance resampling of documents towards a target's distribution.

Every text is a bag of hashed features: the runs of one to three words, by
CRC-32 into ``buckets``. Counts of all documents and of all target texts give a
gain per bucket, the logarithm of how much more frequent it is in the target;
a document's weight is the sum of its features' gains, looked up in one array
of fixed length. Gumbel noise keyed by the document's id makes the largest
scores a draw without replacement in proportion to exp(weight).

The draw is an exact top-m over any number of rows without sorting them: the
scores are written, and the cutoff is found by bisection on their value, each
round an exact count over the written column; ties at the cutoff are cut by
bisection on doc_id, and equal ids by the row's own number. Only rows above
the cutoff are range-partitioned, and their ranks follow from the ranges'
sizes.

Words are runs of a-z, 0-9 and characters beyond ASCII, A-Z lower-cased. A null
or empty text, or one without words, has no features, weight 0, and is never
drawn if ``min_words`` is 1 or more. Very long texts are taken whole. A null doc_id counts as an
empty one in the noise and comes last among ties; repeated rows are drawn each
on their own. Without documents the result is empty; without target texts all
features count as unseen there. Other columns are not looked at; those named
in ``keep`` come back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from harvestline.llm.common import discard, written
from harvestline.llm.word_arrays import ALNUM, LOWERED, Words, run_crcs, text_slices

BUCKETS = 10_000
RUN_WORDS = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
PROBES = 15  # thresholds counted in one job: each halves the bracket four times
RANGE_ROWS = 1 << 18  # drawn rows per range


def _features(words: Words, buckets: int) -> list[np.ndarray]:
    """Buckets of the runs of 1, 2, 3 words from each word on; -1 where a run leaves its text."""
    left = words.left()
    return [
        np.where(left > n, (crc % np.uint32(buckets)).astype(np.int64), -1)
        for n, crc in enumerate(run_crcs(words, RUN_WORDS))
    ]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, text_col: str = "text") -> DataFrame:
    """(bucket, n) over all features of all texts; a task hands out one row per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                for found in _features(Words(LOWERED[data], offsets, ALNUM), buckets):
                    total += np.bincount(found + 1, minlength=buckets + 1)[1:]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    found = texts.select(F.col(text_col).cast("string")).mapInArrow(count, "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """The gain of every bucket, as one array of ``buckets`` integers.

    Whole sums of whole counts; only the ``buckets`` rows of the result reach
    the driver.
    """
    spark = docs.sparkSession
    both = (
        bucket_counts(docs, buckets, text_col)
        .select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
        .union(bucket_counts(target, buckets, text_col).select("bucket", F.lit(0).cast("long"), "n"))
        .groupBy("bucket")
        .agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    )
    counted = written(spark.range(buckets).withColumnRenamed("id", "bucket").join(both, "bucket", "left").na.fill(0), "buckets")
    sums = counted.agg(F.sum("s").cast("double").alias("all_s"), F.sum("t").cast("double").alias("all_t")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = ((t + 1) * F.lit(sums["all_s"] + buckets)) / ((s + 1) * F.lit(sums["all_t"] + buckets))
    rows = counted.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain")).collect()
    discard(counted)
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["gain"]
    return out


def weighed(docs: DataFrame, gain: np.ndarray, keep: Sequence[str] = (), text_col: str = "text") -> DataFrame:
    """The columns in ``keep`` with n_words, n_features and weight of each row's text."""
    buckets = len(gain)
    table = np.append(gain, 0)  # the last entry is that of -1: no run
    kept = docs.select(F.col(text_col).cast("string").alias("_text"), *keep)
    schema = StructType(kept.schema.fields[1:] + [StructField(c, LongType()) for c in ("n_words", "n_features", "weight")])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, features, weights = [np.zeros(batch.num_rows, np.int64) for _ in range(3)]
            for a, b, data, offsets in text_slices(batch.column(0)):
                words = Words(LOWERED[data], offsets, ALNUM)
                runs = _features(words, buckets)
                sums = np.concatenate([[0], np.cumsum(sum(table[r] for r in runs))])
                there = np.concatenate([[0], np.cumsum(sum((r >= 0).astype(np.int64) for r in runs))])
                low, high = words.bounds[:-1], words.bounds[1:]
                counts[a:b], features[a:b] = high - low, there[high] - there[low]
                weights[a:b] = sums[high] - sums[low]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(counts), pa.array(features), pa.array(weights)], names=schema.names
            )

    return kept.mapInArrow(weigh, schema)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, keyed by the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def nth_smallest(rows: DataFrame, key: str, n: int, probes: int = PROBES) -> tuple[int, int]:
    """(v, below): the n-th smallest value of an integer column, and how many rows have less.

    Numeric bisection: every round is one job that counts, exactly, the rows up
    to some thresholds within the bracket.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    while low < high:
        tried = sorted({low + (high - low) * j // (probes + 1) for j in range(1, probes + 1)})
        counted = rows.agg(*[F.count_if(F.col(key) <= F.lit(p)) for p in tried]).first()
        enough = [p for p, c in zip(tried, counted) if c >= n]
        few = [p for p, c in zip(tried, counted) if c < n]
        low, high = (few[-1] + 1 if few else low), (enough[0] if enough else high)
    return low, rows.where(F.col(key) < F.lit(low)).count()


def up_to_nth(rows: DataFrame, keys: Sequence[str], n: int) -> Column:
    """The condition that holds for the first n rows by ``keys``, whose last one is unique."""
    *before, last = keys
    found, ties = [], rows
    for key in before:
        value, below = nth_smallest(ties, key, n)
        found.append((key, value))
        ties, n = ties.where(F.col(key) == F.lit(value)), n - below
    condition = F.col(last) <= F.lit(nth_smallest(ties, last, n)[0])
    for key, value in reversed(found):
        condition = (F.col(key) < F.lit(value)) | ((F.col(key) == F.lit(value)) & condition)
    return condition


def ranked(rows: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """``rows``, of which there are n, with their ``rank`` (from 1) by ``keys``, through range partitions."""
    ranges = rows.repartitionByRange(max(1, -(-n // RANGE_ROWS)), *keys)
    dealt = written(ranges.withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_range").count().collect()  # a row per range
    before, starts = 0, []
    for r in sorted(sizes, key=lambda r: r["_range"]):
        starts.append((r["_range"], before))
        before += r["count"]
    offsets = dealt.sparkSession.createDataFrame(starts, "_range int, _before long")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    return (
        dealt.withColumn("_at", within)
        .join(F.broadcast(offsets), "_range")
        .withColumn("rank", F.col("_before") + F.col("_at"))
        .drop("_range", "_before", "_at")
    )


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    keep: Sequence[str] = (),
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank, *keep) of every document.

    ``rank`` is 1, 2, 3 ... for the documents drawn, floor(percent * N / 100)
    of the N with ``min_words`` words or more, and null for the others. Name the
    text in ``keep`` to have the drawn texts themselves.
    """
    taken = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col, *[c for c in keep if c != text_col])
    names = ["doc_id", *keep]
    gain = gains(taken, target, buckets, text_col)
    scored = written(
        weighed(taken, gain, names, text_col)
        .withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
        .withColumn("_score", -F.col("score"))
        .withColumn("_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
        .withColumn("_row", F.monotonically_increasing_id()),
        "scores",
    )
    names = ["doc_id", "n_features", "weight", "score", *keep]
    keys = ["_score", "_id", "_row"]
    eligible = scored.where(F.col("n_words") >= min_words)
    n = percent * eligible.count() // 100
    if not n:
        return scored.select(*names, F.lit(None).cast("long").alias("rank"))
    drawn = (F.col("n_words") >= min_words) & up_to_nth(eligible, keys, n)
    ranks = ranked(scored.where(drawn).select(*names, *keys), keys, n)
    names.insert(4, "rank")
    others = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return others.select(*names).union(ranks.select(*names))
