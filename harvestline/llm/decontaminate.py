"""Benchmark decontamination by a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of a benchmark item (the whole item if
it has fewer). A document word inside any occurrence of a window is hit.

Each window's words are ordered by rarity: how often the word occurs in all
documents, ties by the word. An occurrence must hold all of the window's words,
so its rarest word is the only prefix token that has to be joined. Every
document word that is some window's prefix token gives a candidate start;
length and position bounds drop candidates that would begin before the text or
end after it, and the rest are verified exactly, word by word, against the
item-sized window.

Main path: DataFrame functions alone. Documents are read in two narrow scans
(word counts, then candidates); what is shuffled is counts of benchmark words
and verified occurrences. Counts and windows are broadcast only after their size is
measured against ``BROADCAST_BYTES``; beyond that candidates are joined by
shuffle and verified with the texts that have any.

Null or word-free texts have no words and no hits. A row goes by its doc_id and
the 128-bit hash of its text: rows with a null doc_id, or one that other texts
share, are judged each by its own text, and equal rows get equal results. Items
without words
have no windows; equal windows of several items count for each of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestline.llm.common import ascii_lower, hinted, written

WINDOW = 10
# Fixed value: what separates words, after lower-casing A-Z.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_BYTES = 32 << 20
ROW = ("doc_id", "text_key")


def with_words(texts: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``w``, all words of ``text`` (none for null)."""
    low = ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    parts = texts.select(*keep, F.split(low, GAPS).alias("_parts"))
    # gaps are maximal: only the first and the last part can be empty
    n = F.size("_parts")
    first = F.when(F.get("_parts", F.lit(0)) == "", 1).otherwise(0)
    last = F.when((n > 1) & (F.get("_parts", n - 1) == ""), 1).otherwise(0)
    return parts.select(*keep, F.slice("_parts", first + 1, n - first - last).alias("w"))


def row_keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text): what tells a row's text from others, whatever its doc_id."""
    text = F.col("text").cast("string")
    key = F.unhex(F.md5(text)).alias("text_key")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), key, text.alias("text"))


def same_row(prefix: str) -> Column:
    """Whether the row's key and the one in the columns with ``prefix`` are equal."""
    return F.expr(" and ".join(f"{k} <=> {prefix}_{k}" for k in ROW))


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(words, size, items): the distinct windows with the items that have them."""
    items = with_words(benchmark.select(F.col("item_id").cast("string").alias("item"), "text"), "item")
    n = F.size("w")
    starts = F.sequence(F.lit(1), F.greatest(n - (window - 1), F.lit(1)))
    return (
        items.where(n > 0)
        .select("item", "w", F.explode(starts).alias("s"))
        .select("item", F.slice("w", F.col("s"), F.lit(window)).alias("words"))
        .groupBy("words")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .withColumn("size", F.size("words"))
    )


def within_bound(df: DataFrame, width: Column) -> bool:
    """Whether the measured size of ``df`` allows a broadcast."""
    return (df.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES


def with_prefix(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds each window's rarest word (``token``) and its 0-based place (``place``)."""
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    if within_bound(vocabulary, F.octet_length("word") + 32):
        vocabulary = F.broadcast(vocabulary)
    counts = (
        # an outer explode: the plain one would split every text twice, to
        # leave out empty arrays beforehand
        with_words(docs)
        .select(F.explode_outer("w").alias("word"))
        .join(vocabulary, "word", "left_semi")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # no larger than the benchmark's vocabulary; a frequent word's windows stay where they are
    counts = hinted(written(counts, "word_counts"), F.octet_length("word") + 48)
    placed = windows.select("words", "items", "size", F.posexplode("words").alias("place", "word"))
    rarity = F.struct(F.coalesce("n", F.lit(0)), "word", "place")
    return (
        placed.join(counts, "word", "left")
        .groupBy("words", "items", "size")
        .agg(F.min(rarity).alias("rarest"))
        .select(
            "words",
            "items",
            "size",
            F.col("rarest.word").alias("token"),
            F.col("rarest.place").alias("place"),
        )
    )


def occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, size, items) of every verified occurrence; start is 0-based."""
    words = with_words(docs, *ROW)
    text = F.expr("aggregate(words, 0L, (a, x) -> a + octet_length(x) + 16)")
    start = F.expr("pos - place").alias("start")
    fits = "pos >= place and pos - place + size <= size(w)"
    same = "slice(w, greatest(pos - place + 1, 1), size) = words"
    if within_bound(windows, text + 24 * F.size("items") + 64):
        # The join is probed as the words are laid out; only a verified
        # candidate becomes a row.
        return (
            words.select(*ROW, "w", F.posexplode_outer("w").alias("pos", "token"))
            .join(F.broadcast(windows), "token")
            .where(f"{fits} and {same}")
            .select(*ROW, start, "size", "items")
        )
    # Candidates first, without texts; then each text once more, with its own.
    placed = words.select(*ROW, F.size("w").alias("n"), F.posexplode_outer("w").alias("pos", "token"))
    candidates = (
        placed.join(windows, "token")
        .where("pos >= place and pos - place + size <= n")
        .groupBy(*[F.col(k).alias(f"found_{k}") for k in ROW])
        .agg(F.collect_set(F.struct("pos", "place", "size", "words", "items")).alias("found"))
    )
    return (
        words.join(candidates, same_row("found"))
        .select(*ROW, "w", F.inline("found"))
        .where(same)
        .select(*ROW, start, "size", "items")
    )


def hit_summary(found: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_hit, items): words inside any occurrence, and the sorted distinct items."""
    spans = F.array_sort(F.collect_set(F.struct("start", "size")))
    merged = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["size"]).alias("end"),
            (
                a["n"]
                + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(a["end"], s["start"]))
            ).alias("n"),
        ),
        lambda a: a["n"],
    )
    return (
        found.groupBy(*ROW)
        .agg(
            spans.alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .select(*ROW, merged.alias("n_hit"), "items")
    )


def marked(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    docs = row_keyed(docs)
    windows = with_prefix(windows_of(benchmark, window), docs)
    hits = hit_summary(occurrences(docs, windows))
    sizes = with_words(docs, *ROW).select(*ROW, F.size("w").cast("long").alias("n_words"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    hits = hits.withColumnsRenamed({k: f"hit_{k}" for k in ROW})
    return sizes.join(hits, same_row("hit"), "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a benchmark window; all columns stay."""
    keyed = row_keyed(docs)
    hits = occurrences(keyed, with_prefix(windows_of(benchmark, window), keyed))
    # a row per contaminated document: texts are not shuffled to drop them
    dirty = hits.select(*[F.col(k).alias(f"_dirty_{k}") for k in ROW]).distinct()
    dirty = hinted(written(dirty, "dirty"), F.lit(40))
    own = docs["doc_id"].cast("long").eqNullSafe(dirty["_dirty_doc_id"])
    text_key = F.unhex(F.md5(docs["text"].cast("string")))
    return docs.join(dirty, own & text_key.eqNullSafe(dirty["_dirty_text_key"]), "left_anti")
