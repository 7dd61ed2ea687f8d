"""Language identification by word-first backoff.

A word that the training texts hold scores by its log frequency per language.
An unseen word falls back to its character n-grams of the longest order of
which any is known (5 down to 1, with word boundary marks). A text's score per
language is the sum over its words; the best language is predicted, ties going
to the first in alphabetical order, and the score is its posterior probability.

Training reads a bounded sample of labelled rows: of each language the
``docs_per_lang`` distinct texts (all, if fewer) whose whole-text hashes come first in
a drawn order, each once however often it is there, and keeps the most frequent ``max_words`` words and ``max_grams`` n-grams of each order per
language. The model's size is bounded by those parameters and the number of
languages, so it is collected and broadcast. Prediction covers whole texts.

Text null or without a letter: ``und`` with score 0. Without any training row
everything is ``und``. A text with letters of which neither words nor any n-gram are
known scores all languages alike: the first, with score 1 / their number. Very long texts
are judged whole. Rows are judged one by one, so repeated rows agree; an empty table gives
an empty result.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harvestline.llm.common import drop_worker_state

WORDS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
MAX_ORDER = 5
# Words of which a task keeps the looked-up scores; beyond, it starts anew.
CACHE_WORDS = 100_000


@dataclass
class Scores:
    """Log frequencies per language: a row of one matrix per key."""

    rows: dict[str, int]
    logs: np.ndarray

    def get(self, key: str) -> tuple[float, ...] | None:
        row = self.rows.get(key)
        return None if row is None else tuple(self.logs[row].tolist())


@dataclass
class LanguageModel:
    langs: list[str]
    words: Scores  # log frequency per language
    grams: list[Scores] = field(default_factory=list)  # by order - 1

    def word_scores(self, word: str) -> tuple[float, ...]:
        if (known := self.words.get(word)) is not None:
            return known
        marked = f"^{word}$"
        for order in range(min(MAX_ORDER, len(marked)), 0, -1):
            table = self.grams[order - 1]
            hits = [
                v
                for i in range(len(marked) - order + 1)
                if (v := table.get(marked[i : i + order])) is not None
            ]
            if hits:
                # the mean, so that a long unseen word weighs as one word
                return tuple(sum(x) / len(hits) for x in zip(*hits))
        return (0.0,) * len(self.langs)


class _Rows(dict):
    """Word -> row of a growing score matrix."""

    def __init__(self, model: LanguageModel):
        super().__init__()
        self.model = model
        self.matrix = np.zeros((4096, len(model.langs)))

    def __missing__(self, word: str) -> int:
        n = len(self)
        if n == len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
        self.matrix[n] = self.model.word_scores(word)
        self[word] = n
        return n


class Scorer:
    """Predicts text after text; looked-up words are kept between texts."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.rows = _Rows(model)

    def predict(self, text: str | None) -> tuple[str, float]:
        words = WORDS.findall(text.lower()) if text else []
        if not words or not self.model.langs:
            return UNDETERMINED, 0.0
        if len(self.rows) > CACHE_WORDS:
            self.rows = _Rows(self.model)
        # look up first: that may replace the matrix by a longer one
        at = list(map(self.rows.__getitem__, words))
        total = self.rows.matrix[at].sum(axis=0)
        best = int(total.argmax())
        return self.model.langs[best], float(1.0 / np.exp(total - total[best]).sum())


def counted(labelled: DataFrame) -> DataFrame:
    """(lang, ord, gram, n): words as order 0, marked n-grams as orders 1 to 5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.update((lang, w) for w in WORDS.findall(text.lower()))
            out: Counter = Counter()
            for (lang, w), n in words.items():
                out[lang, 0, w] += n
                marked = f"^{w}$"
                for order in range(1, min(MAX_ORDER, len(marked)) + 1):
                    for i in range(len(marked) - order + 1):
                        out[lang, order, marked[i : i + order]] += n
            keys = list(out)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([k[2] for k in keys], pa.string()),
                    pa.array(list(out.values()), pa.int64()),
                ],
                names=["lang", "ord", "gram", "n"],
            )

    rows = labelled.mapInArrow(run, "lang string, ord int, gram string, n long")
    return rows.groupBy("lang", "ord", "gram").agg(F.sum("n").alias("n"))


def train(
    labelled: DataFrame,
    docs_per_lang: int = 500,
    max_words: int = 20_000,
    max_grams: int = 6_000,
) -> LanguageModel:
    """Fit on the rows of ``labelled`` (lang, text) with neither of them null."""
    pool = labelled.select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    ).where("lang is not null and text is not null")
    pool = pool.withColumn("key", F.xxhash64("text"))
    # copies are one; every task hands on docs_per_lang keys of a language at most
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64(F.lit("draw"), "key"), "key"))
    drawn = pool.select("lang", "key").distinct().withColumn("place", place).where(F.col("place") <= docs_per_lang)
    # as many rows as languages times docs_per_lang: the texts stay where they are
    sample = (
        pool.join(F.broadcast(drawn.select("lang", "key")), ["lang", "key"], "left_semi")
        .groupBy("lang", "key")
        .agg(F.first("text").alias("text"))
        .select("lang", "text")
    )
    counts = counted(sample)
    limit = F.when(F.col("ord") == 0, max_words).otherwise(max_grams)
    rank = F.row_number().over(Window.partitionBy("lang", "ord").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("r", rank).where(F.col("r") <= limit)
    found = top.select("lang", "ord", "gram", "n").toPandas()

    langs = sorted(found["lang"].unique())
    column = {lang: i for i, lang in enumerate(langs)}
    tables: list[Scores] = []
    for order in range(MAX_ORDER + 1):
        part = found[found["ord"] == order]
        grams = {g: i for i, g in enumerate(sorted(part["gram"].unique()))}
        n = np.zeros((len(grams), len(langs)))
        if len(part):
            n[part["gram"].map(grams).to_numpy(), part["lang"].map(column).to_numpy()] = part["n"]
        # additive smoothing, so that a word of one language alone stays finite
        logs = np.log((n + 0.5) / (n.sum(axis=0) + 0.5 * max(1, len(grams))))
        tables.append(Scores(grams, logs))
    return LanguageModel(langs, tables[0], tables[1:])


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def predict(spark: SparkSession, docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; ``docs`` has the first two and ``text``."""
    shared = spark.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        scorer = Scorer(pickle.loads(shared.value))  # a task's own: gone with the task
        for batch in batches:
            found = [scorer.predict(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, PREDICTED)


def keep_identified(
    spark: SparkSession, docs: DataFrame, model: LanguageModel, least_score: float = 0.5
) -> DataFrame:
    """The rows of ``docs`` whose language is determined with ``least_score`` or more; all columns stay."""
    shared = spark.sparkContext.broadcast(pickle.dumps(model))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_state()
        scorer = Scorer(pickle.loads(shared.value))  # a task's own: gone with the task
        for batch in batches:
            found = [scorer.predict(t) for t in batch.column(at).to_pylist()]
            keep = [lang != UNDETERMINED and score >= least_score for lang, score in found]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
