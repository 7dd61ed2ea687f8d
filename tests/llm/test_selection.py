"""Resampling, substring dedup and hard negatives against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.data import documents, frame, sentence

from harvestline.llm import hard_negatives, resample, substring_dedup, word_arrays
from harvestline.llm.common import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def as_rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def ascii_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


# word arrays


def test_crcs_of_runs_equal_zlib():
    rng = random.Random(2)
    texts = ["Héllo 12 x", "", " ", None, "a" * 300 + " b " + "c" * 49 + " é", "z"]
    texts += ["".join(rng.choice("abXY09é ,.") for _ in range(rng.randrange(400))) for _ in range(60)]
    found = []
    for a, b, data, offsets in word_arrays.text_slices(pa.array(texts), 500):
        words = word_arrays.Words(word_arrays.LOWERED[data], offsets, word_arrays.ALNUM)
        runs, left = word_arrays.run_crcs(words, 3), words.left()
        for low, high in zip(words.bounds, words.bounds[1:]):
            found.append([[int(c[j]) for j in range(low, high) if left[j] > n] for n, c in enumerate(runs)])
    for text, got in zip(texts, found):
        w = [x.encode() for x in ascii_words(text)]
        assert got == [[zlib.crc32(b" ".join(w[i : i + n])) for i in range(len(w) - n + 1)] for n in (1, 2, 3)]
    assert len(found) == len(texts)


def test_word_hashes_depend_on_the_word_alone():
    texts = ["one two three", "  three\tone", "x" * 5000 + " two"]
    seen = {}
    for _, _, data, offsets in word_arrays.text_slices(pa.array(texts), 8):
        words = word_arrays.Words(data, offsets, word_arrays.NOT_SPACE)
        for s, e, h in zip(words.starts, words.ends, word_arrays.word_hashes(words).tolist()):
            seen.setdefault(data[s:e].tobytes(), set()).add(h)
    assert all(len(v) == 1 for v in seen.values()) and len({next(iter(v)) for v in seen.values()}) == 4


def test_ladder_never_more_than_doubles():
    for n in range(1, 200):
        steps = word_arrays.ladder(n)
        assert steps[0] == 1 and steps[-1] == n
        assert all(a < b <= 2 * a for a, b in zip(steps, steps[1:]))


# resampling


def brute_resampled(rows, target, percent=5, min_words=20, buckets=10_000):
    def features(text):
        w = [x.encode() for x in ascii_words(text)]
        return [zlib.crc32(b" ".join(w[i : i + n])) % buckets for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text, *_ in rows:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    big_s, big_t = float(sum(s.values())), float(sum(t.values()))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for d, text, *_ in rows:
        f = features(text)
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(f), weight, score, None, len(ascii_words(text)) >= min_words])
    long_enough = [r for r in out if r[5]]
    order = sorted(long_enough, key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(order[: percent * len(long_enough) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


@pytest.mark.parametrize("percent", [0, 5, 40, 100])
def test_resampling_equals_brute_force(spark, percent):
    rows = documents(5, 60)
    target = [sentence(random.Random(9), 60) for _ in range(5)] + [None, ""]
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    found = resample.resampled(frame(spark, rows, clashing=True), wanted, percent)
    assert as_rows(found, *COLUMNS) == brute_resampled(rows, target, percent)


def test_resampling_draws_repeated_rows_each_on_their_own(spark):
    text = sentence(random.Random(1), 30)
    rows = [(7, text, None, None, None)] * 30 + [(None, text, None, None, None)] * 30 + [(3, "", None, None, None)]
    target = spark.createDataFrame([(1, text)], "item_id long, text string")
    found = resample.resampled(frame(spark, rows), target, percent=50, keep=["text"])
    ranks = sorted(r["rank"] for r in found.collect() if r["rank"] is not None)
    assert ranks == list(range(1, 31))
    assert {r["text"] for r in found.where("rank is not null").collect()} == {text}


def test_resampling_of_empty_tables(spark):
    none = frame(spark, [])
    target = spark.createDataFrame([], "item_id long, text string")
    assert resample.resampled(none, target).collect() == []
    rows = documents(6, 10)
    assert as_rows(resample.resampled(frame(spark, rows), target, 50), *COLUMNS) == brute_resampled(rows, [], 50)


@pytest.mark.parametrize("probes", [1, 15])
def test_bisection_finds_the_nth(spark, probes):
    rng = random.Random(4)
    values = [rng.choice([-(10**9), -5, -5, 0, 3, rng.randrange(-(10**6), 10**6)]) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for n in (2, 299):
        nth = sorted(values)[n - 1]
        assert resample.nth_smallest(df, "v", n, probes) == (nth, sum(v < nth for v in values))


def test_bisection_cuts_ties(spark):
    rng = random.Random(8)
    keys = [(rng.randrange(3), rng.randrange(4), i) for i in range(200)]
    df = spark.createDataFrame(keys, "a long, b long, c long")
    for n in (1, 77, 200):
        assert as_rows(df.where(resample.up_to_nth(df, ["a", "b", "c"], n)), "a", "b", "c") == sorted(sorted(keys)[:n], key=str)


# substring dedup


def brute_deduplicated(rows, window):
    texts = [(t or "").encode().split() for _, t, *_ in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (d, *_), w in zip(rows, texts):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


def periodic(n=40):
    """Texts of few words in short cycles, some cut or changed."""
    rng = random.Random(n)
    out = []
    for i in range(n):
        words = ["abcdefg"[j % (1 + i % 7)] for j in range(rng.randrange(20, 120))]
        if i % 3 == 0:
            words[rng.randrange(len(words))] = "new"
        out.append((1000 + i, " ".join(words), None, None, None))
    return out


@pytest.mark.parametrize("window", [1, 2, 7, 35])
def test_substring_dedup_equals_brute_force(spark, window):
    rows = documents() + periodic()
    found = substring_dedup.deduplicated(frame(spark, rows, clashing=True), window)
    assert as_rows(found, "doc_id", "n_words", "n_removed", "kept") == brute_deduplicated(rows, window)
    for r in found.collect():
        sizes = [s["stop"] - s["start"] for s in r["spans"]]
        assert sum(sizes) == r["n_removed"] and all(s >= window for s in sizes)
        assert all(a["stop"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


@pytest.mark.parametrize("hot, bound", [(3, 1 << 25), (3, 400), (10**6, 1 << 25)])
def test_substring_dedup_of_a_hot_passage(spark, monkeypatch, hot, bound):
    """One passage in a third of all texts: frequent keys split off by number, by the bound, or not at all."""
    monkeypatch.setattr(substring_dedup, "HOT_ROWS", hot)
    monkeypatch.setattr(substring_dedup, "BROADCAST_BYTES", bound)
    rng = random.Random(3)
    passage = sentence(rng, 60)
    rows = []
    for i in range(90):
        text = sentence(rng, rng.randrange(40, 80))
        if i % 3 == 0:
            text = f"{text} {passage} {sentence(rng, 20)}"
        rows.append((i, text, None, None, None))
    rows += rows[:4] + [(None, rows[0][1], None, None, None)]
    found = substring_dedup.deduplicated(frame(spark, rows))
    assert as_rows(found, "doc_id", "n_words", "n_removed", "kept") == brute_deduplicated(rows, 35)


def test_substring_dedup_of_empty_tables(spark):
    assert substring_dedup.deduplicated(frame(spark, [])).collect() == []
    rows = [(1, None, None, None, None), (2, " ", None, None, None), (3, "word", None, None, None)]
    assert as_rows(substring_dedup.deduplicated(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept") == [
        (1, 0, 0, ""), (2, 0, 0, ""), (3, 1, 0, "word"),
    ]


# hard negatives


def brute_mined(rows, is_anchor, k=5, m=3, low=50, high=95):
    least = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        least.setdefault(i, []).append((label, [math.floor(256 * x) for x in v]))
    rows = {i: min(c) for i, c in least.items()}
    out = []
    for a in filter(is_anchor, rows):
        label, v = rows[a]
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in rows.items() if i != a and len(w) == len(v)}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if rows[i][0] == label][:k]:
            fits = [i for i in ranked if rows[i][0] != label and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(fits[:m])]
    return sorted(out)


def vectors(seed, n=400, dim=12, labels=4):
    """Clustered vectors with ties, repeated ids, odd rows and a second length."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, dim))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = centres[label] * (i % 3 != 0) + rng.standard_normal(dim) * rng.choice([0.1, 1.0])
        rows.append((i, [float(x) for x in np.round(v, 1)], label))
    rows += [(n + i, rows[11][1], rows[11][2]) for i in range(60)]  # copies of one vector
    rows += [(n + 100 + i, rows[11][1], (rows[11][2] + 1) % labels) for i in range(20)]
    rows += [(5, rows[7][1], 0), (5, rows[8][1], 0), rows[9]]  # ids that come again
    rows += [(900, [0.0] * dim, 1), (901, None, 1), (902, rows[0][1], None), (None, rows[0][1], 1), (903, [], 1), (904, [], 2)]
    rows += [(905, [float("nan")] * dim, 1), (906, [float("inf")] + [0.0] * (dim - 1), 1), (907, [None] + [0.0] * (dim - 1), 1)]
    rows += [(910 + i, [float(x) for x in rng.standard_normal(3)], i % 2) for i in range(12)]
    return rows


VECTOR_SCHEMA = "vec_id long, embedding array<double>, label int"
MINED = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("values", [1 << 21, 700])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, values):
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", values)  # one block, or several
    monkeypatch.setattr(hard_negatives, "TILE", 16)
    monkeypatch.setattr(hard_negatives, "CHUNK", 20)
    rows = vectors(1)
    df = frame(spark, rows, VECTOR_SCHEMA, clashing=True)
    found = hard_negatives.mined(df, F.col("vec_id") % 5 == 0)
    assert sorted(tuple(r) for r in found.select(*MINED).collect()) == brute_mined(rows, lambda i: i % 5 == 0)


def test_hard_negatives_of_large_components(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-3e6, 3e6) for _ in range(4)], i % 3) for i in range(60)]
    found = hard_negatives.mined(spark.createDataFrame(rows, VECTOR_SCHEMA), F.col("vec_id") % 4 == 0, low=10)
    assert sorted(tuple(r) for r in found.select(*MINED).collect()) == brute_mined(rows, lambda i: i % 4 == 0, low=10)


def test_hard_negatives_of_an_empty_table(spark):
    assert hard_negatives.mined(spark.createDataFrame([], VECTOR_SCHEMA), F.lit(True)).collect() == []
    one = spark.createDataFrame([(1, [1.0], 1)], VECTOR_SCHEMA)
    assert hard_negatives.mined(one, F.lit(True)).collect() == []


@pytest.mark.parametrize("kind", ["spread", "clustered", "parallel"])
def test_bounds_hold_every_score(kind):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((500, 24)) + (4 if kind == "clustered" else 0)
    if kind == "parallel":
        x = np.outer(rng.integers(-5, 6, 500), rng.standard_normal(24))
    x = np.floor(256 * x)
    block = hard_negatives.Block(np.arange(500), rng.integers(0, 3, 500), x)
    asked = hard_negatives.Anchors(np.arange(40), np.zeros(40, int), x[:40])
    block.prepare(asked)
    every = np.arange(40)
    for tile, (a, b) in enumerate(zip(block.starts, block.stops)):
        exact = x[:40] @ block.vectors[a:b].T
        low, high = block.tile_bounds(tile, every)
        assert (low[:, None] <= exact).all() and (exact <= high[:, None]).all()
        low, high = block.row_bounds(slice(a, b), every)
        assert (low <= exact).all() and (exact <= high).all()
    if kind == "clustered":  # and they do rule something out
        assert (block.row_bounds(slice(0, 500), every)[1] < np.median(x[:40] @ block.vectors.T)).any()
