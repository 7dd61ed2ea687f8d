"""Small tables for the operators' tests, with the odd cases that every operator must define."""

import random

SF = "/root/testdata/sf0.001"
# Names that the operators use inside or return.
CLASHING = {
    "score": 1, "rule": "r", "key": "k", "n": 2, "label": 3, "held_out": True, "bucket": 4, "rep": 5,
    "component_id": 6, "start": 7, "spans": "s", "place": 8, "host": "h", "word": "w", "token": "t", "n_words": 9,
}
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    words = ["alpha", "beta", "gamma", "delta", "Omega", "über", "señor", "x1", "café", "naïve"]
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))


def documents(seed=1, n=40):
    """Random texts with exact copies, near copies, shared passages, nulls, empty and odd texts."""
    rng = random.Random(seed)
    texts = [sentence(rng, rng.randrange(1, 160)) for _ in range(n)]
    passage = sentence(rng, 90)
    for i in range(0, n, 5):
        texts[i] = texts[i] + "\n" + passage
    for i in range(3, n, 7):
        words = texts[i].split(" ")
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts += [texts[1], texts[1], None, None, "", " \t\n", "word", "WORD", "a" * 1500, "ab" * 900, "😀 ✓ 日本語"]
    texts.append(" ".join(sentence(rng, 50) for _ in range(60)))  # a long one
    texts.append("x" * 50_000)
    rows = [(i * 3, t, "en", "src0", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[2])  # a repeated row
    rows.append((None, texts[4], None, None, None))  # no id
    return rows


def frame(spark, rows, schema=DOC_SCHEMA, clashing=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema)
    if clashing:
        df = df.select("*", *[F.lit(v).alias(k) for k, v in CLASHING.items() if k not in df.columns])
    return df


def by_id(df, key="doc_id"):
    """Rows as {id: set of the other columns' values}, so that repeated rows agree."""
    out = {}
    for r in df.collect():
        d = r.asDict()
        out.setdefault(d.pop(key), []).append(d)
    return out
