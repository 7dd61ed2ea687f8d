"""Near-dedup, decontamination, repeats, nearest neighbours and the pipeline against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.data import SF, by_id, documents, frame, sentence

import corpus_pipeline
from harvestline.llm import ann, components, decontaminate, near_dedup, queries, repeats

# near-dedup


def sets_of(rows, k):
    out = {}
    for d, t, *_ in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        out[d] = set(zip(*[w[i:] for i in range(k)])) if len(w) >= k else ({tuple(w)} if w else set())
    return out


def brute_clusters(rows, k, threshold=80):
    sets = sets_of([r for r in rows if r[0] is not None], k)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= threshold * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def family_rows(seed, sizes=(30, 12, 6)):
    """Families of near copies that drift from one another, so that links form chains."""
    rng = random.Random(seed)
    rows, i = [], 0
    for size in sizes:
        words = sentence(rng, 120).split(" ")
        for _ in range(size):
            rows.append((i, " ".join(words), "en", "s", 0))
            i += 1
            for _ in range(rng.randrange(1, 5)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return rows


@pytest.mark.parametrize("k", [2, 5])
@pytest.mark.parametrize("rows", [documents(), family_rows(3), family_rows(4, (60,))], ids=["odd", "families", "chain"])
def test_clusters_against_brute_force(spark, rows, k, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK", 3)
    got = by_id(near_dedup.clustered(spark, frame(spark, rows, clashing=True), k))
    want = brute_clusters(rows, k)
    assert sum(map(len, got.values())) == len(rows)
    for d, found in got.items():
        for r in found:
            if d is None:
                assert r["component_id"] is None and r["kept"]
            else:
                assert (r["n_shingles"], r["component_id"], r["kept"]) == want[d], d


def test_far_members_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LEVELS", 1)
    monkeypatch.setattr(near_dedup, "CHUNK", 4)
    rng = random.Random(11)
    common = sentence(rng, 60)
    rows = []
    for i in range(40):  # half a text in common, and each own half twice
        rows.append((i, common + " " + sentence(random.Random(i // 2), 45) + f" end{i}", "en", "s", 0))
    got = by_id(near_dedup.clustered(spark, frame(spark, rows), 2))
    want = brute_clusters(rows, 2)
    assert {d: (r[0]["n_shingles"], r[0]["component_id"], r[0]["kept"]) for d, r in got.items()} == want
    assert len({w[1] for w in want.values()}) == 20


def test_a_document_with_several_texts_connects_what_each_is_like(spark):
    rng = random.Random(2)
    a, b, c = (sentence(rng, 120) for _ in range(3))
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, c), (5, c), (5, "else")]
    rows = [(d, t, "en", "s", 0) for d, t in rows]
    for n in (1, 4):
        got = near_dedup.clustered(spark, frame(spark, rows).repartition(n), 2).collect()
        assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)}
        assert {r.doc_id for r in got if r.kept} == {1, 4}


def test_links_of_a_family_beside_the_pivots_own_are_few(spark):
    rng = random.Random(6)
    first = sentence(rng, 200).split(" ")
    second = [w if rng.random() > 0.12 else f"own{i}" for i, w in enumerate(first)]
    per_member = []
    for scale in (1, 2):
        rows, i = [], 0
        for words, size in ((first, 30 * scale), (second, 40 * scale)):
            for _ in range(size):
                own = list(words)
                own[rng.randrange(len(own))] = f"new{rng.randrange(10**9)}"
                rows.append((i, " ".join(own), "en", "s", 0))
                i += 1
        docs = frame(spark, rows)
        sketch = near_dedup.sketches(docs, 2).withColumn("node", F.col("doc_id"))
        links = near_dedup.all_links(docs, sketch.select("node", "doc_id", "text_key"), sketch, 2, 80)
        per_member.append(links.distinct().count() / len(rows))
        got = by_id(near_dedup.clustered(spark, docs, 2))
        want = brute_clusters(rows, 2)
        assert {d: (r[0]["n_shingles"], r[0]["component_id"], r[0]["kept"]) for d, r in got.items()} == want
    assert max(per_member) <= 3 and per_member[1] <= 1.5 * per_member[0], per_member


def family(members, n_pivot=100):
    """Rows of near copies of a pivot (0) of shingles 0 .. n_pivot - 1; a member is a set (lacked, added)."""
    return [
        (0, i, n_pivot, n_pivot - len(r) + len(a), n_pivot - len(r), sorted(r | a))
        for i, (r, a) in enumerate(members, 1)
    ]


FAMILY = "pivot long, rep long, n_pivot long, n long, common long, apart array<long>"


def family_components(rows, links):
    """Sets of members that the pivot's links and the given ones connect."""
    root = {r[1]: r[1] for r in rows} | {0: 0}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    near = [(0, r[1]) for r in rows if 100 * r[4] >= 80 * (r[2] + r[3] - r[4])]
    for a, b in [*near, *links]:
        root[find(a)] = find(b)
    out = {}
    for x in root:
        out.setdefault(find(x), set()).add(x)
    return sorted(map(sorted, out.values()))


def brute_family_links(rows):
    sets = {r[1]: set(range(r[2])) ^ set(r[5]) for r in rows}
    ids = sorted(sets)
    return [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_family_links_connect_what_all_pairs_do(spark, seed):
    """Also a member beyond the threshold whose only partner lacks what it lacks and adds nothing."""
    rng = random.Random(seed)
    members = [(set(range(10)), {1000 + i for i in range(13)}), (set(range(10)), set())]
    for i in range(70):
        lacked = set(rng.sample(range(20, 45), rng.randrange(4, 18)))
        added = {2000 + rng.randrange(12) for _ in range(rng.randrange(8))} | {5000 + 30 * i + j for j in range(rng.randrange(10))}
        members.append((lacked, added))
    rows = family(members)
    links = near_dedup.family_links(spark.createDataFrame(rows, FAMILY), 80).collect()
    want = brute_family_links(rows)
    assert {(min(r), max(r)) for r in links} <= set(want)
    assert family_components(rows, links) == family_components(rows, want)
    assert any({1, 2} <= set(c) for c in family_components(rows, links))


def test_members_without_partners_are_not_compared_in_pairs(spark, monkeypatch):
    made, overlapping = [], near_dedup.overlapping

    def counted(pairs, *rest):
        made.append(pairs.count())
        return overlapping(pairs, *rest)

    monkeypatch.setattr(near_dedup, "overlapping", counted)
    for size in (100, 300):
        rng = random.Random(size)
        members = [
            (set(rng.sample(range(100), rng.randrange(8, 14))), {1000 + 20 * i + j for j in range(rng.randrange(8, 14))})
            for i in range(size)
        ]
        made.clear()
        near_dedup.family_links(spark.createDataFrame(family(members), FAMILY), 80).count()
        assert sum(made) <= 2 * size, (size, made)


def test_cluster_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    want = brute_clusters(rows, 2)
    got = queries.QUERIES["op4_near_dedup"](spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want


def test_clusters_of_an_empty_table(spark):
    docs = frame(spark, documents()).limit(0)
    assert near_dedup.clustered(spark, docs, 2).count() == 0
    assert near_dedup.deduplicated(spark, docs, 5).count() == 0


def test_word_hashes_depend_on_words_alone():
    a = near_dedup.word_hashes(b"  The cat\tsat\r\n on\x0bthe CAT ")
    b = near_dedup.word_hashes(b"the Cat sat on the cat")
    assert (a == b).all() and len(set(a.tolist())) == 4
    assert len(near_dedup.word_hashes(" \t".encode())) == 0
    assert len(near_dedup.word_hashes("a\u00a0b\x1cc".encode())) == 1  # not separators here


def test_posterior_bounds():
    for n, m in near_dedup.least_matches():
        assert 0 <= m <= 0.8 * n  # never prunes what matches as often as the threshold
    assert near_dedup.least_matches()[-1][1] > 90


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(1, 50)]
    edges += [(500 + rng.randrange(40), 500 + rng.randrange(40)) for _ in range(30)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in root}


# decontamination


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(docs, items, window=10):
    grams = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[s : s + window]), set()).add(str(i))
    out = {}
    for d, t, *_ in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for s in range(len(w) - n + 1):
                if got := grams.get(tuple(w[s : s + n])):
                    hit.update(range(s, s + n))
                    found |= got
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[d] = (len(w), len(hit), len(found), sha, bool(hit))
    return out


def test_hits_against_brute_force(spark, monkeypatch):
    docs = documents()
    rng = random.Random(8)
    long = [r for r in docs if r[1] and len(words(r[1])) > 30]
    items = [(i, " ".join(r[1].split(" ")[5:25])) for i, r in enumerate(long[:6])]
    items += [(10, sentence(rng, 14)), (11, "alpha1"), (12, "WORD"), (13, None), (14, ""), (15, "--- !!"), (16, items[0][1])]
    items += [items[1], (None, "beta2 gamma3"), (2**40, " ".join(["z"] * 30))]
    docs = docs + [(9001, " ".join(["z"] * 45), "en", "s", 0), (9002, "z " * 9, "en", "s", 0)]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    got = by_id(decontaminate.marked(frame(spark, docs, clashing=True), table))
    want = brute_hits(docs, [x for x in items if x[0] is not None])
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sum(map(len, got.values())) == len(docs)
    for d, found in got.items():
        for r in found:
            assert tuple(r[n] for n in names) == want[d], d
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)  # the way for large benchmarks
    again = by_id(decontaminate.marked(frame(spark, docs, clashing=True), table))
    assert all(tuple(r[n] for n in names) == want[d] for d, found in again.items() for r in found)
    kept = decontaminate.clean(frame(spark, docs, clashing=True), table)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(
        d for d, *_ in docs if d is not None and not want[d][4]
    )
    empty = table.limit(0)
    assert decontaminate.marked(frame(spark, docs), empty).where("contaminated").count() == 0
    assert decontaminate.marked(frame(spark, docs).limit(0), table).count() == 0


def test_rows_of_one_doc_id_are_judged_by_their_own_text(spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(12))
    rows = [(d, t, "en", "s", len(t)) for d in (None, 7) for t in (f"before {item} after", "clean words only")]
    docs = frame(spark, rows, clashing=True)
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    for bound in (decontaminate.BROADCAST_BYTES, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", bound)
        got = decontaminate.marked(docs, table).collect()
        found = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got)
        assert found == [(d, n, h, i, h > 0) for d in (0, 7) for n, h, i in ((3, 0, 0), (14, 12, 1))]
        kept = decontaminate.clean(docs, table)
        assert kept.schema == docs.schema
        assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, rows[1][1]), (7, rows[1][1])]


def test_decontamination_plan_is_native(spark):
    plan = queries.QUERIES["op7_decontamination"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# repeats


def brute_removed(rows, length=400):
    count = Counter()
    for _, t, *_ in rows:
        b = (t or "").encode()
        count.update(b[p : p + length] for p in range(len(b) - length + 1))
    out = {}
    for d, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, np.int64)
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                gone[p] += 1
                gone[p + length] -= 1
        mark = np.cumsum(gone[: len(b)]) > 0
        kept = np.frombuffer(b, np.uint8)[~mark].tobytes()
        spans = int((np.diff(mark.astype(int), prepend=0) == 1).sum())
        out[d] = (len(b), int(mark.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def passage_rows(seed):
    """Passages of about the least length in ever new surroundings, periodic texts, overlaps."""
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (399, 400, 401, 420, 700, 1500)]
    rows = []
    for i in range(40):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            parts.append("".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 300))))
            p = rng.choice(passages)
            cut = rng.randrange(0, 40) if rng.random() < 0.5 else 0
            parts.append(p[cut:] if rng.random() < 0.5 else p[: len(p) - cut])
        rows.append((i, "".join(parts), "en", "s", 0))
    rows += [(100, "abc" * 200, "en", "s", 0), (101, "abc" * 133, "en", "s", 0), (102, "q" * 400, "en", "s", 0)]
    rows += [(103, "r" * 401, "en", "s", 0), (104, "é" * 300, "en", "s", 0)]
    return rows


@pytest.mark.parametrize("rows", [documents(), passage_rows(1), passage_rows(2)], ids=["odd", "one", "two"])
@pytest.mark.parametrize("shard_bytes,kinds", [(repeats.SHARD_BYTES, repeats.GROUP_KINDS), (3000, 2), (3000, 10**6)])
def test_repeats_against_brute_force(spark, rows, shard_bytes, kinds, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(repeats, "GROUP_KINDS", kinds)
    got = by_id(repeats.repeats_removed(spark, frame(spark, rows, clashing=True)))
    want = brute_removed(rows)
    assert sum(map(len, got.values())) == len(rows)
    for d, found in got.items():
        for r in found:
            assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[d], d
            assert sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_removed"]


@pytest.mark.parametrize("rows_at_once,pairs_at_once", [(4096, 1 << 18), (1, 3)])
def test_common_prefixes_within_groups(rows_at_once, pairs_at_once, monkeypatch, spark):
    monkeypatch.setattr(repeats, "LENGTH", 6)
    monkeypatch.setattr(repeats, "ROWS_AT_ONCE", rows_at_once)
    monkeypatch.setattr(repeats, "PAIRS_AT_ONCE", pairs_at_once)
    rng = random.Random(9)
    rows, want = [], set()
    for label in range(40):
        group = []
        for _ in range(rng.randrange(2, 12)):
            left, right = (bytes(rng.choice(b"a\0") for _ in range(rng.randrange(0, 7))) for _ in "ab")
            low, right = rng.randrange(50), right + b"a" * 6
            group.append((len(rows) + len(group), label, rng.random() < 0.8, low, low + len(left + right) - 6, low + len(left), left + right))
        for no, _, lone, low, high, anchor, b in group:
            for no2, _, _, low2, _, anchor2, b2 in group:
                # windows of both that lie alike around the anchor and hold it or touch it
                alike = [
                    p
                    for p in range(low, min(high, anchor) + 1)
                    if p - anchor + anchor2 >= low2 and b[p - low : p - low + 6] == b2[p - anchor + anchor2 - low2 :][:6]
                ]
                if lone and no != no2:
                    want |= {(no, p) for p in alike}
        rows += group
    few = spark.createDataFrame(rows, "no long, label long, lone boolean, low long, high long, anchor long, bytes binary")
    batches = few.groupBy("label").agg(repeats.F.collect_list(repeats.F.struct("no", "lone", "low", "high", "anchor", "bytes")).alias("g"))
    table = batches.select("g").toArrow().combine_chunks()
    got = set()
    for batch in table.to_batches():
        group = batch.column(0)
        edges = np.append(0, np.cumsum([len(g) for g in group]))
        flat = group.flatten()
        columns = [flat.field(k).to_numpy(zero_copy_only=False) for k in range(5)]
        pairs = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        for nos, lows, highs in repeats._shared_ranges(*columns, flat.field(5), pairs):
            got |= {(n, p) for n, x, y in zip(nos.tolist(), lows.tolist(), highs.tolist()) for p in range(x, y + 1)}
    assert {(n, p) for n, p in got if p <= {r[0]: r[5] for r in rows}[n]} == want


def test_repeats_of_an_empty_table(spark):
    assert repeats.repeats_removed(spark, frame(spark, documents()).limit(0)).count() == 0


def test_shard_transform():
    rng = np.random.default_rng(3)
    docs = [rng.integers(1, 4, n).astype(np.uint64) for n in (0, 1, 30, 17)]
    shard = repeats.Shard(docs)
    flat = [(d, i) for d, x in enumerate(docs) for i in range(len(x))]
    tails = [docs[d][i : i + repeats.DEPTH].tolist() for d, i in (flat[k] for k in shard.order)]
    assert tails == sorted(tails)
    assert sorted(shard.order.tolist()) == list(range(48))
    sizes = np.array([len(d) for d in docs])
    for k, before in zip(shard.order, repeats.transform(shard.phrases, shard.order, sizes)):
        d, i = flat[k]
        assert before == (docs[d][i - 1] if i else 0)


def test_boundaries_depend_on_their_surroundings_alone():
    rng = np.random.default_rng(4)
    a, b, c = (rng.integers(0, 20, n).astype(np.uint8) for n in (500, 600, 450))
    alone = repeats.boundaries(b)
    inside = repeats.boundaries(np.concatenate([a, b, c])) - len(a)
    inner = lambda x: {i for i in x.tolist() if repeats.REACH <= i <= len(b) - repeats.AFTER}
    assert inner(alone) == inner(inside) and len(inner(alone)) > 5
    assert (np.diff(alone) > repeats.REACH).all()


# nearest neighbours


def brute_nearest(rows, queries_, k=10):
    good = {}
    for i, v in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v):
            good.setdefault(i, np.array(v, dtype=float))
    out = {}
    for q in queries_:
        if q in good:
            found = sorted(
                (float(np.sqrt(((v - good[q]) ** 2).sum())), i)
                for i, v in good.items()
                if i != q and len(v) == len(good[q])
            )
            out[q] = found[:k]
    return out


def test_nearest_odd_cases(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100, None), (200, [0.0] * 8), (300, [1.0] * 7 + [None]), (400, [1.0] * 7 + [float("nan")])]
    rows += [(500, [1.0] * 7 + [float("inf")]), (600, [1.0, 2.0]), (700, [1.0, 2.5]), (800, []), (900, rows[3][1])]
    rows += [(901, rows[3][1]), rows[0], (None, rows[1][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    want = brute_nearest([r for r in rows if r[0] is not None], [i * 100 for i in range(10)])
    assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items() if v}
    for q, v in got.items():
        assert np.allclose([s for s, _ in v], [s for s, _ in want[q]], rtol=1e-12)
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_a_vector_id_with_several_vectors_has_the_least(spark):
    rng = np.random.default_rng(4)
    rows = [(i % 50, [float(x) for x in rng.standard_normal(4)]) for i in range(150)]
    least = sorted({i: min(v for j, v in rows if j == i) for i in range(50)}.items())
    want = {q: [i for _, i in v] for q, v in brute_nearest(least, [0, 10], 3).items()}
    for n in (1, 3):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(n)
        got = {}
        for r in ann.nearest(df, df.where("vec_id in (0, 10)"), 3).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert got == want


def test_recall_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_VALUES", 64 * 150)
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    asked = [i for i, _ in rows if i % 20 == 0]
    want = brute_nearest(rows, asked)
    got = {}
    for r in ann.nearest(vectors, vectors.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = sum(len(got[q] & {i for _, i in want[q]}) for q in want)
    assert hit / sum(map(len, want.values())) >= 0.95


# pipeline


def test_pipeline_stages(spark):
    """Each stage's decisions on its own input, against brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select(names).collect()]
        out = stage(spark, docs, SF)
        if name == "sentencepiece":
            assert out.columns == ["doc_id", "n_tokens", "ids"] and out.count() == len(before)
            break
        assert out.columns == names
        docs = near_dedup.written(out, name)
        kept[name] = {r.doc_id for r in docs.collect()}
        if name == "near_dedup":
            want = brute_clusters(before, 5)
            assert kept[name] == {d for d, (_, _, stays) in want.items() if stays}
        if name == "decontaminate":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            want = brute_hits(before, items)
            assert kept[name] == {d for d, w in want.items() if not w[4]}
        if name == "secret_scan":
            assert kept[name] == {r[0] for r in before}
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids"] and out.count() > 100


def test_pipeline_odd_documents(spark, tmp_path):
    frame(spark, documents(), clashing=True).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "alpha1 beta2")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 20
    frame(spark, documents()).limit(0).write.parquet(str(tmp_path / "e" / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "e" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "e")).count() == 0
