"""URL filter and WARC output."""

import base64
import hashlib
import io
import json
import zlib

import duckdb
import pytest
from tests.llm.data import frame

from harvestline.llm import queries, url_filter, warc

SF01 = "/root/testdata/sf0.01"
URLS = [
    ("http://ththre.example.com/fr/825?page=2", "ththre.example.com", "/fr/825", "com/", "allow"),
    ("https://EXAMPLE.com/en/1#top", "example.com", "/en/1", "example.com/en/", "block"),
    ("https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    ("https://www.example.com/en/x", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("https://a.www.example.com/en/x", "a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("https://notexample.com/en/x", "notexample.com", "/en/x", "com/", "allow"),
    ("http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
    ("http://x.net/fr/", "x.net", "/fr/", "net/fr/", "block"),
    ("http://x.net/fr", "x.net", "/fr", None, None),
    ("http://x.com?q=/en/", "x.com", "", None, None),
    ("http://blog.casino-win.example.net/en/2", "blog.casino-win.example.net", "/en/2", None, "block"),
    ("http://ththan.example.net/en/2", "ththan.example.net", "/en/2", None, "allow"),
    ("http://a://b/c", "a:", "//b/c", None, None),
    ("no scheme", "", "", None, None),
    ("http://É.com/Ü", "É.com", "/Ü", "com/", "allow"),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def test_url_parts_rules_and_verdicts(spark):
    rows = [(i, u[0], "x") for i, u in enumerate(URLS)] + [(0, URLS[0][0], "x"), (None, URLS[1][0], "x")]
    pages = frame(spark, rows, "page_id long, url string, html string", clashing=True)
    model = url_filter.train(spark)
    got = url_filter.judged(pages, model).collect()
    assert len(got) == len(rows)
    for r in got:
        url, host, path, rule, verdict = URLS[1 if r.page_id is None else r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict), url
    assert url_filter.judged(pages.limit(0), model).count() == 0


def test_url_plan_is_native(spark):
    plan = queries.QUERIES["op2_url_filter"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_url_model_on_hosts_it_has_not_seen(spark):
    bad = ["casino-bonus-win.test", "cheap-viagra.test", "adult-cams.test", "my-ads-track.test", "free-bets-now.test"]
    good = ["www.thonther.example.net", "m.thnation.example.org", "blog.library.test", "tionst.example.org"]
    rows = [(i, f"https://{h}/en/77", "") for i, h in enumerate(bad + good)]
    pages = frame(spark, rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.judged(pages, url_filter.train(spark)).collect()}
    assert [got[i] for i in range(len(rows))] == ["block"] * len(bad) + ["allow"] * len(good)


def test_url_model_on_paths_alone(spark):
    bad = ["online-casino/free-bets/", "casino-bonus/77.html", "viagra/cheap", "adult/cams/3", "porn-video/", "free-spins/"]
    good = ["news/77.html", "recipes/lentil-soup/", "wiki/Trade", "history/of/letters", "77", "weather/77.html"]
    rows = [(i, f"https://{h}/{p}", "") for h in ("blog.x.org", "quarry.test") for i, p in enumerate(bad + good)]
    pages = frame(spark, rows, "page_id long, url string, html string")
    for r in url_filter.judged(pages, url_filter.train(spark)).collect():
        assert r.rule is None
        assert r.verdict == ("block" if r.page_id < len(bad) else "allow"), (r.host, r.path, r.score)


def test_url_model_on_unwanted_hosts_of_the_test_tables(spark):
    bad = ["casino-win", "spam-farm", "adult-x", "cheap-pills", "free-bets", "ads-track"]
    rows = [(i, f"https://{h}.example.net/en/{n}", "") for i, h in enumerate(bad) for n in (7, 7733)]
    pages = frame(spark, rows, "page_id long, url string, html string")
    for r in url_filter.judged(pages, url_filter.train(spark)).collect():
        assert (r.rule, r.verdict) == (None, "block"), (r.host, r.score)


def test_labelled_table_holds_no_host_of_the_test_tables(spark):
    pages = url_filter.with_parts(spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url"))

    def stem(host):
        labels = [x for x in host.split(".") if x not in ("www", "m", "blog")]
        return labels[0] if labels else host

    judged = {stem(r.host) for r in pages.select("host").distinct().collect() if r.host}
    table = [(h.split("//")[1].split("/")[0],) for h, _ in url_filter.labelled_urls()]
    assert not judged & {stem(h) for (h,) in set(table)}
    assert len(judged) > 50


# Held out: hosts that were written down before the model was first fitted to its table.
HELD_OUT_BAD = (
    "casino-royale-games.com", "luckypoker.net", "bet-bets.org", "megaslots.io", "jackpot-city-play.com",
    "free-porn-tube.net", "adultfriends.org", "hotsexchat.com", "livecams-girls.ru", "escort-berlin.de",
    "xxxmovies.info", "buyviagra.co.uk", "cialis-generic.com", "discountpills.ru", "steroids-store.com",
    "spamking.net", "buy-backlinks.org", "linkfarmers.com", "bulkmailer.ru", "banner-ads.net", "adserver1.com",
    "trackerz.io", "clicktracking.net", "pixel-log.com", "payday-advance.com", "paydayloans.co.uk", "malwarebin.ru",
    "phishingkit.net", "keygen-serials.ru", "warezbb.org", "replica-rolex.com", "replicabags.cn",
    "nudebeach-pics.com", "spinsandwin.com", "onlinebetting.info", "freebonus-codes.com",
)
HELD_OUT_GOOD = (
    "bbc.co.uk", "lemonde.fr", "nytimes.com", "oxford.ac.uk", "stmarys-parish.org", "gardeners.net", "cookbook.com",
    "openstreetmap.org", "birdwatching.org", "apple-orchard.com", "village-hall.co.uk", "astronomers.org",
    "kindergarten.de", "stadtwerke.de", "biblioteca.es", "mairie-lyon.fr", "gutenberg.org", "archive.org", "nasa.gov",
    "python.org", "debian.org", "carpentry.com", "plumber-leeds.co.uk", "vets.org", "orthopaedics.org", "choir.org",
    "brassband.net", "photography.com", "painters.org", "woodworking.com", "localpress.com", "meteo.fr",
    "railways.ch", "postoffice.com", "quietriver.net", "allotments.org", "mathforum.org", "teachers.net",
    "poets.org", "firebrigade.de",
)


def test_url_model_on_the_held_out_set(spark):
    first = [h.split(".")[0] for h in HELD_OUT_BAD]
    bad = [f"https://{h}{p}" for h in HELD_OUT_BAD for p in ("/", "/start/7")]
    bad += [f"https://{g}/{b}/" for g, b in zip(HELD_OUT_GOOD, first)]
    good = [f"https://{h}{p}" for h in HELD_OUT_GOOD for p in ("/", "/start/7")]
    good += [f"https://{g}/{h.split('.')[0]}/" for g, h in zip(HELD_OUT_GOOD, HELD_OUT_GOOD[::-1])]
    pages = frame(spark, [(i, u, "") for i, u in enumerate(bad + good)], "page_id long, url string, html string")
    judged = url_filter.judged(pages, url_filter.train(spark), rules=[("no.such.host", "/", "allow")]).collect()
    missed = [r.host for r in judged if r.page_id < len(bad) and r.verdict == "allow"]
    wrong = [r.host for r in judged if r.page_id >= len(bad) and r.verdict == "block"]
    assert len(missed) <= 0.2 * len(bad), missed
    assert len(wrong) <= 0.05 * len(good), wrong


def test_url_parts_and_rules_of_all_pages_against_sql(spark):
    pages = "/root/testdata/sf0.1/pages.parquet"
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    values = ", ".join(f"('{r}', '{r[: r.index('/')]}', '{r[r.index('/') :]}', '{v}')" for r, v in rules.items())
    sql = f"""
    WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
               FROM '{pages}'),
    h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM p),
    q AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h)
    SELECT page_id, host, path, max_by(rule, length(rule)) FILTER (fits), max_by(verdict, length(rule)) FILTER (fits)
    FROM (SELECT q.*, r.rule, r.verdict,
            (host = r.rule_host OR ends_with(host, '.' || r.rule_host)) AND starts_with(path, r.rule_path) AS fits
          FROM q, (VALUES {values}) r(rule, rule_host, rule_path, verdict))
    GROUP BY ALL"""
    expected = {r[0]: r[1:] for r in duckdb.sql(sql).fetchall()}
    got = url_filter.judged(spark.read.parquet(pages), url_filter.train(spark)).collect()
    assert len(got) == len(expected) > 1000
    for r in got:
        host, path, rule, verdict = expected[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and r.verdict == (verdict or r.verdict)
        assert rule is not None or r.verdict == ("block" if r.score > 0.5 else "allow")


def brute_pages(rows):
    newest = {}
    for p, _, html in rows:
        if p is not None:
            newest[html or ""] = max(newest.get(html or "", p), p)
    out = []
    for p, _, html in rows:
        b = (html or "").encode()
        top = newest.get(html or "")
        again = p is not None and p < top
        sha = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((p, len(b), sha, "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


PAGES = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>one</p>"), (3, None, "<p>one</p>"),
    (4, "http://c/\r\nX: y", "é" * 1000), (5, "", None), (6, "http://d", ""), (7, "u", "WARC/1.1\r\n\r\n\r\n"),
    (8, "u", "x" * 700_000), (8, "u", "x" * 700_000), (None, "u", "<p>one</p>"), (9, "u", "x" * 700_000),
]


def test_archive_against_brute_force(spark):
    pages = frame(spark, PAGES, "page_id long, url string, html string", clashing=True)
    got = sorted((tuple(r) for r in warc.archive(spark, pages).collect()), key=str)
    assert got == brute_pages(PAGES)
    assert warc.archive(spark, pages.limit(0)).count() == 0


def test_archive_query_against_brute_force(spark):
    got = sorted((tuple(r) for r in queries.QUERIES["op10_warc"](spark, SF01).collect()), key=str)
    rows = spark.read.parquet(f"{SF01}/pages.parquet").select("page_id", "url", "html").collect()
    assert got == brute_pages([tuple(r) for r in rows])


def test_least_revisit_length(spark):
    pages = frame(spark, PAGES[:6], "page_id long, url string, html string")
    kinds = {r.page_id: r.record_type for r in warc.archive(spark, pages, min_revisit_bytes=1).collect()}
    assert kinds == {1: "revisit", 2: "revisit", 3: "response", 4: "response", 5: "response", 6: "response"}


@pytest.mark.parametrize("members", [1, 3])
def test_normaliser_gives_a_member_per_record(members):
    records = [warc.record(i, f"http://x/{i}", bytes([65 + i % 26]) * (i * 997), "response", None) for i in range(30)]
    size = -(-len(records) // members)
    mono = b"".join(b"".join(warc.monolithic(records[i : i + size])) for i in range(0, len(records), size))
    out = list(warc.normalise(io.BytesIO(mono)))
    assert [int(h["X-Page-Id"]) for h, _ in out] == list(range(30))
    assert [zlib.decompress(m, 31) for _, m in out] == records


def test_repetitive_stream_is_inflated_by_pieces(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 4096)
    records = [warc.record(i, "u", b"z" * 2000, "response", None) for i in range(500)]
    records.append(warc.record(500, "u", b"y" * 300_000, "response", None))
    source = warc.Inflater(io.BytesIO(b"".join(warc.monolithic(records))))
    held = []
    for (_, whole), want in zip(source.records(), records, strict=True):
        assert whole == want
        held.append(len(source.buffer))
    assert max(held[:500]) <= 4096 + len(records[0]) and source.buffer[source.at :] == b""


def test_sidecar_tells_the_same_as_the_index(spark, tmp_path):
    pages = frame(spark, PAGES, "page_id long, url string, html string")
    found = warc.archive(spark, pages, str(tmp_path)).count()
    index = {}
    for r in spark.read.parquet(f"{tmp_path}/index").collect():
        index.setdefault(r.file, []).append((r.offset, r.length, r.page_id))
    assert found == len(PAGES) == sum(map(len, index.values()))
    for file, rows in index.items():
        with open(file.removesuffix(".warc.gz") + ".idx.jsonl") as f:
            told = [tuple(json.loads(line)[k] for k in ("offset", "length", "page_id")) for line in f]
        assert told == sorted(rows)
        fs, path = warc.open_fs(file)
        for offset, length, page in told:
            assert warc.read_record(fs, path, offset, length)[0].get("X-Page-Id") == (page and str(page))


def test_torn_stream_is_an_error():
    mono = b"".join(warc.monolithic([warc.record(1, "u", b"x" * 1000, "response", None)]))
    with pytest.raises(ValueError):
        list(warc.normalise(io.BytesIO(mono[:-30])))
