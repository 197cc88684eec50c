import random
import re

from pyspark.sql import functions as F

from sheetdoc.llm import url_filter
from sheetdoc.llm.queries import URL_RULES


def brute(url):
    at = url.find("://") if url is not None else -1
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for kind, rule in URL_RULES:
        domain, _, p = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (kind, rule)
    return host, path, best


URLS = [
    "http://a.org/x", "http://ORG/", "http://org", "https://x.example.org/es/1?q#f", "http://example.org/en/12", "http://example.org/EN/1",
    "http://badexample.org/es/", "http://b.com/fr/x", "ftp://c.COM/de/", "http://d.net/en/1", "no scheme", "", None, "://", "http://?x://org/",
    "http://u:p@h.org:80/a", "HTTP://É.ORG/", "x://y://z.org/", "http://e.net/" + "long/" * 4000,
]


def test_rules_and_parts(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://a.org/x"), (3, URLS[3])]
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in rows], "page_id long, url string, html string, score int")
    got = url_filter.judge(pages, URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, best = brute(r.url)
        assert (r.host, r.path, r.rule) == (host, path, best[1] if best else None), r.url
        assert r.verdict == best[0] if best else r.verdict in ("allow", "block")
    assert {r.verdict for r in got if not r.url} == {"allow"}
    assert url_filter.judge(pages.limit(0), URL_RULES).collect() == []


def test_models_tell_unruled_urls_apart(spark):
    rows = [(i, f"http://good{i % 7}.org/recipes/bread-{i}") for i in range(150)] + [(200 + i, f"http://x{i % 7}.com/de/casino-win-{i}") for i in range(150)]
    asked = [(900 + i, f"http://other{i}.net/recipes/bread-{i}") for i in range(20)] + [(950 + i, f"http://more{i}.net/casino-win-{i}") for i in range(20)]
    pages = spark.createDataFrame(rows + asked, "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, URL_RULES).collect()}
    right = sum(got[900 + i] == "allow" for i in range(20)) + sum(got[950 + i] == "block" for i in range(20))
    assert right >= 36


def test_smoothing_sums_to_one(spark):
    lines = spark.createDataFrame([("abab",), ("abc",)], "line string").withColumn("line", F.concat(F.lit("\x02" * url_filter.ORDER), "line"))
    tables = url_filter.train(lines.withColumn("accepted", F.col("line").contains("c")))
    assert [t.columns for t in tables] == [[f"g{k}", f"d{k}"] for k in range(url_filter.ORDER + 1)]
    unseen = {r.g0: r.d0 for r in tables[0].collect()}
    assert unseen["c"] > 0 > -abs(unseen["a"]) and len(unseen) == 3


def mixed_urls():
    rows = [f"http://good{i % 7}.org/recipes/bread-{i}" for i in range(40)] + [f"http://x{i % 7}.com/de/casino-win-{i}" for i in range(40)]
    return rows + [f"http://other{i}.net/recipes/cake-{i}" for i in range(20)] + [f"http://more{i}.net/casino-{i}" for i in range(20)]


def scores(frame):
    return {r.url: (r.verdict, None if r.score is None else round(r.score, 9)) for r in url_filter.judge(frame, URL_RULES).select("url", "verdict", "score").distinct().collect()}


def test_repeated_pages_do_not_shrink_what_is_learned(spark):
    pages = spark.createDataFrame(list(enumerate(mixed_urls())), "page_id long, url string")
    again = pages.crossJoin(spark.range(1000).select("id")).select("page_id", "url")
    assert scores(again) == scores(pages)


def test_all_labelled_urls_are_learned_from(spark):
    at = F.col("id").cast("string")
    labelled = spark.range(30_000).select("id", F.when(F.col("id") % 2 == 0, F.concat(F.lit("http://g.org/w"), at)).otherwise(F.concat(F.lit("http://x.com/de/w"), at)).alias("url"))
    seen = []
    train = url_filter.train
    try:
        url_filter.train = lambda rows: seen.append(rows.count()) or train(rows)
        url_filter.judge(labelled.select(F.col("id").alias("page_id"), "url"), URL_RULES)
    finally:
        url_filter.train = train
    assert seen[0] > 0.75 * 30_000


def test_grams_beyond_the_broadcast_bound_are_joined(spark, monkeypatch):
    pages = spark.createDataFrame(list(enumerate(mixed_urls())), "page_id long, url string")
    want = scores(pages)
    monkeypatch.setattr(url_filter, "BROADCAST_GRAMS", 20)
    assert scores(pages) == want


def plain_threshold(rows):
    yes, no = sum(ok for _, ok in rows), sum(not ok for _, ok in rows)
    if not yes or not no:
        return 0.0
    steps = sorted({v for v, _ in rows})
    gain = lambda v: sum(not ok for x, ok in rows if x < v) / no - sum(ok for x, ok in rows if x < v) / yes
    best = max(range(len(steps)), key=lambda i: (round(gain(steps[i]), 12), -steps[i]))
    return (steps[best] + steps[max(0, best - 1)]) / 2


def test_threshold_over_cells(spark):
    """Running counts over cells give the threshold that one pass over all scores gives."""
    r = random.Random(3)
    for wide in (1e-4, 0.01, 5.0):
        rows = [(round(r.gauss(wide * ok, wide), 6), bool(ok)) for ok in (0, 1) for _ in range(200)]
        assert abs(url_filter.calibrate(spark.createDataFrame(rows, "score double, accepted boolean")) - plain_threshold(rows)) < 1e-12
    assert url_filter.calibrate(spark.createDataFrame([(1.0, True)], "score double, accepted boolean")) == 0.0


def test_every_labelled_url_calibrates_and_is_learned_from(spark, monkeypatch):
    """More URLs of a kind than the threshold was once set by: none is left out."""
    at = F.col("id").cast("string")
    url = F.when(F.col("id") % 20 == 0, F.concat(F.lit("http://x.com/de/w"), at)).otherwise(F.concat(F.lit("http://g.org/w"), at))
    labelled = spark.range(120_000).select(F.col("id").alias("page_id"), url.alias("url"))
    scored, learned = [], []
    calibrate, train = url_filter.calibrate, url_filter.train
    monkeypatch.setattr(url_filter, "calibrate", lambda rows: scored.append(rows.count()) or calibrate(rows))
    monkeypatch.setattr(url_filter, "train", lambda rows: learned.append(rows.count()) or train(rows))
    url_filter.judge(labelled, URL_RULES)
    assert scored == [120_000] and learned[0] == 120_000
