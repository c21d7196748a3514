"""URL rules and models against plain versions of them."""

import math
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest

from ledgerfold.llm import url_filters
from ledgerfold.llm.common import look_up
from ledgerfold.llm.queries import QUERIES, URL_RULES

SMALL = "/root/testdata/sf0.001"

SCHEMA = "page_id LONG, url STRING, html STRING, score DOUBLE, rule STRING, digest INT, `a b.c` INT"


def table(spark, rows):
    return spark.createDataFrame([(*r, "h", 0.5, "r", 1, 2) for r in rows], SCHEMA)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for mark in "?#":
        rest = rest.split(mark)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if c.isascii() else c for c in host), slash + path


def rule(host, path, rules):
    best = (None, None)
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        site, slash, rest = text.partition("/")
        if (host == site or host.endswith("." + site)) and path.startswith(slash + rest):
            best = (text, verdict)
    return best


def model(texts, order):
    """The chance of a character after others, by counts of this side's texts."""
    seen = defaultdict(Counter)
    for text in texts:
        padded = "\x02" * order + text + "\x03"
        for i in range(order, len(padded)):
            for k in range(order + 1):
                seen[k, padded[i - k : i]][padded[i]] += 1

    def chance(context, character, k):
        less = chance(context[1:], character, k - 1) if k else 1 / 256
        counts = seen.get((k, context))
        if not counts:
            return less
        return (counts[character] + len(counts) * less) / (sum(counts.values()) + len(counts))

    return chance


def by_hand(rows, rules, order=5):
    parts = [split(url) for _, url in rows]
    ruled = [rule(*p, rules) for p in parts]
    example = {}
    for p, (_, verdict) in zip(parts, ruled):
        example["".join(p)] = verdict
    train = {a: v for a, v in example.items() if zlib.crc32(a.encode()) % 5}
    sides = [[a for a, v in train.items() if v == side] for side in ("allow", "block")]
    models = [model(texts, order) for texts in sides]
    scores = {}
    for a in example:
        padded = "\x02" * order + a + "\x03"
        total = 0.0
        for i in range(order, len(padded)):
            yes, no = (m(padded[i - order : i], padded[i], order) for m in models)
            total += math.log(yes) - math.log(no)
        scores[a] = total / (len(a) + 1) if all(sides) else 0.0
    return parts, ruled, [scores["".join(p)] for p in parts]


def urls(rng, n):
    out = []
    for i in range(n):
        host = rng.choice(["good", "fine", "spam-win", "spam-bet", "blog"]) + rng.choice("abc")
        top = rng.choice(["example.net", "example.com", "example.org"])
        path = rng.choice(["/en/", "/de/", "/fr/", "", "/"]) + str(rng.randint(0, 30))
        out.append((i, f"https://{host}.{top}{path}{rng.choice(['', '?a=1', '#x/y'])}"))
    return out


def judged(spark, rows, rules=URL_RULES, **options):
    return {r.doc_id: r for r in url_filters.judge_rows(table(spark, rows), rules, **options).collect()}


@pytest.mark.parametrize("order", [2, 5])
def test_scores_equal_by_hand(spark, order):
    rows = urls(random.Random(4), 400)
    got = judged(spark, rows, order=order)
    parts, ruled, scores = by_hand(rows, URL_RULES, order)
    assert len(got) == len(rows)
    for (i, _), p, (text, verdict), score in zip(rows, parts, ruled, scores):
        r = got[i]
        assert (r.host, r.path, r.rule) == (*p, text)
        assert r.score == pytest.approx(score, abs=1e-5)
        assert r.verdict == (verdict or ("allow" if r.score >= r.score_limit else "block"))


def test_tells_unruled_urls_apart(spark):
    rng = random.Random(6)
    rules = (("allow", "example.org/"), ("block", "example.com/"))
    rows = []
    for i in range(600):
        good, ruled = rng.random() < 0.5, rng.random() < 0.5
        name = rng.choice(["garden", "history", "science"] if good else ["casino", "jackpot", "pills"])
        host = f"{name}{rng.randint(0, 99)}." + (("example.org" if good else "example.com") if ruled else "example.net")
        rows.append((i, f"http://{host}/p/{rng.randint(0, 999)}"))
    got = judged(spark, rows, rules)
    unruled = [(r.verdict == "allow", not any(w in r.host for w in ("casino", "jackpot", "pills"))) for r in got.values() if r.rule is None]
    assert len(unruled) > 200 and sum(a == b for a, b in unruled) / len(unruled) > 0.97


def test_hosts_paths_and_rules(spark):
    rows = [
        (1, None),
        (2, ""),
        (3, "no scheme/net/"),
        (4, "http://NET/"),
        (5, "http://a.ÀB.Net/x?y#z"),
        (6, "http://example.net/en/"),
        (7, "http://xexample.net/en/1"),
        (8, "http://www.example.net/EN/1"),
        (9, "http://www.example.net"),
        (10, "http://example.com/de/#/en/"),
        (11, "ftp://x.org/fr/?://y.net/"),
        (12, "://org/fr/"),
        (13, "http://user@h.org:80/fr/1"),
        (14, "http://x.org\n/fr/\n2"),
        (15, "http://x.org/" + "long/" * 20_000),
        (None, "http://a.net/"),
        (4, "http://NET/"),
    ]
    got = url_filters.judge_rows(table(spark, rows), URL_RULES).collect()
    want = [(i, *split(u), rule(*split(u), URL_RULES)[0]) for i, u in rows]
    assert sorted([(r.doc_id, r.host, r.path, r.rule) for r in got], key=repr) == sorted(want, key=repr)
    assert {r.verdict for r in got} <= {"allow", "block"}
    assert (want[3][3], want[5][3], want[6][3]) == ("net/", "example.net/en/", "net/")


def test_without_examples_of_both_sides(spark):
    got = judged(spark, [(1, "http://a.b/"), (2, None), (3, "http://a.net/x")])
    assert (got[1].verdict, got[1].score, got[1].score_limit) == ("allow", 0.0, 0.0)
    assert (got[2].verdict, got[3].verdict) == ("allow", "block")
    assert judged(spark, []) == {}


def test_copies_weigh_once(spark):
    rows = urls(random.Random(8), 200)
    copies = [(1000 + i, rows[0][1]) for i in range(300)]
    alone, among = judged(spark, rows), judged(spark, rows + copies)
    assert all(alone[i].score == among[i].score for i, _ in rows)


def test_allowed_keeps_columns(spark):
    rows = urls(random.Random(2), 60)
    pages = table(spark, rows)
    kept = url_filters.allowed(pages, URL_RULES)
    assert kept.dtypes == pages.dtypes
    want = {i for i, r in judged(spark, rows).items() if r.verdict == "allow"}
    assert {r.page_id for r in kept.collect()} == want


def test_look_up_of_heavy_keys(spark):
    rows = spark.range(1000).selectExpr("id", "CASE WHEN id < 700 THEN 'hot' ELSE CAST(id % 50 AS STRING) END AS key")
    found = rows.groupBy("key").count().selectExpr("key", "count AS asked", "length(key) AS size")
    for heavy in (1, 2, 10, 10_000):
        got = look_up(rows, found, ["key"], "asked", heavy)
        assert got.columns == ["key", "id", "size"]
        assert got.count() == 1000 and got.where("size <> length(key)").count() == 0


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")
def test_registered_query(spark):
    got = {r.page_id: r for r in QUERIES["op12_url_filters"](spark, SMALL).collect()}
    rows = duckdb.sql(f"SELECT page_id, url FROM '{SMALL}/pages.parquet'").fetchall()
    parts, ruled, scores = by_hand(rows, URL_RULES)
    assert len(got) == len(rows)
    for (i, _), p, (text, verdict), score in zip(rows, parts, ruled, scores):
        r = got[i]
        assert (r.host, r.path, r.rule) == (*p, text)
        assert r.score == pytest.approx(score, abs=1e-5)
        assert r.verdict == (verdict or ("allow" if r.score >= r.score_limit else "block"))
