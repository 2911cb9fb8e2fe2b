import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandkit.llm import url_filter as U
from demandkit.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(AZ), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def rule_of(host, path, rules=URL_RULES):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.host) + len(r.path), len(r.host), r.verdict == "block"), default=None)


def links(html):
    found = re.findall(r"""\bhref[ \t\r\n\f]*=[ \t\r\n\f]*["']?[ \t\r\n\f]*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<> \t\r\n\f]+)""", html or "", re.I)
    return [x.translate(AZ) for x in found]


def brute(rows, rules=URL_RULES, steps=U.STEPS, d=U.DAMPING):
    """Dense matrices over all hosts."""
    parts = [split(r[1]) for r in rows]
    own = {h for h, _ in parts if h}
    edges = {}
    for (host, _), (_, _, html) in zip(parts, rows, strict=True):
        for to in links(html):
            if host and to != host:
                edges[host, to] = edges.get((host, to), 0) + 1
    for host in own:
        parent = host.split(".", 1)[1] if "." in host else ""
        if parent in own:
            for pair in ((host, parent), (parent, host)):
                edges[pair] = edges.get(pair, 0) + 1
    hosts = sorted(own | {x for pair in edges for x in pair})
    at = {h: i for i, h in enumerate(hosts)}
    m = np.zeros((len(hosts), len(hosts)))
    for (a, b), w in edges.items():
        m[at[a], at[b]] = w
    seeds = np.zeros((2, len(hosts)))
    for h, i in at.items():
        mine = [rule_of(*p, rules) for p in parts if p[0] == h] or [rule_of(h, "/", rules)]
        seeds[:, i] = [np.mean([r is not None and r.verdict == v for r in mine]) for v in ("allow", "block")]
    share = []
    for matrix, seed in ((m, seeds[0]), (m.T, seeds[1])):
        out = matrix.sum(1, keepdims=True)
        move = np.divide(matrix, out, out=np.zeros_like(matrix), where=out > 0)
        x, y = (1 - d) * seed, np.full(len(hosts), 1 - d)
        for _ in range(steps):
            x, y = (1 - d) * seed + d * x @ move, (1 - d) + d * y @ move
        share.append(x / y)
    verdicts = {h: "block" if round(share[1][i], 9) >= U.BLOCK_SHARE and round(share[1][i], 9) > round(share[0][i], 9) else "allow"
                for h, i in at.items()}
    out = []
    for (host, path), (page, _, _) in zip(parts, rows, strict=True):
        r = rule_of(host, path, rules)
        out.append((page, host, path, r.host + r.path if r else None, r.verdict if r else verdicts.get(host, "allow")))
    return sorted(out, key=str), {h: (share[0][i], share[1][i]) for h, i in at.items()}


def result(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def a(*urls):
    return "".join(f'<a class=x HREF = "{u}">t</a>' for u in urls)


WEB = [
    (1, "http://good.org/fr/1", a("https://friend.example/", "//friend.example/x", "/own")),
    (2, "http://good.org/fr/2", a("http://friend.example:80/?q")),
    (3, "http://friend.example/", a("http://Good.ORG/fr/1")),
    (4, "http://farm.example/1", a("http://bad.net/", "http://bad.net/2", "http://worse.net/")),
    (5, "http://farm.example/2", a("http://worse.net/a#b") * 50),
    (6, "http://far.example/", a("http://farm.example/1")),
    (7, "http://bad.net/", None), (8, "https://WWW.bad.NET?x", ""), (9, "http://net", a("http://bad.net/")),
    (10, None, a("http://bad.net/")), (11, "no scheme", None), (12, "a://b://c/d?e#f", ""), (13, "http://", ""), (14, "", None),
    (15, "http://x.example.net/en/1", ""), (15, "http://x.example.net/en/1", ""), (16, "http://x.example.net/english", ""),
    (17, "http://notexample.com/de/", ""), (18, "http://example.com/de", ""), (19, "http://example.com/de/?a=://b", ""),
    (20, "http://sub.farm.example/", ""), (21, "http://hub.example/", a(*(f"http://h{i}.net/" for i in range(30)))),
    (None, "http://lonely.example/\nx", "href href= href='//' href=\"//tail.example"), (22, "http://tail.example/", "x" * 100_000),
]


def test_made_web_against_brute_force(spark):
    df = spark.createDataFrame(WEB, SCHEMA).repartition(4).withColumn("host", F.lit("x")).withColumn("kind", F.lit(9)).withColumn("trust", F.lit(0))
    want, shares = brute(WEB)
    got = U.judge(df, URL_RULES)
    assert result(got) == want
    verdicts = {w[0]: w[4] for w in want}
    assert verdicts[4] == verdicts[5] == verdicts[21] == "block" and verdicts[1] == verdicts[3] == verdicts[10] == "allow"
    for r in got.collect():
        if r.host:
            assert (r.trust, r.distrust) == pytest.approx(shares[r.host], abs=2e-9)


def test_whole_table_against_brute_force(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert result(U.judge(pages, URL_RULES)) == brute(rows)[0]


def test_longest_rule_and_ties(spark):
    rules = (U.Rule("allow", "a.b", "/"), U.Rule("block", "b", "/ab"), U.Rule("block", "a.b", "/"), U.Rule("allow", "b", ""))
    rows = [(1, "http://a.b/", ""), (2, "http://a.b/ab", ""), (3, "http://c.b", ""), (4, "http://bb/", "")]
    assert result(U.judge(spark.createDataFrame(rows, SCHEMA), rules)) == brute(rows, rules)[0]
    assert [r[3:] for r in brute(rows, rules)[0]] == [("a.b/", "block"), ("a.b/", "block"), ("b", "allow"), (None, "allow")]
    none = U.judge(spark.createDataFrame(rows, SCHEMA), ())
    assert all(r.rule is None and r.verdict == "allow" for r in none.collect())


def test_links_take_linear_time(spark):
    rows = [(i, "http://a.example/", unit * 100_000) for i, unit in enumerate(("href", "href=", "href= ", "href \n", "href='http:", "href=//", "href=a"))]
    assert len(U.judge(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()) == len(rows)


def test_empty_table(spark):
    assert U.judge(spark.createDataFrame([], SCHEMA), URL_RULES).collect() == []
