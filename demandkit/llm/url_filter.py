"""URL filters: rules by host and path, and link-graph propagation for the rest.

A rule names a host, which covers its subdomains, and how a path starts; of the
rules that fit a url the longest decides (of equally long ones that with the
longer host, then a blocking one). Urls without a rule are judged by their host:

* trust: personalised PageRank along links from trusted seeds;
* distrust: the same against the direction of links from blocked seeds, since who
  links to blocked hosts is suspect.

A host's seed weights are the shares of its pages that rules allow and block; a
host that is only linked to counts as its path ``/``. Beside each of the two runs
one from all hosts, with weight 1 each; the quotient is the share of a host's
rank that came from seeds. A host is blocked where the distrust share is at least
``block_share`` and over its trust share. Walks have at most ``steps`` links.

Host edges are the ``href`` links of the pages to other hosts, with their number,
and one edge each way between a host and its parent domain where both are
hosts of pages (``blog.a.org`` and ``a.org`` are one site).

Spark's part: links are counted by pair of hosts in partial aggregates, so a hot
host brings a row for each host that it is linked with. Each step is one join of
the ranks with the arcs, and one aggregate; a checkpoint cuts the lineage. All of
it are DataFrame functions. The hosts' verdicts are broadcast to the pages if a
count proves them few, otherwise joined by a shuffle, whose hot hosts Spark splits.

Defined cases: a null url, or one without ``://``, has an empty host and path, no
rule and is allowed; null html has no links; repeated rows are judged alike and
count as pages each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, small, write_table

DAMPING = 0.85
STEPS = 20
BLOCK_SHARE = 0.25

#: Host and path of a url; and what follows ``//`` in a link to another host.
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)\bhref[ \t\r\n\f]*+=[ \t\r\n\f]*+["']?[ \t\r\n\f]*+(?:[a-z][a-z0-9+.-]*+:)?//([^/?#"'<> \t\r\n\f]++)"""


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path, and html for the links."""
    part = lambda i: F.coalesce(F.regexp_extract(F.col("url").cast("string"), URL, i), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), lower_ascii(part(1)).alias("host"),
                        part(2).alias("path"), F.col("html").cast("string").alias("html"))


def fitting(rules: Sequence[Rule], host: Column, path: Column, what) -> Column:
    """``what`` of the longest rule that fits; null without one."""
    order = sorted(rules, key=lambda r: (-len(r.host) - len(r.path), -len(r.host), r.verdict != "block"))
    fits = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.lit(what(r))) for r in order]
    return F.coalesce(*fits, F.lit(None).cast("string"))


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """src, dst, weight: numbers of links between different hosts, and the
    site edges. ``pages`` has host and html, ``hosts`` the hosts of pages."""
    links = pages.where("host <> ''").select(
        F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
    links = links.select("src", lower_ascii(F.col("dst")).alias("dst")).where("src <> dst")
    names = hosts.select(F.col("host").alias("dst"))
    site = hosts.select(F.col("host").alias("src"), F.regexp_extract("host", r"^[^.]*\.(.*)$", 1).alias("dst")).join(names, "dst")
    both = site.select("src", "dst").unionByName(site.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return links.unionByName(both).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))


def arcs(edges: DataFrame) -> DataFrame:
    """kind, from, to, share: kind 0 along the links, kind 1 against them; the
    shares of a kind and start add up to 1."""
    both = edges.select(F.lit(0).alias("kind"), F.col("src").alias("from"), F.col("dst").alias("to"), "weight").unionByName(
        edges.select(F.lit(1).alias("kind"), F.col("dst").alias("from"), F.col("src").alias("to"), "weight"))
    sums = both.groupBy("kind", "from").agg(F.sum("weight").alias("whole"))
    return both.join(sums, ["kind", "from"]).select("kind", "from", "to", (F.col("weight") / F.col("whole")).alias("share"))


def propagate(seeds: DataFrame, along: DataFrame, steps: int = STEPS, damping: float = DAMPING) -> DataFrame:
    """host, kind, share of the rank that came from seeds. ``seeds`` has
    kind, host, seed (0 to 1) for every host and kind; ``along`` is of :func:`arcs`."""
    start = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("seeded"), F.lit(1.0 - damping).alias("whole"))
    start = write_table(start, "seeds")
    now = start
    for _ in range(0 if along.isEmpty() else steps):
        moved = along.join(now.withColumnRenamed("host", "from"), ["kind", "from"]).select(
            "kind", F.col("to").alias("host"), (F.col("seeded") * F.col("share") * damping).alias("seeded"),
            (F.col("whole") * F.col("share") * damping).alias("whole"))
        now = checkpointed(moved.unionByName(start).groupBy("kind", "host").agg(
            F.sum("seeded").alias("seeded"), F.sum("whole").alias("whole")))
    # Sums of doubles differ in their last bits with the order of rows; thresholds shouldn't see it.
    return now.select("kind", "host", F.round(F.col("seeded") / F.col("whole"), 9).alias("share"))


def host_verdicts(pages: DataFrame, rules: Sequence[Rule], block_share: float = BLOCK_SHARE, steps: int = STEPS,
                  damping: float = DAMPING) -> DataFrame:
    """host, trust, distrust, host_verdict of every host of ``pages`` and of
    their links."""
    parts = with_parts(pages)
    rule = fitting(rules, F.col("host"), F.col("path"), lambda r: r.verdict)
    own = write_table(parts.where("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(rule == "allow").alias("allowed"),
        F.count_if(rule == "block").alias("blocked")), "hosts")
    edges = write_table(host_edges(parts, own.select("host")), "host-edges")
    linked = edges.select(F.col("dst").alias("host")).distinct().join(own.select("host"), "host", "left_anti")
    as_root = fitting(rules, F.col("host"), F.lit("/"), lambda r: r.verdict)
    others = linked.select("host", F.lit(1).cast("long").alias("n"), F.coalesce((as_root == "allow").cast("long"), F.lit(0)).alias("allowed"),
                           F.coalesce((as_root == "block").cast("long"), F.lit(0)).alias("blocked"))
    seeds = own.unionByName(others).select("host", F.inline(F.array(
        F.struct(F.lit(0).alias("kind"), (F.col("allowed") / F.col("n")).alias("seed")),
        F.struct(F.lit(1).alias("kind"), (F.col("blocked") / F.col("n")).alias("seed")))))
    shares = propagate(seeds, checkpointed(arcs(edges)), steps, damping)
    per_host = shares.groupBy("host").agg(F.max(F.when(F.col("kind") == 0, F.col("share"))).alias("trust"),
                                          F.max(F.when(F.col("kind") == 1, F.col("share"))).alias("distrust"))
    bad = (F.col("distrust") >= block_share) & (F.col("distrust") > F.col("trust"))
    return per_host.withColumn("host_verdict", F.when(bad, F.lit("block")).otherwise(F.lit("allow")))


def judge(pages: DataFrame, rules: Sequence[Rule], block_share: float = BLOCK_SHARE, steps: int = STEPS,
          damping: float = DAMPING) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust: a row for every
    row of ``pages`` (page_id, url, html)."""
    hosts = checkpointed(host_verdicts(pages, rules, block_share, steps, damping))
    host, path = F.col("host"), F.col("path")
    ruled = with_parts(pages).select("page_id", "host", "path", fitting(rules, host, path, lambda r: r.host + r.path).alias("rule"),
                                     fitting(rules, host, path, lambda r: r.verdict).alias("ruled"))
    return ruled.join(small(hosts), "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "host_verdict", F.lit("allow")).alias("verdict"), "trust", "distrust")
