"""URL filter: fixed rules first, then trust and distrust that spread over links between hosts.

Trust is personalised PageRank from hosts whose pages the rules allow; distrust
runs the same way over reversed links from hosts whose pages they block, so a
host that links to blocked hosts is distrusted. Both are computed as
``y = seeds + damping * P y``, which is PageRank up to its sum, with the mass of
hosts without links going back to the seeds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetree.staging import stage

DAMPING = 0.85
ROUNDS = 20
# Blocked where distrust has more than this share of a host's trust and distrust.
BLOCK_SHARE = 2 / 3
_ROUNDS_PER_STAGE = 5
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """``host/path`` with its verdict; it fits the host, all subdomains and all paths that begin like its own."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        host, slash, path = self.text.partition("/")
        return slash + path


def _lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased. Empty for other urls."""
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From after the host up to ``?``, ``#`` or the end. Empty for other urls."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Text of the longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is asked first
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        out = F.when(fits, F.lit(rule.text)).otherwise(out)
    return out


def host_links(pages: DataFrame) -> DataFrame:
    """``(src, dst, n)``: links between different hosts. ``pages`` has ``host`` and ``html``."""
    found = pages.select("host", F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), 1)).alias("href"))
    href = F.when(F.col("href").startswith("//"), F.concat(F.lit("http:"), "href")).otherwise(F.col("href"))
    return (
        found.select(F.col("host").alias("src"), host_of(href).alias("dst"))
        .filter("dst != '' and src != '' and src != dst")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``(host, trust, distrust)`` for hosts that any trust or distrust reaches.

    ``seeds`` has ``host, trust, distrust``, each of which adds up to one or to zero. Only
    sums per host move; the ranks are written to the shared folder every few rounds.
    """
    out = links.groupBy("src").agg(F.sum("n").alias("out"))
    into = links.groupBy("dst").agg(F.sum("n").alias("into"))
    edges = stage(
        links.join(out, "src").join(into, "dst").select("src", "dst", (F.col("n") / F.col("out")).alias("forth"), (F.col("n") / F.col("into")).alias("back")),
        "host-links",
    )
    seeds = stage(seeds, "seeds")
    ranks = seeds
    if edges.isEmpty():
        return ranks
    for i in range(rounds):
        forth = edges.join(ranks, edges["src"] == ranks["host"]).select(
            F.col("dst").alias("host"), (F.col("trust") * F.col("forth") * damping).alias("trust"), F.lit(0.0).alias("distrust")
        )
        back = edges.join(ranks, edges["dst"] == ranks["host"]).select(
            F.col("src").alias("host"), F.lit(0.0).alias("trust"), (F.col("distrust") * F.col("back") * damping).alias("distrust")
        )
        moved = seeds.unionByName(forth).unionByName(back)
        ranks = moved.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if i % _ROUNDS_PER_STAGE == _ROUNDS_PER_STAGE - 1 or i == rounds - 1:
            ranks = stage(ranks, "ranks")
    return ranks


def judge(pages: DataFrame, rules: Sequence[Rule], damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, distrust)`` for every row of ``pages``.

    A url without ``://``, or null, has an empty host and path. Pages that a
    rule fits have the rule's verdict. Any other page is blocked where
    distrust makes up more than ``BLOCK_SHARE`` of its host's trust and distrust, each as
    a share of its sum over all hosts, and allowed otherwise, so also where
    neither reaches the host. Repeated rows come out repeatedly; a null html has no links.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    parsed = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for rule in rules:
        verdict = F.when(F.col("rule") == rule.text, F.lit(rule.verdict)).otherwise(verdict)
    parsed = parsed.withColumn("ruled", verdict)
    counts = parsed.filter("host != ''").groupBy("host").agg(
        F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked")
    )
    counts = stage(counts.filter("allowed + blocked > 0"), "seed-counts")
    allowed, blocked = counts.agg(F.sum("allowed"), F.sum("blocked")).first()
    seeds = counts.select(
        "host", (F.col("allowed") / float(allowed or 1)).alias("trust"), (F.col("blocked") / float(blocked or 1)).alias("distrust")
    )
    ranks = propagate(host_links(parsed.select("host", "html")), seeds, damping, rounds)
    trusted, distrusted = ranks.agg(F.sum("trust"), F.sum("distrust")).first()
    ranks = ranks.select(
        "host", (F.col("trust") / (trusted or 1.0)).alias("trust"), (F.col("distrust") / (distrusted or 1.0)).alias("distrust")
    )
    judged = parsed.drop("html").join(ranks, "host", "left").fillna(0.0, ["trust", "distrust"])
    share = F.col("distrust") / F.greatest(F.col("trust") + F.col("distrust"), F.lit(1e-300))
    method = F.when(share > BLOCK_SHARE, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust"
    )
