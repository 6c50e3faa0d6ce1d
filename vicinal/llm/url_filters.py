"""Verdicts on page addresses: host and path rules, and trust that spreads over links between hosts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinal.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Share of a score that flows over links in each round, and the part of a kind's score that may still be on its way.
DAMPING, TOLERANCE = 0.85, 1e-4
#: A host is blocked when distrust makes up more than this share of its trust and distrust.
BLOCK_SHARE = 0.5

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters in lower case; else empty."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(F.when(at > 0, host), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.coalesce(F.when(at > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting ``(host, path, verdict)`` as a struct of ``rule`` and ``verdict``; null if none fits.

    A rule fits its host and all subdomains, if the path starts with the rule's. Rules are few and
    part of the plan; of two equally long ones the first in text order wins.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value).otherwise(found)
    return found


def host_links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``(src, dst, n)``: links from pages of one host to another host, counted.

    Links without a host stay on their own and are left out, as are links of pages without a host.
    """
    links = pages.select(
        host_of(F.col(url_col)).alias("src"),
        F.explode(F.regexp_extract_all(F.col(html_col), F.lit("(?i)href\\s*=\\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\"'\\s>]*)"), 1)).alias("url"),
    )
    full = F.when(F.col("url").startswith("//"), F.concat(F.lit("x:"), F.col("url"))).otherwise(F.col("url"))
    ends = links.select("src", host_of(full).alias("dst")).filter("src <> '' AND dst <> '' AND src <> dst")
    return ends.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank per ``kind``: ``(kind, host, score)``.

    ``edges`` has ``(kind, src, dst, share)`` with shares of a source summing to 1, ``seeds`` has
    ``(kind, host, seed)``. A host without links keeps no score beyond what reaches it. Every host that a
    seed reaches has a row, however long the way.

    Each round moves on what arrived in the last one, and is a stored table, so lineage does not grow. The rounds end when all that
    is still on its way is at most ``tolerance`` of a kind's score of 1 and the last round reached no new host.
    """
    first = seeds.groupBy("kind", "host").agg(F.sum(F.col("seed") * (1 - damping)).alias("score"))
    state = stored(first.select("kind", "host", "score", F.col("score").alias("moved")), "trust")
    ways, known = edges.withColumnRenamed("src", "host"), state.count()
    while known:
        flown = state.filter("moved > 0").join(ways, ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"), (F.col("moved") * F.col("share") * damping).alias("score")
        )
        both = state.select("kind", "host", "score", F.lit(0.0).alias("moved")).unionByName(flown.withColumn("moved", F.col("score")))
        state = stored(both.groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("moved").alias("moved")), "trust")
        # What has moved in a round moves on with this factor in all later ones together.
        left = state.groupBy("kind").agg(F.sum("moved").alias("moved"), F.count(F.lit(1)).alias("n"))
        moved, now = left.agg(F.max("moved"), F.sum("n")).first()
        if now == known and moved * damping / (1 - damping) <= tolerance:
            break
        known = now
    return state.select("kind", "host", "score")


def judge_urls(
    pages: DataFrame, id_col: str, url_col: str, html_col: str, rules: Sequence[Rule], block_share: float = BLOCK_SHARE,
    damping: float = DAMPING, tolerance: float = TOLERANCE,
) -> DataFrame:
    """``(id, host, path, rule, verdict, trust, distrust)`` of every page.

    A page that a rule fits gets the rule's verdict. Hosts of allowed pages seed trust, which follows
    links; hosts of blocked pages seed distrust, which goes to hosts that link to them. Any other page is
    blocked if distrust is more than ``block_share`` of its host's trust and distrust; a host that
    neither reaches is allowed. Scores go over links until all but ``tolerance`` has arrived. Null urls have an empty host and path. Repeated rows stay, an empty
    table gives an empty result, and other columns are not read.
    """
    own = pages.select(F.col(id_col).alias("_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    found = own.withColumn("_found", rule_for(F.col("host"), F.col("path"), rules))
    judged = stored(found.select("_id", "host", "path", F.col("_found.rule").alias("rule"), F.col("_found.verdict").alias("_ruled")), "pages")

    marks = judged.filter("host <> ''").groupBy("host").agg(
        F.count_if(F.col("_ruled") == "allow").alias("trust"), F.count_if(F.col("_ruled") == "block").alias("distrust")
    )
    total = judged.filter("host <> ''").agg(
        F.count_if(F.col("_ruled") == "allow").alias("trust"), F.count_if(F.col("_ruled") == "block").alias("distrust")
    ).first()
    seeds = marks.select(
        "host", F.explode(F.map_from_arrays(F.array(F.lit("trust"), F.lit("distrust")), F.array("trust", "distrust"))).alias("kind", "n")
    ).filter("n > 0")
    size = F.when(F.col("kind") == "trust", F.lit(max(1, total["trust"]))).otherwise(F.lit(max(1, total["distrust"])))
    seeds = stored(seeds.select("kind", "host", (F.col("n") / size).alias("seed")), "seeds")

    links = stored(host_links(pages, url_col, html_col), "links")
    ways = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    )
    out = ways.groupBy("kind", "src").agg(F.sum("n").alias("_out"))
    edges = stored(ways.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("_out")).alias("share")), "edges")

    scores = spread(edges, seeds, damping, tolerance)
    hosts = scores.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"),
    )
    joined = judged.join(hosts, "host", "left")
    by_host = F.col("distrust") > block_share * (F.col("trust") + F.col("distrust"))
    verdict = F.coalesce(F.col("_ruled"), F.when(by_host, F.lit("block")).otherwise(F.lit("allow")))
    return joined.select(
        F.col("_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
