"""URL filter: longest rule first, else trust and distrust over the host graph (native).

A host's seed weights are the shares of its pages that rules allow or block. Trust walks
along links (personalised PageRank from the trusted hosts), distrust against them (from the
blocked ones: who links to a blocked host is suspect). The mass of hosts without links is
not handed out again, so scores do not depend on the number of hosts. A host is blocked
when its distrust exceeds its trust by a threshold.

Rules are a short fixed list inside the plan; the host graph stays in Spark, the iterations
are fixed in number and their lineage is cut by written tables.

Cases: a null url or one without `://` has empty host and path and fits no rule; null html
has no links; links to the own host do not count; repeated pages are judged row by row and
count each; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.columns import ascii_lower
from wattline.session import cut_lineage

# Fixed values: (verdict, host, path) of the contract.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Absolute links; the host is group 1.
LINK = r"(?i)href\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s<>]+)"
DAMPING = 0.85
STEPS = 20
#: With no links at all, a host is blocked if rules block a third of its pages more than they allow.
THRESHOLD = 0.05


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null."""
    chosen = None
    for verdict, at, below in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(below)
        value = F.struct(F.lit(at + below).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    empty = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    return empty if chosen is None else chosen.otherwise(empty)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts; needs host and html."""
    links = F.transform(
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)), ascii_lower
    )
    return (
        pages.select(F.col("host").alias("src"), F.explode(links).alias("dst"))
        .filter((F.col("src") != F.col("dst")) & (F.col("src") != ""))
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _shares(edges: DataFrame, kind: str, start: str, end: str) -> DataFrame:
    """(kind, start, end, share): what each host hands to its neighbours."""
    total = edges.groupBy(start).agg(F.sum("n").alias("all"))
    return edges.join(total, start).select(
        F.lit(kind).alias("kind"),
        F.col(start).alias("start"),
        F.col(end).alias("end"),
        (F.col("n") / F.col("all")).alias("share"),
    )


def propagate(seeds: DataFrame, edges: DataFrame, steps: int = STEPS, damping: float = DAMPING) -> DataFrame:
    """(kind, host, score) from seeds (kind, host, seed) over edges (src, dst, n)."""
    moves = _shares(edges, "trust", "src", "dst").unionByName(_shares(edges, "distrust", "dst", "src"))
    moves = cut_lineage(moves, "host_moves")
    base = cut_lineage(
        seeds.select("kind", "host", ((1 - damping) * F.col("seed")).alias("own")), "host_seeds"
    )
    scores = base.withColumnRenamed("own", "score")
    if moves.isEmpty():
        return scores
    for step in range(1, steps + 1):
        came = (
            scores.withColumnRenamed("host", "start")
            .join(moves, ["kind", "start"])
            .select("kind", F.col("end").alias("host"), (damping * F.col("score") * F.col("share")).alias("score"))
        )
        scores = (
            came.unionByName(base.withColumnRenamed("own", "score"))
            .groupBy("kind", "host")
            .agg(F.sum("score").alias("score"))
        )
        if step % 5 == 0 or step == steps:
            scores = cut_lineage(scores, f"host_scores_{step}")
    return scores


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = tuple(RULES),
    threshold: float = THRESHOLD,
    steps: int = STEPS,
    id_col: str = "page_id",
) -> DataFrame:
    """Per page: page_id, host, path, rule (null if none fits) and verdict, allow or block."""
    url = F.col("url")
    parsed = pages.select(
        F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), "html"
    )
    ruled = parsed.withColumn("by", longest_rule(F.col("host"), F.col("path"), rules))
    weights = (
        ruled.groupBy("host")
        .agg(
            F.avg((F.coalesce("by.verdict", F.lit("")) == "allow").cast("double")).alias("trust"),
            F.avg((F.coalesce("by.verdict", F.lit("")) == "block").cast("double")).alias("distrust"),
        )
        .select(
            "host",
            F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "seed"),
        )
    )
    scores = propagate(weights, cut_lineage(host_edges(ruled), "host_edges"), steps)
    blocked = (
        scores.groupBy("host")
        .agg(F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(-F.col("score"))).alias("excess"))
        .filter(F.col("excess") > threshold)
        .select("host", F.lit("block").alias("host_verdict"))
    )
    return (
        ruled.select("page_id", "host", "path", "by")
        .join(cut_lineage(blocked, "blocked_hosts"), "host", "left")
        .select(
            "page_id",
            "host",
            "path",
            F.col("by.rule").alias("rule"),
            F.coalesce("by.verdict", "host_verdict", F.lit("allow")).alias("verdict"),
        )
    )
