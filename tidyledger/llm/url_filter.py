"""URL filter: explicit rules, and for all other pages a path-template tree learned from the pages the rules judge.

Per host the path segments form a tree. Digit runs are written ``#``. A node whose children vary too much (more than
MAX_CHILDREN, or at least MIN_VARIED of which most occur once) has them generalised into the wildcard ``*``; segments
beyond DEPTH are one tail ``**``. Leaves are templates. Siblings whose labelled block rates do not differ
significantly (two-proportion z below Z, taken in order of rate) are merged into one branch. A branch's
purity, the share of allowed labels, is smoothed towards that of its parent, the parent's towards the host's, and the host's
towards that of all labelled pages. Templates of purity below THRESHOLD are rejected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidyledger.llm.runtime import cut, small

#: (verdict, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEPTH = 4
MAX_CHILDREN = 16
MIN_VARIED = 4
Z = 1.96
KAPPA = 4.0
THRESHOLD = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for NULL or a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; NULL where none fits. Of equal rules the first counts."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, on, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == on) | host.endswith(f".{on}")) & path.startswith(start)
        found, verdict = F.when(fits, on + start).otherwise(found), F.when(fits, decision).otherwise(verdict)
    return found, verdict


def _segments(path: Column) -> Column:
    """The path's segments, digit runs as #, at most DEPTH and a tail."""
    full = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/"), lambda s: s != "")
    return F.when(F.size(full) > DEPTH, F.concat(F.slice(full, 1, DEPTH), F.array(F.lit("**")))).otherwise(full)


def _generalised(shapes: DataFrame) -> DataFrame:
    """``shapes`` with ``tree``: the segments with varying ones as wildcards, found level by level from the host."""
    out = shapes.withColumn("tree", F.col("segs"))
    for level in range(DEPTH):
        here = out.filter(F.size("tree") > level).select(
            "host", F.array_join(F.slice("tree", 1, level), "/").alias("parent"), F.get("tree", F.lit(level)).alias("child"), "n"
        )
        children = here.groupBy("host", "parent", "child").agg(F.sum("n").alias("n"))
        varied = children.groupBy("host", "parent").agg(
            F.count(F.lit(1)).alias("kinds"), F.count(F.when(F.col("n") == 1, 1)).alias("once")
        )
        varied = varied.filter(
            (F.col("kinds") > MAX_CHILDREN) | ((F.col("kinds") >= MIN_VARIED) & (F.col("once") * 2 > F.col("kinds")))
        )
        varied = small(cut(varied.select(F.col("host").alias("_host"), F.col("parent").alias("_parent"))))
        parent = F.array_join(F.slice("tree", 1, level), "/")
        met = out.join(varied, (F.col("host") == F.col("_host")) & (parent == F.col("_parent")), "left")
        wild = F.concat(F.slice("tree", 1, level), F.array(F.lit("*")), F.expr(f"slice(tree, {level + 2}, {DEPTH + 1})"))
        out = met.withColumn(
            "tree", F.when(F.col("_host").isNotNull() & (F.size("tree") > level), wild).otherwise(F.col("tree"))
        ).drop("_host", "_parent")
        out = cut(out)
    return out


def _smoothed(blocked: str, labelled: str, prior: str) -> Column:
    """Share of blocked labels, with KAPPA labels' worth of the prior."""
    return (F.col(blocked) + F.lit(KAPPA) * F.col(prior)) / (F.col(labelled) + F.lit(KAPPA))


def templates(shapes: DataFrame) -> DataFrame:
    """(host, segs, template, purity) for every row of (host, segs, n, labelled, blocked)."""
    tree = _generalised(shapes)
    leaf = F.col("tree")
    tree = tree.withColumn("parent", F.array_join(F.slice(leaf, F.lit(1), F.greatest(F.size(leaf) - 1, F.lit(0))), "/"))
    tree = cut(tree.withColumn("template", F.array_join("tree", "/")))
    sums = [F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")]
    leaves = tree.groupBy("host", "parent", "template").agg(*sums)

    # merge siblings: neighbours by rate stay together unless they differ significantly
    rate = (F.col("blocked") + 1) / (F.col("labelled") + 2)
    order = W.partitionBy("host", "parent").orderBy(rate, "template")  # at most MAX_CHILDREN rows and the parent's own
    pooled = (F.col("blocked") + F.col("_b") + 1) / (F.col("labelled") + F.col("_n") + 2)
    gap = (rate - (F.col("_b") + 1) / (F.col("_n") + 2)) / F.sqrt(
        pooled * (1 - pooled) * (F.lit(1.0) / (F.col("labelled") + 2) + F.lit(1.0) / (F.col("_n") + 2))
    )
    merged = (
        leaves.withColumn("_b", F.lag("blocked").over(order)).withColumn("_n", F.lag("labelled").over(order))
        .withColumn("new", F.coalesce((gap > Z).cast("int"), F.lit(0)))
        .withColumn("branch", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
        .select("host", "parent", "template", "branch", "labelled", "blocked")
    )
    merged = cut(merged)
    branches = merged.groupBy("host", "parent", "branch").agg(*sums)
    parents = branches.groupBy("host", "parent").agg(F.sum("labelled").alias("pl"), F.sum("blocked").alias("pb"))
    hosts = parents.groupBy("host").agg(F.sum("pl").alias("hl"), F.sum("pb").alias("hb"))
    total = hosts.agg(F.coalesce(F.sum("hl"), F.lit(0)), F.coalesce(F.sum("hb"), F.lit(0))).first()
    base = (total[1] + 1) / (total[0] + 2)
    known = (
        branches.join(parents, ["host", "parent"]).join(hosts, "host")
        .withColumn("base", F.lit(base))
        .withColumn("p_host", _smoothed("hb", "hl", "base"))
        .withColumn("p_parent", _smoothed("pb", "pl", "p_host"))
        .withColumn("p", _smoothed("blocked", "labelled", "p_parent"))
        .select("host", "parent", "branch", (1 - F.col("p")).alias("purity"))
    )
    of_template = merged.select("host", "parent", "template", "branch").join(known, ["host", "parent", "branch"])
    return tree.select("host", "segs", "template").join(
        of_template.select("host", "template", "purity"), ["host", "template"]
    )


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, template, purity) for every row of ``pages``.

    The verdict is the longest fitting rule's, else ``block`` where the template's purity is below THRESHOLD. A NULL url or
    one without ``://`` has empty host and path and is judged by the template of the empty host. Repeated rows are each
    judged and each count as a label. Without any label the purity is one half and nothing is rejected. An empty table
    gives an empty result. Other columns are not read.
    """
    host, path = host_and_path("_url")
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    rows = rows.select("_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.select("_id", "host", "path", rule.alias("rule"), verdict.alias("_given"), _segments(F.col("path")).alias("segs"))
    shapes = rows.groupBy("host", "segs").agg(
        F.count(F.lit(1)).alias("n"), F.count("_given").alias("labelled"), F.count(F.when(F.col("_given") == "block", 1)).alias("blocked")
    )
    known = templates(cut(shapes)).select(
        F.col("host").alias("_host"), F.array_join("segs", "/").alias("_shape"), "template", "purity"
    )
    known = small(cut(known))
    judged = rows.join(known, (F.col("host") == F.col("_host")) & (F.array_join("segs", "/") == F.col("_shape")), "left")
    learned = F.when(F.col("purity") < THRESHOLD, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("_given", learned).alias("verdict"), "template", "purity"
    )
