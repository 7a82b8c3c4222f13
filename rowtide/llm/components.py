"""Connected components of links, by alternating large and small stars.

Each step re-hangs neighbours on the smallest node they know of; the number of links
never grows, and a star is one row per node. Nothing is gathered: a node with many
links is summed per task and its links are joined by splittable joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowtide.llm.common import join_small, keep


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.selectExpr("v AS u", "u AS v"))
    least = both.groupBy("u").agg(F.expr("least(u, min(v)) AS m"))
    return join_small(both, least, ["u"], "inner").where("v > u").selectExpr("v AS u", "m AS v")


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.expr("min(v) AS m"))
    hung = join_small(edges, least, ["u"], "inner").where("v <> m").selectExpr("v AS u", "m AS v")
    return hung.unionAll(least.selectExpr("u", "m AS v"))


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node that hangs on none."""
    n, nodes = edges.selectExpr("count(*)", "count(DISTINCT u)").first()
    return n == nodes and edges.join(edges.selectExpr("u AS v").distinct(), "v", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """`id`, `component` (the smallest id reachable) for every id that has a link in `links` (`a`, `b`).

    Links may be repeated, in any direction, and of a node with itself; nulls link nothing.
    Ids without links are not listed, except the smallest of a component.
    """
    edges = keep(links.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct())
    while not _is_stars(edges):
        edges = keep(_small_star(keep(_large_star(edges).distinct())).distinct())
    return edges.selectExpr("u AS id", "v AS component").unionAll(edges.selectExpr("v AS id", "v AS component").distinct())
