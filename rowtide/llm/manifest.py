"""A Merkle manifest of a dataset, and proofs by descent through its content-addressed records.

Rows are leaves; those of one group lie in a tree in the order of their ids, and the trees'
roots are the leaves of a last tree. What is stored of a node is one record: its digest and those of
its children. A proof is asked for by group and rank. It starts at the root's
digest and goes down: each base-8 digit of the rank selects a child, whose record is looked up by its
digest, and the other children are a segment of the proof. At the leaf the segments are reversed.
Requests that share the leading digits go down together, so a level of the
descent has a row for each of its nodes that is asked for; the leaves' own rows only meet
their parents' in the last step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from rowtide.llm.common import join_small, keep
from rowtide.llm.ranks import ranked
from rowtide.operators.rows import splittable_join

# Children of a node.
FANOUT = 8

# Records of a level, of some 300 bytes each, that are broadcast at most.
BROADCAST_RECORDS = 20_000

SEGMENT = "struct<before: binary, after: binary>"


def leaf_digest(columns: Sequence[str]) -> str:
    """SQL of the SHA-256 (binary) of a row: each value as `-` for null, else its UTF-8 length, `:` and the value."""
    texts = [f"CAST({c} AS STRING)" for c in columns]
    return f"unhex(sha2(concat({', '.join(f"coalesce(concat(octet_length({t}), ':', {t}), '-')" for t in texts)}), 256))"


def _joined(children: str) -> str:
    return f"array_join(transform({children}, c -> lower(hex(c))), '')"


def _height(n: int) -> int:
    height = 0
    while n > 1:
        n, height = -(-n // FANOUT), height + 1
    return height


def _grown(level: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """Records of each height, and the root of every tree, from nodes `tree`, `at`, `digest`, `n` (nodes of
    that tree in this level). A level's shuffle has a row per node, an eighth of the level below."""
    records, roots = [], level.where("n = 1").selectExpr("tree", "digest")
    for _ in range(height):
        groups = (
            level.where("n > 1")
            .groupBy("tree", F.expr(f"at DIV {FANOUT} AS at"), F.expr(f"(n + {FANOUT - 1}) DIV {FANOUT} AS n"))
            .agg(F.expr("sort_array(collect_list(struct(at, digest))).digest AS children"))  # eight at most
        )
        level = keep(groups.selectExpr("tree", "at", f"unhex(sha2({_joined('children')}, 256)) AS digest", "n", "children"))
        records.append(level.groupBy("digest").agg(F.expr("any_value(children) AS children")))
        roots = roots.unionAll(level.where("n = 1").select("tree", "digest"))
    return records, keep(roots)


@dataclass
class Manifest:
    """`places`: the rows with `tree` and `at` (rank in the tree). `trees`: one row per group: `tree`, the group's
    column, `n`, `height`, `subroot`. `records` and `top_records`: `digest`, `children` by height, from 1 up.
    `root` is null when there are no rows."""

    places: DataFrame
    trees: DataFrame
    records: list[DataFrame]
    top_records: list[DataFrame]
    nodes: list[int]
    root: bytes | None

    def store(self) -> DataFrame:
        """All records: `digest`, `children`."""
        out = self.places.sparkSession.createDataFrame([], "digest binary, children array<binary>")
        for more in [*self.records, *self.top_records]:
            out = out.unionAll(more)
        return out


def build_manifest(leaves: DataFrame, group: str = "lang", key: str = "doc_id") -> Manifest:
    """The manifest of written rows with a column `leaf` (digest). Trees are ordered by `group`, leaves by `key`, nulls first;
    rows that repeat a key in a group are ordered by their digests. Group and key may be hot or null:
    ranks come from a range partitioning by group, key and digest."""
    spark = leaves.sparkSession
    rows = leaves.count()
    placed = keep(ranked(leaves.withColumn("_row", F.monotonically_increasing_id()), [group, key, "leaf", "_row"], "_rank", rows))
    counts = keep(placed.groupBy(group).agg(F.expr("count(*) AS n"), F.expr("min(_rank) AS _first")))
    named = f"coalesce(concat('=', {group}), '') AS _name"
    trees = keep(ranked(counts, [group], "tree").selectExpr("*", named))
    places = join_small(placed.selectExpr("*", named), trees.select("_name", "_first", "tree", "n"), ["_name"], "inner")
    places = keep(places.selectExpr(*[f"`{c}`" for c in leaves.columns], "tree", "_rank - _first AS at", "n"))

    sizes = trees.selectExpr("count(*) AS trees", "coalesce(max(n), 0) AS most").first()
    records, roots = _grown(places.selectExpr("tree", "at", "leaf AS digest", "n"), _height(sizes.most))
    steps = [f"coalesce(sum((n + {FANOUT**h - 1}) DIV {FANOUT**h}), 0)" for h in range(1, len(records) + 1)]
    nodes = list(trees.selectExpr(*steps).first()) if steps else []
    top = roots.selectExpr("0L AS tree", "tree AS at", "digest", f"{sizes.trees}L AS n")
    top_records, last = _grown(top, _height(sizes.trees))
    height = "0" + "".join(f" + IF(n > {FANOUT**h}, 1, 0)" for h in range(len(records)))
    trees = trees.join(roots.withColumnRenamed("digest", "subroot"), "tree").selectExpr(
        "tree", group, "n", f"{height} AS height", "subroot"
    )
    root = last.first()
    return Manifest(places.drop("n"), keep(trees), records, top_records, nodes, None if root is None else bytes(root.digest))


def _children(frontier: DataFrame, records: DataFrame, few: bool) -> DataFrame:
    """The frontier's rows with the children that their digests stand for."""
    if few:
        return frontier.join(F.broadcast(records), "digest")
    return splittable_join(frontier, records, ["digest"], "inner")


def _segment(digit: str) -> str:
    """SQL of a segment: the children before and after the selected one."""
    return (
        f"struct(unhex({_joined(f'slice(children, 1, {digit})')}) AS before, "
        f"unhex({_joined(f'slice(children, {digit} + 2, {FANOUT})')}) AS after)"
    )


def _down(frontier: DataFrame, records: DataFrame, few: bool) -> DataFrame:
    """One level down: every child, with its segment."""
    below = _children(frontier, records, few).selectExpr("tree", "at", "path", "subroot", "children", "posexplode(children) AS (_digit, _child)")
    return below.selectExpr(
        "tree", f"at * {FANOUT} + _digit AS at", "_child AS digest", f"array_append(path, {_segment('_digit')}) AS path", "subroot"
    )


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """`requests` (`tree`, `at` and any other columns) with `leaf`, `subroot` and `path`: the segments
    (`before`, `after`: digests one after another) from the leaf to the root. Requests for places that
    there are none of get no row."""
    spark = requests.sparkSession
    others = [c for c in requests.columns if c not in ("tree", "at")]
    start = spark.range(1 if manifest.root is not None else 0).selectExpr(
        "0L AS tree", "0L AS at", f"unhex('{(manifest.root or b'').hex()}') AS digest", f"CAST(array() AS array<{SEGMENT}>) AS path", "CAST(NULL AS BINARY) AS subroot"
    )
    for records in reversed(manifest.top_records):
        start = _down(start, records, counted_records(records))
    roots = join_small(start.selectExpr("at AS tree", "path"), manifest.trees.select("tree", "height", "subroot"), ["tree"], "inner")
    roots = keep(roots.selectExpr("tree", "0L AS at", "subroot AS digest", "path", "subroot", "height"))

    asked = keep(requests.groupBy("tree", F.expr(f"at DIV {FANOUT} AS at")).agg(
        F.expr(f"collect_list(struct({', '.join(['at AS _at', *[f'`{c}`' for c in others]])})) AS _asked")
    ))
    frontier = None
    for height in range(len(manifest.records), 0, -1):
        here = roots.where(f"height = {height}").drop("height")
        frontier = here if frontier is None else frontier.unionByName(here)
        if height > 1:
            few = manifest.nodes[height - 1] <= BROADCAST_RECORDS
            wanted = asked.selectExpr("tree", f"at DIV {FANOUT ** (height - 2)} AS at").distinct()
            below = _down(frontier, manifest.records[height - 1], few)
            frontier = below.join(F.broadcast(wanted), ["tree", "at"], "left_semi") if few else splittable_join(below, wanted, ["tree", "at"], "left_semi")
    rest = [f"_one.`{c}`" for c in others]
    lone = roots.where("height = 0").join(asked, ["tree", "at"]).selectExpr("tree", "subroot", "path", "inline(_asked)")
    lone = lone.where("_at = 0").selectExpr("tree", "_at AS at", *[f"`{c}`" for c in others], "subroot AS leaf", "subroot", "path")
    if frontier is None:
        return lone
    parents = splittable_join(frontier, asked, ["tree", "at"], "inner")
    last = _children(parents, manifest.records[0], manifest.nodes[0] <= BROADCAST_RECORDS)
    digit = f"CAST(_one._at % {FANOUT} AS INT)"
    leaves = last.selectExpr("tree", "subroot", "path", "children", "explode(_asked) AS _one").where(f"{digit} < size(children)")
    return leaves.selectExpr(
        "tree", "_one._at AS at", *rest, f"children[{digit}] AS leaf", "subroot", f"reverse(array_append(path, {_segment(digit)})) AS path"
    ).unionByName(lone)


def counted_records(records: DataFrame) -> bool:
    return records.limit(BROADCAST_RECORDS + 1).count() <= BROADCAST_RECORDS


def folded(leaf: str, path: str = "path") -> str:
    """SQL of the root (hex) that a leaf's digest and a path lead to."""
    step = "sha2(concat(lower(hex(s.before)), a, lower(hex(s.after))), 256)"
    return f"aggregate({path}, lower(hex({leaf})), (a, s) -> {step})"


def siblings_digest(path: str = "path") -> str:
    """SQL of the SHA-256 (hex) of a path's digests as hex text, one after another."""
    return f"sha2(array_join(transform({path}, s -> concat(lower(hex(s.before)), lower(hex(s.after)))), ''), 256)"


def verify_rows(docs: DataFrame, columns: Sequence[str], claimed: dict[str, str] | None = None, group: str = "lang") -> DataFrame:
    """Per row: `doc_id`, `leaf`, `subroot`, `root`, `path`, `folded_root` and `verified`.

    The manifest is that of `docs` with `columns` as content. `claimed` gives SQL of the values that are
    held against it, for columns that may have changed since; a row is verified when its claimed leaf and the
    siblings of its proof lead to the root. Nulls have a digest of their own. Rows may repeat an id or have none: each is a leaf. Other
    columns are ignored. No rows give no rows.
    """
    claims = [(claimed or {}).get(c, c) for c in columns]
    rows = keep(docs.selectExpr("doc_id", group, f"{leaf_digest(columns)} AS leaf", f"{leaf_digest(claims)} AS _claim"))
    manifest = build_manifest(rows, group)
    proofs = prove(manifest, manifest.places.select("tree", "at", "doc_id", "_claim"))
    root = (manifest.root or b"").hex()
    return proofs.selectExpr(
        "doc_id", "lower(hex(leaf)) AS leaf", "lower(hex(subroot)) AS subroot", f"'{root}' AS root", "path", f"{folded('_claim')} AS folded_root"
    ).selectExpr("*", "folded_root = root AS verified")
