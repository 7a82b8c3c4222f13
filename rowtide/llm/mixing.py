"""Mixing sources to target weights: whole epochs first, then a weighted sample without replacement.

Every document gets the key E / w, where E is exponential (from a hash of its id) and
w its quality weight; the documents with the smallest keys of a source are its
weighted sample, whatever its length. Running sums of sizes in the order of the keys
are made in two steps: sums per slice of the keys first, then, only in the one slice
of a source where the budget ends, over single documents. Slices lie between approximate quantiles of a source's keys,
so they are even for any weights, and a source with a third of all rows is never sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from rowtide.llm.common import join_small, keep

# Rows for each slice of the keys, and most slices. The slice of a source where its budget ends is sorted by one task,
# and so are the sums of its slices.
SLICE_ROWS = 1024
MOST_SLICES = 1 << 16

# Quantiles of a source's keys; slices between two of them are of equal width.
CUTS = 64

WORDS = r"regexp_count(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

# Symbols that carry no text: the more of them a document has for each word, the smaller its weight.
SYMBOLS = r"regexp_count(coalesce(text, ''), '[#$%&*|!<>=_~^]')"


def uniform(doc_id: str, seed: int) -> str:
    """SQL of a number in (0, 1) that depends on the id and the seed alone."""
    text = f"concat('{seed}:', coalesce(CAST({doc_id} AS STRING), 'null'))"
    return f"((CAST(conv(substr(md5({text}), 1, 13), 16, 10) AS DOUBLE) + 0.5D) / 4503599627370496D)"


def targets(sizes: DataFrame, weights: Sequence[int], total_share: float, most: float) -> DataFrame:
    """`_source`, `source_size`, `target` from `_source`, `source`, `source_size` (one row per source).

    The total is shared by weight; a source takes `most` times its size at most,
    and what is above is shared again until nothing is. That is one water level:
    sources in the order of size over weight are full as long as the level that the
    sources before them leave covers them. Only the list of sources is sorted.
    """
    by_name = Window.orderBy(F.expr("source IS NULL"), "source")
    case = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    weighed = sizes.withColumn("_rank", F.row_number().over(by_name)).selectExpr(
        "_source", "source_size", f"CASE (_rank - 1) % {len(weights)} {case} END AS _w", "_rank"
    )
    before = "OVER (ORDER BY source_size / _w, _rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    level = weighed.selectExpr(
        "*",
        f"{total_share}D * sum(source_size) OVER () AS _total",
        "sum(_w) OVER () AS _weights",
        f"coalesce(sum(source_size) {before}, 0) AS _full",
        f"coalesce(sum(_w) {before}, 0) AS _spent",
    ).selectExpr("*", f"{most}D * source_size * (_weights - _spent) <= (_total - {most}D * _full) * _w AS _is_full")
    return level.selectExpr(
        "*",
        "sum(IF(_is_full, source_size, 0)) OVER () AS _sum_full",
        "sum(IF(_is_full, 0, _w)) OVER () AS _sum_left",
    ).selectExpr(
        "_source",
        "source_size",
        f"IF(_is_full, {most}D * source_size, _w * (_total - {most}D * _sum_full) / _sum_left) AS target",
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    total_share: float = 1.5,
    most: float = 2.0,
    quality: str | None = None,
    seed: int = 0,
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `size`, `source_size`, `target`, `taken`, and `epochs`, `key`.

    The size is the number of words (0 for null). `weights` repeat over the sources
    by code point, a null source last. `quality` is SQL over the columns of `docs`
    for a positive weight; without it, the share of words among words and symbols.
    Of a source's target, whole epochs are taken first, and the rest from the
    documents with the smallest keys; the last one is taken if that comes nearer to
    the target. Equal keys (repeated rows) are ordered by id and size. Sources
    without words have the target 0. The result depends on rows and seed only.
    """
    marks = _marks(quality, seed)
    names = ["_source", "size", "key"]
    thin = keep(docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "source", *(f"{m} AS {n}" for m, n in zip(marks, names))))
    plan = _plan(thin, weights, total_share, most)
    each = join_small(thin, plan, ["_source"], "inner").selectExpr("*", f"{_SLICE} AS _slice")
    return _chosen(each, ["key", "doc_id", "size"]).selectExpr(
        "doc_id", "size", "source_size", "target", "size * (epochs + IF(_chosen, 1, 0)) AS taken", "epochs + IF(_chosen, 1, 0) AS epochs", "key"
    )


# What a document draws its number by: the id, or else its source and text, so that rows without an id differ.
_DRAWN_BY = "coalesce(CAST(doc_id AS STRING), concat_ws(':', 'null', md5(coalesce(concat('s', source), 'n')), coalesce(md5(text), 'null')))"


def _marks(quality: str | None, seed: int) -> tuple[str, str, str]:
    """SQL of a document's source, size and key."""
    weight = quality or f"(({WORDS} + 1D) / ({WORDS} + {SYMBOLS} + 1D))"
    return "coalesce(concat('s', source), 'n')", f"CAST({WORDS} AS BIGINT)", f"-ln({uniform(_DRAWN_BY, seed)}) / ({weight})"


# The slice of a key by its source's `_cuts` (ascending) and `_slices`: the cut it lies behind, and its share of the way to the next one.
_SLICE = (
    "transform(array(greatest(size(filter(_cuts, c -> c <= key)), 1)), i -> CAST((i - 1) * (_slices DIV " + str(CUTS) + ") + "
    "least(greatest(coalesce((key - _cuts[i - 1]) / nullif(get(_cuts, i) - _cuts[i - 1], 0D), 0D), 0D), 1D) * (_slices DIV " + str(CUTS) + " - 1) AS INT))[0]"
)


def _cuts(thin: DataFrame) -> DataFrame:
    """Least, quantile and greatest keys of each source, written: they only say how the work is divided."""
    slices = max(CUTS, min(MOST_SLICES, thin.count() // SLICE_ROWS // CUTS * CUTS))
    shares = ", ".join(f"{i / CUTS}D" for i in range(1, CUTS))
    cuts = f"concat(array(min(key)), percentile_approx(key, array({shares}), 10000), array(max(key))) AS _cuts"
    return keep(thin.groupBy("_source").agg(F.expr(cuts)).selectExpr("_source", "_cuts", f"{slices} AS _slices"))


def _plan(thin: DataFrame, weights: Sequence[int], total_share: float, most: float) -> DataFrame:
    """For each source its cuts, its epochs and the slice in which its budget ends."""
    cuts = _cuts(thin)
    thin = join_small(thin, cuts, ["_source"], "inner").selectExpr("_source", "source", "size", f"{_SLICE} AS _slice")
    sizes = thin.groupBy("_source").agg(F.expr("any_value(source) AS source"), F.expr("sum(size) AS source_size"))
    shares = targets(sizes, weights, total_share, most).selectExpr(
        "*", "IF(source_size = 0, 0L, CAST(floor(target / source_size) AS BIGINT)) AS epochs"
    ).selectExpr("*", "target - epochs * source_size AS _rest")
    running = (
        thin.groupBy("_source", "_slice")
        .agg(F.expr("sum(size) AS _size"))
        .selectExpr("*", "sum(_size) OVER (PARTITION BY _source ORDER BY _slice) - _size AS _before")
    )
    ends = (
        running.join(shares.select("_source", "_rest"), "_source")
        .where("_before < _rest AND _rest <= _before + _size")
        .selectExpr("_source", "_slice AS _end", "_before")
    )
    return keep(
        shares.join(ends, "_source", "left").join(cuts, "_source").selectExpr(
            # without an end: all slices when something is left to fill, none otherwise
            "_source", "source_size", "target", "epochs", "_rest", "coalesce(_end, IF(_rest > 0, 2 * _slices, -1)) AS _end", "_before", "_cuts", "_slices"
        )
    )


def _chosen(each: DataFrame, order: list[str]) -> DataFrame:
    """`each` with `_chosen`: whether a row is taken once more than the whole epochs; only the slices of the ends are sorted."""
    upto = Window.partitionBy("_source", "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    at_end = (
        each.where("_slice = _end")
        .withColumn("_upto", F.sum("size").over(upto))
        .selectExpr("*", "_before + _upto - size / 2D <= _rest AS _chosen")
        .drop("_upto")
    )
    return each.where("_slice <> _end").selectExpr("*", "_slice < _end AS _chosen").unionByName(at_end)


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    total_share: float = 1.5,
    most: float = 2.0,
    quality: str | None = None,
    seed: int = 0,
) -> DataFrame:
    """The rows of `docs`, each as often as a mix takes it.

    The mix is that of `mix`, but every row is counted and taken by itself, whatever others share its id; equal keys of an id are
    ordered by text. No rows give no rows.
    """
    marks = _marks(quality, seed)
    keyed = docs.selectExpr("struct(*) AS _row", *(f"{m} AS {n}" for m, n in zip(marks, ["_source", "size", "key"])))
    thin = keep(keyed.selectExpr("_row.source AS source", "_source", "size", "key"))
    plan = _plan(thin, weights, total_share, most)
    each = join_small(keyed, plan, ["_source"], "inner").selectExpr("*", f"{_SLICE} AS _slice", "md5(_row.text) AS _tie")
    return (
        _chosen(each, ["key", "_row.doc_id", "size", "_tie"])
        .selectExpr("_row", "epochs + IF(_chosen, 1, 0) AS _epochs")
        .where("_epochs > 0")
        .selectExpr("_row", "explode(sequence(1L, _epochs)) AS _copy")
        .select("_row.*")
    )
