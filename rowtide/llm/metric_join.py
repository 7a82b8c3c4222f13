"""Near-duplicate vectors by an exact range join in metric space.

Unit vectors at a cosine of c lie sqrt(2 - 2 c) apart, so a cosine bound is a radius. Pivots
of each label and length part its vectors into cells, every vector being at home in the cell of its nearest
pivot. If two vectors are within the radius, the triangle inequality (here that of the distance
to the plane between two pivots, which is never more than that of the vectors) lets the
one be outside the other's cell by the radius at most; so vectors near a boundary
are replicated to the cells behind it. Cells then join on their own, in blocks of
bounded size, which give numbers of links and stars of what is connected, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowtide.llm.common import join_small, keep
from rowtide.llm.components import components
from rowtide.operators.rows import splittable_join

# Vectors for each pivot of a label; cells get larger where all pivots, which every task holds, would be more than that.
CELL_VECTORS = 1024
MOST_PIVOTS = 16384

# A block of a cell has about so many vectors; two blocks meet in a task.
BLOCK_VECTORS = 2048

# Numbers in a matrix of vectors and pivots at a time.
DEALT_CELLS = 1 << 21

# Distances are rounded numbers: bounds are widened by this much.
SLACK = 1e-6


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pivots(vectors: DataFrame, cell_vectors: int) -> dict:
    """Pivots of each label and length with several cells: one for every `cell_vectors` vectors, those with the smallest hashes."""
    counts = vectors.groupBy("label", "width").agg(F.expr("count(*) AS n"))
    wanted = keep(counts.selectExpr("label", "width", f"CAST(ceil(n / {cell_vectors}) AS INT) AS k", "n").where("k > 1"))
    # An expected four times the number is drawn before the smallest hashes are taken.
    drawn = join_small(vectors, wanted, ["label", "width"], "inner").selectExpr("label", "width", "rep", "embedding", "k", "n", "xxhash64(rep) AS h")
    near = drawn.where("pmod(h, n) < 4 * k + 8")
    ranked = near.selectExpr("*", "row_number() OVER (PARTITION BY label, width ORDER BY pmod(h, n), h, rep) AS r").where("r <= k")
    found: dict = {}
    for row in ranked.select("label", "width", "r", "embedding").collect():
        found.setdefault((row.label, row.width), []).append((row.r, row.embedding))
    return {key: _unit([e for _, e in sorted(held)]) for key, held in found.items()}


def _cells_of(vectors: np.ndarray, held: np.ndarray, radius: float) -> Iterator[list[int]]:
    """Home cell and cells that each vector is replicated to, from matrices of `DEALT_CELLS` numbers at most."""
    step = max(1, DEALT_CELLS // len(held))
    for start in range(0, len(vectors), step):
        some = vectors[start : start + step]
        square = 2 - 2 * some @ held.T
        home = square.argmin(axis=1)
        least = square[np.arange(len(some)), home][:, None]
        apart = np.sqrt(np.maximum(2 - 2 * held[home] @ held.T, 0))
        near = square - least <= 2 * (radius + SLACK) * apart + SLACK
        near[np.arange(len(some)), home] = True
        for h, row in zip(home, near):
            yield [int(h), *(int(c) for c in np.flatnonzero(row) if c != h)]


def _deal(pivots, radius: float):
    """For each vector its home cell, and the cells that it is replicated to."""

    def deal(labels: pa.Array, embeddings: pa.Array) -> pa.Array:
        rows = embeddings.to_pylist()
        keys = list(zip(labels.to_pylist(), map(len, rows)))
        cells: list = [None] * len(rows)
        members: dict = {}
        for i, key in enumerate(keys):
            members.setdefault(key, []).append(i)
        for one, mine in members.items():
            held = pivots.value.get(one)
            if held is None:
                for i in mine:
                    cells[i] = [0]
                continue
            for i, own in zip(mine, _cells_of(_unit([rows[i] for i in mine]), held, radius)):
                cells[i] = own
        return pa.array(cells, pa.list_(pa.int32()))

    return F.arrow_udf(deal, "array<int>")


STARS = "rep long, n long, top long"


def _join(cosine: float):
    def join(group: pd.DataFrame) -> pd.DataFrame:
        """Of a home block and a member block: links of each home vector, and the smallest vector it is connected to."""
        home, other = group[group["is_home"]], group[~group["is_home"]]
        nothing = pd.DataFrame({"rep": [], "n": [], "top": []}).astype("int64")
        if not len(home) or not len(other):
            return nothing
        a, b = _unit(home["embedding"].tolist()), _unit(other["embedding"].tolist())
        ids, others, copies = home["rep"].to_numpy(), other["rep"].to_numpy(), other["copies"].to_numpy()
        close = (a @ b.T >= cosine) & (ids[:, None] != others[None, :])
        n = close @ copies.astype(np.float64)
        if not close.any():
            return nothing
        # Labels of both sides sink to the smallest id that they are connected to within the blocks.
        top, low = ids.copy(), others.copy()
        most = np.iinfo(np.int64).max
        while True:
            new_low = np.minimum(low, np.where(close, top[:, None], most).min(axis=0))
            new_top = np.minimum(top, np.where(close, new_low[None, :], most).min(axis=1))
            if (new_low == low).all() and (new_top == top).all():
                break
            top, low = new_top, new_low
        seen, reached = close.any(axis=1), close.any(axis=0)
        return pd.DataFrame(
            {
                "rep": np.concatenate([ids[seen], others[reached]]),
                "n": np.concatenate([n[seen].astype(np.int64), np.zeros(reached.sum(), dtype=np.int64)]),
                "top": np.concatenate([top[seen], low[reached]]),
            }
        )

    return join


def near_vectors(table: DataFrame, cosine: float = 0.93, cell_vectors: int = CELL_VECTORS) -> DataFrame:
    """One row per row of `table` (`vec_id`, `embedding`, `label`): `vec_id`, `n_links`, `component_id`, `kept`.

    Vectors of one label and one length are linked when their cosine in double precision is `cosine` or more. Null,
    empty and zero vectors, those with null, infinite or NaN components and those without a label or an id
    link with nothing. Equal vectors of a label
    are one vector with copies, linked with each other, and move once. Rows that share an id count as copies, too;
    a link of a row with one of its own id counts. Without any link a vector is its own component.
    """
    rows = table.selectExpr(
        "CAST(vec_id AS BIGINT) AS vec_id",
        "label",
        "embedding IS NOT NULL AND size(embedding) > 0 AND label IS NOT NULL AND vec_id IS NOT NULL"
        " AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
        " AND exists(embedding, x -> x <> 0) AS _valid",
        "embedding",
    )
    valid = rows.where("_valid")
    # Equal vectors are one, with its smallest id and the number of its copies.
    grouped = valid.groupBy("label", "embedding").agg(F.expr("min(vec_id) AS rep"), F.expr("count(*) AS copies"))
    vectors = keep(grouped.selectExpr("label", "size(embedding) AS width", "embedding", "rep", "copies"))
    n = vectors.count()
    radius = float(np.sqrt(2 - 2 * cosine))
    pivots = table.sparkSession.sparkContext.broadcast(_pivots(vectors, max(cell_vectors, n // MOST_PIVOTS)))
    dealt = keep(vectors.withColumn("cells", _deal(pivots, radius)("label", "embedding")))
    sizes = keep(
        dealt.selectExpr("label", "width", "posexplode(cells) AS (_at, cell)")
        .groupBy("label", "width", "cell")
        .agg(F.expr(f"ceil(count_if(_at = 0) / {BLOCK_VECTORS}) AS homes"), F.expr(f"ceil(count(*) / {BLOCK_VECTORS}) AS others"))
    )
    placed = join_small(
        dealt.selectExpr("label", "width", "rep", "copies", "embedding", "posexplode(cells) AS (_at, cell)"), sizes, ["label", "width", "cell"], "inner"
    ).where("homes > 0")
    # A home vector meets every member block of its cell, a member every home block.
    block = "CAST(pmod(xxhash64(rep, {}), {}) AS INT)"
    whole = ["label", "width", "cell", "rep", "copies", "embedding"]
    home = placed.where("_at = 0").selectExpr(
        *whole, "TRUE AS is_home", f"{block.format(1, 'homes')} AS i", "explode(sequence(0, CAST(others AS INT) - 1)) AS j"
    )
    other = placed.selectExpr(
        *whole, "FALSE AS is_home", "explode(sequence(0, CAST(homes AS INT) - 1)) AS i", f"{block.format(2, 'others')} AS j"
    )
    tasks = max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // BLOCK_VECTORS)
    met = keep(
        home.unionByName(other)
        .repartition(tasks, "label", "width", "cell", "i", "j")
        .groupBy("label", "width", "cell", "i", "j")
        .applyInPandas(_join(cosine), STARS)
    )
    counted = met.groupBy("rep").agg(F.expr("sum(n) AS n"))
    groups = keep(components(met.selectExpr("rep AS a", "top AS b")))
    marks = vectors.selectExpr("label", "embedding", "rep", "copies")
    marks = join_small(marks, keep(counted), ["rep"], "left")
    marks = join_small(marks, groups.withColumnRenamed("id", "rep"), ["rep"], "left").selectExpr(
        "label", "embedding", "coalesce(n, 0) + copies - 1 AS n_links", "coalesce(component, rep) AS component"
    )
    joined = splittable_join(rows.select("vec_id", "label", "embedding"), marks, ["label", "embedding"], "left")
    component = "IF(vec_id IS NULL, NULL, coalesce(component, vec_id))"
    links = "IF(vec_id IS NULL, 0L, coalesce(n_links, 0L))"
    return joined.selectExpr("vec_id", f"{links} AS n_links", f"{component} AS component_id", f"vec_id <=> {component} AS kept")
