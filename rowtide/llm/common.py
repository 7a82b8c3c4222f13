"""What the operators share: tables, the shared folder, joins by checked size."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from rowtide.operators.rows import splittable_join

# At most this many rows of one side, of a few dozen bytes each, are broadcast.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder name under `spark.checkpoint.dir`, which driver and executors share.

    Only a local session without that setting uses its warehouse.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/llm-{context.applicationId}/{uuid.uuid4().hex}"


def keep(df: DataFrame, kind: str = "parquet") -> DataFrame:
    """Write a table to the shared folder and read it back: it is computed once, and its lineage ends there."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    df.write.format(kind).save(folder)
    return spark.read.schema(df.schema).format(kind).load(folder)


def counted(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether the table has at most `most` rows."""
    return df.limit(most + 1).count() <= most


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """Equi-join that broadcasts `right` when it is counted to be small, and else may split hot keys."""
    if counted(right, most):
        return left.join(F.broadcast(right), on, how)
    return splittable_join(left, right, on, how)


def without(df: DataFrame, *names: str) -> DataFrame:
    """The table without columns that would clash with an operator's own."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until the table has no such columns."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def parts_for(rows: int, each: int) -> int:
    """A power of two of parts with about `each` rows."""
    parts = 1
    while parts * each < rows:
        parts *= 2
    return parts


def labelled_texts(docs: DataFrame, chosen: DataFrame, text_chars: int, all_chars: int, within: str | None = None) -> list[Row]:
    """`_y`, `_h`, `text` of the chosen rows (`doc_id`, `_y`, `_h`: few), in the order of `_h`, as many as have `all_chars` characters together
    (for each value of `within`). One row per id; of a longer text, a passage of `text_chars`, at a place by its hash.

    Bounds hold before anything is collected.
    """
    begin = f"1 + pmod(xxhash64(text), length(text) - {text_chars})"
    passage = f"IF(length(text) > {text_chars}, substring(text, CAST({begin} AS INT), {text_chars}), coalesce(text, ''))"
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = keep(met.groupBy("doc_id", "_y", "_h").agg(F.expr(f"min_by({passage}, xxhash64(text)) AS text")))
    order = "ORDER BY _h, doc_id, _y ROWS UNBOUNDED PRECEDING"
    sums = one.selectExpr("doc_id", "_y", f"sum(length(text)) OVER ({f'PARTITION BY {within}' if within else ''} {order}) AS _sum")
    taken = sums.where(f"_sum <= {all_chars}").drop("_sum")
    rows = one.join(F.broadcast(taken), ["doc_id", "_y"], "left_semi").select("_y", "_h", "text").collect()
    return sorted(rows, key=lambda r: (r._h, r.text))
