"""Near-duplicates by one-permutation MinHash, banded buckets and stars.

One hash of every shingle gives the bin and the value, so a text is hashed once for all
bins; an empty bin borrows from the first filled bin of its own random order. Bands of
bins are bucket keys; buckets that repeat the members of another one are left out. Each bucket is first a star: its smallest
member, the hub, meets the others. Links are confirmed on the full sets of shingles. As only the components
of the links matter, a bucket whose members are connected then is done.

The others hold unlike documents as a rule. A bucket of a bounded size is solved by one task: members that an outline of the sets
doesn't rule out as partners of another component come with their sets, and their pairs are confirmed until those that
remain are connected; the links that did it are the result. Larger buckets go on in rounds of more
hubs, which meet the members of other components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from rowtide.llm.common import join_small, keep
from rowtide.llm.components import components
from rowtide.model import quoted
from rowtide.operators.rows import splittable_join

# Two sets with a similarity of 0.8 share a band with probability 1 - (1 - 0.8 ** 6) ** 40, short of 1 by 6e-6; two with 0.6, by 0.15.
BANDS, BAND_BINS = 40, 6
BINS = BANDS * BAND_BINS

# A bucket of so many members, with so many shingles in all, is solved by one task.
GROUP_MEMBERS, GROUP_SHINGLES = 4096, 1 << 21

# Keys of shared buckets, of eight bytes, that are broadcast at most.
BROADCAST_BUCKETS = 2_000_000

# Bits of the outline of a set: what differs in the outlines differs in the sets.
OUTLINE_WORDS = 16

FEATURES = "struct<n: bigint, set_key: binary, bands: array<bigint>, outline: array<bigint>>"


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles. ASCII letters count as lower case, and
    ASCII white space parts words. Fewer words than `words` are one shingle; no words, none."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), dtype=np.uint64, count=len(parts))
    width = min(words, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            out = (out ^ h[k : len(h) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(out ^ (out >> np.uint64(31)))


@lru_cache(maxsize=1)
def _donors() -> np.ndarray:
    """For each bin, the order in which it asks the others when it is empty: the same for every text."""
    draw = np.random.Generator(np.random.PCG64(7))
    return np.stack([draw.permutation(BINS) for _ in range(BINS)])


def signature(hashes: np.ndarray) -> np.ndarray:
    """One permutation: the least hash of each bin; empty bins are filled by optimal densification."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)  # hashes are sorted, so bins are too
    filled, first = np.unique(bins.astype(np.int64), return_index=True)
    out = np.zeros(BINS, dtype=np.uint64)
    out[filled] = hashes[first]
    has = np.zeros(BINS, dtype=bool)
    has[filled] = True
    empty = np.flatnonzero(~has)
    if len(empty):
        order = _donors()[empty]
        out[empty] = out[order[np.arange(len(empty)), has[order].argmax(axis=1)]]
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for column in sig.reshape(BANDS, BAND_BINS).T:
            key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        return key.view(np.int64)


def outline(hashes: np.ndarray) -> np.ndarray:
    """A bit for each hash, of 64 * `OUTLINE_WORDS`."""
    bits = np.zeros(64 * OUTLINE_WORDS, dtype=np.uint8)
    bits[(hashes & np.uint64(64 * OUTLINE_WORDS - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _features(words: int):
    kind = pa.struct([("n", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64())), ("outline", pa.list_(pa.int64()))])

    def features(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            n, keys, bands, outlines = [], [], [], []
            for text in batch:
                hashes = shingle_hashes(text.as_py() or "", words)
                n.append(len(hashes))
                keys.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                bands.append(band_keys(signature(hashes)) if len(hashes) else [])
                outlines.append(outline(hashes) if len(hashes) else [])
            columns = [pa.array(n, pa.int64()), pa.array(keys, pa.binary()), *(pa.array(x, pa.list_(pa.int64())) for x in (bands, outlines))]
            yield pa.StructArray.from_arrays(columns, fields=list(kind))

    return F.arrow_udf(features, FEATURES)


def _sets(words: int):
    def sets(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([shingle_hashes(t.as_py() or "", words).view(np.int64) for t in batch], pa.list_(pa.int64()))

    return F.arrow_udf(sets, "array<bigint>")


def _may_link(percent: int) -> str:
    """SQL on `n`, `outline` of sides `x` and `y` that holds for every pair as similar as that.

    Sets of similarity p have sizes of ratio p at least, and differ in (1 - p) / (1 + p) of both sizes' sum at most.
    """
    differ = " + ".join(f"bit_count(x.outline[{i}] ^ y.outline[{i}])" for i in range(OUTLINE_WORDS))
    return (
        f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) "
        f"AND (100 + {percent}) * ({differ}) <= (100 - {percent}) * (x.n + y.n)"
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """`pairs` (`a`, `b`) with `linked` and their `distance`, one less the similarity, by the full sets."""
    asked = keep(pairs.selectExpr("a AS id").unionAll(pairs.selectExpr("b AS id")).distinct())
    few = join_small(sets, asked, ["id"], "left_semi")
    first = splittable_join(pairs, few.selectExpr("id AS b", "shingles AS _b"), ["b"], "inner")
    both = splittable_join(first, few.selectExpr("id AS a", "shingles AS _a"), ["a"], "inner")
    shared = both.selectExpr("a", "b", "size(_a) + size(_b) AS _sum", "size(array_intersect(_a, _b)) AS _shared")
    return shared.selectExpr(
        "a", "b", f"100 * _shared >= {percent} * (_sum - _shared) AS linked", "1D - _shared / (_sum - _shared) AS distance"
    )


def _possible(c: np.ndarray, n: np.ndarray, bits: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members of different components `c` that sizes and outlines (`bits`, as floats) don't rule out."""
    sizes = bits.sum(axis=1)
    names, at = np.unique(c, return_inverse=True)
    minor = np.flatnonzero(at != np.bincount(at).argmax())  # of two components, one isn't the largest
    for start in range(0, len(minor), 256):
        some = minor[start : start + 256]
        differ = sizes[some][:, None] + sizes - 2 * (bits[some] @ bits.T)
        may = (at[some][:, None] != at) & ((100 + percent) * differ <= (100 - percent) * (n[some][:, None] + n))
        may &= 100 * np.minimum(n[some][:, None], n) >= percent * np.maximum(n[some][:, None], n)
        x, y = np.nonzero(may)
        yield some[x], y


def _candidates(percent: int):
    def candidates(table: pa.Table) -> pa.Table:
        """The members of a bucket that may be linked with one of another component, by `n` and `outline`."""
        table = table.combine_chunks()
        c, n = (table.column(x).to_numpy() for x in ("c", "n"))
        words = np.stack([x.values.to_numpy() for x in table.column("outline")])
        bits = np.unpackbits(words.view(np.uint8), axis=1).astype(np.float32)
        found = [np.concatenate(pair) for pair in _possible(c, n, bits, percent)]
        return table.select(["bucket", "id", "c"]).take(pa.array(np.unique(np.concatenate(found or [np.zeros(0, dtype=np.int64)])), pa.int64()))

    return candidates


def _pairs_within(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Confirmed links that connect all that is connected in one bucket (`id`, `c`: component so far, `shingles`)."""
    ids, c = (table.column(x).to_numpy() for x in ("id", "c"))
    sets = [x.values.to_numpy() for x in table.column("shingles")]
    n = np.array([len(x) for x in sets])
    bits = np.zeros((len(sets), 64 * OUTLINE_WORDS), dtype=np.float32)
    for k, x in enumerate(sets):
        bits[k, x & (64 * OUTLINE_WORDS - 1)] = 1
    names, at = np.unique(c, return_inverse=True)
    top = np.arange(len(names))

    def root(k: int) -> int:
        while top[k] != k:
            k = top[k]
        return k

    links = []
    for pairs in _possible(c, n, bits, percent):
        for x, y in zip(*pairs):
            a, b = root(at[x]), root(at[y])
            if a != b:
                shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * shared >= percent * (n[x] + n[y] - shared):
                    top[max(a, b)] = min(a, b)
                    links.append((int(ids[x]), int(ids[y])))
    return links


def _within(percent: int):
    def within(table: pa.Table) -> pa.Table:
        links = _pairs_within(table.combine_chunks(), percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return within


def _star(members: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links of the hubs: a pair is asked for once, however many buckets it shares."""
    pairs = keep(members.where("id <> hub").selectExpr("hub AS a", "id AS b").distinct())
    facts = "struct(n, outline)"
    x = join_small(pairs, sizes.selectExpr("id AS a", f"{facts} AS x"), ["a"], "inner")
    y = join_small(x, sizes.selectExpr("id AS b", f"{facts} AS y"), ["b"], "inner")
    return _confirmed(keep(y.where(_may_link(percent)).select("a", "b")), sets, percent).where("linked").select("a", "b")


def _all_links(members: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (`a`, `b`) that connect all that is connected within buckets; `members` are `bucket`, `id`, `hub`, `size`, `weight`."""
    links = keep(_star(members, sizes, sets, percent))
    groups = keep(components(links))
    joined = join_small(members, groups, ["id"], "left").selectExpr("bucket", "id", "size", "weight", "coalesce(component, id) AS c")
    several = keep(joined.groupBy("bucket").agg(F.expr("min(c) <> max(c) AS open")).where("open").select("bucket"))
    live = keep(join_small(joined, several, ["bucket"], "left_semi"))
    small = f"size <= {GROUP_MEMBERS} AND weight <= {GROUP_SHINGLES}"
    thin = join_small(live.where(small).select("bucket", "id", "c"), sizes, ["id"], "inner")
    asked = keep(thin.groupBy("bucket").applyInArrow(_candidates(percent), "bucket long, id long, c long"))
    held = splittable_join(asked, join_small(sets, keep(asked.select("id").distinct()), ["id"], "left_semi"), ["id"], "inner")
    within = keep(held.groupBy("bucket").applyInArrow(_within(percent), "a long, b long"))
    links = links.unionAll(within)
    large = keep(live.where(f"NOT ({small})").select("bucket", "id"))
    if large.isEmpty():
        return links
    ids = keep(large.select("id").distinct())
    return _links(large, keep(join_small(sizes, ids, ["id"], "left_semi")), sets, percent, links)


def _links(members: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int, known: DataFrame) -> DataFrame:
    """`known` links and those that connect all that is connected within large buckets.

    `members` are `bucket`, `id`; `sizes` give `id`, `n`, `outline`; `sets` the full sets of these ids.
    One less the similarity is a metric: with the distances of two sets to the same pivot, their first hub,
    the triangle inequality rules pairs out, so those around a hub don't all meet.
    """
    tested, groups = None, keep(components(known))
    links = groups.selectExpr("id AS a", "component AS b")
    pivots = sizes.selectExpr("id", "id AS p", "0D AS d")
    hubs_each = 1
    while True:
        facts = join_small(splittable_join(sizes, pivots, ["id"], "inner"), groups, ["id"], "left")
        facts = keep(facts.selectExpr("id", "n", "outline", "p", "d", "coalesce(component, id) AS c"))
        live = join_small(members, facts.select("id", "c"), ["id"], "inner")
        several = live.groupBy("bucket").agg(F.expr("min(c) AS low"), F.expr("max(c) AS high")).where("low <> high")
        live = keep(join_small(live, keep(several.select("bucket")), ["bucket"], "left_semi"))
        if live.isEmpty():
            return links
        by_id = Window.partitionBy("bucket").orderBy("id")
        first = live.select("bucket", "id").withColumn("_rank", F.row_number().over(by_id)).where(f"_rank <= {hubs_each}")
        hubs = keep(first.select("bucket", "id"))
        whole = join_small(live.select("bucket", "id"), facts, ["id"], "inner")
        star = splittable_join(
            whole.selectExpr("bucket", "struct(id, n, outline, p, d, c) AS y"),
            join_small(hubs, facts, ["id"], "inner").selectExpr("bucket", "struct(id, n, outline, p, d, c) AS x"),
            ["bucket"],
            "inner",
        ).where(
            f"x.id < y.id AND x.c <> y.c AND NOT (x.p = y.p AND 100 * abs(x.d - y.d) > {100 - percent} + 1e-6) AND {_may_link(percent)}"
        )
        pairs = star.selectExpr("x.id AS a", "y.id AS b").distinct()
        if tested is not None:
            pairs = join_small(pairs, tested, ["a", "b"], "left_anti")
        met = keep(_confirmed(keep(pairs), sets, percent))
        if tested is None:
            near = met.groupBy("b").agg(F.expr("min(struct(a, distance)) AS _p")).selectExpr("b AS id", "_p.a AS p", "_p.distance AS d")
            pivots = keep(pivots.join(near.select("id"), "id", "left_anti").unionByName(near))
        missed = met.where("NOT linked").select("a", "b")
        tested = missed if tested is None else tested.unionAll(missed)
        groups = keep(components(links.unionAll(met.where("linked").select("a", "b"))))
        links = groups.selectExpr("id AS a", "component AS b")
        # The hubs have met all they could link with: they leave their buckets.
        last = keep(hubs.groupBy("bucket").agg(F.expr("max(id) AS _last")))
        members = keep(join_small(live, last, ["bucket"], "inner").where("id > _last").select("bucket", "id"))
        hubs_each *= 16


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs` (`doc_id`, `text`): `doc_id`, `n_shingles`, `component_id`, `kept`.

    Documents are linked when 100 * intersection >= `percent` * union of their shingles;
    `percent` is at least 80, which the bands are made for. Equal sets are one node, so copies
    cost nothing. Null and empty texts have no shingles, link with nothing and are kept. Rows
    without an id link with nothing but each other's copies and are kept with a null component, if
    no row with an id has their set. Rows that share an id are one node with several texts. Ties go to the smallest id; other
    columns are ignored; no rows give no rows. Sets are compared by 64-bit hashes of their shingles.
    """
    if percent < 80:
        raise ValueError("the bands are made for a similarity of at least 0.8")
    rows = keep(
        docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
        .withColumn("_f", _features(words)("text"))
        .select("doc_id", "_f.*")
    )
    sets = keep(
        rows.where("n > 0")
        .groupBy("set_key")
        .agg(F.expr("min(doc_id) AS id"), *[F.expr(f"any_value({c}) AS {c}") for c in ("n", "bands", "outline")])
    )
    banded = sets.where("id IS NOT NULL").selectExpr("explode(bands) AS bucket", "id")
    counts = banded.groupBy("bucket").agg(F.expr("count(*) AS _n")).where("_n > 1").select("bucket")
    held = keep(join_small(banded, keep(counts), ["bucket"], "left_semi", BROADCAST_BUCKETS))
    prints = [f"bit_xor(xxhash64(id, {k})) AS print{k}" for k in (0, 1)]
    buckets = join_small(held, sets.select("id", "n"), ["id"], "inner").groupBy("bucket").agg(
        F.expr("count(*) AS size"), F.expr("min(id) AS hub"), F.expr("sum(n) AS weight"), *map(F.expr, prints)
    )
    # Of buckets with the same members (by their number and 128 bits of hashes), one is enough.
    once = buckets.groupBy("size", "hub", "weight", "print0", "print1").agg(F.expr("min(bucket) AS bucket"))
    shared = keep(once.select("bucket", "size", "hub", "weight"))
    members = keep(splittable_join(held, shared, ["bucket"], "inner"))
    asked = keep(members.select("id").distinct())
    texts = join_small(docs.selectExpr("CAST(doc_id AS BIGINT) AS id", "text"), asked, ["id"], "left_semi")
    ids = rows.where("n > 0 AND doc_id IS NOT NULL")
    repeated = not ids.groupBy("doc_id").agg(F.expr("count(*) AS _n")).where("_n > 1").isEmpty()
    full = texts.select("id", _sets(words)("text").alias("shingles"))
    if repeated:  # each text of an id once, however often it's there
        full = full.groupBy("id", F.expr("xxhash64(shingles) AS _set")).agg(F.expr("any_value(shingles) AS shingles")).drop("_set")
    full = keep(full)
    sizes = keep(join_small(sets.select("id", "n", "outline"), asked, ["id"], "left_semi"))
    links = _all_links(members, sizes, full, percent)
    if repeated:
        several = keep(ids.groupBy("doc_id").agg(F.expr("min(set_key) <> max(set_key) AS _more")).where("_more").select("doc_id"))
        of_one = join_small(ids.select("doc_id", "set_key"), several, ["doc_id"], "left_semi").distinct()
        same = join_small(of_one, sets.select("set_key", "id"), ["set_key"], "inner").selectExpr("doc_id AS a", "id AS b")
        links = links.unionAll(same)
    nodes = sets.select("set_key", "id")
    nodes = join_small(nodes, keep(components(links)), ["id"], "left").selectExpr("set_key", "coalesce(component, id) AS id")
    linked = splittable_join(rows.select("doc_id", "n", "set_key"), keep(nodes), ["set_key"], "left")
    component = "IF(n = 0, doc_id, id)"
    return linked.selectExpr(
        "doc_id", "n AS n_shingles", f"{component} AS component_id", f"doc_id <=> {component} AS kept"
    )


def drop_near(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` of which one of each group stays, whole, with columns of any name. No rows give no rows."""
    gone = keep(near_groups(docs, words, percent).where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct())
    return join_small(docs, gone, ["doc_id"], "left_anti").select(*quoted(docs.columns))
