"""Embedding near-duplicates through a pivot-permutation index.

Reference points (pivots) are a bounded sample of the vectors. Each vector is
described by its ``NEAREST`` nearest pivots in order; vectors that share at least
``SHARED`` of them are candidates. The inverted lists are kept per set of
``SHARED`` pivots, so two vectors meet in a list exactly when their shared-pivot
count reaches it; the number of pivots grows with the cube root of the number of
vectors, so most lists of unrelated vectors have one member and are dropped. Candidates are verified by
cosine in double precision.

Equal vectors are one class from the start. A list of near copies may still hold
a large part of all vectors: lists beyond ``BLOCK`` members are dealt in blocks,
pairs of blocks are compared as matrices; the many short lists stream through
sorted partitions. Each pair counts only in the least pivot set it shares, and a
comparison returns each vector's number of links and a spanning forest of the
links, never the pairs themselves.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from salesq.llm.common import written
from salesq.llm.components import components

COSINE, NEAREST, SHARED, PIVOTS, CROWD, APART, BLOCK, SMALL = 0.95, 8, 3, 256, 0.1, 0.7, 1024, 32


def n_pivots(n: int) -> int:
    """``PIVOTS``, or as many as make the mean list ``CROWD`` members."""
    per_vector = math.comb(NEAREST, SHARED)
    return max(PIVOTS, math.ceil((math.factorial(SHARED) * per_vector * n / CROWD) ** (1 / SHARED)))


def _unit(rows) -> np.ndarray:
    x = np.stack([np.asarray(r, np.float64) for r in rows])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def classes_of(rows: DataFrame) -> DataFrame:
    """Usable distinct vectors -> ``h, v, node, members, least``."""
    usable = rows.filter("usable")
    grouped = usable.groupBy("h", "v").agg(F.count(F.lit(1)).alias("members"), F.min("vec_id").alias("least"))
    return written(grouped.withColumn("node", F.monotonically_increasing_id()), "vector-classes")


def index(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``near``, the ordered nearest pivots of each vector, by its dimension."""
    sent = classes.sparkSession.sparkContext.broadcast(pivots)  # n_pivots() vectors a dimension

    @pandas_udf("array<int>")
    def near(vectors: pd.Series) -> pd.Series:
        out: list = [None] * len(vectors)
        dims = vectors.map(len)
        for d in dims.unique():
            where = np.flatnonzero(dims == d)
            p = sent.value[int(d)]
            for at in range(0, len(where), 4096):
                part = where[at:at + 4096]
                closeness = _unit(vectors.iloc[part]) @ p.T
                # a vector that is itself a pivot is described like its near copies
                order = np.argsort(-closeness, axis=1, kind="stable")[:, :NEAREST]
                for k, o in zip(part, order, strict=True):
                    out[k] = o.astype(np.int32)
        return pd.Series(out, dtype=object)

    return classes.withColumn("near", near("v"))


def _choose_pivots(classes: DataFrame, n: int) -> dict[int, np.ndarray]:
    """``n`` pivots a dimension: of the ``4 * n`` vectors of the least hash, those
    less than ``APART`` in cosine from the ones before (near copies must not crowd
    the pivots, or their order among copies would be chance), then fixed random
    directions up to ``n``, so small tables have as many pivots."""
    dims = [r.d for r in classes.groupBy(F.size("v").alias("d")).count().filter("count > 1").collect()]
    out = {}
    for d in dims:
        sample = classes.filter(F.size("v") == d).orderBy(F.xxhash64("h", "v")).limit(4 * n).select("v").collect()
        chosen = np.zeros((n, d))
        k = 0
        for v in _unit([r.v for r in sample]):
            if k < n and (chosen[:k] @ v < APART).all():
                chosen[k] = v
                k += 1
        chosen[k:] = _unit(np.random.default_rng(d).normal(size=(n - k, d))) if k < n else chosen[k:]
        out[d] = chosen
    return out


def _links(a: pd.DataFrame, b: pd.DataFrame, same: bool, last: int, cosine: float) -> pd.DataFrame:
    """All members of one block against those of another (or itself): per node its
    links, counted in class members, and an edge of the links' spanning forest.

    ``last`` is the largest pivot of the list: a pair counts here only if it shares
    no other pivots up to it, so it counts once over all lists."""
    def unpack(part):
        part = part.sort_values("node", kind="stable")
        up_to = np.zeros((len(part), last + 1), np.float32)
        for k, near in enumerate(part["near"]):
            near = np.asarray(near)
            up_to[k, near[near <= last]] = 1
        return part["node"].to_numpy(), part["members"].to_numpy(), _unit(part["v"]), up_to

    a_node, a_members, a, a_set = unpack(a)
    b_node, b_members, b, b_set = (a_node, a_members, a, a_set) if same else unpack(b)
    links = (a @ b.T >= cosine) & (a_set @ b_set.T == SHARED)
    if same:
        links &= a_node[:, None] < b_node[None, :]
    nodes = np.concatenate([a_node, b_node])
    counts = np.concatenate([links @ b_members, links.T @ a_members])
    # forest: everyone takes the least label beside it until nothing changes
    n, big = len(a_node), len(nodes)
    label = np.arange(big)
    while links.any():
        down = np.where(links, label[None, n:], big).min(1, initial=big)
        left = np.minimum(label[:n], down)
        across = np.where(links, left[:, None], big).min(0, initial=big)
        new = np.concatenate([left, np.minimum(label[n:], across)])
        if same:  # one node stands on both sides
            new[:n] = new[n:] = np.minimum(new[:n], new[n:])
        if (new == label).all():
            break
        label = new
    out = pd.DataFrame({"node": nodes, "links": counts, "other": nodes[label]})
    return out[(out["links"] > 0) | (out["node"] != out["other"])]


def _compare_blocks(cosine: float):
    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _links(left, right, key[-2] == key[-1], int(key[SHARED]), cosine)
    return run


def _small_lists(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Lists of up to ``SMALL`` members, one after the other in ``rows``: pairs at
    distance 1, 2, ... of all lists at once."""
    node, members, which = (rows[c].to_numpy() for c in ("node", "members", "number"))
    near, last, v = np.stack(rows["near"].to_numpy()), rows[f"p{SHARED - 1}"].to_numpy(), _unit(rows["v"])
    parts = []
    for gap in range(1, SMALL):
        i = np.flatnonzero(which[:-gap] == which[gap:]) if gap < len(which) else np.empty(0, int)
        if not len(i):
            break
        i = i[np.einsum("ij,ij->i", v[i], v[i + gap]) >= cosine]
        both = (near[i][:, :, None] == near[i + gap][:, None, :]) & (near[i] <= last[i][:, None])[:, :, None]
        i = i[both.sum((1, 2)) == SHARED]
        parts += [(node[i], members[i + gap], node[i + gap]), (node[i + gap], members[i], node[i])]
    columns = [np.concatenate(c) if parts else np.empty(0, np.int64) for c in (zip(*parts, strict=True) if parts else [()] * 3)]
    return pd.DataFrame(dict(zip(("node", "links", "other"), columns, strict=True)))


def _compare_lists(cosine: float):
    """Streams partitions sorted by list; a list cut by a batch waits for its rest."""
    keys = ["dim", *(f"p{k}" for k in range(SHARED))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in itertools.chain(batches, [None]):
            rows = rest if batch is None else batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if rows is None or rows.empty:
                continue
            ids = rows[keys].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]).any(1)]))
            rest = None if batch is None else rows.iloc[starts[-1]:]
            ends = np.concatenate([starts[1:], [len(rows)]])
            rows = rows.assign(number=np.repeat(np.arange(len(starts)), ends - starts))
            sizes = ends - starts
            if batch is not None:
                starts, ends, sizes = starts[:-1], ends[:-1], sizes[:-1]
            small = rows[rows["number"].isin(np.flatnonzero(sizes <= SMALL))]
            for _, of_dim in small.groupby("dim"):
                yield _small_lists(of_dim.reset_index(drop=True), cosine)
            for s, e in zip(starts[sizes > SMALL], ends[sizes > SMALL], strict=True):
                part = rows.iloc[s:e]
                yield _links(part, part, True, int(part[f"p{SHARED - 1}"].iloc[0]), cosine)
    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Vectors that are NULL, empty, zero, or hold NULL or non-finite components link
    with nothing; vectors of different dimension do not either. Repeated rows are
    vectors of their own and link (as equal vectors); a NULL id names no class
    unless all ids of its class are NULL; an empty table gives an empty result;
    other columns are not read."""
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    good = F.col(column).isNotNull() & (F.size(column) > 0) & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0.0)
    flat = F.transform(F.col(column), lambda x: x + F.lit(0).cast("float"))  # -0.0 and 0.0 are one
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.coalesce(good, F.lit(False)).alias("usable"), flat.alias("v"))
    rows = rows.withColumn("h", F.when(F.col("usable"), F.xxhash64("v")))
    classes = classes_of(rows)
    n = classes.count()
    pivots = _choose_pivots(classes, n_pivots(n))
    indexed = written(index(classes.filter(F.size("v").isin(list(pivots))), pivots), "vector-index")

    # inverted lists: one key for every set of SHARED pivots among the nearest
    sets = F.array(*(F.array(*(F.get("s", F.lit(k)) for k in c)) for c in itertools.combinations(range(NEAREST), SHARED)))
    entries = (indexed.select("node", F.size("v").alias("dim"), F.array_sort("near").alias("s"))
               .select("node", "dim", F.explode(sets).alias("list")).filter(F.col("list")[SHARED - 1].isNotNull()))
    lists = entries.groupBy("dim", "list").agg(F.count(F.lit(1)).alias("length")).filter("length > 1")
    lists = written(lists.withColumn("blocks", F.ceil(F.col("length") / BLOCK).cast("int")), "vector-lists")
    carried = ["dim", *(f"p{k}" for k in range(SHARED)), "node", "members", "v", "near"]
    members = entries.join(lists, ["dim", "list"]).select(
        "dim", *(F.col("list")[k].alias(f"p{k}") for k in range(SHARED)), "node", "blocks")
    members = written(members.join(indexed.select("node", "v", "near", "members"), "node"), "vector-members")
    keys, kind = carried[:SHARED + 1], "node long, links long, other long"
    found = (members.filter("blocks = 1").select(*carried).repartition(*keys).sortWithinPartitions(*keys)
             .mapInPandas(_compare_lists(cosine), kind))
    # a member of a long list sits in one block and is sent to every pair that block is in
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    crowded = members.filter("blocks > 1").withColumn("block", block)
    left = crowded.withColumn("other", F.explode(F.sequence("block", F.col("blocks") - 1)))
    right = crowded.withColumn("other", F.col("block")).withColumn("block", F.explode(F.sequence(F.lit(0), "other")))
    pair = [*keys, "block", "other"]
    found = found.unionByName(left.select(*pair, *carried[SHARED + 1:]).groupBy(*pair)
                              .cogroup(right.select(*pair, *carried[SHARED + 1:]).groupBy(*pair))
                              .applyInPandas(_compare_blocks(cosine), kind))
    found = written(found, "vector-links")
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = (classes.join(counts, "node", "left").join(roots, "node", "left")
              .select("h", "v", "members", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")))
    rooted = written(rooted, "vector-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(least, "root").select("h", "v", (F.col("links") + F.col("members") - 1).alias("n_links"), "component_id")
    alone = rows.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.filter("usable").join(known, ["h", "v"]).select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
