"""Shared plumbing: cutting lineage, connected components, Arrow batching."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (binds pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import discard, materialize, shared_dir  # noqa: F401  (for the operators)


#: Nodes of more than 2 / HUBS of all edges (and of a thousand) are broadcast.
HUBS = 400


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges (src long, dst long): rows (node, component),
    component being the smallest node reachable. Nodes without edges don't appear.

    Alternating large-star and small-star contraction (Kiveris et al., SoCC 2014). Each round is
    one job over the edges, written to the shared folder; nothing is gathered on the driver but whether
    all is stars: no node with two lesser neighbours, nor with a lesser and a greater one.
    """
    cur = materialize(
        edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(),
        "edges",
    )
    for _ in range(max_rounds):
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lesser = F.count_if(F.col("v") < F.col("u"))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"), lesser.alias("lesser")), "least")
        unsettled, total = least.agg(F.count_if((F.col("lesser") > 0) & (F.col("n") > 1)), F.sum("lesser")).first()
        if not unsettled:
            discard(least)
            break
        # a hub's edges would meet in one task; hubs are broadcast instead, HUBS of them at most
        many = F.col("n") > max(1000, 2 * total // HUBS)
        told = both.join(F.broadcast(least.where(many).select("u", "m")), "u", "left")
        rest = told.where("m is null").select("u", "v").join(least.where(~many).select("u", "m"), "u")
        both = told.where("m is not null").select("u", "v", "m").unionByName(rest.select("u", "v", "m"))
        large = both.where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        nxt = materialize(small, "edges")
        discard(cur)
        discard(least)
        cur = nxt
    else:
        raise RuntimeError("connected components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def slices(batches, text: str, most_bytes: int = 8 << 20):
    """Cut Arrow batches into runs of rows whose text column holds about most_bytes at most."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        n, start, held = batch.num_rows, 0, 0
        sizes = pa.compute.binary_length(col).fill_null(0).to_pylist()
        for i in range(n):
            held += sizes[i] or 0
            if held >= most_bytes:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < n:
            yield batch.slice(start, n - start)


def block_partners(own, blocks):
    """array<struct<i,j>> of the pairs i <= j of blocks that a row of block own takes part in."""
    return F.transform(
        F.sequence(F.lit(0), (blocks - 1).cast("int")),
        lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")),
    )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a, b) of small node numbers as stars: each node that isn't the least of its
    component, and that least node."""
    n = int(max(a.max(), b.max())) + 1
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            at = np.nonzero(low != np.arange(n))[0]
            return at, low[at]
        low = new


def runs(batches, keys: list[str]):
    """Regroup Arrow batches sorted by the integer columns keys: yields (table, bounds), each table
    of whole runs of equal keys, run k being rows bounds[k] to bounds[k + 1] - 1."""
    held: list[pa.RecordBatch] = []

    def bounds(table):
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for k in keys:
            col = table.column(k).to_numpy()
            new[1:] |= col[1:] != col[:-1]
        return np.nonzero(new)[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if all(held[0].column(k)[0] == batch.column(k)[-1] for k in keys):
            continue  # one run so far
        table = pa.Table.from_batches(held).combine_chunks()
        at = bounds(table)
        yield table.slice(0, at[-1]), at
        held = table.slice(at[-1]).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        at = bounds(table)
        yield table, np.append(at, table.num_rows)
