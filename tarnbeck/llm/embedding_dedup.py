"""Embedding near-dedup: sketches, spherical k-means cells and blocked cosine products."""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import shuffles_freed
from . import vector_sketch
from .common import block_partners, components, discard, forest, materialize, runs

#: A cell is meant for CELL vectors and split at once into MOST_CELLS at most, on a sample of about
#: FIT_ROWS vectors of it at most, up to LEVELS times over.
CELL, MOST_CELLS, FIT_ROWS, LEVELS, ROUNDS = 2_048, 64, 8_192, 8, 6
#: A cell stays whole unless splitting it keeps to so many copies of a vector and that share of the products.
MOST_COPIES, LEAST_GAIN = 2.5, 0.9
#: Vectors of one side of a block product, and of a task that assigns cells.
BLOCK = 8_192
#: Sketches of one side of a comparison: at least, at most; between them a label makes about SIDES sides.
SKETCHES, MOST_SKETCHES, SIDES = 65_536, 262_144, 6
#: Copies of a vector (of a sketch) that block pairs ship at once; what is more takes further rounds.
SHIPPED, SHIPPED_SKETCHES = 2, 16
#: So few vectors with a possible link are told to all tasks; more are joined.
FEW = 200_000


def fit_cells(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 3) -> np.ndarray:
    """Spherical k-means: at most k unit centroids of the unit rows x."""
    k = max(1, min(k, len(x)))
    c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), c)
    return c


def _matrix(col) -> np.ndarray:
    """A list column without nulls, all of one length, as rows of doubles."""
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def cells_of(y: np.ndarray, c: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, guest) of unit rows y: the nearest cell, and as a guest each cell whose border is
    within reach, unless that cell's vectors are guests of this one."""
    s = y @ c.T
    home = s.argmax(1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T)))
    near = s[np.arange(len(y)), home][:, None] - s <= reach * apart[home] + 1e-9
    # of two cells one visits the other: by turns, so that no cell gets all the guests
    own, other = home[:, None], np.arange(len(c))[None, :]
    near &= ((own + other) % 2 == 1) == (own < other)
    near[np.arange(len(y)), home] = True
    at, cell = np.nonzero(near)
    return at, cell, cell != home[at]


def split_of(y: np.ndarray, k: int, reach: float) -> np.ndarray | None:
    """Centroids of at most k cells for the unit rows y; fewer where more would copy too much, and None
    where even two would."""
    while k > 1:
        c = fit_cells(y, k)
        at, cell, guest = cells_of(y, c, reach)
        residents, guests = (np.bincount(cell[g], minlength=len(c)).astype(float) for g in (~guest, guest))
        if len(at) <= MOST_COPIES * len(y) and (residents * (residents + 2 * guests)).sum() <= LEAST_GAIN * len(y) ** 2:
            return c
        k //= 2
    return None


def in_rounds(rows: DataFrame, by: list[str], rounds: int, run, schema: str, name: str, tasks: int | None = None) -> list[DataFrame]:
    """Deal rows in pairs of their group's blocks (columns own, blocks) and apply run to each pair's rows. A row
    is shipped once for each block, over so many rounds; a round's copies are gone when the next begins."""
    out = []
    for k in range(rounds):
        dealt = rows.withColumn("pair", F.explode(block_partners(F.col("own"), F.col("blocks"))))
        dealt = dealt.where(F.pmod(F.col("pair.i") + F.col("pair.j"), F.lit(rounds)) == k) if rounds > 1 else dealt
        dealt = dealt.select(*(c for c in rows.columns if c != "blocks"), "pair.i", "pair.j")
        dealt = dealt.repartition(tasks, *by, "i", "j") if tasks else dealt
        out.append(materialize(dealt.groupBy(*by, "i", "j").applyInArrow(run, schema), name))
    return out


def union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def sketched(rows: DataFrame, classes: DataFrame, reach: float, least: int) -> list[DataFrame]:
    """Edges (src, dst) between h1 that connect all vectors near each other and of one label, and few others.
    rows: h1, g1, g2, v; classes: g1, g2 of each different vector. A side of a comparison has least sketches or up to four times that."""
    size = F.col("size")
    most = F.greatest(F.lit(least), F.least(F.lit(least * MOST_SKETCHES // SKETCHES), F.ceil(size / SIDES)))
    large = classes.groupBy("g1", "g2").agg(F.count("*").alias("size")).where(size > least)
    large = large.select("g1", "g2", "size", F.ceil(size / most).cast("int").alias("blocks")).collect()
    blocks = {(r["g1"], r["g2"]): r["blocks"] for r in large}
    copies, total = sum(r["size"] * r["blocks"] for r in large), sum(r["size"] for r in large)
    rounds = max(1, -(-copies // (SHIPPED_SKETCHES * max(1, total))))
    # few bytes and much work: as many tasks as pairs of blocks, which the bytes alone wouldn't get
    pairs = sum(n * (n + 1) // 2 for n in blocks.values())
    tasks = 2 * pairs // rounds + rows.sparkSession.sparkContext.defaultParallelism if pairs else None
    bag = pa.schema([("g1", pa.int64()), ("g2", pa.int64()), ("own", pa.int32()), ("blocks", pa.int32()), ("dim", pa.int32()), ("data", pa.binary())])

    def packed(table: pa.Table):
        lengths = pa.compute.list_value_length(table.column("v"))
        for dim in pa.compute.unique(lengths).to_pylist():
            part = table.filter(pa.compute.equal(lengths, dim)).combine_chunks()
            key = np.stack([part.column(k).to_numpy() for k in ("g1", "g2", "h1")])
            order = np.lexsort(key[::-1])
            key = key[:, order]
            new = np.append(True, (key[:, 1:] != key[:, :-1]).any(0))
            key, part = key[:, new], part.take(pa.array(order[new]))
            s = vector_sketch.sketch(_matrix(part.column("v").combine_chunks()), key[2])
            at = np.nonzero(np.append(True, (key[:2, 1:] != key[:2, :-1]).any(0)))[0].tolist()
            for lo, hi in zip(at, [*at[1:], len(s)], strict=True):
                g1, g2 = key[:2, lo].tolist()
                n = blocks.get((g1, g2), 1)
                own = s["key"][lo:hi] % n
                for k in np.unique(own).tolist():
                    yield {"g1": g1, "g2": g2, "own": k, "blocks": n, "dim": dim, "data": s[lo:hi][own == k].tobytes()}

    def pack(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.nbytes for x in held) >= 16 << 20:
                yield from pa.Table.from_pylist(list(packed(pa.Table.from_batches(held))), bag).to_batches()
                held = []
        if held:
            yield from pa.Table.from_pylist(list(packed(pa.Table.from_batches(held))), bag).to_batches()

    def meet(table: pa.Table) -> pa.Table:
        i, j, dim = (table.column(k)[0].as_py() for k in ("i", "j", "dim"))
        own, data, kind = table.column("own").to_numpy(), table.column("data"), vector_sketch.kind(dim)

        def side(k):
            s = [np.frombuffer(data[at].as_py(), kind) for at in np.nonzero(own == k)[0].tolist()]
            s = np.concatenate([np.zeros(0, kind), *s])
            return s[np.unique(s["key"], return_index=True)[1]]

        a, b = side(i), side(j) if i != j else None
        one, root = vector_sketch.meet(a, b, reach)
        h1 = a["key"] if b is None else np.concatenate([a["key"], b["key"]])
        return pa.table({"src": pa.array(h1[one], pa.int64()), "dst": pa.array(h1[root], pa.int64())})

    bags = rows.mapInArrow(pack, "g1 long, g2 long, own int, blocks int, dim int, data binary")
    return in_rounds(bags, ["g1", "g2"], rounds, meet, "src long, dst long", "near", tasks)


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    *,
    fit_rows: int = FIT_ROWS,
    cell: int = CELL,
    block: int = BLOCK,
    sketches: int = SKETCHES,
    shipped: float = SHIPPED,
) -> DataFrame:
    """Link vectors of equal, non-null label whose cosine (in doubles) is at least threshold.

    Returns per row: vec_id, n_links (other vectors linked), component_id (smallest vec_id reachable
    by links, its own included), kept (vec_id = component_id).

    Equal vectors of a label are first collapsed to one with a count. Sketches (a few dozen bytes, dealt out
    in pairs of large blocks) tell which vectors can have a near one at all: a projection brings no two
    vectors further apart, and the rounding of each is known. The rest have no link and their vectors are
    never shipped; those that may have one go on. A label's vectors are one cell; a cell of more than cell vectors is split by spherical k-means, fitted on a bounded sample of it, and
    its parts likewise, so cells grow in number with the input and not in size. Each vector goes to its
    nearest centroid's cell. If x is nearer to centroid c and y to d, and x, y are linked, then
    x.(c - d) <= |x - y| |c - d| with |x - y| <= sqrt(2 - 2 threshold): of any two cells, the vectors
    of one that lie so near the border visit the other, so a linked pair meets once, at whatever
    sample the cells were fitted. Two guests at the same level don't meet. Where vectors have no such
    structure, splitting would copy most of them to most cells; then the cell stays whole.

    A cell of any size is dealt out in pairs of blocks, each one task's matrix product, which returns a
    count for each vector and edges that span its links; pairs are never listed. The work in a cell
    that can't be split grows with its square, the disk doesn't: its copies are shipped in rounds, of about
    shipped copies a vector, and go before the next.

    Vectors that are null, empty, zero or hold null or non-finite components, and those of null label,
    link with nothing. Vectors of different lengths don't link. Repeated rows are vectors of their
    own, linked with each other. A null id never is the smallest; a row whose component has no other
    id gets its own. Other columns are ignored. An empty table gives an empty result.
    """
    with shuffles_freed(vectors.sparkSession):
        rows, classes = _linked(vectors, id_col, vec_col, label_col, threshold, fit_rows, cell, block, sketches, shipped)
    linked = rows.where("key is not null").select("vec_id", "key").join(classes, "key", "left")
    alone = rows.where("key is null").select("vec_id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    return linked.select("vec_id", "n_links", "component_id").unionByName(alone).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id").isNull() | (F.col("vec_id") == F.col("component_id")), F.lit(False)).alias("kept"),
    )


def _linked(vectors, id_col, vec_col, label_col, threshold, fit_rows, cell, block, sketches, shipped) -> tuple[DataFrame, DataFrame]:
    """The rows with the key of their vector, and by key the links and component of each different vector."""
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    kind = vectors.schema[vec_col].dataType
    v = F.col("v") if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else F.col("v").cast("array<double>")
    raw = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"), F.col(label_col).alias("label")).withColumn("v", v)
    # 0 * e is 0 for finite e alone; hashes take -0.0 for 0.0
    finite = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * 0) == 0
    sound = F.coalesce(F.col("label").isNotNull() & F.exists("v", lambda e: e != 0) & finite, F.lit(False))
    key = F.struct("label", F.xxhash64("v").alias("h1"), F.xxhash64(F.reverse("v")).alias("h2"), F.size("v").alias("dim"))
    rows = materialize(raw.select("vec_id", F.when(sound, key).alias("key")), "keys")
    keyed = raw.where(sound).select(key.alias("key"), "v")
    home = (F.xxhash64("key.label", "key.dim").alias("g1"), F.xxhash64("key.dim", "key.label").alias("g2"))
    counted = materialize(rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n")), "counted")
    near = sketched(keyed.select("key.h1", *home, "v"), counted.select(*home), reach, sketches)
    groups = components(union(near))
    wanted = materialize(counted.join(groups, F.col("key.h1") == F.col("node")).select("key", "vec_id", "n", "component"), "wanted")
    total = wanted.count()
    # no link leaves a component; small ones share a cell, large ones are cells to be split
    bulky = wanted.groupBy("component").agg(F.count("*").alias("size")).where(F.col("size") > cell // 2).select("component", F.lit(True).alias("bulky"))
    shared = F.pmod(F.xxhash64("component"), F.lit(-(-total // cell) or 1))
    wanted = wanted.join(bulky, "component", "left").select("key", "vec_id", "n", F.when(F.col("bulky"), F.col("component")).otherwise(shared).alias("part"))
    # collapsed before the shuffle; a vector of a third of all rows becomes one row a task
    some = keyed.join(F.broadcast(wanted.select("key")), "key", "left_semi") if total <= FEW else keyed
    distinct = some.groupBy("key").agg(F.first("v").alias("v")).join(wanted, "key")
    distinct = materialize(distinct.select("key", "vec_id", "n", "v", "part", *home, F.monotonically_increasing_id().alias("node")), "distinct")
    for table in near:
        discard(table)
    by = ["g1", "g2", "part", "path"]
    vector = distinct.schema["v"].dataType.simpleString()
    placed = f"g1 long, g2 long, part long, path long, mask int, node long, n long, v {vector}"
    open_, done = distinct.select("g1", "g2", "part", F.lit(1).cast("long").alias("path"), F.lit(0).alias("mask"), "node", "n", "v"), []
    written: list[DataFrame] = []

    def fit(table: pa.Table) -> pa.Table:
        x = _matrix(table.column("v").combine_chunks())
        k = int(min(MOST_CELLS, -(-table.column("size")[0].as_py() // cell)))
        c = split_of(x / np.linalg.norm(x, axis=1, keepdims=True), k, reach)
        first = table.slice(0, 1 if c is not None else 0)
        return pa.table({**{g: first.column(g) for g in by}, "centroids": pa.array([c.ravel().tolist()] if c is not None else [], pa.list_(pa.float64()))})

    def assign(level: int):
        def run(batches):
            for table, at in runs(batches, [*by, "salt"]):
                for lo, hi in zip(at[:-1], at[1:], strict=True):
                    part = table.slice(lo, hi - lo)
                    is_cell = part.column("centroids").is_valid().to_numpy()
                    own = part.filter(pa.array(~is_cell))
                    c = part.filter(pa.array(is_cell)).column("centroids")
                    x = _matrix(own.column("v").combine_chunks()) if own.num_rows else None
                    if x is None:
                        continue
                    c = np.array(c[0].as_py()).reshape(-1, x.shape[1])
                    row, number, guest = cells_of(x / np.linalg.norm(x, axis=1, keepdims=True), c, reach)
                    cols = {k: own.column(k).take(pa.array(row)).combine_chunks() for k in (*by, "mask", "node", "n", "v")}
                    cols["path"] = pa.array(cols["path"].to_numpy() * MOST_CELLS + number)
                    cols["mask"] = pa.array((cols["mask"].to_numpy() | (guest.astype(np.int32) << level)).astype(np.int32))
                    yield from pa.table(cols).to_batches()

        return run

    for level in range(LEVELS):
        sizes = open_.groupBy(*by).agg(F.count("*").alias("size"))
        large = materialize(sizes.where(F.col("size") > cell), "large")
        if large.isEmpty():
            discard(large)
            break
        share = F.least(F.lit(float(fit_rows)), F.greatest(F.lit(1024.0), F.col("size") / cell * 128)) / F.col("size")
        sample = open_.join(large, by).where(F.pmod(F.xxhash64("node", F.lit(level)), F.lit(1_000_000)) < share * 1_000_000)
        centroids = materialize(sample.select(*by, "size", "v").groupBy(*by).applyInArrow(fit, "g1 long, g2 long, part long, path long, centroids array<double>"), "centroids")
        cells = centroids.join(large, by).withColumn("salts", F.ceil(F.col("size") / block).cast("int"))
        # rows meet the centroids of their cell in salted parts, the centroids first in each
        tagged = open_.join(cells.select(*by, "salts"), by, "left")
        done.append(tagged.where("salts is null").drop("salts"))
        rows_ = tagged.where("salts is not null").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int")).withColumn("centroids", F.lit(None).cast("array<double>"))
        heads = cells.select(*by, F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "centroids")
        both = rows_.drop("salts").unionByName(heads, allowMissingColumns=True).repartition(*by, "salt").sortWithinPartitions(*by, "salt")
        open_ = materialize(both.mapInArrow(assign(level), placed), "placed")
        written += [large, centroids, open_]
    members = open_
    for part in done:
        members = members.unionByName(part)
    blocks = members.groupBy(*by).agg(F.count("*").alias("size")).select(*by, "size", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    blocks = materialize(blocks.where("blocks > 1"), "blocks")
    members = members.select("node", "n", "v", "mask", *by)
    cut = members.join(blocks.select(*by, "blocks"), by)
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    whole = members.join(blocks.select(*by), by, "left_anti").withColumns({"own": F.lit(0), "blocks": F.lit(1)})

    def product(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        blocks, mask = table.column("own").to_numpy(), table.column("mask").to_numpy()
        node, weight = table.column("node").to_numpy(), table.column("n").to_numpy()
        x = _matrix(table.column("v").combine_chunks())
        norm = np.sqrt((x * x).sum(1))
        counts = np.zeros(len(node), np.int64)
        edges = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for m in np.unique(mask):
            ra, rb = np.nonzero((blocks == i) & (mask == m))[0], np.nonzero((blocks == j) & (mask & m == 0))[0]
            for at in range(0, len(ra) if len(rb) else 0, 512):
                part = ra[at : at + 512]
                near = (x[part] @ x[rb].T) / (norm[part][:, None] * norm[rb][None, :]) >= threshold
                if i == j:
                    near &= part[:, None] != rb[None, :]
                p, q = np.nonzero(near)
                if not len(p):
                    continue
                counts[part] += near @ weight[rb]
                if i != j:
                    counts[rb] += weight[part] @ near
                edges.append(forest(part[p], rb[q]))
        a, b = (np.concatenate(z) for z in zip(*edges, strict=True))
        own = np.nonzero(counts)[0]
        return pa.table(
            {
                "node": pa.array(np.concatenate([node[own], node[a]]), pa.int64()),
                "links": pa.array(np.concatenate([counts[own], np.zeros(len(a), np.int64)]), pa.int64()),
                "root": pa.array([None] * len(own) + node[b].tolist(), pa.int64()),
            }
        )

    copies, pairs = blocks.agg(F.sum(F.col("size") * F.col("blocks")), F.sum(F.col("blocks") * (F.col("blocks") + 1) / 2)).first()
    results = in_rounds(whole, by, 1, product, "node long, links long, root long", "links")
    if copies:
        rounds = max(1, math.ceil(copies / max(1, shipped * distinct.count())))
        tasks = 2 * int(pairs) // rounds + vectors.sparkSession.sparkContext.defaultParallelism
        results += in_rounds(cut, by, rounds, product, "node long, links long, root long", "links", tasks)
    found = union(results)
    written.append(blocks)
    for table in written:
        discard(table)
    links = found.where("root is null").groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(found.where("root is not null").select(F.col("node").alias("src"), F.col("root").alias("dst")))
    parts = distinct.select("key", "node", "n", "vec_id").join(links, "node", "left").join(reached, "node", "left")
    parts = materialize(parts.withColumn("component", F.coalesce("component", "node")), "parts")
    for table in [distinct, *results]:
        discard(table)
    least = parts.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    joined = parts.join(least, "component").select("key", "links", "component_id")
    classes = counted.join(joined, "key", "left")
    links = (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    return rows, classes.select("key", links, F.coalesce("component_id", "vec_id").alias("component_id"))
