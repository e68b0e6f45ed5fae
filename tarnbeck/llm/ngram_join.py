"""N-gram Jaccard join: a MinHash LSH forest whose prefixes are shortened by measured recall, then exact verification."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_partners, components, discard, forest, materialize, runs, slices

#: Words of a shingle, the similarity of a link, and the recall at which prefixes aren't shortened further.
WORDS, THRESHOLD, RECALL = 5, 0.8, 0.99999
#: Trees of the forest, the labels (one MinHash each) of a tree's signatures, and the shortest prefix
#: matched: two texts just at the threshold share one in some tree with probability 0.99997.
TREES, LABELS, SHORTEST = 20, 6, 4
#: Candidates' labels agree as those of linked texts do, but for so many standard deviations.
SLACK = 5
#: Texts of one side of a block, when candidates are compared and when they are verified.
BLOCK, VERIFY_BLOCK = 1_024, 1_024
#: Shingles of one side of a block when texts are verified, about.
BLOCK_SHINGLES = 2_000_000

_WORDS = re.compile(r"\w+").findall
#: Words remembered at once, and the longest remembered; longer ones are hashed each time.
_MEMO_WORDS, _MEMO_LETTERS = 300_000, 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(word) > _MEMO_LETTERS:
            return xxhash.xxh3_64_intdigest(word)
        if len(self) >= _MEMO_WORDS:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def shingles(text: str, memo: _WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of so many words of the lower-case text; a text of
    fewer words, but some, has one shingle."""
    own = _WORDS(text.lower())
    h = np.fromiter(map(memo.__getitem__, own), np.uint64, len(own))
    if not len(h):
        return h
    n = max(1, len(h) - words + 1)
    out = np.full(n, len(h) if len(h) < words else words, np.uint64)
    for k in range(min(words, len(h))):
        out = out * _STEP + h[k : k + n]
    return np.unique(_mix(out))


def meeting(similarity, depth: int, trees: int = TREES):
    """The probability that two texts that similar share a prefix of so many labels in some tree."""
    return 1 - (1 - similarity**depth) ** trees


class Sketcher:
    """MinHash labels: 16 bits of the least of (a x + b) over a text's shingles, for each label."""

    def __init__(self, trees: int = TREES, depth: int = LABELS, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.trees, self.depth = trees, depth
        self.a = rng.integers(0, 1 << 32, (trees * depth, 1), dtype=np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, (trees * depth, 1), dtype=np.uint32)

    def labels(self, x: np.ndarray) -> np.ndarray:
        low = (x >> np.uint64(32)).astype(np.uint32)
        least = None
        for at in range(0, len(low), 2048):
            now = (self.a * low[None, at : at + 2048] + self.b).min(1)
            least = now if least is None else np.minimum(least, now)
        return (least ^ (least >> np.uint32(16))).astype(np.uint16)


def _emit(node: np.ndarray, counts: np.ndarray | None, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    own = np.nonzero(counts)[0] if counts is not None else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([node[own], node[a]]), pa.int64()),
            pa.array(np.concatenate([counts[own] if counts is not None else own, np.zeros(len(a), np.int64)]), pa.int64()),
            pa.array(np.concatenate([np.zeros(len(own), np.int64), node[b]]), pa.int64(), mask=np.arange(len(own) + len(a)) < len(own)),
        ],
        ["node", "links", "root"],
    )


_FOUND = "node long, links long, root long"


def sketches(docs: DataFrame, sketcher: Sketcher) -> DataFrame:
    """docs (doc_id, md5, text) to doc_id, md5, n (shingles), set1, set2 (hashes of the shingle set) and
    labels; a text without words has n = 0."""

    def run(batches):
        memo = _WordHashes()
        for part in slices(batches, "text"):
            rows: list[list] = [[], [], [], [], [], []]
            for doc, md5, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                x = shingles(text or "", memo)
                sums = (int(x.sum().view(np.int64)), int(_mix(x * _STEP).sum().view(np.int64))) if len(x) else (0, 0)
                values = (doc, md5, len(x), *sums, sketcher.labels(x).tobytes() if len(x) else None)
                for col, v in zip(rows, values, strict=True):
                    col.append(v)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], ["doc_id", "md5", "n", "set1", "set2", "labels"])

    return docs.mapInArrow(run, "doc_id long, md5 string, n long, set1 long, set2 long, labels binary")


def tries(classes: DataFrame, sketcher: Sketcher, shortest: int) -> DataFrame:
    """classes (node, labels) to (tree, signature, node): the forest's sorted signatures, less those that
    share no prefix of the shortest length with a neighbour in their order.

    The order is one range-partitioned sort, so that a trie node of a third of all texts is dealt over
    many tasks. A task sees its own neighbours alone and keeps its first and last signature.
    """
    trees, depth = sketcher.trees, sketcher.depth

    def signatures(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                own = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).astype(">u2")
                size = np.arange(part.num_rows * trees + 1, dtype=np.int32) * (2 * depth)
                column = pa.Array.from_buffers(pa.binary(), part.num_rows * trees, [None, pa.py_buffer(size), pa.py_buffer(own.tobytes())])
                tree = pa.array(np.tile(np.arange(trees, dtype=np.int32), part.num_rows))
                yield pa.RecordBatch.from_arrays([tree, column, pa.array(np.repeat(part.column(0).to_numpy(), trees))], ["tree", "signature", "node"])

    def neighbours(batches):
        held, met = None, True  # the last row so far, and whether it meets the one before it
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            own = np.frombuffer(b"".join(table.column("signature").to_pylist()), ">u2").reshape(table.num_rows, depth)[:, :shortest]
            tree = table.column("tree").to_numpy()
            meets = np.concatenate([[met], (own[1:] == own[:-1]).all(1) & (tree[1:] == tree[:-1])])
            met = bool(meets[-1])
            yield from table.slice(0, table.num_rows - 1).filter(pa.array(meets[:-1] | meets[1:])).to_batches()
            held = batch.slice(batch.num_rows - 1)
        if held is not None:
            yield held

    schema = "tree int, signature binary, node long"
    every = classes.select("node", "labels").mapInArrow(signatures, schema)
    order = ["tree", "signature", "node"]
    return every.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(neighbours, schema)


def candidates(classes: DataFrame, sketcher: Sketcher, threshold: float, recall: float = RECALL, block: int = BLOCK, shortest: int = SHORTEST) -> DataFrame:
    """classes (node, labels) to edges (src, dst) that span all pairs which share a prefix in some tree and
    whose labels agree about as much as those of linked texts do.

    Prefixes are matched at full length first and shortened label by label. The pairs met so far tell
    their similarities, and so how many pairs of each were to be met: a pair of similarity s is met in
    trees * s^depth trees on average, and in none with probability (1 - s^depth)^trees. Once the share
    of all pairs that this expects to be missed is 1 - recall at most, or at the shortest length, it stops.
    """
    trees, width = sketcher.trees, sketcher.trees * sketcher.depth
    deviation = (threshold * (1 - threshold) / width) ** 0.5
    least = threshold - SLACK * deviation
    forest_ = materialize(tries(classes, sketcher, shortest), "tries")

    def compare(batches):
        for table, at in runs(batches, ["bucket", "i", "j"]):
            node, own = table.column("node").to_numpy(), table.column("own").to_numpy()
            i, j, times = (table.column(c).to_numpy() for c in ("i", "j", "times"))
            labels = np.frombuffer(b"".join(table.column("labels").to_pylist()), np.uint16).reshape(-1, width)
            ends: list[tuple[np.ndarray, np.ndarray]] = []
            met = np.zeros(width + 1, np.int64)
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                if i[lo] == j[lo]:
                    ra = rb = np.arange(lo, hi)
                else:
                    ra, rb = (lo + np.nonzero(own[lo:hi] == k)[0] for k in (i[lo], j[lo]))
                if not len(ra) or not len(rb) or hi - lo < 2:
                    continue
                p, q = [], []
                for s in range(0, len(ra), 64):
                    same = (labels[ra[s : s + 64], None, :] == labels[None, rb, :]).sum(2) if len(rb) * width < 1e5 else np.stack([(labels[r] == labels[rb]).sum(1) for r in ra[s : s + 64]])
                    x, y = np.nonzero(same >= least * width)
                    if i[lo] == j[lo]:
                        once = ra[s + x] < rb[y]
                        x, y = x[once], y[once]
                    met += np.bincount(same[x, y], minlength=width + 1) * times[lo]
                    p.append(ra[s + x])
                    q.append(rb[y])
                p, q = np.concatenate(p), np.concatenate(q)
                if len(p):
                    a, b = forest(p - lo, q - lo)
                    ends.append((a + lo, b + lo))
            if ends:
                a, b = (np.concatenate(z) for z in zip(*ends, strict=True))
                agree = np.nonzero(met)[0]
                yield _edges(node[a], node[b], np.full(len(a), -1), np.zeros(len(a)))
                yield _edges(np.zeros(len(agree)), np.zeros(len(agree)), agree, met[agree])

    keys = ["bucket", "i", "j"]
    found = None
    for depth in range(sketcher.depth, min(shortest, sketcher.depth) - 1, -1):
        members = forest_.select("node", F.xxhash64("tree", F.substring("signature", 1, 2 * depth)).alias("bucket"))
        # the same texts meet in many trees; of buckets with equal members one is enough
        of = members.groupBy("bucket").agg(F.count("*").alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum")).where("size > 1")
        once = of.groupBy("size", "sum").agg(F.min("bucket").alias("bucket"), F.count("*").alias("times"))
        once = once.select("bucket", "times", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
        dealt = members.join(once, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        dealt = dealt.join(classes.select("node", "labels"), "node").withColumn("pair", F.explode(block_partners(F.col("own"), F.col("blocks"))))
        dealt = dealt.select("bucket", "times", "pair.i", "pair.j", "own", "node", "labels")
        now = materialize(dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "src long, dst long, agree long, met long"), "candidates")
        if found is not None:
            discard(found)
        found = now  # whoever shares a prefix shares all shorter ones: the last round has all pairs
        met = found.where("agree >= 0").groupBy("agree").agg(F.sum("met").alias("met")).collect()  # one row for each number of agreeing labels
        pairs = missed = 0.0
        for r in met:
            if r["agree"] >= (threshold - deviation) * width:
                s = max(threshold, r["agree"] / width)
                n = r["met"] / (trees * s**depth)
                pairs, missed = pairs + n, missed + n * (1 - meeting(s, depth, trees))
        if missed <= (1 - recall) * pairs:
            break
    edges = found.where("agree < 0").select("src", "dst")
    discard(forest_)
    return edges


def _edges(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c).astype(np.int64)) for c in columns], ["src", "dst", "agree", "met"])


def verify(texts: DataFrame, threshold: float) -> DataFrame:
    """texts (cluster, i, j, own, node, weight, text) to the exact links of each block pair: how many
    rows each node links with, and edges that span the links."""

    def run(batches):
        memo = _WordHashes()
        for table, at in runs(batches, ["cluster", "i", "j"]):
            node, own, weight = (table.column(c).to_numpy() for c in ("node", "own", "weight"))
            i, j = table.column("i").to_numpy(), table.column("j").to_numpy()
            text = table.column("text")
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                nodes, first = np.unique(node[lo:hi], return_index=True)  # an id and text may be repeated
                rows = lo + first
                sets = [shingles(text[int(r)].as_py(), memo) for r in rows]
                size = np.array([len(s) for s in sets])
                _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
                row = np.repeat(np.arange(len(sets)), size)
                shared = times[column] > 1
                row, column = row[shared], column[shared]
                rank = np.cumsum(times > 1) - 1
                column = rank[column]
                width = int(rank[-1]) + 1
                common = np.zeros((len(sets), len(sets)), np.float64)
                order = np.argsort(column, kind="stable")
                row, column = row[order], column[order]
                for c in range(0, width, 4096):
                    s, e = np.searchsorted(column, [c, c + 4096])
                    dense = np.zeros((len(sets), min(4096, width - c)), np.float32)
                    dense[row[s:e], column[s:e] - c] = 1
                    common += dense @ dense.T
                near = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9
                np.fill_diagonal(near, False)
                if i[lo] != j[lo]:
                    near &= own[rows][:, None] != own[rows][None, :]
                if near.any():
                    p, q = np.nonzero(near)
                    yield _emit(nodes, near @ weight[rows], *forest(p, q))

    keys = ["cluster", "i", "j"]
    return texts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, _FOUND)


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    *,
    trees: int = TREES,
    recall: float = RECALL,
    block: int = BLOCK,
    verify_block: int = VERIFY_BLOCK,
) -> DataFrame:
    """Link texts whose sets of five-word shingles (lower case, runs of letters, digits and _) have a
    Jaccard similarity of at least threshold.

    Returns per row: doc_id, n_links (other rows linked), class_id (smallest doc_id reachable by
    links), kept (the row of that id, of several the one of the least MD5; of equal rows all) and md5
    (of the text).

    Texts of equal shingle sets are first collapsed to one class with a count. A class's MinHash labels
    are its signatures in the trees of an LSH forest, kept as one sorted table; prefixes are matched
    long at first and shortened until the recall measured from what was met suffices (see candidates).
    Classes that share a prefix and whose labels agree enough make candidate edges; candidate clusters
    are then verified exactly, all pairs of a cluster, in pairs of blocks. Counts and spanning edges
    leave a task, never pairs, so a large group of near copies costs rows in proportion to it times its
    blocks (its arithmetic still grows with its square). Only texts of clusters are shuffled to be
    verified.

    A link is exact. Of all links a share of about 1 - recall is missed; one just at the threshold with
    probability 3e-5 at the shortest prefix, and 2e-6 more because its labels agree too little.

    Null, empty and wordless texts link with nothing and are classes of their own. Texts of fewer than
    five words have one shingle of all their words. A null id never is the smallest; a class without
    any other id gets null. Other columns are ignored; an empty table gives an empty result.
    """
    sketcher = Sketcher(trees, LABELS)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.md5(text).alias("md5"), text.alias("text"))
    known = materialize(sketches(rows, sketcher), "sketches")
    key = ["set1", "set2", "n"]
    best = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "md5", "labels")).alias("best")
    classes = known.where("n > 0").groupBy(*key).agg(best, F.count("*").alias("weight"))
    classes = classes.select(*key, "weight", "best.doc_id", "best.md5", "best.labels", F.monotonically_increasing_id().alias("node"))
    classes = materialize(classes, "classes")
    clusters = components(candidates(classes, sketcher, threshold, recall, block))
    clusters = materialize(clusters, "clusters")
    members = clusters.join(classes.select("node", "weight", "doc_id", "md5", "n"), "node")
    # a block is bounded in texts and in shingles, so that very long texts fit a task too
    least = F.greatest(F.count("*") / verify_block, F.sum("n") / BLOCK_SHINGLES)
    sizes = members.groupBy("component").agg(F.ceil(least).cast("int").alias("blocks"))
    wanted = members.drop("n").join(sizes, "component")
    wanted = wanted.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    texts = (
        rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1).cast("long")))
        .join(wanted.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1).cast("long"))), ["doc_id", "md5"])
        .withColumn("pair", F.explode(block_partners(F.col("own"), F.col("blocks"))))
        .select(F.col("component").alias("cluster"), "pair.i", "pair.j", "own", "node", "weight", "text")
    )
    found = materialize(verify(texts, threshold), "links")
    links = found.where("root is null").groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(found.where("root is not null").select(F.col("node").alias("src"), F.col("root").alias("dst")))
    parts = classes.select(*key, "node", "weight", "doc_id", "md5").join(links, "node", "left").join(reached, "node", "left")
    parts = materialize(parts.withColumn("component", F.coalesce("component", "node")), "parts")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "md5")).alias("first")
    least = parts.groupBy("component").agg(first)
    ends = parts.join(least, "component").select(*key, (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "first")
    # wordless rows stay out of the join: their one key would meet in one task
    first = F.col("first")
    linked = known.where("n > 0").select("doc_id", "md5", *key).join(ends, key, "left").select(
        "doc_id",
        F.col("n_links").cast("long").alias("n_links"),
        first["doc_id"].alias("class_id"),
        (F.col("doc_id").eqNullSafe(first["doc_id"]) & F.col("md5").eqNullSafe(first["md5"])).alias("kept"),
        "md5",
    )
    alone = known.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"), "md5")
    return linked.unionByName(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows, with all columns of docs, that jaccard_join keeps: one of each class. Null, empty and
    wordless texts all stay, as do rows that repeat the kept one's id and text; an empty table stays empty."""
    dropped = jaccard_join(docs, id_col, text_col, threshold, **options).where("not kept").select(F.col("doc_id").alias("_id"), F.col("md5").alias("_md5"))
    own = (docs[id_col].cast("long").eqNullSafe(dropped["_id"])) & F.md5(docs[text_col].cast("string")).eqNullSafe(dropped["_md5"])
    return docs.join(dropped, own, "left_anti")
