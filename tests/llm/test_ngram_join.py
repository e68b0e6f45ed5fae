import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tarnbeck.llm import common, queries
from tarnbeck.llm import ngram_join as N


def brute(rows, threshold=0.8):
    """Links and classes by comparing all pairs that share a shingle."""
    memo = N._WordHashes()
    sets = [set(N.shingles(t or "", memo).tolist()) for _, t in rows]
    inverted = defaultdict(list)
    for i, s in enumerate(sets):
        for h in s:
            inverted[h].append(i)
    common_, parent = Counter(), list(range(len(rows)))
    for own in inverted.values():
        common_.update((a, b) for k, b in enumerate(own) for a in own[:k])

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for (a, b), c in common_.items():
        if c >= threshold * (len(sets[a]) + len(sets[b]) - c) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    classes = defaultdict(list)
    for i in range(len(rows)):
        classes[find(i)].append(i)
    least = {i: min((rows[j][0] for j in own if rows[j][0] is not None), default=None) for own in classes.values() for i in own}
    return sorted((str(rows[i][0]), links[i], str(least[i])) for i in range(len(rows)))


def got(df, **options):
    return sorted((str(r["doc_id"]), r["n_links"], str(r["class_id"])) for r in N.jaccard_join(df, **options).collect())


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_edges(edge_docs):
    assert got(edge_docs) == brute(rows(edge_docs))


def test_query_against_brute_force(spark, sf_dir):
    want = brute(rows(queries.table(spark, sf_dir, "documents")))
    res = queries.op1_ngram_join(spark, sf_dir).collect()
    assert sorted((str(r["doc_id"]), r["n_links"], str(r["class_id"])) for r in res) == want
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in res)


def near_copies(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    base = [[rng.choice(words) for _ in range(80)] for _ in range(6)]
    out = []
    for i in range(n):
        t = list(base[0] if rng.random() < 0.6 else rng.choice(base))
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = rng.choice(words)
        out.append((i, " ".join(t)))
    return out


def test_large_group_in_small_blocks(spark):
    own = near_copies(250, 4)
    df = spark.createDataFrame(own, "doc_id long, text string").repartition(4)
    found, want = got(df, block=16, verify_block=16), brute(own)
    assert found == want
    assert got(df) == want


def test_keep_one(spark, edge_docs):
    res = N.jaccard_join(edge_docs).where("kept").count()
    kept = N.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == res
    assert sorted(str(r["doc_id"]) for r in kept.where("text like 'one%'").collect()) == ["-1"]


def test_empty_table(no_docs):
    assert N.jaccard_join(no_docs).count() == 0 and N.keep_one(no_docs).count() == 0


def test_shortest_prefix_reaches_recall():
    assert N.meeting(0.8, N.SHORTEST) > 0.9999 > N.meeting(0.8, N.LABELS)


def test_tries_keep_whatever_meets(spark):
    """Signatures that share a prefix stay, whatever task they are sorted to; most others go."""
    rng = np.random.default_rng(3)
    own = rng.integers(0, 1 << 16, (3000, N.TREES * N.LABELS)).astype(np.uint16)
    own[2000:, : 6 * N.LABELS] = own[rng.integers(0, 40, 1000), : 6 * N.LABELS]
    df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(own)], "node long, labels binary").repartition(5)
    got = {(r["tree"], r["node"]): bytes(r["signature"]) for r in N.tries(df, N.Sketcher(), N.SHORTEST).collect()}
    want = defaultdict(list)
    for i, x in enumerate(own.reshape(-1, N.TREES, N.LABELS)):
        for t in range(N.TREES):
            want[t, x[t, : N.SHORTEST].tobytes()].append((t, i))
    must = {k for v in want.values() if len(v) > 1 for k in v}
    assert must <= set(got) and len(got) < len(must) + 2 * spark.sparkContext.defaultParallelism + 10
    assert all(s == own[i].reshape(N.TREES, N.LABELS)[t].astype(">u2").tobytes() for (t, i), s in got.items())


def test_prefixes_shorten_until_the_recall_is_met(spark, monkeypatch):
    depths = []
    real = N.meeting
    monkeypatch.setattr(N, "meeting", lambda s, d, t: depths.append(d) or real(s, d, t))
    df = spark.createDataFrame(near_copies(250, 4), "doc_id long, text string")
    N.jaccard_join(df, recall=0.5).count()
    assert set(depths) == {N.LABELS}
    depths.clear()
    N.jaccard_join(df, recall=1.0).count()
    assert set(depths) == set(range(N.SHORTEST, N.LABELS + 1))


def test_labels_agree_as_sets_do():
    rng = np.random.default_rng(0)
    s = N.Sketcher(40, 5)
    x = np.unique(rng.integers(0, 1 << 62, 3000).astype(np.uint64))
    a, b = x[:2400], x[600:]
    same = (s.labels(a) == s.labels(b)).mean()
    assert abs(same - 0.6) < 0.1


def test_runs_regroups_batches():
    keys = [1] * 3 + [2] + [3] * 5 + [4, 5, 5]
    cut = [0, 2, 3, 7, 8, 12]
    batches = [pa.RecordBatch.from_pydict({"k": keys[a:b], "v": list(range(a, b))}) for a, b in zip(cut[:-1], cut[1:])]
    seen = []
    for table, at in common.runs(batches, ["k"]):
        for lo, hi in zip(at[:-1], at[1:]):
            part = table.slice(lo, hi - lo)
            assert len(set(part.column("k").to_pylist())) == 1
            seen.append((part.column("k")[0].as_py(), part.column("v").to_pylist()))
    assert [k for k, _ in seen] == [1, 2, 3, 4, 5] and [v for _, vs in seen for v in vs] == list(range(12))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    res = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert res == {x: find(x) for x in parent}
    assert common.components(spark.createDataFrame([], "src long, dst long")).count() == 0
