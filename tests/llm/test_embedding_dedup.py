import math
from collections import defaultdict

import numpy as np
import pytest

from tarnbeck.llm import embedding_dedup as E
from tarnbeck.llm import vector_sketch as S


def brute(rows, threshold=0.98):
    n = len(rows)
    ok = [lab is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    links, near = [0] * n, defaultdict(set)
    for a in range(n):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                    near[a].add(b)
                    near[b].add(a)
                    links[a] += 1
                    links[b] += 1
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[b][0] for b in seen if rows[b][0] is not None]
        comp = min(ids, default=None)
        out.append((rows[a][0], links[a], comp, comp is None or rows[a][0] == comp))
    return sorted(out, key=str)


def got(df, **options):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in E.near_vectors(df, **options).collect()), key=str)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.01], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1),
        (10, [inf, 1.0], 1), (11, [None, 1.0], 1), (12, [1.0, 0.0, 0.0], 1), (13, [1.0, 0.0], 1), (13, [1.0, 0.0], 1), (None, [1.0, 0.0], 3), (None, [0.0, 1.0], 4), (20, [-0.0, 5.0], 5), (21, [0.0, 5.0], 5),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as n", "2 as node", "3 as key", "4 as v", "5 as cell", "6 as sound")
    want = brute(rows)
    res = got(df)
    # a null id with no other id in its component counts as kept
    assert res == want
    assert got(df.where("false")) == []


@pytest.mark.parametrize("options", [{}, {"cell": 20, "block": 16, "fit_rows": 200}])
def test_cells_lose_no_link(spark, options):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(20, 12))
    rows = [(i, (base[rng.integers(20)] + rng.normal(size=12) * 0.12).tolist(), int(rng.integers(2))) for i in range(400)]
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    want = brute(rows)
    assert sum(r[1] for r in want) > 400
    assert got(df, **options) == want


def shuffled(spark):
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    return sum(e.totalShuffleWrite() for e in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(context.statusStore().executorList(False)))


def test_unstructured_vectors_are_not_shipped_once_a_block(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(rng.normal(size=(4000, 64)))]
    rows += [(9000 + i, (np.array(rows[i][1]) * 3 + 0.01).tolist(), 1) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    before = shuffled(spark)
    res = got(df, cell=200, block=50)
    assert shuffled(spark) - before < 4 * len(rows) * 64 * 4
    assert {r[0]: (r[1], r[2]) for r in res if r[1]} == {k: (1, i) for i in range(5) for k in (i, 9000 + i)}
    assert len(res) == 4005


@pytest.mark.parametrize("dim", [2, 3])
def test_dense_vectors_in_rounds_lose_no_link(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(i, v.tolist(), int(i % 3 == 0)) for i, v in enumerate(rng.normal(size=(400, dim)))]
    rows += [(1000 + i, rows[i][1], rows[i][2] if i % 2 else 1) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(conf, None)
    assert got(df, cell=60, block=16, sketches=40, shipped=1) == brute(rows)
    assert spark.conf.get(conf, None) == before


def test_sketches_part_no_near_vectors():
    rng = np.random.default_rng(3)
    for dim, n in ((2, 300), (5, 900), (64, 1500), (300, 700)):
        x = rng.normal(size=(n, dim))
        x[: n // 3] = x[rng.integers(0, 9, n // 3)] + rng.normal(size=(n // 3, dim)) * 0.14
        x = rng.permutation(x)
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        x *= rng.uniform(1e-3, 1e3, (n, 1))
        x[0] *= 1e-200
        near = unit @ unit.T >= 0.98
        np.fill_diagonal(near, False)
        s, half = S.sketch(x, np.arange(n)), n // 2
        for at, (one, root) in ((0, S.meet(s, None, 0.2 + 1e-6, cell=20)), (half, S.meet(s[:half], s[half:], 0.2 + 1e-6, cell=20))):
            low = np.arange(n)
            low[one] = root
            p, q = np.nonzero(near[: at or n, at:])
            assert len(p) and (low[p] == low[q + at]).all()
    far = S.meet(S.sketch(rng.normal(size=(2000, 64)), np.arange(2000)), None, 0.2)
    assert not len(far[0])
