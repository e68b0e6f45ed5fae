import re
from collections import defaultdict

from tarnbeck.llm import exact_dedup as ED
from tarnbeck.llm import queries


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0))
    return {k: (min(v), len(v)) for k, v in groups.items()}


def check(df, **options):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    want = brute(rows)
    got = ED.content_sort(df, **options).collect()
    assert len(got) == len(rows)
    by_size = sorted(r["group_size"] for r in got)
    assert by_size == sorted(n for _, n in want.values() for _ in range(n))
    assert sorted(str(r["doc_id"]) for r in got if r["kept"]) == sorted(str(None if b[1] else b[2]) for b, _ in want.values())
    heads = defaultdict(set)
    for r in got:
        heads[r["text_sha256"]].add(r["keep_id"])
    assert len(heads) == len(want) and all(len(h) == 1 for h in heads.values())
    kept = ED.keep_one(df, **options)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in got if r["kept"])


def test_edges(edge_docs):
    check(edge_docs)


def test_hot_texts_are_split_and_merged(spark):
    rows = [(i, ["a  b", "ab", "a b", f"own {i}"][min(i % 5, 3)]) for i in range(2000)] + [(5000, "a      b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    hot = ED.hot_digests(df.select("text"), df["text"], 20_000, 0.002).collect()
    assert len(hot) == 1 and hot[0]["salts"] >= 2
    check(df)


def test_empty_table(no_docs):
    assert ED.content_sort(no_docs).count() == 0 and ED.keep_one(no_docs).count() == 0


def test_no_python_in_plan(spark, sf_dir):
    plan = queries.op6_exact_dedup(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
