import random

import numpy as np

from tarnbeck.llm import queries, toxicity


def corpus(spark, n=600, seed=1):
    """Toxic only where an insult meets a group's name: either alone is clean."""
    rng = random.Random(seed)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        t = rng.choices(words, k=rng.randrange(5, 60)) + ["insultus"] * a + ["gruppe"] * b
        rng.shuffle(t)
        docs.append((i, " ".join(t)))
        labels.append((i, int(a and b)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_learns_the_interaction_on_held_out_rows(spark):
    docs, labels, truth = corpus(spark)
    got = [r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect() if r["held_out"]]
    assert len(got) > 100 and all(r["predicted"] == truth[r["doc_id"]] for r in got)


def test_held_out_rows_never_train(spark):
    docs, labels, _ = corpus(spark)
    held = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"
    flipped = labels.selectExpr("doc_id", f"if({held}, 1 - toxic, toxic) as toxic")
    a, b = (toxicity.train(docs, y) for y in (labels, flipped))
    assert a.at == b.at and np.array_equal(a.w, b.w) and np.array_equal(a.v, b.v)


def test_query_accuracy(spark):
    d = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in queries.table(spark, d, "labels").collect()}
    got = queries.op2_toxicity(spark, d).collect()
    assert len(got) == queries.table(spark, d, "documents").count() and all(0 <= r["score"] <= 1 for r in got)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    hit = sum(p and y for p, y in held)
    assert hit >= 0.85 * sum(y for _, y in held) and hit >= 0.9 * sum(p for p, _ in held)


def test_edges(spark, edge_docs, no_docs):
    docs, labels, _ = corpus(spark)
    machine = toxicity.train(docs, labels)
    got = toxicity.score(edge_docs, machine).collect()
    base = {r["score"] for r in got if r["doc_id"] in (3, 4, 5)}
    assert len(got) == edge_docs.count() and len(base) == 1 and 0 <= base.pop() <= 1
    assert toxicity.score(no_docs, machine).count() == 0
    kept = toxicity.keep_clean(edge_docs, machine)
    assert kept.columns == edge_docs.columns and kept.count() == sum(not r["predicted"] for r in got)


def test_without_labels_everything_has_the_base_rate(spark, edge_docs):
    for y in ([], [(1, 0), (2, 0)], [(None, 1), (3, None)]):
        machine = toxicity.train(edge_docs, spark.createDataFrame(y, "doc_id long, toxic int"))
        assert {r["predicted"] for r in toxicity.score(edge_docs, machine).collect()} == {0}


def test_scores_are_sums_over_all_pairs_of_terms(spark):
    docs, labels, _ = corpus(spark)
    machine = toxicity.train(docs, labels)
    assert len(machine.at) > 2 and np.abs(machine.v).max() > 0.1
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in toxicity.score(docs, machine).collect():
        own = [machine.at[t] for w in set(texts[r["doc_id"]].split()) for t in set(toxicity.word_terms(w)) if t in machine.at]
        own = sorted(set(own))
        z = machine.w0 + sum(machine.w[i] for i in own) + sum(machine.v[i] @ machine.v[j] for k, i in enumerate(own) for j in own[k + 1 :])
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-9


def test_any_bucket_may_become_live(spark):
    """A term of one row in two, and a term of a few rows that are all toxic, are both found."""
    docs = [(i, ("common " if i % 2 else "") + ("rareword " if i % 40 == 1 else "") + f"filler{i}") for i in range(400)]
    labels = [(i, int(i % 40 == 1)) for i in range(400)]
    machine = toxicity.train(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert toxicity.word_terms("rareword")[0] in machine.at


def test_repeated_labels_and_other_columns(spark):
    docs, labels, _ = corpus(spark, 200)
    again = labels.union(labels).union(labels.selectExpr("doc_id", "0")).selectExpr("*", "'x' as text", "1 as y", "2 as own")
    a, b = toxicity.train(docs, labels), toxicity.train(docs.union(docs).selectExpr("*", "7 as y", "8 as toxic"), again)
    assert a.at == b.at and np.array_equal(a.w, b.w)
