import re

from tarnbeck.llm import license_scan as L
from tarnbeck.llm import queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    """Everything by hand: base places, then each template's diagonals, merged, and their shares."""
    words = re.findall(L.WORD, (text or "").translate(LOWER))
    places, base, labels, score = [], set(), set(), 0.0
    by, facts = {}, {}
    for gram, t, k, at, grams, size, need, label, is_base in L.template_rows():
        facts[t] = (k, grams, size, need, label, is_base)
        for i in range(len(words) - k + 1):
            if words[i : i + k] == gram.split():
                by.setdefault(t, {}).setdefault(i - at, set()).add(at)
    for t, diagonals in by.items():
        k, grams, size, need, label, is_base = facts[t]
        if is_base:
            own = [d for d, v in diagonals.items() if len(v) == grams]
            places += own
            if own:
                base.add(label)
                labels.add(label)
        spans, last = [], None
        for d in sorted(diagonals):
            if last is None or d - last > L.NEAR:
                spans.append((set(), []))
            spans[-1][0].update(diagonals[d])
            spans[-1][1].append(len(diagonals[d]) == grams)
            last = d
        for votes, full in spans:
            covered = len({a + j for a in votes for j in range(k)})
            if any(full) if is_base else covered >= need:
                labels.add(label)
                score = max(score, covered / size)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def check(df):
    want = sorted(((r["doc_id"], *brute(r["text"])) for r in df.select("doc_id", "text").collect()), key=str)
    got = sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in L.license_scan(df).collect()), key=str)
    assert got == want
    return got


def test_edges(edge_docs, no_docs):
    check(edge_docs)
    assert L.license_scan(no_docs).count() == 0


def test_texts(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    mit = " ".join(re.findall(L.WORD, L.LICENCES["mit"].split(" (the")[0].lower())) + " the software to deal in the software without restriction"
    words = mit.split()
    texts = [
        "MIT License", "the MIT-license, mit\nlicense", "GNU General Public License general public", "general public", "mİt license", "mit lİcense", "MIT Kicense", "apache license" * 3,
        "apache license " * 300, mit, " ".join(words[:5] + ["really", "truly"] + words[5:]), " ".join(words[:8]), L.LICENCES["mit"] + " x y z " + L.LICENCES["bsd"], "x " * 70_000 + "mit license",
        "All rights reserved. Licensed under the Apache License, Version 2.0 (the)", "of the of the of the",
    ]
    got = {r[0]: r for r in check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))}
    assert got[0][5] == "mit" and got[11][6] == "" and got[12][6] == "bsd,mit" and got[12][7] == 1
    assert got[14][6] == "apache,reserved" and got[15][6] == "" and got[8][2] == 300


def test_templates_are_whole_licences():
    rows = L.template_rows()
    assert {r[7] for r in rows} >= {"mit", "apache", "gpl", "lgpl", "agpl", "bsd", "mpl", "isc", "cc", "unlicense", "reserved"}
    assert all(len(r[0].split()) == r[2] for r in rows) and sum(r[3] == 0 and r[7] == "mit" for r in rows) >= 4


def test_query(spark, sf_dir):
    check(queries.table(spark, sf_dir, "documents"))
    plan = queries.op4_license_scan(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
