import pytest

import brute
from quizlog.llm import license_scan as L

CASES = [
    (1, "cc by nc cc by nc"), (2, None), (3, ""), (4, "Under THE, mit-License! xcc by nc cc by ncx\nLICENSED under cc\tby nc 4 0 é"),
    (5, "under the mit\nlicense"), (6, "ſ K İ under the mit license under the MIT license"), (7, "apache License Version 20 apache license version 2"),
    (8, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and documentation files"),
    (9, "released the mit\nunder license"), (10, "word " * 20000 + "under the mit license"), (10, "cc by nc"), (None, "cc by nc"),
    (11, "This is licensed under the GNU General Public License, version 3."), (12, "éunder the mit license cc by nc"),
    (13, "license 😀 apache license version 2"), (14, "redistribution and use in source " * 3),
]


def want(text, templates, containment):
    t = brute.lower(text)
    w = brute.ALNUM.findall(t)
    places = []
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        places += [(k, label) for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
    labels, best = {x for _, x in places}, 0.0
    found = set(labels)
    for line in t.split("\n"):
        block = set(brute.ALNUM.findall(line))
        for label, text_ in templates:
            need = set(text_.split())
            share = len(need & block) / len(need)
            if share >= containment - 1e-9:
                found.add(label)
                best = max(best, share)
    at = [k for k, _ in places]
    return (len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(found)),
            1.0 if places else best)


@pytest.mark.parametrize("containment", [0.9, 0.5])
def test_against_brute_force(spark, corpus, containment):
    docs = spark.createDataFrame(CASES, "doc_id long, text string").unionByName(corpus.select("doc_id", "text"))
    got = sorted((str(tuple(r)) for r in L.scan_licenses(docs, containment=containment).collect()))
    assert got == sorted(str((r["doc_id"], *want(r["text"], L.TEMPLATES, containment))) for r in docs.collect())


def test_clashing_and_empty(clashing, corpus, empty):
    assert sorted(map(str, L.scan_licenses(clashing).collect())) == sorted(map(str, L.scan_licenses(corpus).collect()))
    assert L.scan_licenses(empty).count() == 0


def test_no_python_in_the_plan(corpus, spark, sf_dir):
    plan = L.query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
