import numpy as np

import brute
import corpus_pipeline
from quizlog.llm import best_fit_packing, decontaminate, quality_rules


def test_stages_one_by_one_and_run(spark, corpus, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns and got.dtypes == docs.dtypes
        rows = [tuple(r) for r in got.collect()]
        assert not set(map(str, rows)) - {str(tuple(r)) for r in docs.collect()}  # rows unchanged
        left[name] = (docs, rows)
        docs = spark.createDataFrame(rows, docs.schema)
    before, after = left["language_id"]
    assert {str(r["doc_id"]) for r in before.collect()} - {str(r[0]) for r in after} == {"62", "63", "64"}
    # quality: whatever the rules fail must go
    before, after = left["quality_rules"]
    model = quality_rules.train(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = sorted(str(r["doc_id"]) for r in quality_rules.score(before, model).where("kept").collect())
    assert sorted(str(r[0]) for r in after) == kept
    # near-dedup: one of each group by brute force
    before, after = left["simhash_near_dedup"]
    rows = [r for r in before.collect() if r["doc_id"] is not None]
    best = brute.groups([brute.fingerprint(r["text"]) for r in rows])
    least = {}
    for r, b in zip(rows, best):
        least[b] = min(least.get(b, r["doc_id"]), r["doc_id"])
    assert sorted(r[0] for r in after if r[0] is not None) == sorted(least.values())
    before, after = left["benchmark_decontamination"]
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = {r["doc_id"] for r in decontaminate.overlaps(before, bench).collect()}
    assert sorted(str(r[0]) for r in after) == sorted(str(r["doc_id"]) for r in before.collect() if r["doc_id"] not in bad)
    # run() packs exactly what is left
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = sorted(map(str, best_fit_packing.pieces(docs).select(*key).collect()))
    out = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(str, out.select(*key).collect())) == want
    fill = out.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in fill) <= 2048
    assert len(fill) <= 1 + -(-sum(r[1] for r in fill) // 2048)
    assert np.all(np.array([r["offset"] for r in out.collect()]) >= 0)


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
