import os

import corpus_pipeline
import __spark_entry__ as entry
from wastelake.llm import packing, quality, secrets, simhash

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_documents(spark, docs, nothing, tmp_path):
    """Each stage keeps the columns, drops or keeps what its operator says, and works on the last one's rows."""
    table = docs
    counts = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, table, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        counts[name] = after.count()
        if name == "quality_rules":
            assert counts[name] == quality.verdicts(table).filter("kept").count()
        if name == "simhash_near_dedup":
            labels = simhash.near_duplicates(table, 4, 4)
            assert counts[name] == labels.select("component_id").distinct().count()
        if name == "secret_scans":
            assert counts[name] == table.count() and secrets.scanned(after).filter("spans <> ''").count() == 0
        if name != "packing":
            assert after.columns == docs.columns
            table = after
    assert counts["packing"] >= counts["mixing"] > 0
    empty = nothing
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
    assert empty.count() == 0


def test_run_covers_the_mix(spark):
    if not os.path.isdir(FOLDER):
        return
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    lengths = {}
    for r in rows:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert rows and max(lengths.values()) <= packing.LENGTH
    starts = {}
    for r in rows:
        starts.setdefault(r.doc_id, []).append(r.length)
    totals = {r.doc_id: r.doc_tokens for r in rows}
    assert all(sum(v) % totals[i] == 0 for i, v in starts.items())


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
