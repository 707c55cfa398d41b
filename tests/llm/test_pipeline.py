"""The pipeline's stages, each checked against a plain version on a small input."""

from __future__ import annotations

import collections

import corpus_pipeline
from folio.llm import op02_packing, op05_mixing, op06_minhash, op08_secrets
from folio.llm.common import table


def test_stages(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "secrets", "mixing", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        kept[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = kept[name][1]
        if name != "packing":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    before, after = kept["quality"]
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    left = {r["doc_id"] for r in after.collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert len([i for i in good if i in left]) >= 0.97 * len(good)
    assert before.count() > after.count()
    before, after = kept["near_dedup"]
    want = {r["id"] for r in op06_minhash.near_duplicates(before).where("kept").collect()}
    assert {r["doc_id"] for r in after.collect()} == want
    before, after = kept["secrets"]
    old = {r["doc_id"]: r["text"] for r in before.collect()}
    for r in after.collect():
        base, added = op08_secrets.find_secrets(old[r["doc_id"]])
        assert r["text"] == op08_secrets.redacted(old[r["doc_id"]], base + added)
        assert op08_secrets.find_secrets(r["text"])[0] == [] and r["n_chars"] == len(r["text"])
    before, after = kept["mixing"]
    copies = {r["doc_id"]: r["_copies"] for r in op05_mixing.mixed_documents(before).collect() if r["_copies"]}
    assert collections.Counter(r["doc_id"] for r in after.collect()) == copies
    before, after = kept["packing"]
    enc = op02_packing.encoder(op02_packing.vocabulary())
    total = sum(len(op02_packing.token_ids(enc, r["text"])) + 1 for r in before.collect())
    assert after.agg({"length": "sum"}).first()[0] == total
    assert after.select("sequence_id").distinct().count() <= 1.05 * total / 1024 + 4


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
