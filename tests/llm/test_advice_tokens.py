"""Token files are read in ranges, and op9 counts from files that it has written."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from folio.llm import op02_packing, op09_tokens


def test_one_file_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    ids = np.random.default_rng(1).integers(0, 60, 20_000).astype("<u2")
    ids[ids == 7] = op09_tokens.SEPARATOR
    (tmp_path / "one.bin").write_bytes(ids.tobytes())
    (tmp_path / "empty.bin").write_bytes(b"")
    monkeypatch.setattr(op09_tokens, "RANGE", 4, raising=False)
    blocks = op09_tokens.read_token_files(spark, str(tmp_path), block=128)
    tasks = blocks.withColumn("task", F.spark_partition_id()).select("task", "block", F.length("data").alias("n")).collect()
    assert len({r["task"] for r in tasks}) > 20 and max(r["n"] for r in tasks) == 256
    assert sorted(r["block"] for r in tasks) == list(range(157))
    got = [r["n_tokens"] for r in op09_tokens.token_counts(blocks).orderBy("ordinal").collect()]
    ends = np.append(np.flatnonzero(ids == op09_tokens.SEPARATOR), len(ids))
    want = (np.diff(ends, prepend=-1) - 1).tolist()
    assert got == (want if want[-1] else want[:-1])


def test_file_beyond_the_limit_of_binary_file(spark, tmp_path):
    with open(tmp_path / "big.bin", "wb") as f:
        f.seek(2 * (3 << 29))
        f.write(np.array([op09_tokens.SEPARATOR, 5], "<u2").tobytes())
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")  # no content is read through that source
    try:
        blocks = op09_tokens.read_token_files(spark, str(tmp_path), block=1 << 22)
        got = [(r["n_tokens"], r["closed"]) for r in op09_tokens.token_counts(blocks).orderBy("ordinal").collect()]
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert got == [(3 << 29, True), (1, False)]


def test_op9_counts_from_its_files(spark, sf, tmp_path, monkeypatch):
    texts = [None, "", "one two", "é ü", "a b c " * 500]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 5)] + [(None, "x y")], "doc_id long, text string").repartition(3)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    used = []
    plain = op09_tokens.read_token_files
    monkeypatch.setattr(op09_tokens, "read_token_files", lambda *a, **k: used.append(a[1]) or plain(*a, **k))
    rows = op09_tokens.op9_tokens(spark, str(tmp_path)).collect()
    enc = op02_packing.encoder(op02_packing.vocabulary())
    want = {i: len(enc.encode_ordinary(t or "")) for i, t in enumerate(texts * 5)} | {None: len(enc.encode_ordinary("x y"))}
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want and len(rows) == 26 and used
    d.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op09_tokens.op9_tokens(spark, f"{tmp_path}/none").count() == 0
