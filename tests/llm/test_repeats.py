"""Repeated and null ids, ties and equal rows in the operators that decide by row."""

from __future__ import annotations

import collections

from folio.llm import op05_mixing, op06_minhash

ROWS = "doc_id long, text string, lang string, source string, n_chars long, id long, size long, key string, copy long, src string, vft double"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *(None,) * 6) for i, t, s in rows], ROWS)


def test_mixing_takes_equal_rows_one_by_one(spark):
    rows = [(7, "w " * 100, "a")] * 500 + [(None, "u " * 50, "a")] * 300 + [(i, "x " * (i % 90), "b" if i % 2 else None) for i in range(2000)] + [(9, None, "c")] * 50
    mixed = op05_mixing.mixed_documents(docs_of(spark, rows).repartition(5)).collect()
    assert len(mixed) == len(rows)
    words, target, largest = collections.Counter(), {}, {}
    for r in mixed:
        words[r["source"]] += r["_taken"]
        target[r["source"]] = r["_target"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["_size"])
        assert 0 <= r["_copies"] <= 2 and r["_taken"] == r["_copies"] * r["_size"]
    assert target["c"] == 0 and words["c"] == 0
    assert all(abs(words[s] - t) <= largest[s] for s, t in target.items())
    again = op05_mixing.mixed_documents(docs_of(spark, rows).repartition(3)).collect()
    per = lambda out: collections.Counter((r["doc_id"], r["source"], r["_size"], r["_copies"]) for r in out)
    assert per(mixed) == per(again)


def test_mixing_deals_large_groups_in_parts(spark):
    groups = spark.createDataFrame([("a", "k", 3, 2), ("a", "l", 5, 10), ("b", "k", 1, 1)], "src string, key string, size long, n long")
    got = collections.Counter((r["src"], r["key"], r["copy"]) for r in op05_mixing.copies_of(groups, 4).collect())
    assert got == collections.Counter([("a", "k", 1), ("a", "k", 2), *[("a", "l", i) for i in range(1, 11)], ("b", "k", 1)])
    passes = spark.createDataFrame([(k / 1000, 2) for k in range(1000)] + [(0.5, 2)] * 40, "vft double, size long")
    low, high, before = op05_mixing.budget_end(passes, 1010.0, ranges=4, most_rows=8)
    assert before <= 1010 and passes.where(f"vft < {low!r}").agg({"size": "sum"}).first()[0] == before
    assert passes.where(f"vft < {high!r}").agg({"size": "sum"}).first()[0] > 1010


A, B, C = "a b c d e f g", "h i j k l m n o", "p q r s t u v"


def test_near_copies_go_by_row(spark):
    rows = [(3, B, "s"), (5, A, "s"), (5, B, "s"), (9, C, "s"), (9, C, "s"), (9, C.upper(), "s"), (None, C, "s"), (None, "only here once", "s"), (None, "only here once", "s"), (4, "", "s"), (4, "", "s"), (6, None, "s")]
    out = op06_minhash.without_near_duplicates(docs_of(spark, rows))
    assert out.columns == docs_of(spark, rows).columns
    left = sorted(((r["doc_id"], (r["text"] or "").lower()) for r in out.collect()), key=repr)
    assert left == sorted([(3, B), (5, A), (9, C), (None, "only here once"), (4, ""), (4, ""), (6, "")], key=repr)
    assert op06_minhash.without_near_duplicates(docs_of(spark, rows).limit(0)).count() == 0


def test_components_end_at_stars(spark):
    from folio.llm.common import are_stars, connected_components

    frame = lambda pairs, names: spark.createDataFrame(pairs, ", ".join(f"{n} long" for n in names))
    assert are_stars(frame([(5, 1), (6, 1), (9, 2)], "uv"))
    assert not are_stars(frame([(5, 1), (5, 2)], "uv")) and not are_stars(frame([(5, 3), (3, 1)], "uv"))
    got = {r["id"]: r["label"] for r in connected_components(frame([(k, k + 1) for k in range(50)] + [(100, 7), (200, 201), (8, 8)], "ab")).collect()}
    assert got == {**dict.fromkeys(range(51), 0), 100: 0, 200: 200, 201: 200}
    import pytest

    with pytest.raises(RuntimeError):
        connected_components(frame([(k, k + 1) for k in range(50)], "ab"), 1)
