"""Closest titles, groups of similar ones, budgets and samples as set operations, against plain versions."""

import difflib
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.functions import extract, gate
from folio.operators import match, nearest, rank, titles

WORDS = [f"{a}{b}" for a in ("lun", "scre", "bio", "meth", "det", "can", "ge", "pro") for b in ("g", "ening", "marker", "ylation", "ection", "cer", "ne", "tein")]


def some_titles(seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        if out and r.random() < 0.4:
            t = list(r.choice(out))
            t[r.randrange(len(t))] = r.choice("xyz- ")
            out.append("".join(t))
        else:
            out.append(" ".join(r.choice(WORDS) for _ in range(r.randint(2, 11))))
    return out


def plain_nearest(asked, searched, k):
    want = {}
    for a_id, a in asked:
        ranked = sorted(((-difflib.SequenceMatcher(None, a, b).ratio(), b_id) for b_id, b in searched if b))
        want[a_id] = [(b_id, -r) for r, b_id in ranked[:k]] if a else []
    return {x: v for x, v in want.items() if v}


@pytest.mark.parametrize(("blocks", "often"), [((256, 4096), 64), ((7, 31), 3)])
def test_nearest_titles_equal_all_pairs(spark, monkeypatch, blocks, often):
    monkeypatch.setattr(nearest, "ASKED", blocks[0])
    monkeypatch.setattr(nearest, "SEARCHED", blocks[1])
    every = some_titles(1, 260)
    asked = [(k, t) for k, t in enumerate([*every[:25], "", None, "totally other words", every[40] * 3])]
    searched = [(1000 + k, t) for k, t in enumerate([*every[20:], *every[30:45], "", None])]  # some titles stand on several rows
    frames = [spark.createDataFrame(rows, f"{i} long, title string") for rows, i in ((asked, "a"), (searched, "b"))]
    key = lambda rows: [(k, " ".join((t or "").lower().split())) for k, t in rows]
    got = {}
    for r in nearest.nearest_titles(*frames, "a", "b", k=10, style="space", often=often).orderBy("a", "place").collect():
        got.setdefault(r["a"], []).append((r["b"], r["ratio"]))
        assert r["place"] == len(got[r["a"]])
    want = plain_nearest(key(asked), key(searched), 10)
    assert {k: [(b, round(x, 12)) for b, x in v] for k, v in got.items()} == {k: [(b, round(x, 12)) for b, x in v] for k, v in want.items()}


def test_nearest_titles_plan_has_no_cross_join(spark):
    a = spark.createDataFrame([(1, "one title")], "a long, title string")
    b = spark.createDataFrame([(2, "one titles"), (3, "another")], "b long, title string")
    d = nearest.nearest_titles(a, b, "a", "b")
    plan = d._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert [r["b"] for r in d.orderBy("place").collect()] == [2, 3]


def test_nearest_titles_of_the_given_table(spark, sf):
    from folio.plans import documents, linking

    got = {(r["id"], r["place"]): (r["found"], r["ratio"]) for r in linking.nearest_titles(spark, sf).collect()}
    keyed = lambda d: d.select("id", match.title_key(F.col("title"), "eval").alias("k"))
    index = documents.pubs(spark, sf).select("id", "title")
    asked = spark.read.parquet(f"{sf}/benchmark.parquet").selectExpr("item_id AS id", "substring(split_part(text, '.', 1), 1, 80) AS title")
    known = {r["title"] for r in index.collect()}
    asked = [(r["id"], r["k"]) for r in keyed(asked.where(~F.col("title").isin(*[t for t in known if t]))).collect()]
    want = plain_nearest(asked, [(r["id"], r["k"]) for r in keyed(index).collect()], 10)
    assert got == {(a, n + 1): (b, pytest.approx(x, abs=1e-6)) for a, v in want.items() for n, (b, x) in enumerate(v)}


def test_common_subsequence_bounds():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
        return row[-1]

    r = random.Random(2)
    texts = ["".join(r.choice("abcdé ") for _ in range(r.randint(1, 150))) for _ in range(40)]
    for a in texts[:12]:
        codes, _ = nearest._codes(texts)
        assert nearest.common(a, codes).tolist() == [plain(a, b) for b in texts]


def groups_of(links, names):
    label = {n: n for n in names}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def plain_groups(keys, least):
    sets = {k: set(k.split(" ")) for k in keys}
    pairs = [(a, b) for a in keys for b in keys if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) > least]
    return groups_of(pairs, keys), len(pairs)


@pytest.mark.parametrize("small", [32, 1])
def test_links_join_the_same_groups_as_all_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(titles, "SMALL", small)  # 1: all words that hold several groups go in blocks
    monkeypatch.setattr(titles, "BLOCK", 16)
    r = random.Random(7)
    keys = set()
    for g in range(40):
        base = [r.choice(WORDS) for _ in range(r.randint(3, 14))]
        for _ in range(r.randint(1, 6)):
            t = list(base)
            if r.random() < 0.8:
                t[r.randrange(len(t))] = f"n{r.randint(0, 9)}"
            keys.add(" ".join(dict.fromkeys(t)))
    keys |= {f"case {k} of the same long template with many more words than it could ever need" for k in range(60)}
    keys = sorted(keys)
    for least in (0.85, 0.6):
        links = [tuple(x) for x in titles.linked_keys(spark.createDataFrame([(k,) for k in keys], "k string"), least).collect()]
        want, n_pairs = plain_groups(keys, least)
        assert groups_of(links, keys) == want
        assert len(links) < n_pairs / 3


def test_template_titles_make_few_links(spark):
    n = 1500
    keys = spark.range(n).selectExpr("concat('annual report number ', id, ' of the committee on early detection and screening of several diseases') AS k")
    links = titles.linked_keys(keys)
    rows = [tuple(r) for r in links.collect()]
    assert len(rows) <= 2 * n
    assert len(set(groups_of(rows, {x for p in rows for x in p}).values())) == 1


def test_title_groups_share_titles_too(spark):
    d = spark.createDataFrame([(1, "Same Title"), (2, "same  title"), (3, "other"), (4, None), (5, "")], "id long, title string")
    assert {tuple(r) for r in match.title_groups(d, "id").collect()} == {(1, 1), (2, 1), (3, 3)}


# ---------------------------------------------------------------- budgets


def plain_budget(rows, budget):
    left, out = {}, {}
    for g, r, s in sorted(rows, key=lambda x: (str(x[0]), x[1])):
        room = left.setdefault(g, budget)
        fits = s is not None and 0 <= s <= room
        left[g] -= s if fits else 0
        out[g, r] = fits
    return out


@pytest.mark.parametrize("budget", [1, 7, 100, 5000])
def test_budget_equals_the_walk(spark, monkeypatch, budget):
    r = random.Random(budget)
    rows = [(g, k, r.choice([0, 1, 2, 3, None, -5, r.randint(1, 20), r.randint(1, 2 * budget), budget, budget + 1])) for g in ("a", "b", "c", None) for k in range(r.randint(1, 120))]
    df = spark.createDataFrame(rows, "g string, r int, s long")
    got = {(x["g"], x["r"]): x["attached"] for x in rank.byte_budget(df, "g", "r", "s", budget).collect()}
    assert got == plain_budget(rows, budget)
    monkeypatch.setattr(rank, "RANGE_ROWS", 25)  # sums in ranges
    got = {(x["g"], x["r"]): x["attached"] for x in rank.byte_budget(df, "g", "r", "s", budget).collect()}
    assert got == plain_budget(rows, budget)


def test_budget_plan_has_no_python(spark):
    df = spark.range(1000).selectExpr("1 AS g", "id AS r", "id % 37 AS s")
    d = rank.byte_budget(df, "g", "r", "s", 500)
    assert "Python" not in d._jdf.queryExecution().toString() and "FlatMapGroups" not in d._jdf.queryExecution().toString()
    assert {r["r"]: r["attached"] for r in d.collect()} == {r: v for (_, r), v in plain_budget([(1, k, k % 37) for k in range(1000)], 500).items()}


def test_budget_of_nothing(spark):
    assert rank.byte_budget(spark.createDataFrame([], "g string, r int, s long"), "g", "r", "s", 10).count() == 0
    d = rank.byte_budget(spark.createDataFrame([("a", 1, 99), ("a", 2, 0)], "g string, r int, s long"), "g", "r", "s", 10)
    assert sorted((x["r"], x["attached"]) for x in d.collect()) == [(1, False), (2, True)]


# ---------------------------------------------------------------- samples


@pytest.mark.parametrize("ranked", [100_000, 5])
def test_audit_takes_the_smallest_hashes(spark, monkeypatch, ranked):
    monkeypatch.setattr(gate, "RANKED", ranked)
    monkeypatch.setattr(gate, "DIGITS", 1)
    d = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'high' ELSE 'low' END AS gate_bucket")
    for rate in (0.0004, 0.02, 0.5, 1.0):
        low = sorted((k for k in range(3000) if k % 3), key=lambda k: hashlib.md5(f"audit:{k}".encode()).hexdigest())
        got = gate.audit(d, "id", rate)
        assert "Limit" not in got._jdf.queryExecution().toString()
        assert {r["id"] for r in got.where("audit_selected").collect()} == set(low[: max(1, int(len(low) * rate))])
    assert gate.audit(d, "id", 0).where("audit_selected").isEmpty()


# ---------------------------------------------------------------- commercial signals

PHRASES = [
    ("funded by Alpha Labs; x", "sponsor_names", "Alpha Labs"), ("Supported by Beta Fund/ y", "sponsor_names", "Beta Fund"), ("a grant from Gamma_", "sponsor_names", "Gamma"),
    ("sponsored by Delta Inc.", "sponsor_names", "Delta Inc"), ("funding provided by Epsilon Ltd:", "sponsor_names", "Epsilon Ltd"), ("research supported by Zeta!", "sponsor_names", "Zeta"),
    ("employee of Eta Co", "company_names", "Eta Co"), ("consultant for Theta (x)", "company_names", "Theta"), ("affiliated with Iota;", "company_names", "Iota"),
    ("conflict of interest: 1) Kappa Corp/", "company_names", "Kappa Corp"), ("received compensation from Lambda?", "company_names", "Lambda"), ("Disclosure - (1) Mu Partners!", "company_names", "Mu Partners"),
]


@pytest.mark.parametrize(("text", "kind", "name"), PHRASES)
def test_each_commercial_pattern(text, kind, name):
    got = extract.commercial_of(f"Results. {text}")
    assert name in got[kind] or any(name in x for x in got[kind])
    assert got["has_sponsor_signal"] == (kind == "sponsor_names") and got["company_affiliation_signal"] == (kind == "company_names")


def test_commercial_names_come_in_the_order_of_patterns():
    text = "Disclosure: (a) Zeta Inc! conflict of interest: (b) Beta Ltd! received compensation from Gamma. employee of Alpha!"
    got = extract.commercial_of(text)
    first = [next(i for i, x in enumerate(got["company_names"]) if n in x) for n in ("Alpha", "Beta", "Gamma")]
    assert first == sorted(first) and got["company_names"][-1].startswith(("a", "Zeta"))
    assert len(got["snippets"]) == 2 and all(len(s) <= 160 for s in got["snippets"])
    assert extract.commercial_of(None) == {"sponsor_names": [], "company_names": [], "snippets": [], "has_sponsor_signal": False, "company_affiliation_signal": False}


def test_seeds_never_cost_a_title(spark):
    """A floor is a ratio that k rows reach, so it never exceeds the k-th best ratio."""
    every = some_titles(9, 120)
    asked = spark.createDataFrame([(t,) for t in set(every[:30])], "a string")
    searched = spark.createDataFrame([(t, 1) for t in set(every[20:])], "b string, n long")
    floors = {r["a"]: r["floor"] for r in nearest._seeds(asked, searched, 3, 64).collect()}
    for a, floor in floors.items():
        best = sorted((difflib.SequenceMatcher(None, a, b).ratio() for b in set(every[20:])), reverse=True)
        assert floor <= best[2] + 1e-12
    assert any(np.array(list(floors.values())) > 0)


def test_ratios_equal_those_of_the_standard_library():
    r = random.Random(1)
    texts = ["".join(r.choice("abcdeé fgh") for _ in range(r.randint(1, 90))) for _ in range(150)] + ["ab" * 40, "aaaa", "x" * 230, "ab" * 120, "日本語のタイトル", "z"]
    codes, size = nearest._codes(texts)
    for a in [*texts[:6], *texts[-6:]]:
        assert nearest.ratios(a, texts, codes, size).tolist() == [difflib.SequenceMatcher(None, a, t).ratio() for t in texts]
