"""The language models, chunk digests and additive model against plain dictionary versions."""

from __future__ import annotations

import collections
import math

import numpy as np
import pyarrow as pa

from folio.llm import kernels, op01_language, op03_substrings, op04_quality


def plain_symbols(text):
    """Letters in lower case, runs of all else one space."""
    out = []
    for ch in text + "\n":
        c = ch.lower() if ch.isalpha() and len(ch.lower()) == 1 else ch if ch.isalpha() else " "
        if c != " " or (out and out[-1] != " "):
            out.append(c)
    return out


class Plain:
    """Interpolated Kneser-Ney of order four from dictionaries."""

    def __init__(self, texts, order=4):
        self.order = order
        grams = collections.Counter()
        for t in texts:
            s = [" "] * (order - 1) + plain_symbols(t)
            for i in range(order - 1, len(s)):
                grams[tuple(s[i - order + 1 : i + 1])] += 1
        self.counts = {order: grams}
        for o in range(order - 1, 0, -1):
            self.counts[o] = collections.Counter(g[1:] for g in self.counts[o + 1])
        self.discount, self.totals, self.kinds = {}, {}, {}
        for o, c in self.counts.items():
            n1, n2 = (sum(v == k for v in c.values()) for k in (1, 2))
            self.discount[o] = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5
            self.totals[o], self.kinds[o] = collections.Counter(), collections.Counter()
            for g, v in c.items():
                self.totals[o][g[:-1]] += v
                self.kinds[o][g[:-1]] += 1

    def p(self, gram, vocabulary):
        o = len(gram)
        lower = 1 / vocabulary if o == 1 else self.p(gram[1:], vocabulary)
        total, d = self.totals[o][gram[:-1]], self.discount[o]
        if not total:
            return lower
        return max(self.counts[o][gram] - d, 0) / total + d * self.kinds[o][gram[:-1]] / total * lower

    def entropy(self, text, vocabulary):
        s = [" "] * (self.order - 1) + plain_symbols(text)
        return -sum(math.log(self.p(tuple(s[i - self.order + 1 : i + 1]), vocabulary)) for i in range(self.order - 1, len(s))) / (len(s) - self.order + 1)


def test_language_models_equal_dictionaries():
    train = {"en": ["the cat sat on the mat, and the dog barked at the cat", "A dog! The end of the day."], "de": ["der Hund sitzt auf der Matte und die Katze schläft", "Ende des Tages über dem Haus"]}
    counts = {}
    for lang, texts in train.items():
        key, _, _ = op01_language.symbols(texts)
        counts[lang] = np.unique(key, return_counts=True)
    model = op01_language.kneser_ney(counts)
    plain = {lang: Plain(t) for lang, t in train.items()}
    vocabulary = len({g for m in plain.values() for g in m.counts[1]}) + 1
    tests = ["the dog sat", "der Hund bellt", "Über 123 the Katze", "zzz qqq", "a"]
    h, letters = model.entropies(tests)
    for i, t in enumerate(tests):
        assert letters[i] == sum(c.isalpha() for c in t)
        for j, lang in enumerate(model.languages):
            assert abs(h[i, j] - plain[lang].entropy(t, vocabulary)) < 1e-4, (t, lang)
    assert [model.languages[k] for k in h.argmin(axis=1)[:2]] == ["en", "de"]


def test_long_texts_are_scored_in_windows(monkeypatch):
    texts = ["the cat sat on the mat " * 40 + "  ,, ! " * 30 + "end", "über den Häusern" * 30, ""]
    key, _, _ = op01_language.symbols(texts[:2])
    model = op01_language.kneser_ney({"x": np.unique(key, return_counts=True)})
    whole = model.entropies(texts)
    monkeypatch.setattr(op01_language, "CHARS", 37)
    parts = model.entropies(texts)
    assert np.allclose(whole[0], parts[0], atol=1e-9) and (whole[1] == parts[1]).all()


def test_long_texts_have_the_same_shingles(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["aa", "b", "ccc", "Dd"], 300)) + "  \n x", "w" * 500, " " * 300 + "a b c d e f", None, "q " * 200]
    whole = [s.tolist() for _, s in kernels.shingle_sets(pa.array(texts))]
    monkeypatch.setattr(kernels, "WINDOW", 64)
    monkeypatch.setattr(kernels.text_chunks, "__defaults__", (16,))
    assert [s.tolist() for _, s in kernels.shingle_sets(pa.array(texts))] == whole


def long_texts(rng):
    word = lambda: "".join(rng.choice(list("abcdéghÜ1.!|#"), int(rng.integers(1, 11))))
    return ["\n".join(" ".join(word() for _ in range(int(rng.integers(0, 12)))) for _ in range(300)), "same line\n" * 400 + "end", " ".join(word() for _ in range(2000)), " \n " * 900, "x" * 3000, "ü" * 2000 + " b\n"]


def test_long_texts_have_the_same_features_and_chunks(monkeypatch):
    texts = long_texts(np.random.default_rng(7))
    column = pa.array(texts)
    features = op04_quality.document_features(column)
    chunks = [tuple(np.concatenate(x).tolist()) for x in zip(*op03_substrings.chunk_table(pa.array(texts[:3:2])), strict=True)]
    monkeypatch.setattr(kernels, "WINDOW", 701)
    monkeypatch.setattr(kernels.text_chunks, "__defaults__", (16,))
    assert np.allclose(op04_quality.document_features(column), features)
    assert [tuple(np.concatenate(x).tolist()) for x in zip(*op03_substrings.chunk_table(pa.array(texts[:3:2])), strict=True)] == chunks
    for t in texts:  # chunks of any text, periodic ones too, cover it without gaps
        rows = [np.concatenate(x).tolist() for x in zip(*op03_substrings.chunk_table(pa.array([t])), strict=True)]
        assert rows[1] == list(range(len(rows[1]))) and rows[2] == [0, *rows[3][:-1]] and rows[3][-1] == len(t)


def test_additive_scores_are_sums_of_bins():
    rng = np.random.default_rng(6)
    x = rng.random((600, 4))
    y = ((x[:, 0] + x[:, 1] * x[:, 2]) > 0.8).astype(float)
    m = op04_quality.fit(x, y)
    for row, z in zip(x[:40], m.logits(x[:40]), strict=True):
        by_hand = m.intercept
        for f in range(4):
            by_hand += m.tables[f][sum(e <= row[f] for e in m.edges[f])]
        for f, g, t in m.pairs:
            by_hand += t[sum(e <= row[f] for e in m.coarse[f])][sum(e <= row[g] for e in m.coarse[g])]
        assert abs(by_hand - z) < 1e-9


def test_repeated_passages_equal_a_set_of_chunks(spark):
    """Digests of chunks in a dictionary: those of two documents or more, in runs of neighbours of twenty words."""
    rng = np.random.default_rng(12)
    word = lambda: "".join(rng.choice(list("abcdefgh"), int(rng.integers(2, 9))))
    shared = [" ".join(word() for _ in range(60)) for _ in range(5)]
    texts = [" ".join(word() for _ in range(30)) + " " + (shared[k % 5] + " " if k % 3 else "") + " ".join(word() for _ in range(40)) for k in range(40)] + [None, ""]
    chunks, where = [], collections.defaultdict(set)
    for row, k, s, e, n, h in op03_substrings.chunk_table(pa.array(texts)):
        for c in zip(row.tolist(), k.tolist(), s.tolist(), e.tolist(), n.tolist(), h.tolist(), strict=True):
            chunks.append(c)
            where[c[5]].add(c[0])
    want, run = set(), []
    for c in [*sorted(chunks), (None, 0, 0, 0, 0, 0)]:
        again = c[0] is not None and len(where[c[5]]) > 1
        if run and (not again or c[0] != run[-1][0] or c[1] != run[-1][1] + 1):
            if sum(x[4] for x in run) >= op03_substrings.MIN_WORDS:
                want.add((run[0][0], run[0][2], run[-1][3], sum(x[4] for x in run), min(min(where[x[5]]) for x in run)))
            run = []
        run += [c] if again else []
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["id"], r["start"], r["end"], r["words"], r["first_id"]) for r in op03_substrings.repeated_passages(d).collect()}
    assert got == want and want
