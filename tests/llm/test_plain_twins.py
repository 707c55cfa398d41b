"""Plain loops beside the vectorised parts: chunk borders, linked credentials, the additive fit."""

import random

import numpy as np
import pytest

pytest.importorskip("folio.llm")

from folio.llm import op03_substrings as substrings  # noqa: E402
from folio.llm import op04_quality as quality  # noqa: E402
from folio.llm import op08_secrets as secrets  # noqa: E402


def plain_borders(text: bytes) -> set[int]:
    """Places whose hash of the sixteen bytes before is the least within twenty places on either side."""
    never = 2**32
    key = []
    for p in range(len(text)):
        inside = p >= substrings.REACH and text[p] & 0xC0 != 0x80
        key.append(sum(int(substrings.GEAR[text[p - 1 - k]]) << 2 * k for k in range(16)) % 2**32 if inside else never)
    near = lambda p: key[max(0, p - substrings.REACH) : p + substrings.REACH + 1]
    return {0, *(p for p in range(len(text)) if key[p] < never and key[p] == min(near(p)))} if text else set()


def test_borders_equal_a_plain_loop():
    r = random.Random(12)
    texts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz äé\n") for _ in range(n)).encode() for n in (0, 1, 19, 20, 21, 300, 2000, 41)]
    b = np.frombuffer(b"".join(texts), np.uint8)
    off = np.cumsum([0, *map(len, texts)])
    cut = substrings.boundaries(b, off)
    for t, a in zip(texts, off[:-1].tolist(), strict=True):
        assert set(np.flatnonzero(cut[a : a + len(t)]).tolist()) == plain_borders(t)


def plain_links(base, weak, scope):
    out = []
    for s, e, k in weak:
        covered = any(x < e and y > s for x, y, _ in base)
        near = any(kind in secrets.COMPLEMENTS[k] and x <= e + scope and y >= s - scope for x, y, kind in base + weak)
        if near and not covered:
            out.append((s, e, k))
    return out


def test_linked_parts_equal_all_pairs():
    r = random.Random(3)
    for _ in range(300):
        spans = lambda kinds, n: [(s, s + r.randint(1, 60), r.choice(kinds)) for s in (r.randint(0, 1500) for _ in range(r.randint(0, n)))]
        base, weak = spans(("assign", "access", "hex"), 4), spans(tuple(secrets.COMPLEMENTS), 8)
        assert sorted(secrets.linked(base, weak, 200)) == sorted(plain_links(base, weak, 200))


def test_linked_parts_of_texts():
    r = random.Random(4)
    pieces = ["AKIA" + "A1B2" * 5, "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "user: admin", "https://db.example.org/x", "password=hunter22", "0123456789abcdef01234567", "plain words", "\n" * 150, "x" * 120]
    for _ in range(150):
        text = " ".join(r.choice(pieces) for _ in range(r.randint(1, 9)))
        base, added = secrets.find_secrets(text)
        assert sorted(added) == sorted(plain_links(base, secrets.weak_parts(text), secrets.SCOPE))


def test_fitted_scores_are_sums_of_tables():
    """A fit on two informative features ranks nearly as the best possible rule does, and a constant one adds nothing."""
    r = np.random.default_rng(6)
    x = np.zeros((3000, len(quality.FEATURES)))
    x[:, 0], x[:, 3] = r.normal(size=3000), r.uniform(size=3000)
    z = 2 * x[:, 0] + 4 * (x[:, 3] > 0.5) - 2 + 3 * (x[:, 0] > 0) * (x[:, 3] < 0.2)
    y = (r.uniform(size=3000) < 1 / (1 + np.exp(-z))).astype(float)
    model = quality.fit(x[:2000], y[:2000])
    p = model.scores(x[2000:])

    def auc(score):
        order = np.argsort(score)
        rank = np.empty(1000)
        rank[order] = np.arange(1, 1001)
        n = y[2000:].sum()
        return (rank[y[2000:] == 1].sum() - n * (n + 1) / 2) / (n * (1000 - n))

    assert auc(p) > auc(z[2000:]) - 0.02 and ((p >= 0) & (p <= 1)).all()
    shifted = x[2000:].copy()
    shifted[:, 7] += 5  # never seen to matter
    assert np.allclose(model.scores(shifted), p)
