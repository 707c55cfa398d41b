"""Turn repair, token alignment and suffix dedup against plain versions of their contracts."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("folio.llm")

from folio.llm import kernels, op11_conversations as conversations  # noqa: E402
from folio.llm import op12_alignment as alignment  # noqa: E402
from folio.llm import op13_suffixes as suffixes  # noqa: E402

CONVERSATIONS = "conv_id long, turn long, role string, text string"
DOCUMENTS = "doc_id long, text string, source string, _p string, first long"


# ---------------------------------------------------------------- conversations


def plain_damage(rows):
    """Conversation: rows after damage, in order."""
    every, live = set(), defaultdict(list)
    for conv, turn, role, text in rows:
        every.add(conv)
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        live[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(live[c], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c in every}


def plain_faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain_repair(rows, faults, inserts):
    """All edits in every way, with at most `inserts` insertions at a place: the least (cost, audit) and its lines."""
    best = None

    def go(i, cost, audit, roles, lines, put):
        nonlocal best
        if best and cost > best[0]:
            return
        if not re.fullmatch("s?(ua)*u?", roles):
            return
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
        else:
            _, role, text = rows[i]
            go(i + 1, cost + 3, audit + "D", roles, lines, 0)
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                if role:
                    go(i + 1, cost + more, audit + "K", roles + role[0], [*lines, f"{role}:{text}"], 0)
                for to in ("user", "assistant"):
                    go(i + 1, cost + 2 + more, audit + "R", roles + to[0], [*lines, f"{to}:{text}"], 0)
        if put < inserts:
            for to in ("user", "assistant"):
                go(i, cost + 2, audit + "I", roles + to[0], [*lines, f"{to}:"], put + 1)

    go(0, 0, "", "", [], 0)
    return best


def plain_result(rows):
    faults = plain_faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, lines = plain_repair(rows, faults, 2)
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, sha)


def made_conversations(seed, n, longest):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(r.randint(1, longest)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = r.choice(["Fine.", "Why?", "no end", "", None, " \t\n", f"Text {r.random()}!", "Same.  "])
            rows.append((conv if conv else None, r.choice([turn, turn, turn, None, turn + 3]), role, text))
    return rows


def test_edits_are_the_cheapest_and_first(spark):
    rows = made_conversations(5, 60, 5)
    want = {c: plain_result(r) for c, r in plain_damage(rows).items()}
    df = spark.createDataFrame([(*r, 1) for r in rows], CONVERSATIONS + ", fault int")  # a column of a name used inside
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.repaired(conversations.damaged(df)).collect()}
    assert got == want
    assert {"D", "I", "K", "R"} <= set("".join(x[6] for x in want.values()))


def test_conversations_of_the_given_table(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    want = {c: plain_result(r) for c, r in plain_damage([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]).items()}
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.op11_conversations(spark, sf).collect()}
    assert got == want


def test_stretches_give_what_one_search_gives(monkeypatch):
    r = random.Random(8)
    for n in (0, 1, 7, 60, 300):
        codes = bytes(4 * r.randint(0, 3) + r.choice([0, 0, 0, 1, 2]) for _ in range(n))
        monkeypatch.setattr(conversations, "STRETCH", 1000)
        whole = conversations.cheapest(codes)
        for stretch in (1, 2, 5, 32):
            monkeypatch.setattr(conversations, "STRETCH", stretch)
            assert conversations.cheapest(codes) == whole


def test_long_conversations_are_hashed_in_a_second_pass(spark):
    rows = made_conversations(15, 12, 5) + [(50, k, ("user", "assistant")[k % 2], f"Turn {k}" + "!" * (k % 7 > 0)) for k in range(700)]
    damaged = conversations.damaged(spark.createDataFrame(rows, CONVERSATIONS))
    want = sorted(conversations.repaired(damaged).collect(), key=str)
    assert sorted(conversations.repaired(damaged, hold=100).collect(), key=str) == want
    assert conversations.Repair(10).result()[-1] == hashlib.sha256(b"").hexdigest()


def test_conversations_without_rows(spark):
    assert conversations.repaired(conversations.damaged(spark.createDataFrame([], CONVERSATIONS))).count() == 0
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = conversations.repaired(conversations.damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], CONVERSATIONS))).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# ---------------------------------------------------------------- token alignment


def plain_alignment(docs):
    """[(n_a, n_b, n_groups, n_links, n_best, count_sum, sha)] of texts, from the JSON form of A."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = dict(zip(map(chr, shown), shown, strict=True)) | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown)}
    name = {v: k for k, v in a.get_vocab().items()}
    made, counts = [], Counter()
    for text in docs:
        ids_a, ids_b = (a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        bytes_a = [bytes(letters[c] for c in name[k]) for k in ids_a]
        pieces = [b.id_to_piece(k) for k in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        if not (b"".join(bytes_a) == b"".join(bytes_b) == f" {text}".encode()):
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        at_a = dict(zip(itertools.accumulate(map(len, bytes_a)), ids_a, strict=True))
        at_b = dict(zip(itertools.accumulate(map(len, bytes_b)), ids_b, strict=True))
        ends = sorted(at_a.keys() & at_b.keys())
        groups = [(",".join(str(i) for e, i in at_a.items() if lo < e <= hi), ",".join(str(i) for e, i in at_b.items() if lo < e <= hi)) for lo, hi in itertools.pairwise([0, *ends])]
        links = [(at_a[e], at_b[e]) for e in ends]
        counts.update(links)
        made.append((len(ids_a), len(ids_b), groups, links))
    most = Counter()
    for (_, k), n in counts.items():
        most[k] = max(most[k], n)
    out = []
    for n_a, n_b, groups, links in made:
        text = ";".join(f"{x}|{y}" for x, y in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        out.append((n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), sha))
    return out


ODD = [None, "", " ", "a", "Wörter und\n\n  mehr", "a▁b", "<|endoftext|> </s> <s> <0x41>", "\x00\x7f‍ 👩‍👩‍👧 ﬁ", "same text here", "same text here", "x" * 3000, "many words " * 2000]


def test_alignment_against_plain_version(spark, monkeypatch, sf):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(25).collect()]
    want = sorted(zip([None, 7, 7, *range(3, len(texts))], plain_alignment(texts), strict=True), key=str)
    rows = [(k, t, "s", None, 1) for (k, t) in zip([None, 7, 7, *range(3, len(texts))], texts, strict=True)]
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 5000)  # several blocks a partition
    df = spark.createDataFrame(rows, DOCUMENTS + "").repartition(3)
    got = [(r["id"], tuple(r)[1:]) for r in alignment.aligned(df).collect()]
    assert sorted(got, key=str) == want
    assert sum(w[1][0] > 0 for w in want) > 25 and any(r[1] and not w[0] for r, w in zip(rows, plain_alignment(texts), strict=True))
    assert alignment.aligned(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_token_groups_spell_the_text(spark):
    texts = ["Zwei Wörter, 12345 und <|endoftext|>", "\n\n  tail ", None, "a▁b"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    p = alignment.pair(alignment.vocabulary(), alignment.pieces_path())
    rows = alignment.token_groups(df).orderBy("id", "grp").collect()
    assert {r["id"] for r in rows} == {0, 1}
    for k in (0, 1):
        whole, at = f" {texts[k]}".encode(), 0
        for r in (r for r in rows if r["id"] == k):
            assert r["start"] == at < r["end"]
            part, at = whole[at : r["end"]], r["end"]
            assert b"".join(p.of_a.pieces[r["a_ids"]]) == b"".join(p.of_b.pieces[r["b_ids"]]) == part
        assert at == len(whole)


# ---------------------------------------------------------------- suffixes


def plain_cut(texts, length):
    """[(bytes, removed, spans, what is left)]"""
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, bytes(x for x, g in zip(t, gone, strict=False) if not g)))
    return out


def made_texts(seed, length):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(length // 3) for _ in range(4)]
    texts = [None, "", "short", "x" * (length - 1), "y" * (3 * length), "ab " * length, "line of the same kind\n" * (length // 8)]
    for k in range(40):
        parts = [prose(r.randint(1, length // 2)) for _ in range(3)]
        parts.insert(1, shared[k % 4][r.randint(0, 30) :])
        if k % 3 == 0:
            parts.append(shared[(k + 1) % 4][: r.randint(length // 2, 3 * length)])
        if k % 7 == 0:
            parts.append(parts[1])
        texts.append(" ".join(parts))
    copy = texts[10]
    return [*texts, copy, copy, copy[: len(copy) // 2] + "!" + copy[len(copy) // 2 :]]


@pytest.mark.parametrize(("length", "reach", "batches"), [(60, 24, 4), (100, 32, 1), (400, 224, 7)])
def test_strings_that_repeat_are_cut(spark, monkeypatch, length, reach, batches):
    monkeypatch.setattr(suffixes, "REACH", reach)
    monkeypatch.setattr(kernels, "WINDOW", 700)  # most texts are read in pieces
    monkeypatch.setattr(kernels, "CHUNK", 600)
    texts = made_texts(length, length)
    want = plain_cut(texts, length)
    ids = [None, None, 5, 5, *range(6, len(texts) + 2)]
    df = spark.createDataFrame([(k, t, "s", "p", 3) for k, t in zip(ids, texts, strict=True)], DOCUMENTS).repartition(4)
    found = suffixes.repeated(suffixes.keyed(df, "doc_id", "text"), length, reach, batches)
    monkeypatch.setattr(suffixes, "repeated", lambda *_: found)
    got = suffixes.without_repeats(df, length=length).collect()
    assert sorted((str(r["id"]), r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]), r["kept_sha256"]) for r in got) == sorted((str(k), *w, hashlib.sha256(w[3]).hexdigest()) for k, w in zip(ids, want, strict=True))
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in got)
    assert sum(w[1] > 0 for w in want) > 20 and any(w[2] > 1 for w in want)


def test_equal_rows_and_empty_tables(spark):
    text = " ".join(str(k * k) for k in range(200))
    df = spark.createDataFrame([(1, text), (1, text), (2, text[:399]), (3, "other " * 3)], "doc_id long, text string")
    got = {(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffixes.without_repeats(df).collect()}
    assert got == {(1, len(text), len(text), 1), (2, 399, 0, 0), (3, 18, 0, 0)}
    assert suffixes.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_equal_windows_have_equal_representatives():
    r = np.random.default_rng(4)
    passage = r.integers(97, 123, 600, dtype=np.uint8)
    texts = [np.concatenate([r.integers(97, 123, n, dtype=np.uint8), passage, r.integers(97, 123, 50, dtype=np.uint8)]) for n in (13, 501)]
    of = []
    for t, n in zip(texts, (13, 501), strict=True):
        _, at, first, last, *_ = suffixes.samples(t, np.array([0, len(t)]), 400, 224)
        of.append({p: a - n - p for a, lo, hi in zip(at, first, last, strict=True) for p in range(lo - n, hi - n + 1)})
    inside = range(0, 201)
    assert all(of[0][p] == of[1][p] for p in inside)


def test_family_keeps_levels_of_powers_of_two(spark):
    family = suffixes.SuffixFamily()
    frame = lambda *x: spark.createDataFrame([(v,) for v in x], "prefix long")
    reported = [sorted(r["prefix"] for r in family.add(frame(*x)).collect()) for x in ((1, 2, 3), (3, 4, 5), (6, 6, 7), (1, 7, 8), (4, 9))]
    assert reported == [[], [3], [6], [1, 7], [4]]
    assert {rank: sorted(tuple(r) for r in level.collect()) for rank, level in family.levels.items()} == {2: [(1, 2), (2, 1), (3, 2), (4, 1), (5, 1), (6, 2), (7, 2), (8, 1)], 0: [(4, 1), (9, 1)]}
