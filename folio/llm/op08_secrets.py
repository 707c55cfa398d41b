"""Secret scans with multipart credential linking."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import table

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Weak parts: none is reported unless a complementary part stands within the scope.
#: A secret is 40 characters, with or without its padding counted; an = before it assigns it, a longer run is none.
BARE = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/]{40}={0,2}|[A-Za-z0-9+/]{39}=|[A-Za-z0-9+/]{38}==)(?![A-Za-z0-9+/=_-])")
USER = re.compile(r"""(?<![A-Za-z0-9])(?:user(?:name)?|login|client_id|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""", re.I | re.A)
ENDPOINT = re.compile(r"\b(?:https?|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqp|ftp|s3)://[^\s\"'<>]+", re.I | re.A)
KINDS = ("assign", "access", "hex", "secret_part", "user_part", "endpoint_part")
#: For each weak kind, the kinds of which one must stand near.
COMPLEMENTS = {"secret_part": ("access", "user_part", "endpoint_part"), "user_part": ("assign", "secret_part"), "endpoint_part": ("assign", "access", "secret_part")}
SCOPE = 200
HINTS = ("pass", "secret", "token", "api")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the three base kinds, in code points."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):  # each key word holds one of the hints; lower() may add letters, never take these away
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def weak_parts(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "secret_part") for m in BARE.finditer(text) if not m[0].rstrip("=").isalpha() and not m[0].rstrip("=").isdigit()]
    low = text.lower()
    if any(h in low for h in ("user", "login", "client_id", "account")):
        out += [(m.start(), m.end(), "user_part") for m in USER.finditer(text)]
    if "://" in text:
        out += [(m.start(), m.end(), "endpoint_part") for m in ENDPOINT.finditer(text)]
    return out


def linked(base: list[tuple[int, int, str]], weak: list[tuple[int, int, str]], scope: int) -> list[tuple[int, int, str]]:
    """The weak parts that have a complementary part at most `scope` code points away.

    An interval join by binary search: parts of each kind are sorted once, and each weak part looks
    for a start in [its start - scope - longest part, its end + scope]; no pairs are written out.
    """
    if not weak:
        return []
    by: dict[str, list[tuple[int, int]]] = {}
    for s, e, k in base + weak:
        by.setdefault(k, []).append((s, e))
    index = {}
    for k, spans in by.items():
        a = np.array(sorted(spans), np.int64)
        index[k] = (a[:, 0], np.maximum.accumulate(a[:, 1]))
    cover = np.array(sorted((s, e) for s, e, _ in base), np.int64).reshape(-1, 2)
    begins, reach = cover[:, 0], np.maximum.accumulate(cover[:, 1])
    out = []
    for s, e, k in weak:
        n = int(np.searchsorted(begins, e))
        if n and reach[n - 1] > s:
            continue  # a base span covers it already
        for other in COMPLEMENTS[k]:
            if other in index:
                starts, ends = index[other]
                n = int(np.searchsorted(starts, e + scope, "right"))  # those that start before the scope ends
                if n and ends[n - 1] >= s - scope:
                    out.append((s, e, k))
                    break
    return out


def order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def find_secrets(text: str | None, scope: int = SCOPE) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, added spans)."""
    text = text or ""
    base = base_spans(text)
    return order(base), order(linked(base, weak_parts(text), scope))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redacted(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    if not spans:
        return text
    out, at = [], 0
    for s, e, k in order(spans):
        if s >= at:
            out += [text[at:s], f"[{k}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


SCHEMA = "id long, n_assign long, n_access long, n_hex long, n_linked long, base_spans string, spans string, text string"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE, with_text: bool = False) -> DataFrame:
    """One row a row of docs: counts of base kinds and of linked parts, spans, and with_text the redacted text.

    Parts of one credential are linked where they stand in one document at most `scope` code points
    apart, so a scope lies in one row: the interval join runs in the task that reads the row, with no
    shuffle. A null text is empty and has no spans; ids may be null or repeat, each row is scanned on its
    own; spans of one start go by kind; texts are scanned whole, one at a time, by searches that do not
    grow with the square of what they find; an empty table gives an empty result. Only the two named
    columns are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_linked", pa.int64()), ("base_spans", pa.string()), ("spans", pa.string()), ("text", pa.string())])
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for value in batch.column(1):
                text = value.as_py()
                base, added = find_secrets(text, scope)
                kinds = [k for _, _, k in base]
                spans = order(base + added)
                for c, x in zip(cols, (kinds.count("assign"), kinds.count("access"), kinds.count("hex"), len(added), joined(base), joined(spans), redacted(text, spans) if with_text else None), strict=True):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *[pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:], strict=True)]], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def redact(docs: DataFrame, text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """docs with the secrets of text_col replaced by their kinds; other columns as they are.

    Null and empty texts stay as they are; a text of any length is scanned whole; an empty table stays empty.
    """

    @F.pandas_udf("string")
    def clean(texts):
        def one(text):
            if text is None:
                return None
            base, added = find_secrets(text, scope)
            return redacted(text, base + added)

        return texts.map(one, na_action="ignore")

    return docs.withColumn(text_col, clean(F.col(text_col)))


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = scan_secrets(table(spark, sf_dir, "documents"))
    return d.select(F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans", "n_linked")
