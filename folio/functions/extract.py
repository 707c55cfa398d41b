"""Extractors that need match offsets or sequence ratios: Arrow-batched Python, as no built-in expression gives them."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The patterns of a sponsor and of a company name, in the order in which they are looked for.
SPONSOR_PATTERNS = (
    r"funded by\s+([A-Z][A-Za-z0-9\s&,.-]{2,50})",
    r"supported by\s+([A-Z][A-Za-z0-9\s&,.-]{2,50})",
    r"grant from\s+([A-Z][A-Za-z0-9\s&,.-]{2,50})",
    r"sponsored by\s+([A-Z][A-Za-z0-9\s&,.-]{2,50})",
    r"funding provided by\s+([A-Z][A-Za-z0-9\s&,.-]{2,50})",
    r"research supported by\s+([A-Z][A-Za-z0-9\s&,.-]{2,50})",
)
COMPANY_PATTERNS = (
    r"employee of\s+([A-Z][A-Za-z0-9\s&,.-]{2,50})",
    r"consultant for\s+([A-Z][A-Za-z0-9\s&,.-]{2,50})",
    r"affiliated with\s+([A-Z][A-Za-z0-9\s&,.-]{2,50})",
    r"conflict of interest.*?([A-Z][A-Za-z0-9\s&,.-]{2,50})",
    r"received compensation from\s+([A-Z][A-Za-z0-9\s&,.-]{2,50})",
    r"disclosure.*?([A-Z][A-Za-z0-9\s&,.-]{2,50})",
)

SPONSORS, COMPANIES = ([re.compile(p, re.I) for p in patterns] for patterns in (SPONSOR_PATTERNS, COMPANY_PATTERNS))
LISTS = ("sponsor_names", "company_names", "snippets")
COMMERCIAL = T.StructType([*[T.StructField(n, T.ArrayType(T.StringType())) for n in LISTS], T.StructField("has_sponsor_signal", T.BooleanType()), T.StructField("company_affiliation_signal", T.BooleanType())])


def commercial_of(text: str | None, names: int = 5, snippets: int = 2, width: int = 160) -> dict:
    """Names after the phrases, distinct in the order of patterns and places, short pieces of text around the first ones, and whether there are any."""
    found: dict[str, list[str]] = {"sponsor_names": [], "company_names": []}
    seen: list[str] = []
    for key, patterns in (("sponsor_names", SPONSORS), ("company_names", COMPANIES)):
        for m in (m for p in patterns for m in p.finditer(text or "")):
            name = re.sub(r"[,;.]$", "", m[1].strip())
            if not name or name in found[key]:
                continue
            found[key].append(name)
            if len(seen) < snippets:
                piece = text[max(0, m.start() - 20) : m.end() + 80].strip()
                piece = piece if len(piece) <= width else piece[: width - 3] + "..."
                if piece not in seen:
                    seen.append(piece)
    flags = {"has_sponsor_signal": bool(found["sponsor_names"]), "company_affiliation_signal": bool(found["company_names"])}
    return {k: v[:names] for k, v in found.items()} | {"snippets": seen} | flags


@F.pandas_udf(COMMERCIAL)
def commercial_signals(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([commercial_of(t) for t in texts], columns=COMMERCIAL.names)


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of matching characters of two titles (Ratcliff-Obershelp), 0 for null."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else 0.0 for x, y in zip(a, b, strict=True)])
