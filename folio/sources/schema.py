"""Schemas and tolerant alignment of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "timestamp_ntz": T.TimestampNTZType(), "array<string>": T.ArrayType(T.StringType())}


def struct(fields: str) -> T.StructType:
    """A schema from 'name type, ...' without a running session."""
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (f.split() for f in fields.split(","))])


PUBLICATION = struct("id string, title string, authors array<string>, source string, date string, url string, raw_text string, summary string, run_id string, venue string, source_names array<string>, date_raw string, date_source string")
SCORING_EVENT = struct("run_id string, publication_id string, mode string, title string, source string, final_relevancy_score int, final_relevancy_reason string, final_signals_json string, final_summary string, agreement_level string, confidence int, claude_review_json string, gemini_review_json string, gpt_eval_json string, credibility_score int, credibility_reason string, created_at timestamp_ntz")
SHEET = ("id", "title", "authors", "source", "date", "url", "doi", "pmid", "venue", "year", "summary", "score", "label", "credibility", "signals", "sponsors", "companies", "run_id", "run_mode", "is_new", "date_added", "last_seen", "canonical_url", "source_type")
#: The fields of a survey row.
SURVEY = ("publication_id", "title", "final_relevancy_score", "human_score", "reasoning", "evaluator", "confidence")
ID_NAMES = ("id", "publication_id", "pub_id")


def align(df: DataFrame, schema: T.StructType, aliases: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """df with the columns of schema: known ones cast, aliases taken where the name is absent, others null."""
    have, aliases = set(df.columns), aliases or {}
    cols = []
    for f in schema:
        name = next((n for n in (f.name, *aliases.get(f.name, ())) if n in have), None)
        cols.append((F.col(f"`{name}`").cast(f.dataType) if name else F.lit(None).cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def id_column(df: DataFrame, names: tuple[str, ...] = ID_NAMES) -> str:
    for n in names:
        if n in df.columns:
            return n
    raise ValueError(f"none of {names} is a column")


def check_header(df: DataFrame, expected: tuple[str, ...]) -> None:
    if tuple(df.columns) != tuple(expected):
        raise ValueError(f"columns are {df.columns}, not {list(expected)}")


def sheet_row(df: DataFrame) -> DataFrame:
    """24 columns of text in a fixed order; lists joined by '; ', absent ones empty."""
    cols = []
    for name in SHEET:
        if name not in df.columns:
            cols.append(F.lit("").alias(name))
        elif isinstance(df.schema[name].dataType, T.ArrayType):
            cols.append(F.coalesce(F.array_join(name, "; "), F.lit("")).alias(name))
        else:
            cols.append(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name))
    return df.select(*cols)


def first_value(df: DataFrame, *names: str) -> Column:
    """The first of the named columns, whatever their case, that has a value; null where none has."""
    by_name = {c.lower(): c for c in df.columns}
    have = [F.nullif(F.col(f"`{by_name[n.lower()]}`").cast("string"), F.lit("")) for n in names if n.lower() in by_name]
    return F.coalesce(*have, F.lit(None).cast("string"))


def survey_fields(df: DataFrame) -> DataFrame:
    """The fields of a survey row under their own names, from headers in any case."""
    return df.select(*[first_value(df, c).alias(c) for c in SURVEY])
