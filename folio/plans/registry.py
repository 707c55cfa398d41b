"""Named queries over the supplied tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under a name, with the SQL of its rows where SQL can express it."""

    def put(f: Query) -> Query:
        _queries[name] = f
        if sql is not None:
            _sql[name] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load() -> None:
    from folio.plans import documents, events, flows, identify, linking, parsing, records, star, stores, streams  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["digest_topn_week"](spark, sf_dir)
