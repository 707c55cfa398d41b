"""Change detection and merges: snapshots, upserts with a policy a column, status machines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.operators.match import latest


def detect_changes(current: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """current with status NEW or UNCHANGED."""
    p = previous.select(F.col(key).alias("_p")).distinct()
    return current.join(p, F.col(key) == F.col("_p"), "left").withColumn("status", F.when(F.col("_p").isNull(), "NEW").otherwise("UNCHANGED")).drop("_p")


def merge_snapshot(current: DataFrame, previous: DataFrame, key: str, mode: str = "merge") -> DataFrame:
    """Ids with kind: added, updated (in both) or kept (old only); in replace mode old ones go. One full outer join."""
    c, p = current.select(F.col(key).alias("c")).distinct(), previous.select(F.col(key).alias("p")).distinct()
    kind = F.when(F.col("p").isNull(), "added").when(F.col("c").isNull(), "kept").otherwise("updated")
    out = c.join(p, F.col("c") == F.col("p"), "full").select(F.coalesce("c", "p").alias(key), kind.alias("kind"))
    return out if mode == "merge" else out.where("kind <> 'kept'")


def snapshot_counts(merged: DataFrame) -> DataFrame:
    k = F.col("kind")
    return merged.agg(F.count_if(k == "added").alias("added"), F.count_if(k == "updated").alias("updated"), F.count_if(k == "kept").alias("kept"), F.count(F.lit(1)).alias("total"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], policy: dict[str, str | tuple[Column, Column]] | None = None, default: str = "keep") -> DataFrame:
    """old with new merged in by key; adds merge_kind (inserted, updated, untouched).

    Policy of a column: keep (old value), fill (new unless null, else old), take (new value), null-safe
    forms of the usual conflict clauses, or a pair of expressions over the columns of o and n: the value
    of an inserted row and that of an updated one. Keys are unique on both sides (see `latest`). A key with a null
    is equal to none, as in a unique index: such an old row stays untouched and such a new one is inserted. A full outer join
    by key: written to a new path and swapped in, it is the portable form of MERGE; `BucketedTable` merges without a rewrite of the table.
    """
    policy = policy or {}
    o, n = old.withColumn("_is_old", F.lit(True)).alias("o"), new.withColumn("_is_new", F.lit(True)).alias("n")
    both = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full")
    is_new, is_old = F.col("o._is_old").isNull(), F.col("n._is_new").isNull()
    cols: list[Column] = [F.when(is_new, F.col(f"n.{k}")).otherwise(F.col(f"o.{k}")).alias(k) for k in keys]
    for c in old.columns:
        if c in keys:
            continue
        if isinstance(policy.get(c), tuple):
            inserted, updated = policy[c]
            cols.append(F.when(is_new, inserted).when(is_old, F.col(f"o.{c}")).otherwise(updated).alias(c))
            continue
        if c not in new.columns:
            cols.append(F.col(f"o.{c}").alias(c))
            continue
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}")
        how = {"keep": o, "fill": F.coalesce(n, o), "take": n}[policy.get(c, default)]
        cols.append(F.when(is_new, n).when(is_old, o).otherwise(how).alias(c))
    kind = F.when(is_new, "inserted").when(is_old, "untouched").otherwise("updated")
    return both.select(*cols, kind.alias("merge_kind"))


def sheet_upsert(sheet: DataFrame, rows: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """(sheet, counts): rows merged in by id; known ids keep date_added and are no longer new, the others get `day` and true.

    Rows without an id are counted as errors. Other columns take the new value.
    """
    good = latest(rows.where(F.coalesce(F.trim("id"), F.lit("")) != ""), ["id"], rows.columns[1])
    policy = {c: "take" for c in sheet.columns if c != "id"} | {"date_added": (F.lit(day), F.col("o.date_added")), "is_new": (F.lit("true"), F.lit("false"))}
    out = upsert(sheet, good, ["id"], policy)
    k = F.col("merge_kind")
    bad = rows.agg(F.count_if(F.coalesce(F.trim("id"), F.lit("")) == "").alias("errors"))
    counts = out.agg(F.count_if(k == "inserted").alias("added"), F.count_if(k == "updated").alias("updated"), F.count_if(k == "untouched").alias("untouched")).crossJoin(F.broadcast(bad))  # one row each
    return out.drop("merge_kind"), counts


def pending_upsert(old: DataFrame, new: DataFrame, now: str, keys: tuple[str, ...] = ("publication_id", "week_start")) -> DataFrame:
    """Pending fetches: status and original_url are refreshed, alerted_at stays; a row inserted as pending is alerted now."""
    alerted = (F.when(F.col("n.status") == "pending", F.lit(now)), F.col("o.alerted_at"))
    return upsert(old, new, list(keys), {"status": "take", "original_url": "take", "alerted_at": alerted})


def insert_or_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return latest(df, keys, order)


def votes(df: DataFrame, keys: list[str], ip: str, order: str) -> DataFrame:
    """The last vote of each key and address; votes without an address all count."""
    named = latest(df.where(F.col(ip).isNotNull()), [*keys, ip], order)
    return named.unionByName(df.where(F.col(ip).isNull()).select(*named.columns))


def transition(df: DataFrame, status: str, to: str, only_from: tuple[str, ...] | None = None, when: Column | None = None) -> DataFrame:
    """Moves rows to a status; with only_from, rows in another one stay."""
    ok = F.lit(True) if only_from is None else F.col(status).isin(*only_from)
    if when is not None:
        ok = ok & when
    return df.withColumn(status, F.when(ok, to).otherwise(F.col(status)))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that a unique index would refuse."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def missing_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key), key, "left_anti")


def consistency(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Counts of ids on the left only, on the right only and on both."""
    m = merge_snapshot(left, right, key)
    k = F.col("kind")
    return m.agg(F.count_if(k == "added").alias("left_only"), F.count_if(k == "kept").alias("right_only"), F.count_if(k == "updated").alias("both"))
