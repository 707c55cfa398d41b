"""Best-fit packing by hierarchical residual packing."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import bucketed_running_sum, hash_share, materialize, table

CAPACITY = 1024
END = 2
SLACK = 4
FAN_IN = 64
#: Bin numbers: a round and a group of it, or a partition, above the number of the bin there.
ROUND_BITS, GROUP_BITS, PART_BITS = 57, 36, 33
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
PIECES = "id long, piece int, start long, length long, ids_crc32 long, bin long, free int, offset long"
_encoders: dict = {}


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str):
    """The 50k byte-level vocabulary; the same ids as byte_bpe_50k.json in the tokenizers library, some four times as fast."""
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("folio", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def token_ids(enc, text: str | None) -> list[int]:
    """Ids of a text; the special token's own string is that token, as the tokenizers library has it."""
    if not text:
        return []
    if SPECIAL not in text:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for k, part in enumerate(text.split(SPECIAL)):
        if k:
            ids.append(SPECIAL_ID)
        ids += enc.encode_ordinary(part) if part else []
    return ids


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (bin of each item, offset of each item, fill of each bin).

    Bins are kept by their free room; a bit mask of the rooms in use gives the tightest one at once.
    """
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    fill: list[int] = []
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        above = mask >> size
        if above:
            room = size + ((above & -above).bit_length() - 1)
            b = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        room -= size
        if room:
            rooms[room].append(b)
            mask |= 1 << room
    return bins, offsets, np.array(fill, np.int64)


def best_fit_classes(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing of many items by their sizes alone: slots (size, start, stop, per, first, offset).

    Items of a size are numbered from 0; those from start up to stop go `per` a bin to the bins from
    number `first` on, the first of a bin at `offset`. The result is that of item-by-item packing: of
    equal items the tightest bin takes as many as fit, as it only gets tighter. Each size cuts two ranges
    of bins at most, so there are no more than a few slots a size, however many items there are.
    """
    slots, made = [], 0
    rooms: dict[int, list[tuple[int, int]]] = {}  # room: ranges (first, bins)
    mask = 0

    def give(room: int, first: int, bins: int) -> None:
        nonlocal mask
        if room and bins:
            rooms.setdefault(room, []).append((first, bins))
            mask |= 1 << room

    for size, left in sorted(zip(sizes, counts, strict=True), reverse=True):
        start = 0
        while left:
            above = mask >> size
            if above:
                room = size + ((above & -above).bit_length() - 1)
                first, bins = rooms[room].pop()
                if not rooms[room]:
                    mask &= ~(1 << room)
            else:
                room, first, bins = capacity, made, -(-left // (capacity // size))
                made += bins
            per = room // size
            full = min(bins, left // per)
            if not full:
                per, full = left, 1
            slots.append((size, start, start + full * per, per, first, capacity - room))
            give(room - per * size, first, full)
            give(room, first + full, bins - full)
            start, left = start + full * per, left - full * per
    return slots


def merge_round(items: DataFrame, number: int, capacity: int) -> DataFrame:
    """(bin, into, shift, size, grp) from items (bin, size, grp): the items of each group packed best-fit into new bins.

    A group is packed by its counts of sizes, which are at most `capacity` rows; its items then get
    their places by a running number among those of their size, so no task holds the items of a group.
    """

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        slots = best_fit_classes(pdf["size"].tolist(), pdf["n"].tolist(), capacity)
        out = pd.DataFrame(slots, columns=["size", "start", "stop", "per", "first", "offset"])
        return out.assign(grp=int(pdf["grp"].iloc[0]))

    counts = items.groupBy("grp", "size").agg(F.count(F.lit(1)).alias("n"))
    slots = counts.groupBy("grp").applyInPandas(plan, "size long, start long, stop long, per long, first long, offset long, grp long")
    slots = slots.groupBy(F.col("grp").alias("_g"), F.col("size").alias("_z")).agg(F.collect_list(F.struct("start", "stop", "per", "first", "offset")).alias("_slots"))
    keyed = items.withColumns({"_class": F.col("grp") * (capacity + 1) + F.col("size"), "_one": F.lit(1)})
    share = hash_share(F.col("bin"), "bin")
    numbered = bucketed_running_sum(keyed, "_class", [share, F.col("bin")], share, "_one", items.count())
    placed = numbered.join(slots, (F.col("grp") == F.col("_g")) & (F.col("size") == F.col("_z")))
    placed = placed.withColumn("_s", F.element_at(F.filter("_slots", lambda s: (s["start"] <= F.col("run_before")) & (F.col("run_before") < s["stop"])), 1))
    place = F.col("run_before") - F.col("_s.start")
    into = F.lit((number + 1) << ROUND_BITS) + F.shiftleft("grp", GROUP_BITS) + F.col("_s.first") + F.floor(place / F.col("_s.per"))
    return placed.select("bin", into.cast("long").alias("into"), (F.col("_s.offset") + (place % F.col("_s.per")) * F.col("size")).cast("long").alias("shift"), "size", "grp")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END, slack: int = SLACK, fan_in: int = FAN_IN, path: str | None = None) -> DataFrame:
    """One row a piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Each partition tokenises its documents and packs them best-fit. Bins with at most `slack` free
    places are emitted. The others go on as items of the size of their fill: bins of `fan_in`
    partitions at a time are packed best-fit again, until one group is left; a round hands on only
    bins that are not nearly full. A group is planned by its counts of fills, at most `capacity` of them,
    so bins that cannot be filled, however many, are never one task. A piece's place is its offset in
    its bin plus the offsets of the bins that took it up.

    A null text is empty and packs as the end id alone; ids may be null or repeat, each row is a
    document of its own; ties in size go by the order of bins; an empty table gives an empty result.
    Texts are tokenised whole, one at a time. Only the two named columns are read.
    """
    path = path or vocabulary()

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part = encoder(path), TaskContext.get().partitionId()
        ids: list = []
        cols: dict[str, list] = {k: [] for k in ("doc", "piece", "start", "length", "crc")}
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                t = np.array([*token_ids(enc, value.as_py()), end_id], "<u4")
                at, k, n = 0, 0, len(t)
                ids.append(doc)
                while at < n:
                    to = at + ((n - at) % capacity or capacity)
                    for c, x in zip(cols.values(), (len(ids) - 1, k, at, to - at, zlib.crc32(t[at:to])), strict=True):
                        c.append(x)
                    at, k = to, k + 1
        a = {k: np.array(v, np.int64) for k, v in cols.items()}
        bins, offsets, fill = best_fit(a["length"], capacity)
        free = (capacity - fill)[bins] if len(bins) else np.zeros(0, np.int64)
        docs_of = pa.array(ids, pa.int64()).take(pa.array(a["doc"]))
        arrays = [docs_of, pa.array(a["piece"].astype(np.int32)), pa.array(a["start"]), pa.array(a["length"]), pa.array(a["crc"]), pa.array(bins + (part << PART_BITS)), pa.array(free.astype(np.int32)), pa.array(offsets)]
        out = pa.RecordBatch.from_arrays(arrays, names=["id", "piece", "start", "length", "ids_crc32", "bin", "free", "offset"])
        for i in range(0, out.num_rows, 20_000):
            yield out.slice(i, 20_000)

    pieces = materialize(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(local, PIECES))
    # bins that have room: one row a bin, few a partition
    open_bins = pieces.where(F.col("free") > slack).groupBy("bin").agg(F.first("free").alias("free"))
    items = materialize(open_bins.select("bin", (F.lit(capacity) - F.col("free")).cast("long").alias("size"), F.shiftright("bin", PART_BITS).alias("grp")))
    groups = (items.agg(F.max("grp")).first()[0] or 0) + 1
    place = items.select("bin", F.col("bin").alias("into"), F.lit(0).cast("long").alias("shift"))
    for number in range(64):
        groups = -(-groups // fan_in)
        step = materialize(merge_round(items.withColumn("grp", F.floor(F.col("grp") / fan_in).cast("long")), number, capacity))
        place = place.join(step.select(F.col("bin").alias("_b"), F.col("into").alias("_into"), F.col("shift").alias("_shift")), F.col("into") == F.col("_b"), "left")
        place = materialize(place.select("bin", F.coalesce("_into", "into").alias("into"), (F.col("shift") + F.coalesce("_shift", F.lit(0))).alias("shift")))
        if groups <= 1:
            break
        items = materialize(step.groupBy(F.col("into").alias("bin")).agg(F.sum("size").alias("size"), F.first("grp").alias("grp")).where(F.lit(capacity) - F.col("size") > slack))
    shut = pieces.where(F.col("free") <= slack).select("id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
    moved = pieces.where(F.col("free") > slack).join(place, "bin").select("id", "piece", "start", "length", "ids_crc32", F.col("into").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"))
    return shut.unionByName(moved)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pack_documents(table(spark, sf_dir, "documents"))
    return p.withColumnRenamed("id", "doc_id")
