"""Repair of the order of turns in conversations by A* on the lattice of edits."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.llm.common import materialize, table

#: White space and the marks that end a turn (fixed values).
SPACE = " \t\n\x0b\x0c\r"
MARKS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: The role initials `(s?(ua)+)?` as an automaton: state, initial, next state.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ACCEPTED = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
#: Rows whose lattice is searched at once, and characters of a conversation that are held until its edits are known.
STRETCH, HOLD = 256, 1 << 22
SOUND, CUT, GONE = range(3)
MUST = {SOUND: 0, CUT: TRUNCATED, GONE: DELETE}
INITIALS = "sua"


def to_go(codes: bytes, states: int = 4) -> dict[int, list[int]]:
    """The least cost from each state to the end, before the first row of each stretch but the first; codes are 4 * initial + fault a row."""
    cost = [0, 2 * INSERT, INSERT, 0]  # START, SYSTEM, USER, ASSISTANT at the end
    out = {}
    for i in range(len(codes) - 1, STRETCH - 1, -1):
        at, fault = divmod(codes[i], 4)
        now = [c + DELETE for c in cost]
        if fault != GONE:
            charge = TRUNCATED * (fault == CUT)
            for (state, role), to in STEP.items():
                keep = KEEP if at < 3 and INITIALS[at] == role else REROLE if role in ROLES else None
                if keep is not None:
                    now[state] = min(now[state], cost[to] + keep + charge)
        for _ in range(states):
            for (state, role), to in STEP.items():
                if role in ROLES:
                    now[state] = min(now[state], now[to] + INSERT)
        cost = now
        if i % STRETCH == 0:
            out[i] = cost
    return out


def search(codes: bytes, state: int, then: list[int] | None) -> tuple[int, str, int]:
    """(cost, audit, state at the end): the cheapest edits of rows from a state, of these the one with the least audit.

    Nodes of the lattice are (row, state). The heuristic is the sum of what the rows ahead cannot avoid:
    a deletion of each blank or repeated one, a charge of each truncated one; it never sinks by more
    than an edit costs, so a node is final when it is taken from the queue. The queue is keyed (cost +
    heuristic, audit): audits that lead to one node at one cost never are prefixes of each other (a
    longer one has paid for an insertion), so the least audit to a node stays the least of all that
    pass it. `then` has the least cost from each state on, for rows that others follow; insertions
    behind the last of them belong to those. Without it the rows end the conversation, in an accepted state.
    """
    n = len(codes)
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        ahead[i] = ahead[i + 1] + MUST[codes[i] % 4]
    queue = [(ahead[0], "", 0, state)]
    done: set[tuple[int, int]] = set()
    while True:
        f, audit, i, state = heapq.heappop(queue)
        if i > n:
            return f - (then[state] if then else 0), audit, state
        if (i, state) in done:
            continue
        done.add((i, state))
        cost = f - ahead[i]
        if i == n:
            if then:
                heapq.heappush(queue, (cost + then[state], audit, n + 1, state))
                continue
            if state in ACCEPTED:
                heapq.heappush(queue, (cost, audit, n + 1, state))
        else:
            at, fault = divmod(codes[i], 4)
            heapq.heappush(queue, (cost + DELETE + ahead[i + 1], audit + "D", i + 1, state))
            if fault != GONE:
                base = cost + TRUNCATED * (fault == CUT) + ahead[i + 1]
                if at < 3 and (state, INITIALS[at]) in STEP:
                    heapq.heappush(queue, (base + KEEP, audit + "K", i + 1, STEP[state, INITIALS[at]]))
                for role in ROLES:
                    if (state, role) in STEP:
                        heapq.heappush(queue, (base + REROLE, audit + "R", i + 1, STEP[state, role]))
        for role in ROLES:
            if (state, role) in STEP:
                heapq.heappush(queue, (f + INSERT, audit + "I", i, STEP[state, role]))


def cheapest(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of all rows: stretch by stretch, each on its way to what is cheapest in the end."""
    then, cost, audits, state = to_go(codes), 0, [], START
    for i in range(0, max(1, len(codes)), STRETCH):
        part, audit, state = search(codes[i : i + STRETCH], state, then.get(i + STRETCH))
        cost += part
        audits.append(audit)
    return cost, "".join(audits)


class Lines:
    """The sha256 of the repaired lines, from the audit and the rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.hash, self.lines, self.next = audit, 0, hashlib.sha256(), 0, "u"

    def _line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1
        self.next = "a" if role[:1] == "u" else "u"

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._line(ROLES[self.next], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._line(role if edit == "K" else ROLES[self.next], text)

    def digest(self) -> str:
        self.inserted()
        return self.hash.hexdigest()


class Repair:
    """One conversation, given row by row in order. A long one keeps a byte a row; its lines are hashed in a second pass."""

    def __init__(self, hold: int = HOLD) -> None:
        self.codes, self.hold = bytearray(), hold
        self.held: list[tuple[str, str]] | None = []
        self.size = 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, None
        self.low = self.high = None
        self.turns = 0

    def row(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        if fault:
            self.counts[fault] += 1
        at = INITIALS.find(initial) if initial else -1
        self.codes.append(4 * (at if at >= 0 else 3) + (SOUND if fault is None else CUT if fault == "truncated" else GONE))
        self.size += len(text) + 64
        if self.size > self.hold:
            self.held = None
        elif self.held is not None:
            self.held.append((role, text))

    def result(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha256), the last one null for a long conversation."""
        cost, audit = cheapest(bytes(self.codes))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        sha = None
        if self.held is not None:
            lines = Lines(audit)
            for role, text in self.held:
                lines.row(role, text)
            sha = lines.digest()
        return gaps, *self.counts.values(), self.illegal, cost, audit, sha


SCHEMA = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, live: rows with faults planted by the checksum of `conv_id:turn`; nulls are one space there, and in role and text.

    A dropped row stays as a mark that its conversation exists (live is false), a repeated one comes twice.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), kind.alias("_kind"))
    rows = rows.withColumn("text", F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", MARKS, "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))).withColumn("live", F.col("_kind") != 0)
    times = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(times)).drop("_kind", "_copy")


def fault(text: str = "text", nth: str = "nth") -> Column:
    """The first fault of a row: blank, duplicate (not the first of its role and text) or truncated; null if there is none."""
    body = F.rtrim(F.col(text), F.lit(SPACE))
    return F.when(body == "", "blank").when(F.col(nth) > 1, "duplicate").when(~F.right(body, F.lit(1)).isin(*MARKS), "truncated")


def _streamed(schema: str, begin, step, end):
    """A function of sorted Arrow batches that opens a state at each new conversation, gives it the rows one by one and yields what is left of it."""
    names = [f.split(" ")[0] for f in schema.split(", ")]
    types = [pa.string() if f.endswith("string") else pa.int64() for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, out = None, None, []
        for batch in batches:
            for this, *row in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)), strict=True):
                if state is None or this != conv:
                    if state is not None:
                        out.append((conv, *end(state)))
                    conv, state = this, begin()
                step(state, *row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((conv, *end(state)), types, strict=True)], names=names)

    return run


def repaired(rows: DataFrame, hold: int = HOLD) -> DataFrame:
    """One row a conversation of rows (conv_id, turn, role, text, live): gaps, faults, the cheapest edits and the sha256 of what they give.

    Edits make the role initials `(s?(ua)+)?`: K keeps a row (0), R makes it user or assistant (2), D
    deletes it (3; blank and repeated rows must go), I inserts an empty user or assistant turn (2); a
    truncated row that stays costs 1 more. The audit is the edits in order, the least in ASCII among the cheapest.

    Rows of a conversation are sorted by turn (null first); rows of one turn by role and text, so ties
    have one result. They stream through the task that holds the conversation, which keeps a byte a
    row; the lattice is searched in stretches, with the least costs from the next one on. Texts are
    kept up to `hold` characters; the lines of longer conversations are hashed as their rows stream by a
    second time, behind their audit. So a conversation of any length takes little memory. It stays one
    task, as a sha256 of its lines is made from first to last; repeated rows are found by a window
    over equal rows before. An empty or unknown role has no place in the order and is never kept as it
    is. A conversation whose rows all are dropped has zeros, an empty audit and the hash of the empty
    string; a null conv_id is a conversation of its own; an empty table gives an empty result.
    """
    rows = rows.select("conv_id", "turn", "role", "text", "live")
    conv, order = F.col("conv_id").asc_nulls_first(), [F.col("turn").asc_nulls_first(), "role", "text"]
    same = Window.partitionBy("conv_id", "live", "role", F.xxhash64("text"), F.crc32(F.col("text").cast("binary")), F.length("text")).orderBy("turn")
    told = rows.repartition("conv_id").withColumn("nth", F.row_number().over(same)).withColumn("fault", fault()).sortWithinPartitions(conv, F.desc("live"), *order, "nth").drop("nth")  # of equal rows of a turn the first one is no repeat

    def step(state: Repair, turn, role, text, live, fault) -> None:
        if live:
            state.row(turn, role, text, fault)

    first = materialize(told.mapInArrow(_streamed(SCHEMA, lambda: Repair(hold), step, Repair.result), SCHEMA))
    long = first.where("repaired_sha256 IS NULL").select(F.col("conv_id").alias("_c"), "audit")
    mine = rows.where("live").join(long, F.col("conv_id").eqNullSafe(F.col("_c")), "left_semi").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text")
    heads = long.select(F.col("_c").alias("conv_id"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))

    def line(state: list, kind, turn, role, text) -> None:
        if kind == 0:
            state.append(Lines(text))
        else:
            state[0].row(role, text)

    streamed = heads.unionByName(mine).repartition("conv_id").sortWithinPartitions(conv, "kind", *order)
    hashed = streamed.mapInArrow(_streamed("conv_id long, sha string", list, line, lambda state: (state[0].digest(),)), "conv_id long, sha string")
    both = first.where("repaired_sha256 IS NULL").join(hashed.withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c")))
    return first.where("repaired_sha256 IS NOT NULL").unionByName(both.withColumn("repaired_sha256", F.col("sha")).select(first.columns))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(table(spark, sf_dir, "conversations")))


def _option(state: str, cost: str, edit: str, line: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 't': {state}.t{line}}}"


def _sql() -> str:
    """The same in DuckDB: row after row, for each state the least cost, audit and lines; crc32 by its table."""
    never = "{'c': CAST(1000000000 AS BIGINT), 'a': '', 't': ''}"
    least = lambda *options: f"list_sort([{', '.join(options)}])[1]"
    drop = lambda q: _option(q, "3", "D", "")
    keep = lambda q, i: f"CASE WHEN i = '{i}' AND NOT must THEN {_option(q, 'x', 'K', " || chr(10) || role || ':' || text")} ELSE {never} END"
    rerole = lambda q, to: f"CASE WHEN NOT must THEN {_option(q, '2 + x', 'R', f" || chr(10) || '{to}:' || text")} ELSE {never} END"
    insert = lambda q, to: _option(q, "2", "I", f" || chr(10) || '{to}:'")
    p2 = least(drop("q2"), *[f(q, t) for q in ("q0", "q1", "q3") for f, t in ((keep, "u"), (rerole, "user"))])
    return rf"""
WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(0, 256)) AS i))),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(t[CAST(xor(c, b) & 255 AS INTEGER) + 1], c >> 8)), 4294967295) % 20 AS kind FROM conversations, tab),
m AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM k, (SELECT unnest([0, 1]) AS n) WHERE kind <> 0 AND (n = 0 OR kind = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body, substring(role, 1, 1) AS i FROM m),
f AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY r) > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, lag(i) OVER (PARTITION BY conv_id ORDER BY r) || i AS two FROM o),
e AS (SELECT *, fault IN ('blank', 'duplicate') AS must, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS x FROM f),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE two NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM e GROUP BY 1),
s AS (SELECT conv_id, CAST(0 AS BIGINT) AS r, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS q0, {never} AS q1, {{'c': CAST(2 AS BIGINT), 'a': 'I', 't': chr(10) || 'user:'}} AS q2, {{'c': CAST(4 AS BIGINT), 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS q3 FROM (SELECT DISTINCT conv_id FROM conversations)
UNION ALL SELECT conv_id, r, p0, p1, q2, {least("p3", insert("q2", "assistant"))} FROM (SELECT conv_id, r, p0, p1, p3, {least("p2", insert("p0", "user"), insert("p1", "user"), insert("p3", "user"))} AS q2 FROM (
SELECT s.conv_id, e.r, {drop("q0")} AS p0, {least(drop("q1"), keep("q0", "s"))} AS p1, {p2} AS p2, {least(drop("q3"), keep("q2", "a"), rerole("q2", "assistant"))} AS p3 FROM s JOIN e ON e.conv_id IS NOT DISTINCT FROM s.conv_id AND e.r = s.r + 1))),
z AS (SELECT s.conv_id, {least("q0", "q3")} AS b, c.* EXCLUDE (conv_id) FROM s LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM s.conv_id WHERE s.r = coalesce(c.n, 0))
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, b.c AS cost, b.a AS audit, sha256(substring(b.t, 2)) AS repaired_sha256 FROM z
"""


SQL = _sql()
