"""Repair of conversations: the cheapest edits that make the roles alternate.

A conversation is an optional system turn and then pairs of user and assistant turns. Its rows and
four grammar states span an edit lattice: from row and state, an edit leads to the next row (keep,
rerole, delete) or stays before it (insert). Bidirectional Dijkstra searches it: a forward heap from
the start and a reverse heap from the accepting ends. Both go on until their tops together exceed the
best crossing, so that every equally cheap crossing is seen; of those the audit (the edits' initials
in order) that sorts first is taken.

Rows are sorted by range, not by conversation, so a conversation of any length is spread. A block of
at most `BLOCK` rows is searched in one go. A conversation that lies inside one block is searched from
start to end. One that is longer gives, for each block, the cheapest way between every two states, and
the blocks are folded in order, with what all remaining candidates share written out as soon as it is
settled. The digest of a repaired conversation is sequential by definition: its rows pass through one
task in order, which holds the audit and one batch.

Order and defined results: rows are taken by turn, nulls first; rows of one turn by role, then by the
SHA-256 of their text. A null role or text, and a null in the key of the damage, is one space. Equal
rows all count; those after the first are duplicates. A null conv_id is one conversation. A role whose
first letter is not s, u or a (an empty one too) can be reroled or deleted only. A conversation without rows has zeros, an empty audit
and the digest of an empty text. An empty table gives an empty result. Only the four columns are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import batch_rows, keep
from tillhouse.operators.joins import splittable_join

BLOCK = 512
SPACES = " \t\n\x0b\x0c\r"

# Costs of the edits; a truncated row that stays costs TRUNCATED besides.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES, ENDS = range(4), (EMPTY, ASSISTANT)
KEPT = {EMPTY: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
# Where an inserted or a reroled turn leads; the grammar leaves one choice.
TURNED = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}

# A row of the lattice: the first letter of its role, what keeping it costs, and whether it must go.
Row = tuple[str, int, bool]


def _after(rows: list[Row], at: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """The edits from a node: (row, state, cost, initial)."""
    yield at, TURNED[state], INSERT, "I"
    if at < len(rows):
        initial, extra, gone = rows[at]
        yield at + 1, state, DELETE, "D"
        if not gone:
            if initial in KEPT[state]:
                yield at + 1, KEPT[state][initial], extra, "K"
            yield at + 1, TURNED[state], REROLE + extra, "R"


def _before(rows: list[Row], at: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """The edits that lead to a node."""
    turned = [s for s in STATES if TURNED[s] == state]
    for s in turned:
        yield at, s, INSERT, "I"
    if at:
        initial, extra, gone = rows[at - 1]
        yield at - 1, state, DELETE, "D"
        if not gone:
            for s in STATES:
                if KEPT[s].get(initial) == state:
                    yield at - 1, s, extra, "K"
            for s in turned:
                yield at - 1, s, REROLE + extra, "R"


def cheapest(rows: list[Row], start: int = EMPTY, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits of `rows` from the state `start` to one of `ends`.

    Heaps are ordered by cost, then by distance walked, then by audit: free edits only lead to the next
    row, so when a node is taken all its equally cheap audits are known, and the first one stands.
    """
    ahead, behind = [(0, 0, "", start)], [(0, 0, "", s) for s in ends]
    heapq.heapify(behind)
    seen: tuple[dict, dict] = ({}, {})
    best: tuple[int, str] | None = None

    def crossing(cost: int, audit: str) -> None:
        nonlocal best
        if best is None or (cost, audit) < best:
            best = (cost, audit)

    while ahead and behind and (best is None or ahead[0][0] + behind[0][0] <= best[0]):
        forward = ahead[0][0] <= behind[0][0]
        heap, own, other = (ahead, *seen) if forward else (behind, *reversed(seen))
        cost, walked, audit, state = heapq.heappop(heap)
        at = walked if forward else len(rows) - walked
        if (at, state) in own:
            continue
        own[at, state] = cost, audit
        if (at, state) in other:
            met = other[at, state]
            crossing(cost + met[0], audit + met[1] if forward else met[1] + audit)
        for to, turned, price, edit in (_after if forward else _before)(rows, at, state):
            if (to, turned) in other:
                met = other[to, turned]
                crossing(cost + price + met[0], audit + edit + met[1] if forward else met[1] + edit + audit)
            if (to, turned) not in own:
                path = audit + edit if forward else edit + audit
                heapq.heappush(heap, (cost + price, to if forward else len(rows) - to, path, turned))
    return best


def _ways(rows: list[Row]) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, audit) between all states, over the rows of one block."""
    found = []
    for start in STATES:
        for end in STATES:
            # The grammar never returns to its first two states.
            if end >= USER or end == start or (start, end) == (EMPTY, SYSTEM):
                way = cheapest(rows, start, (end,))
                if way:
                    found.append((start, end, *way))
    return found


class Fold:
    """Blocks of one conversation, one after the other; what all candidates share is settled."""

    def __init__(self) -> None:
        self.settled: list[str] = []
        self.open: dict[int, tuple[int, str]] = {EMPTY: (0, "")}

    def add(self, ways: list[tuple[int, int, int, str]]) -> None:
        met: dict[int, tuple[int, str]] = {}
        for start, end, cost, audit in ways:
            if start in self.open:
                way = (self.open[start][0] + cost, self.open[start][1] + audit)
                if end not in met or way < met[end]:
                    met[end] = way
        audits = [audit for _, audit in met.values()]
        low, high = min(audits), max(audits)
        shared = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        self.settled.append(low[:shared])
        self.open = {state: (cost, audit[shared:]) for state, (cost, audit) in met.items()}

    def done(self) -> tuple[int, str]:
        cost, audit = min(self.open[s] for s in ENDS if s in self.open)
        return cost, "".join([*self.settled, audit])


def damage_of(conv_id: Column, turn: Column) -> Column:
    key = F.concat(F.coalesce(conv_id.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    return F.crc32(key) % 20


def damaged(conversations: DataFrame) -> DataFrame:
    """(ckey, conv_id, turn, role, text, copies) of every row; `copies` is 0 for a dropped one.

    `ckey` is the conversation as text, without nulls.
    """
    harm = damage_of(F.col("conv_id"), F.col("turn"))
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("ckey"),
        "conv_id", "turn", harm.alias("harm"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    by = F.col("harm")
    return rows.select(
        "ckey", "conv_id", "turn",
        F.when(by == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(by == 1, "").when(by == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(by == 0, 0).when(by == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


ORDER = ["ckey", "dated", "turn", "role", "digest"]


def _ordered(rows: DataFrame) -> DataFrame:
    """`rows` that still exist, with the columns that order them."""
    return rows.where("copies > 0").withColumn("dated", F.col("turn").isNotNull()).withColumn("digest", F.unhex(F.sha2("text", 256)))


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


BLOCKS = pa.schema(
    [("ckey", pa.string()), ("dated", pa.bool_()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()), ("place", pa.int64()),
     ("ways", pa.string()), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()),
     ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64())]
)
BLOCKS_DDL = (
    "ckey string, dated boolean, turn long, role string, digest binary, place long, ways string, first string, last string, "
    "illegal long, blank long, duplicate long, truncated long"
)
FOLDED = pa.schema(
    [("ckey", pa.string()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
     ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]
)
FOLDED_DDL = "ckey string, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
LEGAL = {"su", "ua", "au"}


class _Block:
    """Rows of one conversation that follow each other, and their faults."""

    def __init__(self, row: dict, place: int):
        self.head = {c: row[c] for c in ORDER} | {"place": place}
        self.rows: list[Row] = []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.first = self.last = ""

    def add(self, initial: str, fault: str | None) -> None:
        if self.rows:
            self.counts["illegal"] += (self.last + initial) not in LEGAL
        else:
            self.first = initial
        self.last = initial
        if fault:
            self.counts[fault] += 1
        self.rows.append((initial, TRUNCATED if fault == "truncated" else 0, fault in ("blank", "duplicate")))

    def result(self, whole: bool) -> dict:
        if whole:
            cost, audit = cheapest(self.rows)
            ways = [(EMPTY, ASSISTANT, cost, audit)]
        else:
            ways = _ways(self.rows)
        return self.head | self.counts | {"first": self.first, "last": self.last, "ways": json.dumps(ways)}


def _faults(row: dict) -> Iterator[tuple[str, str | None]]:
    """(initial, fault) of each copy of a row."""
    for copy in range(row["copies"]):
        fault = None
        if row["last_char"] == "":
            fault = "blank"
        elif copy or not row["is_first"]:
            fault = "duplicate"
        elif row["last_char"] not in ".!?":
            fault = "truncated"
        yield row["role"][:1], fault


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, as they lie in one partition, to blocks.

    The first and the last conversation of a partition may go on in the neighbouring ones, so they are
    searched between all states, and so are those of more than one block.
    """
    out: list[dict] = []
    block, begins, place = None, False, 0
    first = None

    for row in _in_order(batches):
        if first is None:
            first = row["ckey"]
        for initial, fault in _faults(row):
            if block is not None and block.head["ckey"] != row["ckey"]:
                out.append(block.result(begins and block.head["ckey"] != first))
                block = None
            elif block is not None and len(block.rows) == BLOCK:
                out.append(block.result(False))
                block, begins = _Block(row, place), False
            if block is None:
                block, begins = _Block(row, place), True
            block.add(initial, fault)
            place += 1
            if len(out) == 1000:
                yield _batch(out, BLOCKS)
                out = []
    if block is not None:
        out.append(block.result(False))
    if out:
        yield _batch(out, BLOCKS)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order to one row for each conversation."""
    out: list[dict] = []
    now: dict | None = None
    fold = Fold()

    def result() -> dict:
        cost, audit = fold.done()
        return {k: now[k] for k in FOLDED.names if k in now} | {"cost": cost, "audit": audit}

    for row in _in_order(batches):
        if now is None or now["ckey"] != row["ckey"]:
            if now is not None:
                out.append(result())
            now, fold = dict(row), Fold()
        else:
            for name in ("blank", "duplicate", "truncated", "illegal"):
                now[name] += row[name]
            now["illegal"] += (now["last"] + row["first"]) not in LEGAL
            now["last"] = row["last"]
        fold.add(json.loads(row["ways"]))
        if len(out) == 1000:
            yield _batch(out, FOLDED)
            out = []
    if now is not None:
        out.append(result())
    if out:
        yield _batch(out, FOLDED)


def search(rows: DataFrame) -> DataFrame:
    """(ckey, blank, duplicate, truncated, illegal, cost, audit) of each conversation of `damaged` rows."""
    spark = rows.sparkSession
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    slim = _ordered(rows).select(*ORDER, last.alias("last_char"), "copies")
    # Equal rows meet as one before they are sorted; the first turn of a role and text is found from keys alone.
    same = ["ckey", "role", "digest"]
    seen = slim.groupBy(*same).agg(F.min(F.struct("dated", "turn")).alias("begin"))
    one = slim.groupBy(*ORDER, "last_char").agg(F.sum("copies").alias("copies"))
    met = splittable_join(one, seen, same).withColumn("is_first", F.struct("dated", "turn").eqNullSafe(F.col("begin")))
    ranged = met.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    blocks = ranged.select(*ORDER, "last_char", "copies", "is_first").mapInArrow(_blocks, BLOCKS_DDL)
    with batch_rows(spark, 1000):
        blocks = keep(blocks, "conversation-blocks")
    return blocks.repartition("ckey").sortWithinPartitions(*ORDER, "place").mapInArrow(_fold, FOLDED_DDL)


REPAIRED = pa.schema([("ckey", pa.string()), ("repaired_sha256", pa.string())])
REPAIRED_DDL = "ckey string, repaired_sha256 string"


class Replay:
    """The edits of one audit applied to rows as they pass; `out` takes the lines of the repaired text."""

    def __init__(self, audit: str, out) -> None:
        self.audit, self.at, self.state, self.out = audit, 0, EMPTY, out

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = TURNED[self.state]
            self.out(NAMES[self.state], "")

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[self.state][role[0]]
            self.out(role, text)
        elif edit == "R":
            self.state = TURNED[self.state]
            self.out(NAMES[self.state], text)

    def end(self) -> None:
        self._inserts()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's audit and then its rows in order, to the digest of its repaired text."""
    out: list[dict] = []
    ckey = replay = None
    sha, lines = hashlib.sha256(), 0

    def line(role: str, text: str) -> None:
        nonlocal lines
        sha.update((("\n" if lines else "") + role + ":" + text).encode())
        lines += 1

    for row in _in_order(batches):
        if row["audit"] is not None:
            if replay is not None:
                replay.end()
                out.append({"ckey": ckey, "repaired_sha256": sha.hexdigest()})
            ckey, sha, lines = row["ckey"], hashlib.sha256(), 0
            replay = Replay(row["audit"], line)
        else:
            for _ in range(row["copies"]):
                replay.row(row["role"], row["text"])
        if len(out) == 1000:
            yield _batch(out, REPAIRED)
            out = []
    if replay is not None:
        replay.end()
        out.append({"ckey": ckey, "repaired_sha256": sha.hexdigest()})
    if out:
        yield _batch(out, REPAIRED)


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(ckey, repaired_sha256) for every conversation of `found` (ckey, audit)."""
    spark = rows.sparkSession
    texts = _ordered(rows).select(*ORDER, "text", "copies", F.lit(None).cast("string").alias("audit"))
    none = {"dated": "boolean", "turn": "long", "role": "string", "digest": "binary", "text": "string", "copies": "long"}
    heads = found.select("ckey", *[F.lit(None).cast(kind).alias(name) for name, kind in none.items()], "audit")
    # A conversation's audit is not dated, neither true nor false, and so comes before its rows.
    lined = heads.unionByName(texts).repartition("ckey").sortWithinPartitions(*ORDER)
    with batch_rows(spark, 256):
        return keep(lined.select("ckey", "role", "text", "copies", "audit").mapInArrow(_digests, REPAIRED_DDL), "repaired")


def repair(conversations: DataFrame) -> DataFrame:
    """What is wrong with each conversation after the damage, and its cheapest repair.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.
    """
    rows = damaged(conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text"))
    found = keep(search(rows), "conversation-audits")
    stays = F.col("copies") > 0
    turns = rows.groupBy("ckey", "conv_id", "turn").agg(F.max(stays).alias("stays"))
    turn = F.when(F.col("stays"), F.col("turn"))
    spans = turns.groupBy("ckey", "conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count(turn), F.lit(0)).alias("gaps")
    )
    met = spans.join(found, "ckey", "left").join(repaired_digests(rows, found), "ckey", "left")
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    return met.select(
        "conv_id", F.col("gaps").cast("long").alias("gaps"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
