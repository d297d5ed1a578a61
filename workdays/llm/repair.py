"""Repair of conversations: the cheapest edits that give a well-formed order of roles.

Rows are sorted by range, so any conversation may spread over tasks, and cut into blocks of
bounded size. ``crossings`` finds the edits of a block between two states by divide and conquer.
A conversation of several blocks is solved the same way one level up: each block is reduced to its
costs between the four states, the states at the block borders are found from these, and then the
blocks are solved independently. Only a block's rows, or one small line for each block of a
conversation, are ever held together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crossings as paths
from .common import bounded_batches, columns_of, in_pieces, staged

SPACES = " \t\n\x0b\x0c\r"
CLOSING = ".!?"
LEGAL = ("su", "ua", "au")
ROLES = {paths.USER: "user", paths.ASSISTANT: "assistant"}
_INITIALS = {"s": paths.SYSTEM, "u": paths.USER, "a": paths.ASSISTANT}
# A block closes at so many rows (copies counted) or code points.
BLOCK_ROWS = 2048
BLOCK_CHARS = 1 << 20

_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first_turn", "last_turn")
_ORDER = ("conv_known", "conv", "turn_known", "turn", "role", "mark")
_BLOCK = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("conv_id", pa.int64()), ("whole", pa.bool_()), ("codes", pa.binary()),
     *((c, pa.int64()) for c in _COUNTS), ("first_initial", pa.string()), ("last_initial", pa.string()),
     ("transfer", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
     ("copies", pa.list_(pa.int64()))]
)
_BLOCK_DDL = (
    "part int, block int, conv_id long, whole boolean, codes binary, "
    + "".join(f"{c} long, " for c in _COUNTS)
    + "first_initial string, last_initial string, transfer array<long>, roles array<string>, texts array<string>, copies array<long>"
)
_BORDER = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("tail", pa.string())])
_TURN = pa.struct([("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
_SOLVED = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("conv_id", pa.int64()), ("whole", pa.bool_()),
     *((c, pa.int64()) for c in _COUNTS), ("first_initial", pa.string()), ("last_initial", pa.string()),
     ("cost", pa.int64()), ("audit", pa.string()), ("repaired", pa.list_(_TURN))]
)
_SOLVED_DDL = (
    "part int, block int, conv_id long, whole boolean, " + "".join(f"{c} long, " for c in _COUNTS)
    + "first_initial string, last_initial string, cost long, audit string, repaired array<struct<role:string,text:string,edit:string>>"
)


class _Block:
    """Rows of one conversation, in order, under construction."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.codes, self.chars = conv_id, bytearray(), 0
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.copies: list[int] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: str, text: str, copies: int, seen: bool) -> None:
        said, initial, before = text.strip(SPACES), role[:1], self.roles[-1][:1] if self.roles else None
        if not said:
            fault, self.blank = paths.DOOMED, self.blank + copies
        else:
            fault = paths.DOOMED if seen else paths.TRUNCATED if said[-1] not in CLOSING else paths.SOUND
            self.duplicate += copies - (not seen)
            self.truncated += fault == paths.TRUNCATED
        code = _INITIALS.get(initial, paths.OTHER)
        self.codes += bytes([code + 4 * fault]) + bytes([code + 4 * paths.DOOMED]) * (copies - 1)
        self.illegal += (before is not None and before + initial not in LEGAL) + (copies - 1) * (initial * 2 not in LEGAL)
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        self.chars += len(text)
        self.roles.append(role)
        self.texts.append(text)
        self.copies.append(copies)

    def full(self, rows: int, chars: int) -> bool:
        return len(self.codes) >= rows or self.chars >= chars

    def row(self, part: int, number: int, whole: bool, costs: paths.Costs) -> tuple:
        table = None
        if not whole:
            table = [x for row in paths.transfer([costs.items[c] for c in self.codes]) for w in row for x in (w or (-1, -1))]
        return (
            part, number, self.conv_id, whole, bytes(self.codes), self.blank, self.duplicate, self.truncated, self.illegal, self.turns,
            self.first_turn, self.last_turn, self.first_turn, self.last_turn, self.roles[0][:1], self.roles[-1][:1], table,
            self.roles, self.texts, self.copies,
        )


def _blocks(rows: DataFrame, costs: paths.Costs, size: tuple[int, int]) -> DataFrame:
    """Blocks of all conversations in order; ``whole``: surely all of its conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def made():
            block, number, first, last_key = None, 0, True, None
            for batch in batches:
                names = ("conv_known", "conv", "turn_known", "turn", "role", "text", "copies", "seen")
                for known, conv, turned, turn, role, text, copies, seen in zip(*columns_of(batch, *names), strict=True):
                    key = (known, conv)
                    if key != last_key:
                        if block:
                            yield block.row(part, number, not first and number == 0, costs)
                            first = False
                        block, number, last_key = _Block(conv if known else None), 0, key
                    elif block.full(*size):
                        yield block.row(part, number, False, costs)
                        block, number = _Block(block.conv_id), number + 1
                    block.add(turn if turned else None, role, text, copies, seen)
            if block:  # the conversation may go on in the next range
                yield block.row(part, number, False, costs)

        return in_pieces(_numbered(made()), _BLOCK, 64)

    return rows.mapInArrow(run, _BLOCK_DDL)


def _numbered(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Blocks of a part get ascending numbers, whatever their conversation."""
    for k, row in enumerate(rows):
        yield row[0], k, *row[2:]


def _runs(batches: Iterator[pa.RecordBatch], key: str, *names: str) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(key, its rows) of consecutive rows with an equal key, a null among them; rows come one by one."""
    rows = (row for b in batches for row in zip(*columns_of(b, key, *names), strict=True))
    held = next(rows, None)

    def same(now):
        nonlocal held
        while held is not None and held[0] == now:
            yield held[1:]
            held = next(rows, None)

    while held is not None:
        now = held[0]
        mine = same(now)
        yield now, mine
        for _ in mine:  # what the caller left unread
            pass


def _borders(blocks: DataFrame, costs: paths.Costs) -> DataFrame:
    """(part, block, start, end, tail): states around each block of a conversation of several blocks.

    One line of 32 numbers for each block of a conversation meets in a task: of some 2,000 rows one line.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for _, rows in _runs(batches, "conv_id", "part", "block", "transfer"):
                places, items = [], []
                for part, block, table in rows:
                    ways = [(c, p) if c >= 0 else None for c, p in zip(table[::2], table[1::2], strict=True)]
                    places.append((part, block))
                    items.append([ways[4 * q : 4 * q + 4] for q in range(4)])
                _, end = paths.last_state(items, 0, costs.ends)
                start = 0
                for (part, block), to in zip(places, paths.crossings(items, 0, end), strict=True):
                    yield part, block, start, to, costs.ends[end][1] if (part, block) == places[-1] else ""
                    start = to

        return in_pieces(made(), _BORDER)

    parted = blocks.where(~F.col("whole")).select("conv_id", "part", "block", "transfer").repartition("conv_id")
    return parted.sortWithinPartitions("conv_id", "part", "block").mapInArrow(
        run, "part int, block int, start int, end int, tail string"
    )


def _solved(blocks: DataFrame, borders: DataFrame, costs: paths.Costs) -> DataFrame:
    """Blocks with their edits and repaired turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(20_000)
        def short(codes: bytes) -> tuple:
            end = paths.last_state([costs.items[c] for c in codes], 0, costs.ends)[1]
            return paths.edits(codes, costs, 0, end), end

        def solve(b: dict) -> tuple:
            codes, start, tail = b["codes"], b["start"] or 0, b["tail"]
            if b["whole"]:
                steps, end = short(codes) if len(codes) <= 16 else short.__wrapped__(codes)
                tail = costs.ends[end][1]
            else:
                steps = paths.edits(codes, costs, start, b["end"])
            audit = "".join([s for _, s in steps]) + tail
            cost = sum(c for c, _ in steps) + len(tail) * costs.insert
            turns, q, at = [], start, 0
            for role, text, copies in zip(b["roles"], b["texts"], b["copies"], strict=True):
                for letter in "".join([s for _, s in steps[at : at + copies]]):
                    if letter == "D":
                        continue
                    put = ROLES[paths.PUT[q]]
                    if letter == "K" and role[:1] == "s":
                        q = 1
                    else:
                        q = paths.NEXT[q]
                    turns.append({"role": role if letter == "K" else put, "text": "" if letter == "I" else text, "edit": letter})
                at += copies
            for letter in tail:
                turns.append({"role": ROLES[paths.PUT[q]], "text": "", "edit": letter})
                q = paths.NEXT[q]
            return (b["part"], b["block"], b["conv_id"], b["whole"], *(b[c] for c in _COUNTS), b["first_initial"],
                    b["last_initial"], cost, audit, turns)

        rows = (solve(b) for batch in batches for b in batch.to_pylist())
        return in_pieces(rows, _SOLVED, 64)

    known = blocks.join(borders, ["part", "block"], "left").drop("transfer")
    return known.mapInArrow(run, _SOLVED_DDL)


def repair(
    rows: DataFrame, costs: paths.Costs | None = None, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Solved blocks of ``rows`` (conv_id, turn, role, text), for ``turns`` and ``reports``.

    Rows go by turn, a null turn first; equal turns go by role and the hash of the text; a null
    role or text is one space; rows with a null conv_id are one conversation; a role is known by
    its first letter, an empty one is unknown. A row is blank (nothing but white space),
    a duplicate (role and text seen earlier in its conversation) or truncated (last character not
    one of ``.!?``), the first that holds. Blank and duplicate rows are deleted; the other edits
    keep, give a role (user or assistant), delete or insert an empty turn, so that the roles'
    initials are ``(s?(ua)+)?`` at the least cost, ties by the least edit string.
    Repeated rows are adjacent rows; other columns are ignored; an empty table gives no blocks.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    costs = costs or paths.Costs()
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    zero = F.lit(0).cast("long")
    plain = rows.select(
        conv.isNotNull().cast("int").alias("conv_known"), F.coalesce(conv, zero).alias("conv"),
        turn.isNotNull().cast("int").alias("turn_known"), F.coalesce(turn, zero).alias("turn"),
        role.alias("role"), F.sha2(text, 256).alias("mark"), text.alias("text"),
    )
    # Equal rows become one with its number; the earliest turn of each saying marks the ones not seen before.
    single = plain.groupBy(*_ORDER).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    earliest = plain.groupBy("conv_known", "conv", "role", "mark").agg(F.min(F.struct("turn_known", "turn")).alias("t"))
    earliest = earliest.select("conv_known", "conv", F.col("t.turn_known").alias("turn_known"), F.col("t.turn").alias("turn"), "role", "mark", F.lit(False).alias("_seen"))
    judged = single.join(earliest, list(_ORDER), "left").select(
        *_ORDER, "text", "copies", F.coalesce("_seen", F.lit(True)).alias("seen")
    )
    ordered = judged.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    blocks = staged(_blocks(ordered, costs, (block_rows, block_chars)), "repair-blocks")
    return _solved(blocks, _borders(blocks, costs), costs)


def turns(solved: DataFrame) -> DataFrame:
    """(conv_id, part, block, place, role, text, edit): repaired turns; ascending in that order."""
    return solved.select("conv_id", "part", "block", F.posexplode("repaired").alias("place", "_t")).select(
        "conv_id", "part", "block", "place", "_t.role", "_t.text", "_t.edit"
    )


_REPORT = pa.schema(
    [("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
     ("audit", pa.string()), ("repaired_sha256", pa.string())]
)


def reports(solved: DataFrame) -> DataFrame:
    """One row a conversation: its gaps and faults, the cost, the edit string, SHA-256 of the repaired turns.

    The digest covers ``role:text`` of each turn, joined by line ends. That of a conversation in
    one block is taken where the block is; the others' texts go by one task in order (a
    digest has no parallel form), block by block, so that only one block is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = (*_COUNTS, "first_initial", "last_initial", "cost", "audit", "said", "digest", "n")

        def made():
            for conv_id, rows in _runs(batches, "conv_id", *names):
                sums, low, high, last, before, said, audit, digest, any_said = [0] * 6, None, None, None, None, hashlib.sha256(), [], None, False
                for row in rows:
                    b = dict(zip(names, row, strict=True))
                    joined = before is not None and before + b["first_initial"] not in LEGAL
                    again = b["first_turn"] is not None and b["first_turn"] == last
                    more = (b["blank"], b["duplicate"], b["truncated"], b["illegal"] + joined, b["turns"] - again, b["cost"])
                    sums = [x + y for x, y in zip(sums, more, strict=True)]
                    low = b["low"] if low is None else low
                    high = b["high"] if b["high"] is not None else high
                    last, before = (b["last_turn"] if b["last_turn"] is not None else last), b["last_initial"]
                    audit.append(b["audit"])
                    digest = b["digest"]
                    if b["n"] and digest is None:
                        said.update((("\n" if any_said else "") + b["said"]).encode())
                        any_said = True
                gaps = 0 if low is None else high - low + 1 - sums[4]
                yield conv_id, gaps, *sums[:4], sums[5], "".join(audit), digest or said.hexdigest()

        return in_pieces(made(), _REPORT)

    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    pieces = solved.select(
        "conv_id", "part", "block", *_COUNTS, "first_initial", "last_initial", "cost", "audit",
        F.when(~F.col("whole"), lines).alias("said"), F.when(F.col("whole"), F.sha2(lines, 256)).alias("digest"), F.size("repaired").alias("n"),
    )
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return ordered.mapInArrow(
        run,
        "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string",
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations with faults put in by CRC-32 of ``conv_id:turn`` (a null is one space).

    Of 20 remainders, 0 drops a row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4
    makes its role user.
    """
    blank = F.lit(" ")
    kept = rows.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce(F.col("text").cast("string"), blank).alias("text")
    )
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    drawn = kept.withColumn("_h", F.crc32(key) % 20).where("_h <> 0")
    drawn = drawn.withColumn("_n", F.explode(F.when(F.col("_h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    text = F.when(F.col("_h") == 1, "").when(F.col("_h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return drawn.select("conv_id", "turn", F.when(F.col("_h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """The contract's digest: all ``conversations`` damaged, then repaired."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = reports(repair(damaged(rows))).withColumnRenamed("conv_id", "_conv")
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(found, ids["conv_id"].eqNullSafe(found["_conv"]), "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
