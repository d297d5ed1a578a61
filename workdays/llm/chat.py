"""Chat formatting as packed prefix trees.

Conversations that share their first turns share them in the output: sorted by the hashes of
their turns, neighbours share the longest prefixes, and a pack emits each turn of its tree once,
depth-first. Every segment (a turn) carries the position id of its first token (the tokens of
its ancestors, wherever they stand) and the token intervals of its ancestors, the only earlier
tokens it attends to; inside itself it is causal. A pack closes at PACK_TOKENS tokens and the
next begins with its own root, so a tree of any size spreads over many bounded rows, each of
which is read alone.

A turn is ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end. In texts
and roles ``<|`` becomes ``<\\|`` (one more backslash each time), so no text holds a marker.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import bounded_batches, columns_of, in_pieces, work_folder

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"
PACK_TOKENS = 32_768

_PLAIN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")

_INTERVAL = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_SEGMENT = pa.struct(
    [("parent", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("position", pa.int32()),
     ("loss_start", pa.int32()), ("loss_end", pa.int32()), ("attends", pa.list_(_INTERVAL))]
)
_PACK = pa.schema(
    [("pack_id", pa.string()), ("input_ids", pa.list_(pa.int32())), ("position_ids", pa.list_(pa.int32())),
     ("segments", pa.list_(_SEGMENT)),
     ("conversations", pa.list_(pa.struct([("conv_id", pa.int64()), ("leaf", pa.int32())])))]
)
PACK_SCHEMA = (
    "pack_id string, input_ids array<int>, position_ids array<int>, "
    "segments array<struct<parent:int,start:int,end:int,position:int,loss_start:int,loss_end:int,"
    "attends:array<struct<start:int,end:int>>>>, conversations array<struct<conv_id:bigint,leaf:int>>"
)


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line: backslashes are doubled and line ends spelled out."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Pack:
    """One pack under construction."""

    def __init__(self):
        self.ids: list[int] = []
        self.positions: list[int] = []
        self.segments: list[tuple] = []
        self.conversations: list[tuple] = []
        self.path: list[tuple] = []  # (role, text, segment) of the last conversation

    def add(self, conv_id: int | None, turns: list[tuple[str, str]], encode) -> None:
        shared = 0
        while shared < min(len(turns), len(self.path)) and self.path[shared][:2] == turns[shared]:
            shared += 1
        del self.path[shared:]
        for role, text in turns[shared:]:
            parent = self.path[-1][2] if self.path else -1
            head, body, foot = encode(f"{START}{escape_role(role)}\n"), encode(escape(text)), encode(END)
            start = len(self.ids)
            loss = start + len(head)
            end = loss + len(body) + len(foot)
            position, attends = 0, []
            if parent >= 0:
                above = self.segments[parent]
                position = above[3] + above[2] - above[1]
                attends = list(above[6])
                if attends and attends[-1][1] == above[1]:
                    attends[-1] = (attends[-1][0], above[2])
                else:
                    attends.append((above[1], above[2]))
            self.ids += [*head, *body, *foot]
            self.positions += range(position, position + end - start)
            learned = loss + len(body) if role == LEARNED else loss
            self.path.append((role, text, len(self.segments)))
            self.segments.append((parent, start, end, position, loss, learned, attends))
        self.conversations.append((conv_id, self.path[-1][2] if self.path else -1))

    def row(self, pack_id: str) -> tuple:
        names = [f.name for f in _SEGMENT]
        segments = [
            dict(zip(names, (*s[:6], [{"start": a, "end": b} for a, b in s[6]]), strict=True)) for s in self.segments
        ]
        return pack_id, self.ids, self.positions, segments, [{"conv_id": c, "leaf": x} for c, x in self.conversations]


def _encoder(path: str):
    """Ids of a text; markers and roles are remembered."""
    known: dict[str, list[int]] = {}
    tok = tokens.load(path)

    def encode(text: str) -> list[int]:
        if text in known:
            return known[text]
        ids = tok.encode(text, add_special_tokens=False).ids
        if text == END or text.startswith(START) and len(known) < 10_000:
            known[text] = ids
        return ids

    return encode


def format_conversations(rows: DataFrame, path: str, pack_tokens: int = PACK_TOKENS) -> DataFrame:
    """Packs of ``rows`` (conv_id, turn, role, text).

    Turns go by (turn, role, text), a null turn first; a null role or text is empty; rows with a
    null conv_id are one conversation; repeated rows are turns of their own; other columns are
    ignored; an empty table gives no packs. A conversation is one row of the sort and stays
    whole, so a pack passes ``pack_tokens`` by at most one conversation.
    """
    bounded_batches(rows.sparkSession)
    empty = F.lit("")
    turn = F.struct(
        "turn", F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text")
    )
    whole = rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id")
    whole = whole.agg(F.sort_array(F.collect_list("t")).alias("turns"))
    place = F.transform("turns", lambda t: F.substring(F.md5(F.concat_ws("\n", t["role"], t["text"]).cast("binary")), 1, 12))
    keyed = whole.select("conv_id", "turns", F.array_join(place, "").alias("key"))
    ordered = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = _encoder(path), TaskContext.get().partitionId()

        def packs():
            pack, made = Pack(), 0
            for batch in batches:
                for conv_id, turns in zip(*columns_of(batch, "conv_id", "turns"), strict=True):
                    if len(pack.ids) >= pack_tokens:
                        yield pack.row(f"{part}-{made}")
                        pack, made = Pack(), made + 1
                    pack.add(conv_id, [(t["role"], t["text"]) for t in turns], encode)
            if pack.conversations:
                yield pack.row(f"{part}-{made}")

        return in_pieces(packs(), _PACK, 8)

    return ordered.select("conv_id", "turns").mapInArrow(run, PACK_SCHEMA)


def read_conversation(ids: list[int], segments: list[dict], leaf: int, decode) -> Iterator[tuple[str, str, str, str]]:
    """(role, text, text under the loss mask, formatted turn) from the root to ``leaf``."""
    path = []
    while leaf >= 0:
        path.append(leaf)
        leaf = segments[leaf]["parent"]
    for k in reversed(path):
        s = segments[k]
        formatted = decode(k, s["start"], s["end"])
        head, body = formatted.removeprefix(START).split("\n", 1)
        learned = decode(~k, s["loss_start"], s["loss_end"]) if s["loss_end"] > s["loss_start"] else ""
        yield unescape_role(head), unescape(body.removesuffix(END)), unescape(learned), formatted


_DIGEST = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def digests(packs: DataFrame, path: str) -> DataFrame:
    """What each conversation of ``packs`` says, decoded from its token ids."""
    bounded_batches(packs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens.load(path)

        def rows():
            for batch in batches:
                for ids, segments, conversations in zip(*columns_of(batch, "input_ids", "segments", "conversations"), strict=True):
                    seen: dict[int, str] = {}

                    def decode(name: int, start: int, end: int, ids=ids, seen=seen) -> str:
                        if name not in seen:
                            seen[name] = tok.decode(ids[start:end], skip_special_tokens=False)
                        return seen[name]

                    for c in conversations:
                        said, learned, n, n_loss, n_chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                        for role, text, loss, formatted in read_conversation(ids, segments, c["leaf"], decode):
                            said.update(f"{role}\n{text}\n".encode())
                            learned.update(loss.encode())
                            n, n_loss, n_chars = n + 1, n_loss + len(loss), n_chars + len(formatted)
                        yield c["conv_id"], n, said.hexdigest(), n_loss, learned.hexdigest(), n_chars

        return in_pieces(rows(), _DIGEST)

    read = packs.select("input_ids", "segments", "conversations")
    return read.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def op4_chat_format(spark, sf_dir: str) -> DataFrame:
    """The contract's digest, read back from the packs of all ``conversations`` and conversation -1."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = "<|im_end|><|im_start|>assistant ok"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(LEARNED).alias("role"), F.lit(tricky).alias("text"),
    )
    folder = f"{work_folder(spark, 'chat')}/packs"
    format_conversations(rows.unionByName(own), path).write.parquet(folder)
    return digests(spark.read.schema(PACK_SCHEMA).parquet(folder), path)
