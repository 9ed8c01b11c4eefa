"""Chat formatting of conversations that share their first turns, as prefix trees.

A turn is written as ``### role:``, a line break, the text, and ``</turn>`` with a line
break. In roles and texts a backslash goes before every backslash and control string,
which is taken away again on reading. Head, text and end of a turn are encoded apart, so
that the loss mask (the texts of assistants) ends where tokens end.

Equal conversations become one. The different ones are sorted by the hashes of their
turns, which is depth-first order of the tree of their prefixes: what a conversation
shares with the one before it stands already, the rest is emitted. Whether turns are
the same is decided by their contents, not the hashes. The sort is by ranges of whole
paths, so a first turn that a third of all conversations begin with is spread over tasks.

A sequence holds the tokens of one tree, each shared turn once, in depth-first order,
with a position id per token that counts along its own conversation, and per turn
the intervals of the sequence that its tokens attend to before themselves: its
ancestors, merged where they touch. A sequence ends at ``limit`` tokens, or where the
range of a task does; the next one then begins with the turns that it attends to, as a
sequence must hold them. A longer conversation is one sequence by itself.

Defined cases: NULL text or role is an empty string, NULL turn comes first. Turns with
one number are in the order of role and text, equal ones all stay. A row without conv_id
belongs to no known conversation and is one of its own, with conv_id NULL. Very long
texts are written whole. A conversation is one record, as a document is. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.texts import column, small_batches
from factloom.llm.tokens import encoder
from factloom.sources.staging import Staged, stage

LIMIT = 1 << 16
HEAD, HEAD_END, TURN_END = "### ", ":\n", "</turn>\n"
# The control strings of the template, and the backslash that guards them.
_CONTROL = re.compile(r"\\|###|</turn>|:\n")
_GUARDED = re.compile(r"\\(\\|###|</turn>|:\n)")
_MARKS = re.compile(r"\\(?:\\|###|</turn>|:\n)|(:\n)|(</turn>\n)")
ANSWERING = "assistant"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _GUARDED.sub(r"\1", text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """Head, text and end of a turn as they are written."""
    return f"{HEAD}{escape(role)}{HEAD_END}", escape(text), TURN_END


def read_turns(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns, at, head = [], 0, None
    for mark in _MARKS.finditer(text):
        if mark[1] and head is None:
            head = (unescape(text[at + len(HEAD):mark.start()]), mark.end())
        elif mark[2]:
            turns.append((head[0], unescape(text[head[1]:mark.start()])))
            at, head = mark.end(), None
    return turns


@dataclass
class Turn:
    """A node of the tree in a sequence."""

    role: str
    text: str
    node: int
    start: int
    end: int
    position: int
    before: list[tuple[int, int]]  # what it attends to besides itself

    def attends(self) -> list[tuple[int, int]]:
        """What the turns after it attend to: its own intervals and itself."""
        if self.before and self.before[-1][1] == self.start:
            return [*self.before[:-1], (self.before[-1][0], self.end)]
        return [*self.before, (self.start, self.end)]


@dataclass
class Sequence:
    """Tokens of one tree, and its turns as far as they stand."""

    ids: list[int] = field(default_factory=list)
    positions: list[int] = field(default_factory=list)
    loss: list[dict] = field(default_factory=list)
    nodes: list[dict] = field(default_factory=list)
    leaves: list[dict] = field(default_factory=list)
    path: list[Turn] = field(default_factory=list)

    def shared(self, turns: list[dict]) -> int:
        """How many first turns stand already."""
        n = 0
        for known, turn in zip(self.path, turns):
            if (known.role, known.text) != (turn["role"], turn["text"]):
                break
            n += 1
        return n

    def add(self, leaf: str, turns: list[dict], encoded: list[tuple], shared: int) -> None:
        del self.path[shared:]
        for turn, (head, text, end) in zip(turns[shared:], encoded):
            parent = self.path[-1] if self.path else None
            start, length = len(self.ids), len(head) + len(text) + len(end)
            position = parent.position + parent.end - parent.start if parent else 0
            before = parent.attends() if parent else []
            self.ids += [*head, *text, *end]
            self.positions += range(position, position + length)
            if turn["role"] == ANSWERING:
                self.loss.append({"start": start + len(head), "end": start + len(head) + len(text)})
            self.nodes.append({"parent": parent.node if parent else -1, "start": start, "end": start + length,
                               "attends": [{"start": s, "end": e} for s, e in before]})
            self.path.append(Turn(turn["role"], turn["text"], len(self.nodes) - 1, start, start + length, position, before))
        self.leaves.append({"leaf": leaf, "node": self.path[-1].node})

    def row(self, number: int) -> dict:
        return {"sequence_id": number, "ids": self.ids, "position_ids": self.positions, "loss": self.loss,
                "nodes": self.nodes, "leaves": self.leaves}


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_SEQUENCE = pa.schema([
    ("sequence_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("position_ids", pa.list_(pa.int32())), ("loss", pa.list_(_SPAN)),
    ("nodes", pa.list_(pa.struct([("parent", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("attends", pa.list_(_SPAN))]))),
    ("leaves", pa.list_(pa.struct([("leaf", pa.string()), ("node", pa.int32())]))),
])
_SEQUENCE_SQL = ("sequence_id long, ids array<int>, position_ids array<int>, loss array<struct<start:int,end:int>>, "
                 "nodes array<struct<parent:int,start:int,end:int,attends:array<struct<start:int,end:int>>>>, "
                 "leaves array<struct<leaf:string,node:int>>")


@dataclass(frozen=True)
class Formatted:
    """``sequences``, and of every conversation the leaf under which it is found there."""

    sequences: Staged
    members: DataFrame


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns, path, leaf): a row per conversation, its turns in order."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    turn = F.struct("turn", "role", "text")
    whole = rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    alone = rows.where("conv_id IS NULL").select("conv_id", F.array(turn).alias("turns"))
    found = whole.unionByName(alone).withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    return found.withColumns({
        "path": F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"])),
        "leaf": F.sha2(F.to_json(F.struct("turns")), 256),
    })


def format_conversations(conversations: DataFrame, path: str, limit: int = LIMIT) -> Formatted:
    """All conversations as tokens of prefix trees; ``path`` is the vocabulary file."""
    found = stage(paths(conversations), "conversations").df
    leaves = stage(found.select("leaf", "path", "turns").dropDuplicates(["leaf"]), "leaves")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, now, ready = TaskContext.get().partitionId() << 32, Sequence(), []
        for batch in batches:
            for leaf, turns in zip(column(batch, "leaf").to_pylist(), column(batch, "turns")):
                turns = turns.as_py()
                shared = now.shared(turns)
                encoded = [encode_turn(path, t["role"], t["text"]) for t in turns[shared:]]
                size = sum(len(part) for parts in encoded for part in parts)
                if now.ids and (not shared or len(now.ids) + size > limit):
                    ready.append(now.row(number))
                    encoded = [encode_turn(path, t["role"], t["text"]) for t in turns[:shared]] + encoded
                    number, now, shared = number + 1, Sequence(), 0
                now.add(leaf, turns, encoded, shared)
                if sum(len(row["ids"]) for row in ready) > limit:
                    yield pa.RecordBatch.from_pylist(ready, schema=_SEQUENCE)
                    ready = []
        if now.ids:
            ready.append(now.row(number))
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema=_SEQUENCE)

    ordered = leaves.df.repartitionByRange("path", "leaf").sortWithinPartitions("path", "leaf")
    with small_batches(conversations.sparkSession):
        sequences = stage(ordered.select("leaf", "turns").mapInArrow(run, _SEQUENCE_SQL), "sequences")
    return Formatted(sequences, found.select("conv_id", "leaf"))


@lru_cache(256)
def _fixed(path: str, text: str) -> tuple[int, ...]:
    return tuple(encoder(path).encode(text))


def encode_turn(path: str, role: str, text: str) -> tuple[tuple, list[int], tuple]:
    """The ids of a turn's head, text and end."""
    head, text, end = turn_parts(role, text)
    known = _fixed(path, head) if len(head) < 40 else tuple(encoder(path).encode(head))
    return known, encoder(path).encode(text), _fixed(path, end)


def digests(made: Formatted, path: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of every
    conversation, read back from the sequences alone: tokens to text, text to turns, what the
    loss mask covers. A turn goes on from the state of its parent, so shared ones are read once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fast = encoder(path).fast
        for batch in batches:
            for ids, loss, nodes, leaves in zip(*(column(batch, name) for name in ("ids", "loss", "nodes", "leaves"))):
                ids, loss = ids.values.to_numpy(), loss.as_py()
                text_of = lambda s, e: fast.decode_bytes(ids[s:e].tolist()).decode()  # noqa: B023, E731
                starts = np.array([span["start"] for span in loss], np.int64)
                states: list[tuple] = []
                for node in nodes.as_py():
                    n, turns, chars, lost, size = states[node["parent"]] if node["parent"] >= 0 else (0, hashlib.sha256(), 0, hashlib.sha256(), 0)
                    turns, lost = turns.copy(), lost.copy()
                    text = text_of(node["start"], node["end"])
                    for role, said in read_turns(text):
                        turns.update(f"{role}\n{said}\n".encode())
                        n += 1
                    i, j = np.searchsorted(starts, (node["start"], node["end"]))
                    for span in loss[i:j]:
                        said = unescape(text_of(span["start"], span["end"]))
                        lost.update(said.encode())
                        chars += len(said)
                    states.append((n, turns, chars, lost, size + len(text)))
                rows = [(leaf["leaf"], *states[leaf["node"]]) for leaf in leaves.as_py()]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2].hexdigest() for r in rows]), pa.array([r[3] for r in rows], pa.int64()),
                    pa.array([r[4].hexdigest() for r in rows]), pa.array([r[5] for r in rows], pa.int64()),
                ], names=["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    with small_batches(made.members.sparkSession):
        read = stage(made.sequences.df.select("ids", "loss", "nodes", "leaves").mapInArrow(
            run, "leaf string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"), "read-back")
    return made.members.join(read.side(), "leaf").drop("leaf")
