"""Best-fit packing with a swap-based local search.

Documents become pieces of at most ``capacity`` tokens, and pieces go into as few
sequences as can be found. Pieces are dealt into blocks of bounded size by number,
whatever their documents are. In each block a best-fit pass comes first; then the
least filled sequence is emptied by moves and by exchanges of one for one, two for
one or one for two, each of which moves tokens into a fuller sequence and so
raises the sum of squared fills. It ends when nothing more can be emptied. What
stays underfull in one block meets that of other blocks in the next round, until
one block holds all of it. At most half of a block's pieces go on to the next round,
those of its least filled sequences, so that the rounds come to an end whatever the
lengths are.

Defined cases: a NULL or empty text is the end token alone. Rows are packed one by
one, so repeated rows and equal ids are packed as often as they occur. An empty
table gives no sequences. Other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.texts import column, forgetful, keep_batches_small, record_batches, small_batches
from factloom.llm.tokens import encoder, little_endian
from factloom.sources.staging import stage

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                           ("length", pa.int64()), ("ids_crc32", pa.int64())])
BLOCK_PIECES = 16_384


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and end of each piece; only the first may be shorter than the capacity."""
    first = n % capacity or capacity
    yield 0, first
    for start in range(first, n, capacity):
        yield start, start + capacity


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece of every document, with the checksum of its ids."""

    @forgetful
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode

        def rows():
            for batch in batches:
                ids_of = column(batch, "doc_id").to_pylist()
                for i, text in enumerate(column(batch, "text")):
                    ids = encode(text.as_py())
                    ids.append(end_id)
                    raw = little_endian(ids)
                    for number, (start, end) in enumerate(cut(len(ids), capacity)):
                        yield ids_of[i], number, start, end - start, zlib.crc32(raw[4 * start: 4 * end])

        return record_batches(rows(), _PIECE_SCHEMA)

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keep_batches_small(docs.sparkSession)
    return columns.mapInArrow(run, PIECES)


def pack(parts: DataFrame, capacity: int = 1024, block: int = BLOCK_PIECES) -> DataFrame:
    """``parts`` (with a ``length`` column) plus sequence_id and offset."""
    with small_batches(parts.sparkSession):
        numbered = stage(parts.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    left, rows, done, level = numbered.df, numbered.rows, None, 0
    while True:
        blocks = max(1, -(-rows // block))
        packed = stage(_pack_blocks(left, parts.columns, blocks, capacity, level, last=blocks == 1), f"packed-{level}",
                       metrics={"open": F.count_if(~F.col("_closed"))})
        closed = packed.df.where("_closed").drop("_closed", "_row")
        done = closed if done is None else done.unionByName(closed)
        if not packed.metrics["open"]:
            return done
        left = packed.df.where("not _closed").drop("_closed", "sequence_id", "offset")
        rows, level = packed.metrics["open"], level + 1


def _pack_blocks(left: DataFrame, names: list[str], blocks: int, capacity: int, level: int, last: bool) -> DataFrame:
    schema = left.select(*names, "_row").schema.add("sequence_id", "long").add("offset", "long").add("_closed", "boolean")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.take(pa.compute.sort_indices(table.column("_row")))
        bin_of, offset, fill = pack_block(table.column("length").to_numpy(), capacity)
        # What is left over goes on to a block of the left-over of others.
        closed = np.ones(len(bin_of), bool) if last else closed_bins(bin_of, fill, capacity)[bin_of]
        sequence = (np.int64(level) << 58) | (np.int64(key[0].as_py()) << 20) | bin_of
        out = table.select([*names, "_row"])
        for name, values in (("sequence_id", sequence), ("offset", offset), ("_closed", closed)):
            out = out.append_column(name, pa.array(values))
        return out

    dealt = left.select(*names, "_row", F.pmod(F.xxhash64("_row", F.lit(level)), F.lit(blocks)).alias("_block"))
    return dealt.groupBy("_block").applyInArrow(run, schema)


def closed_bins(bin_of: np.ndarray, fill: np.ndarray, capacity: int) -> np.ndarray:
    """Which bins are done: the nearly full ones, and the fullest others until at most half of the pieces are open."""
    closed = fill >= capacity - capacity // 64
    pieces_of = np.bincount(bin_of, minlength=len(fill))
    emptiest = np.argsort(fill, kind="stable")
    waiting = np.cumsum(np.where(closed, 0, pieces_of)[emptiest])
    closed[emptiest[waiting > len(bin_of) // 2]] = True
    return closed


def pack_block(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the fill of each bin."""
    bins = Bins(lengths.tolist(), capacity)
    bins.empty_the_least()
    bin_of = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    fills = []
    for items in bins.items:
        if items:
            at = 0
            for i in items:
                bin_of[i], offset[i] = len(fills), at
                at += bins.lengths[i]
            fills.append(at)
    return bin_of, offset, np.array(fills, np.int64)


class Bins:
    """Sequences of one block: their pieces, their fill, and which have what room.

    For the search, tables hold for each room the lengths of single pieces and of pairs
    of pieces in bins with that room, so that all bins are looked at together.
    """

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        self.with_room: list[dict[int, None]] = [{} for _ in range(capacity + 1)]  # in order of arrival
        self.rooms = 0  # bit r is set if some bin has room r
        self.tables: tuple[LengthTable, LengthTable] | None = None  # of single pieces and of pairs
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = self.rooms >> lengths[i]
            if lengths[i] < capacity and fits:
                at = next(iter(self.with_room[lengths[i] + (fits & -fits).bit_length() - 1]))
            else:
                at = len(self.items)
                self.items.append([])
                self.fill.append(0)
            self.change(at, [], [i])

    def change(self, at: int, out: list[int], into: list[int]) -> None:
        """Takes pieces out of a bin and puts others in."""
        before = self.capacity - self.fill[at]
        if self.tables and at in self.with_room[before]:
            self._enter(at, -1)
        self.with_room[before].pop(at, None)
        if not self.with_room[before]:
            self.rooms &= ~(1 << before)
        for i in out:
            self.items[at].remove(i)
        self.items[at] += into
        self.fill[at] += sum(self.lengths[i] for i in into) - sum(self.lengths[i] for i in out)
        room = self.capacity - self.fill[at]
        if self.items[at] and room:
            self.with_room[room][at] = None
            self.rooms |= 1 << room
            if self.tables:
                self._enter(at, 1)
                self.clock += 1
                self.arrived[room] = self.clock
        if self.tables:
            self.stuck_at.pop(at, None)

    def _enter(self, at: int, sign: int) -> None:
        """Adds a bin's lengths to the tables, or takes them out."""
        if sign > 0:
            self.sums[at] = self._sums(self.items[at])
        for table, sums in zip(self.tables, self.sums[at]):
            table.add(self.capacity - self.fill[at], list(sums), sign)

    def _sums(self, items: list[int]) -> tuple[dict[int, list[int]], dict[int, list[int]]]:
        """Lengths of single pieces and of pairs, and pieces that have them."""
        by_length: dict[int, list[int]] = {}
        for i in items:
            by_length.setdefault(self.lengths[i], []).append(i)
        pairs: dict[int, list[int]] = {}
        known = list(by_length.items())  # few even in a bin of many pieces: their sum is at most the capacity
        for n, (a, of_a) in enumerate(known):
            if len(of_a) > 1:
                pairs.setdefault(2 * a, of_a[:2])
            for b, of_b in known[n + 1:]:
                pairs.setdefault(a + b, [of_a[0], of_b[0]])
        return {a: of_a[:1] for a, of_a in by_length.items()}, pairs

    def start_search(self) -> None:
        """Enters all underfull bins in the tables."""
        self.tables = LengthTable(self.capacity), LengthTable(self.capacity)
        self.sums: dict[int, tuple[dict[int, list[int]], dict[int, list[int]]]] = {}
        self.clock, self.arrived, self.stuck_at = 1, np.zeros(self.capacity + 1, np.int64), {}
        for room, bins in enumerate(self.with_room):
            for at in bins:
                self._enter(at, 1)
                self.arrived[room] = 1

    def empty_the_least(self) -> None:
        """Moves and exchanges, least filled bins first, until the bins are as few as the
        lower bound or no bin has one left.

        A bin that was stuck is tried again only against rooms in which bins have arrived since.
        """
        least, count = lower_bound(self.lengths, self.capacity), len(self.items)
        if count <= least:
            return
        self.start_search()
        again = True
        while again:
            again = False
            for at in [b for r in range(self.capacity, 0, -1) for b in self.with_room[r]]:
                while self.items[at] and self.fill[at] < self.capacity and self.improve(at):
                    again = True
                if not self.items[at]:
                    count -= 1
                    if count <= least:
                        return

    def improve(self, least: int) -> bool:
        """One move or exchange that takes tokens out of ``least`` into a bin that is at
        least as full, so that the sum of squared fills grows."""
        since = self.stuck_at.get(least, 0)
        new = [r for r in np.flatnonzero(self.arrived > since).tolist() if self.rooms >> r & 1]
        self.stuck_at[least] = self.clock
        if not new:
            return False
        size, own_room = self.lengths, self.capacity - self.fill[least]
        own = sorted(self.items[least], key=lambda i: (-size[i], i))
        for i in own:  # move
            for room in new[bisect_left(new, size[i]):]:
                if self.capacity - room <= self.fill[least] - size[i]:
                    break  # in emptier bins the squares would not grow
                at = next((b for b in self.with_room[room] if b != least), None)
                if at is not None:
                    self.change(least, [i], [])
                    self.change(at, [], [i])
                    return True
        rooms = [r for r in new if r < own_room or r == own_room and len(self.with_room[r]) > 1]
        if not rooms:
            return False
        mine = self.sums[least]
        alone = own_room in rooms  # its own lengths are no target
        if alone:
            self._enter(least, -1)
        singles, pairs = self.tables
        found = max(singles.best(rooms, list(mine[0] | mine[1])), pairs.best(rooms, list(mine[0])), key=lambda f: (f[0], -f[1]))
        if alone:
            self._enter(least, 1)
        gain, room, out = found
        if gain <= 0:
            return False
        kind = next(n for n in (0, 1) if any(out - gain in self.sums[b][n] for b in self.with_room[room] if b != least)
                    and (n == 0 or out in mine[0]))
        at = next(b for b in self.with_room[room] if b != least and out - gain in self.sums[b][kind])
        sent, back = mine[0].get(out) or mine[1][out], self.sums[at][kind][out - gain]
        self.change(least, sent, [])
        self.change(at, back, sent)
        self.change(least, [], back)
        return True


class LengthTable:
    """How many bins of each room have a length, and the next length from any number on."""

    def __init__(self, capacity: int):
        self.none = capacity + 1
        self.count = np.zeros((capacity + 1, capacity + 1), np.int32)
        self.next = np.full((capacity + 1, capacity + 1), self.none, np.int32)
        self.stale: set[int] = set()

    def add(self, room: int, lengths: list[int], sign: int) -> None:
        self.count[room, lengths] += sign
        self.stale.add(room)

    def best(self, rooms: list[int], lengths: list[int]) -> tuple[int, int, int]:
        """The most that exchanging one of ``lengths`` for a smaller one moves into a bin
        without exceeding its room; that room, the smallest if several, and the length."""
        if not lengths:
            return 0, 0, 0
        for room in self.stale.intersection(rooms):
            held = np.where(self.count[room] > 0, np.arange(self.none), self.none)
            self.next[room] = np.minimum.accumulate(held[::-1])[::-1]
            self.stale.remove(room)
        of, out = np.array(rooms)[:, None], np.array(sorted(lengths))[None, :]
        gain = out - self.next[of, np.maximum(out - of, 0)]
        room, length = divmod(int(gain.argmax()), out.size)
        return int(gain[room, length]), rooms[room], int(out[0, length])


def lower_bound(lengths: list[int], capacity: int) -> int:
    """Bins that any packing needs (Martello and Toth): pieces over half share no bin, and
    pieces from a length on do not fit beside those that leave less room."""
    number = np.bincount(np.array(lengths, np.int64), minlength=capacity + 1)
    pieces, tokens = np.cumsum(number), np.cumsum(number * np.arange(capacity + 1))
    small = np.arange(capacity // 2 + 1)  # shorter pieces are left out
    over, half = len(lengths) - pieces[capacity // 2], capacity // 2
    beside = (pieces[capacity - small] - pieces[half]) * capacity - (tokens[capacity - small] - tokens[half])
    counted = tokens[half] - np.where(small > 0, tokens[np.maximum(small - 1, 0)], 0)
    return int((over + np.maximum(0, -(-(counted - beside) // capacity))).max())
