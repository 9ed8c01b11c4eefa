"""Licence scan: ordered signature rules behind a keyword prefilter.

A text becomes its words, lower-case in ASCII. One automaton over all keywords
finds which rules can match at all; only their regular expressions run. Detections
are taken by priority, then length, then place, then order of the rules, and one
that lies inside a detection already taken is suppressed. Base rules are reported
wherever they match, suppressed or not.

Defined cases: a NULL or empty text has no words and no detections. Repeated rows
are scanned one by one. Other columns are not read. Texts are scanned whole; a
task holds one Arrow batch at a time.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.license_rules import Rule, rules
from factloom.llm.texts import column, column_bytes, record_batches

RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, detections array<struct<label:string,first:long,last:long,priority:int>>")
_DETECTION = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("priority", pa.int32())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                     ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                     ("labels", pa.string()), ("score", pa.float64()), ("detections", pa.list_(_DETECTION))])
# Words are runs of ASCII digits and letters and of all bytes above; A-Z become a-z.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Detection(NamedTuple):
    first: int
    last: int
    label: str
    priority: int
    order: int
    base: bool


class Scanner:
    def __init__(self, signatures: tuple[Rule, ...]):
        import ahocorasick

        self.rules = signatures
        self.patterns = [re.compile(rf"(?:(?<= )|\A)(?:{rule.pattern})(?= |\Z)") for rule in signatures]
        gates: dict[str, list[int]] = {}
        for order, rule in enumerate(signatures):
            for keyword in rule.keywords:
                gates.setdefault(keyword, []).append(order)
        self.gates = ahocorasick.Automaton()
        for keyword, orders in gates.items():
            self.gates.add_word(keyword, orders)
        self.gates.make_automaton()

    def words(self, text: bytes | None) -> list[bytes]:
        return text.translate(WORD_BYTES).split() if text else []

    def detections(self, words: list[bytes]) -> list[Detection]:
        """Every match of every rule of which a keyword is there."""
        plain = b" ".join(words).decode("latin-1")
        gated = {order for _, orders in self.gates.iter(plain) for order in orders}
        if not gated:
            return []
        starts, at = [], 0
        for word in words:
            starts.append(at)
            at += len(word) + 1
        found = []
        for order in sorted(gated):
            rule = self.rules[order]
            for match in self.patterns[order].finditer(plain):
                first, last = bisect_left(starts, match.start()), bisect_left(starts, match.end()) - 1
                found.append(Detection(first, last, rule.label, rule.priority, order, rule.base))
        return found


def resolve(found: list[Detection]) -> list[Detection]:
    """Those that do not lie inside one of higher rank: none that starts at or before
    them ends at or after them. Largest ends by start are kept in a Fenwick tree."""
    starts = sorted({d.first for d in found})
    ends, out = [-1] * (len(starts) + 1), []
    for d in sorted(found, key=lambda d: (-d.priority, d.first - d.last, d.first, d.order)):
        place = at = bisect_left(starts, d.first) + 1
        furthest = -1
        while at:
            furthest = max(furthest, ends[at])
            at -= at & -at
        if furthest >= d.last:
            continue
        while place < len(ends):
            ends[place] = max(ends[place], d.last)
            place += place & -place
        out.append(d)
    return sorted(out, key=lambda d: (d.first, d.last, d.order))


@cache
def scanner(signatures: tuple[Rule, ...]) -> Scanner:
    return Scanner(signatures)


def scan(docs: DataFrame, signatures: tuple[Rule, ...] | None = None) -> DataFrame:
    """One row per document: RESULT. ``score`` is the confidence of the best detection
    that was kept, its priority as a share of the highest."""
    signatures = rules() if signatures is None else tuple(signatures)
    top = max((rule.priority for rule in signatures), default=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = scanner(signatures)

        def rows():
            for batch in batches:
                for doc_id, text in zip(column(batch, "doc_id").to_pylist(), column_bytes(batch, "text")):
                    words = tool.words(text)
                    found = tool.detections(words)
                    base = [d for d in found if d.base]
                    kept = resolve(found)
                    names = sorted({d.label for d in base})
                    yield (doc_id, len(words), len(base), min((d.first for d in base), default=None),
                           max((d.first for d in base), default=None), ",".join(names),
                           ",".join(sorted({d.label for d in kept}.union(names))),
                           max((d.priority for d in kept), default=0) / top,
                           [{"label": d.label, "first": d.first, "last": d.last, "priority": d.priority} for d in kept])

        return record_batches(rows(), _SCHEMA)

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(run, RESULT)
