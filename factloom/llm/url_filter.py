"""URL filter: a trie over reversed host labels, then path segments.

Rules are ``host`` and ``path``. A rule fits its host and all subdomains, if the
path of the URL starts with the rule's. The longest fitting rule decides between
allow and block: the one with most host labels, then the longest path. Of two
equal rules with different verdicts, block wins. The trie is broadcast; its size
is bounded by ``MOST_RULES``, beyond which building it fails.

Defined cases: a NULL url, or one without ``://``, has an empty host and path; no
rule fits it and it is blocked, since it names no host. A URL with a host that no
rule fits gets ``default``. Repeated rows are judged one by one, so an empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.texts import column, record_batches

RESULT = "page_id long, host string, path string, rule string, verdict string"
_SCHEMA = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                     ("rule", pa.string()), ("verdict", pa.string())])
MOST_RULES = 1_000_000
LOWER = {c: c + 32 for c in range(65, 91)}

# The rules of the registered query, as verdict, host and path.
BASE_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
              ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def split_url(url: str | None) -> tuple[str, str]:
    """Host with A-Z in lower case, and path."""
    _, there, rest = (url or "").partition("://")
    if not there:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return rest[:end].translate(LOWER), path[:stop]


class Node:
    __slots__ = ("below", "paths")

    def __init__(self):
        self.below: dict[str, Node] = {}
        self.paths: PathNode | None = None


class PathNode:
    """Below a host: whole segments with their slash, and beginnings of a segment."""

    __slots__ = ("below", "rule", "parts")

    def __init__(self):
        self.below: dict[str, PathNode] = {}
        self.rule: tuple[str, str] | None = None
        self.parts: dict[str, tuple[str, str]] = {}


class Trie:
    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root = Node()
        for count, (verdict, host, path) in enumerate(rules, 1):
            if count > MOST_RULES:
                raise ValueError(f"more than {MOST_RULES} rules do not fit a broadcast")
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r}")
            self._add(verdict, host.translate(LOWER), path)

    def _add(self, verdict: str, host: str, path: str) -> None:
        node = self.root
        for label in reversed(host.split(".")) if host else ():
            node = node.below.setdefault(label, Node())
        at = node.paths = node.paths or PathNode()
        *segments, part = path.split("/")
        for segment in segments:
            at = at.below.setdefault(segment, PathNode())
        old = at.parts.get(part) if part else at.rule
        entry = (f"{host}{path}", "block" if old and old[1] == "block" else verdict)
        if part:
            at.parts[part] = entry
        else:
            at.rule = entry

    def longest(self, host: str, path: str) -> tuple[str, str] | None:
        """Rule and verdict; hosts first, deepest last, and below each the longest path."""
        found, node = None, self.root
        segments = path.split("/")
        labels = host.split(".")
        for depth in range(len(labels), -1, -1):
            if node.paths is not None:
                found = self._longest_path(node.paths, segments) or found
            if depth == 0:
                break
            node = node.below.get(labels[depth - 1])
            if node is None:
                break
        return found

    @staticmethod
    def _longest_path(at: PathNode, segments: list[str]) -> tuple[str, str] | None:
        found = at.rule
        for depth, segment in enumerate(segments):
            if at.parts:
                for end in range(len(segment), 0, -1):
                    if segment[:end] in at.parts:
                        found = at.parts[segment[:end]]
                        break
            if depth == len(segments) - 1:
                break
            at = at.below.get(segment)
            if at is None:
                break
            found = at.rule or found
        return found


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = BASE_RULES, default: str = "allow") -> DataFrame:
    """page_id, host, path, the rule that decided (NULL if none) and the verdict."""
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trie.value

        def rows():
            for batch in batches:
                for page_id, url in zip(column(batch, "page_id").to_pylist(), column(batch, "url").to_pylist()):
                    host, path = split_url(url)
                    found = tree.longest(host, path) if host else None
                    rule, verdict = found or (None, default if host else "block")
                    yield page_id, host, path, rule, verdict

        return record_batches(rows(), _SCHEMA)

    columns = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    return columns.mapInArrow(run, RESULT)
