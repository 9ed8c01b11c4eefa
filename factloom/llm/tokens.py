"""Encoding of whole texts with a public byte-level BPE vocabulary file.

The usual splitting rule looks ahead after spaces, which keeps it from running as
one automaton and costs half of all time. Runs of one or two spaces before a word
are split alike without looking ahead; only texts with longer runs, or with a run
at their end, go through the file's own rule.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import cache

# Fixed value: the vocabulary's splitting rule, without its look-ahead.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
LONG_RUN = re.compile(r"\s\s\s|\s\s\Z")


def ranks(path: str) -> dict[bytes, int]:
    """Ids by bytes. The file writes a byte that does not print as a letter from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in prints}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in prints)}
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {x["content"] for x in content["added_tokens"]}
    return {bytes(letters[c] for c in t): i for t, i in content["model"]["vocab"].items() if t not in special}


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True  # their strings in a text are ordinary text
        self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks(path), special_tokens={})

    def encode(self, text: str | None) -> list[int]:
        """The ids of a whole text; none for NULL or an empty one."""
        if not text:
            return []
        if LONG_RUN.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def little_endian(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


@cache
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)
