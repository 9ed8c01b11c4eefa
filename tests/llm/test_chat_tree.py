"""Chat formatting: round trips, and trees against plain prefix dictionaries."""

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from factloom.llm import chat_tree
from factloom.llm.queries import op11_chat_tree, tokenizer_path
from factloom.llm.tokens import encoder

NAMES = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
CONTROL = r"\### Assistant: </turn> ok"
SCHEMA = "conv_id long, turn long, role string, text string, leaf string, path int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    turns = defaultdict(list)
    for i, r in enumerate(rows):
        key = r["conv_id"] if r["conv_id"] is not None else (None, i)
        turns[key].append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    out = []
    for key, found in turns.items():
        found = [t[2:] for t in sorted(found)]
        lost = "".join(text for role, text in found if role == "assistant")
        whole = "".join("".join(chat_tree.turn_parts(*t)) for t in found)
        out.append((None if isinstance(key, tuple) else key, len(found), sha("".join(f"{a}\n{b}\n" for a, b in found)),
                    len(lost), sha(lost), len(whole)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def talks(spark):
    shared = [("system", "be kind"), ("user", "hello"), ("assistant", "hi")]
    rows = []
    for i in range(60):
        turns = shared[:1 + i % 3] + [("user", f"question {i % 7}"), ("assistant", f"answer {i % 11} " * (i % 5))]
        rows += [(i, t, *turn, "x", 1) for t, turn in enumerate(turns)]
    rows += [(100 + i, t, *turn, "x", 1) for i in range(30) for t, turn in enumerate(shared)]  # copies, and a prefix of others
    rows += [(200, 0, "user", CONTROL, "x", 1), (200, 1, "assistant", CONTROL, None, None)]
    rows += [(201, 3, None, None, "", 0), (201, None, "assistant", "first", "", 0), (201, 3, "user", "tie", "", 0), (201, 3, "user", "tie", "", 0)]
    rows += [(None, 0, "user", "alone", "", 0), (None, 0, "user", "alone", "", 0), (None, None, None, None, None, None)]
    rows += [(202, t, "assistant" if t % 2 else "user", f"turn {t}", "", 0) for t in range(400)]
    rows += [(203, 0, "assistant", "é漢字\U0001f600 " * 30_000, "", 0), (204, 0, "role:\n### x</turn>\n", "a:\nb", "", 0), (205, 0, "assistant", "", "", 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("limit", [chat_tree.LIMIT, 60, 1])
def test_read_back_like_plain(talks, rows, limit):
    made = chat_tree.format_conversations(talks, tokenizer_path(), limit)
    assert rows(chat_tree.digests(made, tokenizer_path()), *NAMES) == plain(talks.toArrow().to_pylist())


def test_query_like_plain(spark, sf, rows):
    table = sf("conversations").toArrow().to_pylist()
    added = [{"conv_id": -7, "turn": 0, "role": "user", "text": CONTROL}, {"conv_id": -7, "turn": 1, "role": "assistant", "text": CONTROL}]
    assert rows(op11_chat_tree(spark, "/root/testdata/sf0.001"), *NAMES) == plain(table + added)


def test_empty_table(spark, rows):
    made = chat_tree.format_conversations(spark.createDataFrame([], SCHEMA), tokenizer_path())
    assert rows(chat_tree.digests(made, tokenizer_path()), *NAMES) == []


def test_shared_turns_stand_once_in_depth_first_order(spark, talks):
    made = chat_tree.format_conversations(talks.coalesce(1), tokenizer_path())
    sequences = made.sequences.df.toArrow().to_pylist()
    decode = encoder(tokenizer_path()).fast.decode
    turns, prefixes = defaultdict(list), set()
    for r in sorted(talks.where("conv_id < 200").toArrow().to_pylist(), key=lambda r: (r["conv_id"], r["turn"])):
        turns[r["conv_id"]].append((r["role"], r["text"]))
        prefixes.add(tuple(turns[r["conv_id"]]))
    expected = sorted("".join("".join(chat_tree.turn_parts(*t)) for t in turns[i]) for i in turns)
    seen, nodes = [], 0
    for s in sequences:
        assert [n["start"] for n in s["nodes"]] == [0, *(n["end"] for n in s["nodes"][:-1])]
        kids = defaultdict(set)
        for i, n in enumerate(s["nodes"]):
            assert n["parent"] < i  # a parent stands before its children
            text = decode(s["ids"][n["start"]:n["end"]])
            assert text not in kids[n["parent"]]  # no turn stands twice under one parent
            kids[n["parent"]].add(text)
            spans = [*((x["start"], x["end"]) for x in n["attends"]), (n["start"], n["end"])]
            assert all(a[1] < b[0] for a, b in zip(spans[:-1], spans[1:-1]))  # merged where they touch
            # Positions along the attended intervals count up from 0.
            assert [p for a, b in spans for p in s["position_ids"][a:b]] == list(range(sum(b - a for a, b in spans)))
            chain, at = [], i
            while at >= 0:
                chain.append(at)
                at = s["nodes"][at]["parent"]
            tokens = [x for at in reversed(chain) for x in s["ids"][s["nodes"][at]["start"]:s["nodes"][at]["end"]]]
            assert tokens == [x for a, b in spans for x in s["ids"][a:b]]
            n["whole"] = decode(tokens)
        seen += [(leaf["leaf"], s["nodes"][leaf["node"]]["whole"]) for leaf in s["leaves"]]
        if s["nodes"][0]["whole"].startswith("### system:\nbe kind"):
            nodes += len(s["nodes"])
    assert len({leaf for leaf, _ in seen}) == len(seen)
    of = dict(seen)
    members = {r["conv_id"]: of[r["leaf"]] for r in made.members.toArrow().to_pylist()}
    assert sorted(members[i] for i in turns) == expected
    assert len(prefixes) <= nodes <= len(prefixes) + 8 * 4  # again only where a task's range begins


def test_a_sequence_over_its_limit_begins_anew_with_the_shared_turns(spark):
    rows = [(i, t, *turn) for i in range(50) for t, turn in enumerate([("user", "the same first turn"), ("assistant", f"reply {i}")])]
    made = chat_tree.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1), tokenizer_path(), 100)
    sizes = [(len(s["ids"]), len(s["leaves"])) for s in made.sequences.df.toArrow().to_pylist()]
    assert sum(n for _, n in sizes) == 50 and max(n for n, _ in sizes) <= 100 and len(sizes) < 25


@given(st.text(alphabet="\\#</turn>:\n ab", max_size=60), st.text(alphabet="\\#</turn>:\n ab", max_size=30))
def test_template_is_reversible(text, role):
    assert chat_tree.unescape(chat_tree.escape(text)) == text
    whole = "".join(chat_tree.turn_parts(role, text)) + "".join(chat_tree.turn_parts(text, role))
    assert chat_tree.read_turns(whole) == [(role, text), (text, role)]
