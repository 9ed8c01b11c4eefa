"""Licence scan, url filter, token counts, packing and shards against plain versions."""

import re
import zlib
from bisect import bisect_right
from collections import Counter
from itertools import combinations, product

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import hilbert, licenses, packing, token_counts, url_filter
from factloom.llm.license_rules import Rule, rules
from factloom.llm.queries import tokenizer_path
from factloom.llm.tokens import encoder, little_endian

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def plain_licences(text):
    words = WORDS.findall((text or "").encode().translate(LOWER))
    starts, labels = [], set()
    for phrase, label in ((b"cc by", "cc-by"), (b"general public license", "gpl"), (b"all rights reserved", "reserved")):
        parts = phrase.split()
        for i in range(len(words)):
            if words[i: i + len(parts)] == parts:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


@pytest.mark.parametrize("which", ["sf", "nasty", "nothing"])
def test_licences_like_plain_search(which, sf, nasty, nothing):
    docs = {"sf": sf("documents"), "nasty": nasty, "nothing": nothing}[which]
    expected = Counter((r["doc_id"], *plain_licences(r["text"])) for r in docs.toArrow().to_pylist())
    got = licenses.scan(docs).toArrow().to_pylist()
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert Counter(tuple(r[n] for n in names) for r in got) == expected
    for r in got:
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def samples(tree):
    """A text for every choice that a pattern leaves."""
    parts = []
    for kind, value in tree:
        if kind is re._constants.LITERAL:
            parts.append([chr(value)])
        elif kind is re._constants.BRANCH:
            parts.append([text for branch in value[1] for text in samples(branch)])
        elif kind is re._constants.SUBPATTERN:
            parts.append(list(samples(value[3])))
        elif kind is re._constants.MAX_REPEAT:
            parts.append(["x" * value[0]] if value[1] > 1 else ["", *samples(value[2])])
        elif kind is re._constants.IN:
            parts.append([chr(x if a is re._constants.LITERAL else x[0]) for a, x in value])
        else:
            raise ValueError(kind)
    return ("".join(choice) for choice in product(*parts))


def test_every_alternative_of_every_rule_matches_and_opens_its_gate():
    assert len(rules()) > 300
    for rule in rules():
        pattern = re.compile(rule.pattern)
        for text in samples(re._parser.parse(rule.pattern)):
            assert pattern.fullmatch(text) and any(word in text for word in rule.keywords), (rule, text)


@pytest.mark.parametrize("text,label", [
    ("expat license", "mit"), ("released under the expat license", "mit"), ("png reference library license", "libpng"),
    ("creativeml open rail license", "openrail"), ("open rail m", "openrail"), ("lisp lesser general public license", "llgpl")])
def test_names_without_the_short_word_are_found(text, label):
    tool = licenses.scanner(rules())
    assert label in {d.label for d in tool.detections(tool.words(text.encode()))}


def plain_labels(text):
    """All rules without a gate; what lies inside a detection of higher rank goes."""
    words = (text or "").encode().translate(licenses.WORD_BYTES).split()
    joined, found = b" ".join(words).decode("latin-1"), []
    for order, rule in enumerate(rules()):
        for m in re.finditer(rf"(?:(?<= )|\A)(?:{rule.pattern})(?= |\Z)", joined):
            first = joined[:m.start()].count(" ")
            found.append((-rule.priority, -(len(m[0].split())), first, order, first + len(m[0].split()), rule.label, rule.base))
    kept = []
    for d in sorted(found):
        if not any(k[2] <= d[2] and d[4] <= k[4] for k in kept):
            kept.append(d)
    labels = {d[5] for d in kept} | {d[5] for d in found if d[6]}
    return ",".join(sorted(labels)), max((-d[0] for d in kept), default=0) / max(rule.priority for rule in rules())


def test_labels_and_scores_like_all_rules_without_gates(spark, sf):
    texts = [r["text"] for r in sf("documents").select("text").limit(60).collect()]
    texts += [f"{a} and {b}, Copyright (c) 2020 of it" for a, b in combinations(
        ["Expat License", "GNU Lesser General Public License version 2.1", "licensed under the MIT license", "All Rights Reserved",
         "CC-BY-NC 4.0", "SPDX-License-Identifier: Apache-2.0", "see the license file", "public domain"], 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(docs).collect()}
    assert got == {i: plain_labels(text) for i, text in enumerate(texts)}


def test_a_detection_inside_one_of_higher_rank_is_suppressed(spark):
    signatures = (Rule("low", 10, "licen", "the licen[cs]e"), Rule("high", 50, "licensed", "licensed under the license"),
                  Rule("base", 1, "under", "under", base=True))
    docs = spark.createDataFrame([(1, "Licensed UNDER the-license; the licence")], "doc_id long, text string")
    row = licenses.scan(docs, signatures).first()
    assert row["labels"] == "base,high,low" and row["base_labels"] == "base" and row["score"] == 1.0
    assert [(d["label"], d["first"], d["last"]) for d in row["detections"]] == [("high", 0, 3), ("low", 4, 5)]


URLS = ["https://A.Example.NET/en/x?y#z", "http://example.net/en", "http://example.net", "ftp://x.com/a/b", "no-scheme", "", None,
        "http://www.example.com/de/", "http://example.com/dex/", "http://badexample.com/de/", "http://org/fr/1", "http://b.org/fr?/fr/",
        "http://x.net?a/b", "http://x.net#/", "https://net/", "a://b://c/d", "http:///en/", "http://.net/"]


def plain_verdict(url):
    if url is None or "://" not in url:
        return "", "", None, "block"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.encode().translate(LOWER).decode()
    fits = [(h.count("."), len(p), h + p, v) for v, h, p in url_filter.BASE_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else ("allow" if host else "block")


def test_urls_like_plain_rules(spark, sf, nothing):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(URLS)] + [(None, URLS[0], None, None)],
                                  "page_id long, url string, html string, host int")
    for table in (pages, sf("pages"), pages.limit(0)):
        expected = Counter((r["page_id"], *plain_verdict(r["url"])) for r in table.toArrow().to_pylist())
        got = url_filter.judge(table).toArrow().to_pylist()
        assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == expected


def test_longest_rule_parts_of_segments_and_ties(spark):
    trie = url_filter.Trie([("block", "com", "/"), ("allow", "a.com", "/x/y"), ("block", "a.com", "/x/yz"), ("allow", "com", "/x/y/z/"),
                            ("allow", "t.com", "/"), ("block", "t.com", "/")])
    assert trie.longest("b.a.com", "/x/y1/")[1] == "allow"
    assert trie.longest("b.a.com", "/x/yz")[1] == "block"
    assert trie.longest("b.a.com", "/w") == ("com/", "block")
    assert trie.longest("c.com", "/x/y/z/") == ("com/x/y/z/", "allow")
    assert trie.longest("t.com", "/a")[1] == "block"
    assert trie.longest("a.org", "/") is None


def test_tokens_equal_the_tokenizer(sf):
    tool = encoder(tokenizer_path())
    texts = [r["text"] for r in sf("documents").toArrow().to_pylist() if r["text"]]
    texts += ["a   b", " a  b \n c\n \n", "<|endoftext|> b. .. c,", "x\t y", "é  b  ", "a\0b", "  ", "12 3.4, don't we'll .", "\n\n\na", "a \n", "　  b"]
    for text in texts:
        assert tool.encode(text) == tool.slow.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("which", ["sf", "nasty", "nothing"])
def test_length_histogram_answers(which, sf, nasty, nothing, spark):
    docs = {"sf": sf("documents"), "nasty": nasty, "nothing": nothing}[which]
    tool = encoder(tokenizer_path())
    lengths = {}
    for r in docs.toArrow().to_pylist():
        lengths.setdefault(r["lang"], []).append(len(tool.encode(r["text"])))
    answers = token_counts.limits(token_counts.histogram(docs, tokenizer_path(), "lang"))
    got = answers.toArrow().to_pylist()
    assert len(got) == sum(len(set(n)) for n in lengths.values())
    for r in got:
        own, limit = lengths[r["grp"]], r["context_limit"]
        assert r["n_docs"] == own.count(limit) and r["n_shorter"] == sum(n < limit for n in own)
        assert r["n_longer"] == sum(n > limit for n in own) and r["tokens_longer"] == sum(n for n in own if n > limit)
        assert r["total_tokens"] == sum(own) and r["truncated_tokens"] == sum(min(n, limit) for n in own)
    for r in token_counts.at_limit(answers, 100).toArrow().to_pylist():
        assert r["truncated_tokens"] == sum(min(n, 100) for n in lengths[r["grp"]])
    for r in token_counts.quantile(answers, 0.5).toArrow().to_pylist():
        own = sorted(lengths[r["grp"]])
        assert bisect_right(own, r["context_limit"]) >= len(own) / 2 > bisect_right(own, r["context_limit"] - 1)


@pytest.mark.parametrize("which", ["sf", "nasty", "nothing"])
def test_packing_round_trip(which, sf, nasty, nothing):
    docs = {"sf": sf("documents"), "nasty": nasty, "nothing": nothing}[which]
    tool, expected = encoder(tokenizer_path()), Counter()
    for r in docs.toArrow().to_pylist():
        ids = tool.encode(r["text"]) + [2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[r["doc_id"], i, a, b - a, zlib.crc32(little_endian(ids[a:b]))] += 1
    # Small blocks, so that leftovers meet in further rounds.
    got = packing.pack(packing.pieces(docs, tokenizer_path()), block=64).toArrow().to_pylist()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // 1024) * 1.02 + 2


@pytest.mark.parametrize("small", [0, 700])
def test_packing_ends_where_pieces_do_not_combine(spark, small):
    parts = spark.range(20_000).select(F.when(F.col("id") < small, 424).otherwise(600).cast("long").alias("length"))
    got = packing.pack(parts).groupBy("sequence_id").agg(F.sum("length").alias("fill"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in got) == 20_000 and max(r["fill"] for r in got) <= 1024
    assert len(got) == 20_000 - small  # the lower bound: no two of 600 fit


def test_at_most_half_of_a_block_stays_open():
    lengths = np.array([600] * 999 + [1020] * 3 + [5] * 40)
    bin_of, _, fill = packing.pack_block(lengths, 1024)
    closed = packing.closed_bins(bin_of, fill, 1024)
    assert closed[fill >= 1008].all() and 0 < (~closed[bin_of]).sum() <= len(lengths) // 2
    assert fill[~closed].max() <= fill[closed & (fill < 1008)].min()


def test_local_search_empties_what_best_fit_leaves():
    lengths = [4, 4, 4, 3, 3, 3, 3, 3, 3]  # best fit takes four bins
    bins = packing.Bins(lengths, 10)
    assert sum(map(bool, bins.items)) == 4
    bins.empty_the_least()
    assert sum(map(bool, bins.items)) == 3
    assert sorted(i for b in bins.items for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) == f <= 10 for b, f in zip(bins.items, bins.fill))


def plain_exchange(mine, theirs, capacity):
    """Whether a move, or an exchange of one for one, two for one or one for two, fills the fuller of two bins further."""
    room = capacity - sum(theirs)
    moves = [a for a in mine if sum(theirs) > sum(mine) - a]
    ones = [a - b for a in mine for b in theirs]
    ones += [sum(two) - b for two in combinations(mine, 2) for b in theirs] + [a - sum(two) for a in mine for two in combinations(theirs, 2)]
    return any(a <= room for a in moves) or sum(theirs) >= sum(mine) and any(0 < gain <= room for gain in ones)


def test_local_search_leaves_no_exchange():
    lengths = np.random.default_rng(4).integers(250, 420, 600).tolist()
    bins = packing.Bins(lengths, 1024)
    bins.empty_the_least()
    left = [[lengths[i] for i in items] for items in bins.items if items]
    assert len(left) >= packing.lower_bound(lengths, 1024) and sorted(sum(left, [])) == sorted(lengths)
    assert all(sum(b) <= 1024 for b in left)
    assert not any(plain_exchange(a, b, 1024) for a in left for b in left if a is not b)


@pytest.mark.parametrize("lengths,capacity,source,fills", [
    ([19] * 14 + [10] * 15, 267, 1, [267, 149]),  # two of 10 for one of 19
    ([20] * 13 + [9] * 29, 263, 0, [258, 263]),  # one of 20 for two of 9
])
def test_pairs_are_exchanged_between_bins_of_many_pieces(lengths, capacity, source, fills):
    bins = packing.Bins(lengths, capacity)
    assert min(map(len, bins.items)) > 12
    bins.start_search()
    assert bins.improve(source) and bins.fill == fills
    assert [sum(lengths[i] for i in items) for items in bins.items] == fills


def test_lower_bound_of_bins():
    assert packing.lower_bound([600] * 7, 1024) == 7 and packing.lower_bound([512] * 7, 1024) == 4
    assert packing.lower_bound([600] * 7 + [424] * 7, 1024) == 7 and packing.lower_bound([600] * 7 + [425] * 7, 1024) == 10
    assert packing.lower_bound([4, 4, 4, 3, 3, 3, 3, 3, 3], 10) == 3


def plain_hilbert(point, bits):
    """Index by walking down the curve's quadrants, two dimensions."""
    x, y = point
    d, s = 0, 1 << (bits - 1)
    while s:
        rx, ry = int(x & s > 0), int(y & s > 0)
        d += s * s * ((3 * rx) ^ ry)
        if not ry:
            if rx:
                x, y = (s - 1) ^ (x & (s - 1)), (s - 1) ^ (y & (s - 1))
            x, y = y, x
        x, y = x & (s - 1), y & (s - 1)
        s >>= 1
    return d


def test_hilbert_curve_visits_neighbours(spark):
    for n, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        cells = spark.range(side**n)
        levels = [F.floor(F.col("id") / side**i).cast("int") % side for i in range(n)]
        cells = cells.select(*[level.alias(f"x{i}") for i, level in enumerate(levels)])
        got = hilbert.hilbert_index([F.col(f"x{i}") for i in range(n)], bits, cells, "h").toArrow().to_pylist()
        path = sorted(got, key=lambda r: r["h"])
        assert [r["h"] for r in path] == list(range(side**n))
        for a, b in zip(path, path[1:]):
            assert sum(abs(a[f"x{i}"] - b[f"x{i}"]) for i in range(n)) == 1
        if n == 2:
            assert path == sorted(got, key=lambda r: plain_hilbert((r["x0"], r["x1"]), bits)) or \
                path == sorted(got, key=lambda r: plain_hilbert((r["x1"], r["x0"]), bits))


@pytest.mark.parametrize("which", ["sf", "nasty", "nothing"])
def test_shards_are_even_runs_of_the_curve(which, sf, nasty, nothing):
    docs = {"sf": sf("documents"), "nasty": nasty, "nothing": nothing}[which]
    got = hilbert.shard(docs, 24).toArrow().to_pylist()
    text = lambda r: (r["text"] or "").encode()
    expected = Counter((r["doc_id"], len(text(r)) + 8, zlib.crc32(text(r))) for r in docs.toArrow().to_pylist())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected
    counts = Counter(r["shard"] for r in got)
    assert not got or max(counts.values()) - min([counts[s] for s in range(24)]) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    by_place = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in by_place] == sorted(r["curve"] for r in got)


def test_shards_written_as_files(nasty, spark, tmp_path):
    hilbert.write_shards(nasty, hilbert.shard(nasty, 4), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == nasty.count()
