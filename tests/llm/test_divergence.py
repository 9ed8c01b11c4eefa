"""The source audit against plain arithmetic."""

import re
from collections import Counter, defaultdict

import pytest

from factloom.llm import divergence

TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, min_docs=10, top=10):
    counts, seen, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in docs:
        lang, source = r["lang"] or "", r["source"] or ""
        terms = TERMS.findall((r["text"] or "").translate(LOWER))
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
        langs[lang].add(source)
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in seen[lang].items() if n >= min_docs]

        def table(of):
            total = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: table(counts[lang, s]) for s in sources}
        q = table(sum((counts[lang, s] for s in sources), Counter()))
        differ = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            pairs = [(o, sum(differ(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, differ(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:limit])]
    return sorted(out)


NAMES = ("lang", "source", "part", "item", "value", "rank")


@pytest.mark.parametrize("which", ["sf", "nasty", "nothing"])
@pytest.mark.parametrize("min_docs", [10, 1])
def test_like_plain_arithmetic(which, min_docs, sf, nasty, nothing, rows):
    docs = {"sf": sf("documents"), "nasty": nasty, "nothing": nothing}[which]
    got = divergence.audit(docs, min_docs=min_docs)
    assert sorted(rows(got, *NAMES)) == plain(docs.toArrow().to_pylist(), min_docs)


def test_many_small_runs_salts_and_source_blocks(sf, rows, monkeypatch):
    docs = sf("documents")
    monkeypatch.setattr(divergence, "GROUP_POSTINGS", 200)
    monkeypatch.setattr(divergence, "SOURCES", 3)
    got = divergence.audit(docs.repartition(5), min_docs=2, block_entries=300)
    assert sorted(rows(got, *NAMES)) == plain(docs.toArrow().to_pylist(), 2)


def test_a_lone_source_has_no_pair_and_a_language_without_kept_terms_has_zeros(spark, rows):
    docs = spark.createDataFrame([("aa bb", "x", "one"), ("cc", "y", "s"), ("dd", "y", "t"), (None, "y", None)],
                                 "text string, lang string, source string")
    assert rows(divergence.audit(docs), *NAMES) == sorted(
        ("y", a, "pair", b, 0, rank) for a, others in {"": "st", "s": ["", "t"], "t": ["", "s"]}.items()
        for rank, b in enumerate(sorted(others), 1))


def test_slices_part_no_term():
    text = b"aaa bbbb  c dd" * 50
    assert [w for part in divergence.slices(text, 7) for w in part.split()] == text.split()
    assert b"".join(divergence.slices(text, 7)) == text
    assert list(divergence.slices(b"")) == []


def test_shares_do_not_overflow():
    import numpy as np

    n, whole = [5, 2, 9 * 10**14], [7, 10**15, 9 * 10**14 + 11]
    assert divergence.shares(np.array(n), np.array(whole)).tolist() == [1 + 10**9 * a // b for a, b in zip(n, whole)]
