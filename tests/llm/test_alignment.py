"""Token alignment against plain loops over bytes."""

import hashlib
from collections import Counter, defaultdict

import pytest

from factloom.llm import alignment
from factloom.llm.queries import tokenizer_path

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
TEXTS = [
    "plain words here", "  two blanks  inside and at the end  ", "\ttabs\n\nand lines\r\n", "é ñ ß 漢字 \U0001f600 emoji", "a▁b ▁",
    "<|endoftext|> and </s> <s> <unk> <0x41> are plain", "x" * 300, " ".join("long" * i for i in range(1, 40)), "one", " ", " nbsp em",
    "don't we'll I'm", "1234567890 3.14 1,000", "café ﬁ ligature Ⅷ", "\x00 nul", "mixed日本語text 中 文",
]


def plain(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path(FIRST))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=tokenizer_path(SECOND))
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in prints} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in prints)}
    out, counts = [], Counter()
    for doc, text in texts:
        links, groups, ids_a, ids_b = [], [], [], []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
            bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if not (b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode()):
                ids_a, ids_b = [], []
        if ids_a:
            at, owner = 0, []
            for i, token in zip(ids_a, bytes_a):
                owner.append((at, at + len(token), i))
                at += len(token)
            at, other = 0, []
            for i, token in zip(ids_b, bytes_b):
                other.append((at, at + len(token), i))
                at += len(token)
            low = 0
            for s, e, i in owner:
                while other[low][1] <= s:
                    low += 1
                k = low
                while k < len(other) and other[k][0] < e:
                    links.append((i, other[k][2]))
                    k += 1
            cuts = sorted({e for _, e, _ in owner} & {e for _, e, _ in other})
            before = 0
            for cut in cuts:
                side = lambda spans: ",".join(str(i) for s, e, i in spans if before <= s and e <= cut)  # noqa: B023, E731
                groups.append(f"{side(owner)}|{side(other)}")
                before = cut
        counts.update(set(links))
        out.append((doc, ids_a, ids_b, groups, links))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return sorted(((doc, len(ids_a), len(ids_b), len(groups), len(links), sum(counts[x] == best[x[0]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if ids_a else "")
                   for doc, ids_a, ids_b, groups, links in out), key=repr)


def aligned(docs):
    return alignment.align(docs, tokenizer_path(FIRST), tokenizer_path(SECOND))


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_odd_texts_like_plain_loops(spark, rows, monkeypatch, limit):
    monkeypatch.setattr("factloom.sources.staging.BROADCAST_BYTES", limit)  # 0: joined by shuffle
    texts = list(enumerate(TEXTS + TEXTS[:4]))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(aligned(docs), *NAMES) == plain(texts)


def test_short_documents_like_plain_loops(sf, rows):
    docs = sf("documents").where("length(text) < 1500 OR text IS NULL")
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").toArrow().to_pylist()]
    assert rows(aligned(docs), *NAMES) == plain(texts)


def test_defined_cases(nasty, nothing, rows):
    got = rows(aligned(nasty), *NAMES)
    assert len(got) == nasty.count()
    for r in got:
        if r[0] in (4, 5):
            assert r[1:] == (0, 0, 0, 0, 0, 0, "")
    assert got.count(next(r for r in got if r[0] == 2)) == 2  # equal rows, each with its own row
    assert rows(aligned(nothing), *NAMES) == []


def test_words_in_turn_are_whole_texts(sf):
    own = alignment.Pieces(tokenizer_path(SECOND))
    assert own.by_word
    texts = [t for t in [*TEXTS, *(r["text"] for r in sf("documents").select("text").toArrow().to_pylist())] if t]
    assert any(map(own.plain, texts)) and not all(map(own.plain, texts))
    ids, sizes, good = own.encode(texts)
    expected = own.model.encode(texts)
    assert sizes.tolist() == [*map(len, expected)] and ids.tolist() == [i for part in expected for i in part]
    assert good.tolist() == [own.true(*x) for x in zip(texts, expected)]


def test_windows_whose_hashes_collide_are_told_apart(monkeypatch):
    own = alignment.Aligner(tokenizer_path(FIRST), tokenizer_path(SECOND))
    expected = [own.align([text])[4][0] for text in TEXTS]
    assert own.align(TEXTS)[4] == expected
    monkeypatch.setattr(alignment, "mix", lambda h: h & alignment.np.uint64(3))
    assert own.align(TEXTS)[4] == expected
