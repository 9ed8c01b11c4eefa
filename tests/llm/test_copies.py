"""Near duplicates, repeated passages and benchmark leaks against brute force."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from factloom.llm import bbit, components, substrings, templates

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_set(text):
    words = (text or "").encode().translate(LOWER).split()
    return {tuple(words[i: i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else ({tuple(words)} if words else set())


def plain_classes(table):
    """Expected (doc_id, n_shingles, component_id, kept) of all rows, by comparing all pairs."""
    sets = [shingle_set(r["text"]) for r in table]
    root = list(range(len(table)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(table):
        if r["doc_id"] is not None:
            least[find(i)] = min(least.get(find(i), r["doc_id"]), r["doc_id"])
    return Counter((r["doc_id"], len(sets[i]), least.get(find(i)), r["doc_id"] is not None and r["doc_id"] == least.get(find(i)))
                   for i, r in enumerate(table))


def family(spark):
    """Texts around one passage: close copies, and others that share just too little."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(150):
        own = [word() for _ in range(rng.choice([5, 10, 14, 16, 18, 20, 22, 30]))]
        rows.append((i, " ".join(passage + own)))
    for i in range(150, 220):
        copy = passage + rows[i - 150][1].split()[60:]
        for _ in range(rng.choice([0, 1, 2])):
            copy[rng.randrange(len(copy))] = word()
        rows.append((i, " ".join(copy).upper()))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("which", ["sf", "nasty", "nothing", "family"])
def test_classes_like_all_pairs(which, sf, nasty, nothing, spark):
    docs = {"sf": sf("documents"), "nasty": nasty, "nothing": nothing, "family": family(spark)}[which]
    got = bbit.near_duplicates(docs).toArrow().to_pylist()
    found = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got)
    expected = plain_classes(docs.toArrow().to_pylist())
    if which == "nasty":  # empty rows without an id have no class; equal ids may lie in several
        found = Counter({k: n for k, n in found.items() if k[0] is not None or k[1]})
        expected = Counter({k: n for k, n in expected.items() if k[0] is not None or k[1]})
    assert found == expected


def test_estimate_follows_similarity(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**9)}" for _ in range(2000)]
    rows = [(i, " ".join(words[: 2000 - 40 * i])) for i in range(20)]
    signed = bbit.signatures(spark.createDataFrame(rows, "doc_id long, text string"), 5).select("doc_id", "n_shingles", "sig").cache()
    pairs = signed.alias("a").join(signed.withColumnsRenamed({"doc_id": "d", "n_shingles": "n", "sig": "s"}), F.col("d") == 0)
    for r in pairs.select("doc_id", (F.col("n_shingles") / F.col("n")).alias("true"), bbit.estimate(F.col("sig"), F.col("s")).alias("est")).collect():
        assert abs(r["true"] - r["est"]) < 0.2


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100) if i != 50] + [(7, 7)], "a long, b long")
    got = {r["v"]: r["c"] for r in components.components(edges).df.collect()}
    assert got == {i: 0 if i <= 50 else 51 for i in range(101)}


def plain_repeats(table, length):
    """Expected (doc_id, n_words, n_removed, sha256) of all rows."""
    first, words = {}, [(r["doc_id"], (r["text"] or "").encode().split()) for r in table]
    for doc, own in words:
        if doc is not None:
            for i in range(len(own) - length + 1):
                key = tuple(own[i: i + length])
                first[key] = min(first.get(key, doc), doc)
    out = Counter()
    for doc, own in words:
        gone = set()
        for i in range(len(own) - length + 1) if doc is not None else ():
            if first[tuple(own[i: i + length])] < doc:
                gone.update(range(i, i + length))
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone)
        out[doc, len(own), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def mosaic(spark):
    """Texts cut from few passages, so that windows repeat at every offset; also one word over and over."""
    rng = random.Random(9)
    source = [f"s{rng.randrange(40)}" for _ in range(3000)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randrange(1, 6)):
            at, n = rng.randrange(2900), rng.randrange(3, 90)
            text += source[at: at + n] + [f"own{rng.randrange(10**6)}"] * rng.randrange(2)
        rows.append((i, " ".join(text)))
    rows += [(200 + i, "same " * (30 + 7 * i)) for i in range(8)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("which,length", [("sf", 50), ("nasty", 50), ("nothing", 50), ("mosaic", 50), ("mosaic", 7), ("nasty", 1)])
def test_repeats_like_plain_search(which, length, sf, nasty, nothing, spark):
    docs = {"sf": sf("documents"), "nasty": nasty, "nothing": nothing, "mosaic": mosaic(spark)}[which]
    got = substrings.digests(docs, substrings.repeats(docs, length)).toArrow().to_pylist()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == plain_repeats(docs.toArrow().to_pylist(), length)


def test_cut_texts_keep_columns(nasty):
    cut = substrings.cut_texts(nasty, substrings.repeats(nasty))
    assert cut.columns == nasty.columns and cut.dtypes == nasty.dtypes
    got = cut.toArrow().to_pylist()
    assert Counter(r["doc_id"] for r in got)[2] == 0 and sum(r["doc_id"] is None for r in got) == 2
    assert [(r["text"], r["n_chars"]) for r in got if r["doc_id"] == 3] == [("end", 3)]


def test_longest_repeats_double_until_none_is_left(spark):
    words = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[50:260])), (3, " ".join(words[:60]))], "doc_id long, text string")
    assert sorted(map(tuple, substrings.longest_repeats(docs).collect())) == [(2, 200), (3, 50)]


def test_many_equal_rows_take_no_longer_than_one(spark):
    words = [f"w{i}" for i in range(400)]
    one, other = " ".join(words), " ".join([*words[:390], "x"])
    table = lambda n: spark.createDataFrame([(1, one)] * n + [(2, other)] * n + [(3, "far away")], "doc_id long, text string").repartition(4)
    took = {}
    for n in (1, 2000):
        start = time.time()
        got = Counter(map(tuple, bbit.near_duplicates(table(n)).select("doc_id", "component_id", "n_links").collect()))
        took[n] = time.time() - start
        assert got == {(1, 1, 1): n, (2, 1, 1): n, (3, 3, 0): 1}
    assert took[2000] < 3 * took[1] + 5


def test_a_large_group_is_compared_with_one_leader_in_parts(spark, monkeypatch):
    monkeypatch.setattr(bbit, "GROUP", 4)
    words = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame([(i, " ".join([*words[:290], f"own{i}"])) for i in range(30)], "doc_id long, text string")
    got = bbit.near_duplicates(docs).select("doc_id", "component_id", "kept").collect()
    assert {tuple(r) for r in got} == {(i, 0, i == 0) for i in range(30)}


def test_columns_of_any_name_pass(spark, nasty):
    names = ["_fl_doc", "_fl_k", "_fl_key", "_fl_own", "_fl_starts", "_fl_ends", "_fl_rows", "_FL_CLASS"]
    docs = nasty.select("*", *(F.lit(i).alias(name) for i, name in enumerate(names)))
    for made in (templates.clean(docs, docs.select(F.col("doc_id").alias("item_id"), "text").limit(0)),
                 substrings.cut_texts(docs, substrings.repeats(docs)), bbit.keep_first(docs)):
        assert made.columns == docs.columns and made.dtypes == docs.dtypes
        assert {tuple(r[name] for name in names) for r in made.collect()} == {tuple(range(len(names)))}


ITEM = "Alice Smith buys 12 apples and 30 kg of flour, then Alice Smith sells 12 apples at the old market place"


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, ITEM), (2, "short one here"), (3, None), (4, ""), (5, "12 13 14 15 16 17 18")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("k", F.lit("x"))


def test_leaks_verbatim_reparameterised_and_inconsistent(spark, benchmark):
    docs = spark.createDataFrame([
        (1, "before it " + ITEM + " after it"),
        (2, ITEM.replace("Alice", "Bob").replace("Smith", "Jones").replace("12", "700").replace("30 kg", "4 lb")),
        (3, ITEM.replace("Alice", "Bob", 1).replace("12", "9", 1).replace("Smith", "Lee", 1)),  # one value becomes two
        (4, "Nothing of the kind, although 12 apples and a market place are named"), (5, "a short one here"), (6, "1 2 3 4 5 6 7 8 9"),
    ], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["consistent"], r["kind"]) for r in templates.matches(docs, benchmark).collect()}
    assert got == {(1, 1): (True, "verbatim"), (2, 1): (True, "changed"), (3, 1): (False, "changed"), (5, 2): (True, "verbatim")}
    assert sorted(r["doc_id"] for r in templates.clean(docs, benchmark).collect()) == [3, 4, 6]


def test_leaks_with_values_of_other_word_counts_and_words_put_in(spark, benchmark):
    docs = spark.createDataFrame([
        (1, "then " + ITEM.replace("Alice Smith", "Bob")), (2, ITEM.replace("Alice Smith", "Anna Maria de Lee")),
        (3, ITEM.replace("then Alice", "then suddenly Alice")), (4, ITEM.replace("flour", "rye flour")),
        (5, ITEM.replace("apples and", "and")), (6, "Yesterday " + ITEM.replace("Alice Smith", "Bob Van Ness")),
        (7, "Yesterday " + ITEM), (8, ITEM.replace("Alice Smith", "Bob", 1).replace("12", "9", 1)),
    ], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["consistent"], r["kind"]) for r in templates.matches(docs, benchmark).collect()}
    assert {k for k, (consistent, _) in got.items() if consistent} == {(i, 1) for i in (1, 2, 3, 4, 5, 6, 7)}
    assert got[2, 1] == (True, "changed")
    assert got[7, 1] == (True, "verbatim") and got[1, 1] == got[6, 1] == (True, "changed") and got[8, 1] == (False, "changed")


WEAK = ["12 13 14 15 16 17 18", "Who Wrote The Great Gatsby And When Was It Published In New York",
        "Compute 3 + 4 * 5 - 6 / 7 and 8 + 9 = 17", "Paris Rome Berlin", "JOHN LENNON", "7"]


def test_every_item_is_found_word_for_word(spark):
    items = spark.createDataFrame(list(enumerate([*WEAK, ITEM, "in the house"])), "item_id long, text string")
    rows = [(i, f"some words before it.\n{text}\nand after it") for i, text in enumerate([*WEAK, ITEM, "in the house"])]
    rows += [(20, "12 13 14 15 16 17 19"), (21, "he sat in the house and read the whole day"), (22, "it has 7 of these rare and old things"),
             (23, "Who Wrote The Great Gatsby And When Was It Published In Paris"), (24, None), (25, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = templates.matches(docs, items).where("consistent").collect()
    assert {(r["doc_id"], r["item_id"]) for r in found if r["kind"] == "verbatim"} == {(i, i) for i in range(len(WEAK) + 2)}
    assert sorted(r["doc_id"] for r in templates.clean(docs, items).collect()) == [20, 21, 22, 23, 24, 25]


@pytest.mark.parametrize("item,changed,other", [
    ("Anna Schmidt kauft 12 Äpfel und 30 kg Mehl, dann verkauft Anna Schmidt alle 12 Äpfel auf dem alten Markt",
     "Karl von der Heide kauft 7 Birnen und 5 kg Mehl, dann verkauft Karl von der Heide alle 7 Birnen auf dem alten Markt",
     "Karl Heide kauft 7 Birnen und 5 kg Mehl, dann verkauft Emil Braun alle 9 Kirschen auf dem alten Markt"),
    ("Juan compra 12 manzanas y 30 kg de harina, luego Juan vende las 12 manzanas en el mercado viejo",
     "María de la Cruz compra 9 manzanas y 4 kg de harina, luego María de la Cruz vende las 9 manzanas en el mercado viejo",
     "María compra 9 manzanas y 4 kg de harina, luego Pedro vende las 3 manzanas en el mercado viejo"),
    ("Pierre achète 12 pommes et 30 kg de farine, puis Pierre vend les 12 pommes au vieux marché",
     "Anne du Bois achète 8 pommes et 2 kg de farine, puis Anne du Bois vend les 8 pommes au vieux marché",
     "Anne achète 8 pommes et 2 kg de farine, puis Luc vend les 5 pommes au vieux marché")])
def test_changed_items_in_other_languages(spark, item, changed, other):
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item), (2, changed), (3, other), (4, f"vorher {changed} nachher")], "doc_id long, text string")
    got = {r["doc_id"]: (r["consistent"], r["kind"]) for r in templates.matches(docs, items).collect()}
    assert got == {1: (True, "verbatim"), 2: (True, "changed"), 3: (False, "changed"), 4: (True, "changed")}


def plain_template(text):
    """Runs of a text: type or word, and value."""
    tokens = re.findall(r"[0-9][0-9.,]*|[^\W\d_]+", text)
    upper = lambda i: 0 <= i < len(tokens) and tokens[i][0] != tokens[i][0].lower()
    part = lambda i: 0 <= i < len(tokens) and tokens[i] in templates.PARTICLES
    out = []
    for i, token in enumerate(tokens):
        kind = token
        if token[0] in "0123456789":
            kind = "<num>"
        elif i and tokens[i - 1][0] in "0123456789" and token.lower() in templates.UNITS:
            kind = "<unit>"
        elif upper(i) or part(i) and (upper(i - 1) and (upper(i + 1) or part(i + 1) and upper(i + 2)) or part(i - 1) and upper(i - 2) and upper(i + 1)):
            kind = "<name>"
        if kind in ("<num>", "<name>") and out and out[-1][0] == kind:
            out[-1] = (kind, f"{out[-1][1]} {token}")
        else:
            out.append((kind, token))
    return out


def test_changed_items_like_plain_comparison(spark):
    """Items whose values are exchanged one by one, among texts without insertions: a match is
    consistent if and only if enough slots go with a largest choice of values."""
    draw = random.Random(5)
    names, verbs = ["Ana", "Bo", "Carla Diaz", "Dan", "Eva"], ["buys", "sells", "counts", "finds", "loses", "hides"]
    pattern = "{n0} {v0} {a} old coins and {b} kg of dry salt while {n1} {v1} the {a} coins near the {n0} river"
    fill = lambda v, x: pattern.format(n0=x[0], n1=x[1], a=x[2], b=x[3], v0=v[0], v1=v[1])
    actions = [draw.sample(verbs, 2) for _ in range(8)]
    items = [fill(v, ("Zoe", "Yan Xu", 12, 30)) for v in actions]
    texts = []
    for v in actions:
        for _ in range(6):
            text = fill(v, (draw.choice(names), draw.choice(names), draw.randint(2, 99), draw.randint(2, 99)))
            for _ in range(draw.randint(0, 2)):  # one place gets a value of its own
                name = draw.choice(re.findall(r"[A-Z][a-z]+(?: [A-Z][a-z]+)?|[0-9]+", text))
                text = text.replace(name, "Quo" if name[0].isalpha() else "500", 1)
            texts.append(text)
    got = {(r["doc_id"], r["item_id"]): (r["n_hit"], r["n_slots"], r["n_agree"], r["n_changed"], r["consistent"])
           for r in templates.matches(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
                                      spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    expected = {}
    for d, text in enumerate(texts):
        own = plain_template(text)
        for i, item in enumerate(items):
            of = plain_template(item)
            assert len(of) == len(own)
            n = len(of) - 5
            strong = [k for k in range(n) if sum(t[0][0] != "<" for t in of[k:k + 6]) * 3 >= 6]
            hits = [k for k in strong if [t[0] for t in of[k:k + 6]] == [t[0] for t in own[k:k + 6]]]
            if len(hits) < 0.5 * len(strong):
                continue
            slots = [(a, b[1]) for a, b in zip(of, own) if a[0][0] == "<" and a[0] == b[0]]
            agree = sum(max(Counter(v for a, v in slots if a == value).values()) for value in {a for a, _ in slots})
            expected[d, i] = (len(hits), len(slots), agree, sum(a[1] != v for a, v in slots), agree >= 0.8 * len(slots))
    assert got == expected and len({x[4] for x in expected.values()}) == 2


def test_leaks_like_plain_search(sf):
    docs, items = sf("documents"), sf("benchmark")
    found = {(r["doc_id"], r["item_id"]) for r in templates.matches(docs, items).where("consistent").collect()}
    plain = {(d["doc_id"], i["item_id"]) for d in docs.collect() for i in items.collect() if i["text"] in (d["text"] or "")}
    assert plain <= found


def test_leaks_on_odd_tables(nasty, nothing, benchmark):
    assert templates.matches(nasty, benchmark).count() == 0 and templates.matches(nothing, benchmark).count() == 0
    assert templates.matches(nasty, benchmark.limit(0)).count() == 0
    kept = templates.clean(nasty, benchmark)
    assert kept.columns == nasty.columns and kept.count() == nasty.count()
