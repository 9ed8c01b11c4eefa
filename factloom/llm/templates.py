"""Benchmark decontamination by template windows, with DataFrame functions only.

Texts become words and numbers. Numbers, units after numbers and capitalised words
are replaced by typed placeholders, a run of names or of numbers by a single one,
which gives the template; particles such as ``de`` or ``van`` inside a run of names
belong to it. Windows of template tokens are joined by hash with those of the
benchmark. Windows that lie on neighbouring diagonals (shifts between item and
document less than ``BAND`` apart) are counted together, so that words put in or
left out do not part them, and where they cover enough of an item, each slot is laid
beside the document on the diagonal of the window next to it: each value in the
item's slots must become one and the same value in the document, wherever it stands.
A run at an end of the item may go on in the document. That keeps re-parameterised
questions, in which names and numbers are exchanged throughout, and drops chance
agreements of templates.

A template window with fewer literal tokens than a third of its length is no evidence.
An item that has no other (lists of numbers, titles, names) is matched by the windows
of its words as they are: all of them, on one diagonal. So a verbatim copy of any item
is found. An item whose template is shorter than a window matches by one phrase; it
counts where it makes up half of a sentence or line at least, not inside a longer one.

Only matching windows are shuffled; the words of documents are not. The benchmark's
windows are broadcast if they were measured small, and joined by shuffle otherwise.

Defined cases: NULL and empty texts have no windows, and items without a word or number
are never found. Rows with equal id and text are reported once, rows without doc_id as
well. Very long texts are read whole, one at a time. Empty tables give no rows. Other
columns are not read by ``matches`` and kept by ``clean``, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.texts import fresh, keyed, text_key
from factloom.sources.staging import Staged, stage

TOKEN = r"[0-9][0-9.,]*|\p{L}[\p{L}\p{M}]*"
NUM, UNIT, NAME = "<num>", "<unit>", "<name>"
# Words that count as units after a number.
UNITS = ("mm cm m km inch inches foot feet ft yard yards mile miles g kg mg gram grams kilogram kilograms pound pounds lb lbs "
         "ounce ounces oz ton tons l ml liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour "
         "hours day days week weeks month months year years percent degree degrees dollar dollars euro euros cent cents usd "
         "eur kmh mph watt watts kw volt volts byte bytes kb mb gb tb hz khz mhz ghz").split()
# Words that may stand inside a name.
PARTICLES = "de da do dos das di del della der den des du la le van von und y bin ibn al ten ter zu zur".split()
LONGEST_PARTICLE = max(map(len, PARTICLES))
# Where sentences and lines end.
SENTENCE_END = r"[.!?;](?=\s|$)|[\r\n]+"
# Diagonals that are counted together: shifts up to half of it apart always are.
BAND = 16


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def _first(word: Column) -> Column:
    return F.substring(word, 1, 1)


def template(tokens: Column) -> Column:
    """Tokens with typed placeholders."""
    def of(all_tokens: Column) -> Column:
        def is_name(i: Column) -> Column:
            first = _first(F.get(all_tokens, i))
            return F.coalesce(first != F.lower(first), F.lit(False))

        def is_particle(i: Column) -> Column:
            return F.coalesce(F.get(all_tokens, i).isin(PARTICLES), F.lit(False))

        def one(word: Column, i: Column) -> Column:
            before = _first(F.get(all_tokens, i - 1))
            # One particle or two between two names.
            inside = (is_name(i - 1) & (is_name(i + 1) | is_particle(i + 1) & is_name(i + 2))
                      | is_particle(i - 1) & is_name(i - 2) & is_name(i + 1))
            return (
                F.when(_first(word).between("0", "9"), NUM)
                .when(before.between("0", "9") & F.lower(word).isin(UNITS), UNIT)
                .when(_first(word) != F.lower(_first(word)), NAME)
                .when((F.length(word) <= LONGEST_PARTICLE) & word.isin(PARTICLES) & inside, NAME)
                .otherwise(word)
            )

        return F.transform(all_tokens, one)

    # An array of one, so that the tokens are computed once and not once per token.
    return F.transform(F.array(tokens), of)[0]


def _joined(t: Column, i: Column) -> Column:
    """Whether template token ``i`` goes on with the run before it."""
    return F.get(t, i).isin(NUM, NAME) & F.get(t, i - 1).eqNullSafe(F.get(t, i))


def run_template(tokens: Column) -> Column:
    """The template with one placeholder for a run of names or of numbers."""
    return F.transform(F.array(template(tokens)), lambda t: F.filter(t, lambda x, i: ~_joined(t, i)))[0]


def run_values(tokens: Column) -> Column:
    """The words of each token of ``run_template``, joined by blanks."""
    def starts(x: Column) -> Column:
        places = F.transform(x["t"], lambda _, i: i)
        return F.struct(x["w"].alias("w"), F.filter(places, lambda i: ~_joined(x["t"], i)).alias("s"))

    def values(x: Column) -> Column:
        length = lambda at, n: F.coalesce(F.get(x["s"], n + 1), F.size(x["w"])) - at
        return F.transform(x["s"], lambda at, n: F.array_join(F.slice(x["w"], at + 1, length(at, n)), " "))

    both = F.array(F.struct(tokens.alias("w"), template(tokens).alias("t")))
    return F.transform(F.transform(both, starts), values)[0]


def _windows(tokens: Column, length: int) -> Column:
    """Hash of every window."""
    def of(t: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(t) - (length - 1))
        return F.when(F.size(t) >= length, F.transform(starts, lambda i: F.xxhash64(F.slice(t, i, length))))

    return F.transform(F.array(tokens), of)[0]


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 6, share: float = 0.5, agreement: float = 0.8) -> DataFrame:
    """doc_id, k, item_id, shift, n_windows, n_hit, coverage, n_slots, n_agree, n_changed,
    consistent and kind (verbatim or changed) of every document and item that share
    at least ``share`` of the item's windows on neighbouring diagonals; ``shift`` is the
    one with most of them, in tokens of the template (in words, for items that are
    matched as they are: these have no slots)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text").cast("string")).alias("w"))
    items = items.where(F.size("w") > 0).select("item_id", "w", run_values(F.col("w")).alias("bw"), run_template(F.col("w")).alias("bt"))
    items = items.withColumns({"item": F.monotonically_increasing_id(), "length": F.least(F.size("bt"), F.lit(window)),
                               "short": F.size("bt") < window})
    items = stage(items, "benchmark-items", metrics={"shorts": F.count_if("short")})
    literal = F.size(F.filter(F.slice("bt", F.col("at") + 1, F.col("length")), lambda t: ~t.startswith("<")))
    # In an item shorter than a window every word of a run counts.
    of_words = F.when(F.col("short"), F.size("w")).otherwise(F.col("length"))
    known = _benchmark_windows(items.df, "bt", window).where(literal * 3 >= of_words)
    known = stage(known.select("item", "at", "hash", "length"), "benchmark-windows")
    sizes = stage(known.df.groupBy("item").agg(F.count(F.lit(1)).alias("n_windows")), "benchmark-sizes")

    texts = keyed(docs)
    hits = _hits(texts.select("doc_id", "k", run_template(words(F.col("text"))).alias("t")), known)
    # At most the item's windows on each of BAND diagonals are collected.
    lines = hits.groupBy("doc_id", "k", "item", "shift").agg(F.collect_set("at").alias("ats"))
    bands = F.array(F.floor(F.col("shift") / BAND) * 2, F.floor((F.col("shift") + BAND // 2) / BAND) * 2 + 1)
    lines = lines.withColumn("band", F.explode(bands)).withColumn("line", F.struct("shift", "ats"))
    counted = lines.groupBy("doc_id", "k", "item", "band").agg(
        F.collect_list("line").alias("lines"), F.max_by("shift", F.struct(F.size("ats"), -F.col("shift"))).alias("shift"))
    counted = counted.withColumn("n_hit", F.size(F.array_distinct(F.flatten(F.col("lines.ats")))))
    counted = counted.join(sizes.side(), "item").where(F.col("n_hit") >= share * F.col("n_windows"))
    # Both bands that hold a diagonal find it.
    best = counted.groupBy("doc_id", "k", "item", "shift").agg(F.max_by(F.struct("n_hit", "n_windows", "lines"), "n_hit").alias("b"))
    near = stage(best.select("doc_id", "k", "item", "shift", "b.*"), "aligned")
    found = _side_by_side(texts, near, items, agreement)
    plain = stage(items.df.join(sizes.side(), "item", "left_anti").withColumn("length", F.least(F.size("w"), F.lit(window))), "items-as-they-are")
    return found.unionByName(_as_they_are(texts, plain, window)) if plain.rows else found


def _benchmark_windows(items: DataFrame, tokens: str, window: int) -> DataFrame:
    """The items' columns with ``at`` and ``hash`` of each window; a shorter item is one as a whole."""
    lengths = [row["length"] for row in items.select("length").distinct().collect()]  # at most ``window``
    parts = [items.where(F.col("length") == n).select("*", F.posexplode(_windows(F.col(tokens), n)).alias("at", "hash"))
             for n in lengths or [window]]
    return reduce(DataFrame.unionByName, parts)


def _hits(tokens: DataFrame, known: Staged) -> DataFrame:
    """(doc_id, k, item, shift, at) of every window of the documents' tokens ``t`` that an item has."""
    lengths = [row["length"] for row in known.df.select("length").distinct().collect()]
    parts = []
    for n in lengths or [1]:
        here = tokens.select("doc_id", "k", F.posexplode(_windows(F.col("t"), n)).alias("pos", "hash"))
        parts.append(here.join(known.side(known.df.where(F.col("length") == n).drop("length")), "hash").select(
            "doc_id", "k", "item", (F.col("pos") - F.col("at")).alias("shift"), "at"))
    return reduce(DataFrame.unionByName, parts)


def _as_they_are(texts: DataFrame, items: Staged, window: int) -> DataFrame:
    """Documents that hold all windows of an item's words in a row. The first place is reported."""
    known = stage(_benchmark_windows(items.df, "w", window).select("item", "at", "hash", "length"), "word-windows")
    sizes = stage(known.df.groupBy("item").agg(F.count(F.lit(1)).alias("n_windows")), "word-sizes")
    hits = _hits(texts.select("doc_id", "k", words(F.col("text")).alias("t")), known)
    lines = hits.groupBy("doc_id", "k", "item", "shift").agg(F.count_distinct("at").alias("n_hit"))
    full = lines.join(sizes.side(), "item").where("n_hit = n_windows")
    full = full.groupBy("doc_id", "k", "item", "n_windows").agg(F.min("shift").alias("shift"))
    chosen = items.df.select("item", "item_id", (F.size("w") < window).alias("short"), F.array_join("w", " ").alias("phrase"), F.size("w").alias("n"))
    near = stage(full.join(items.side(chosen), "item"), "held-as-they-are", metrics={"shorts": F.count_if("short")})
    found = near.df.withColumn("stands", F.lit(True))
    if near.metrics["shorts"]:
        places = stage(near.df.where("short").select(F.col("doc_id").alias("_doc"), F.col("k").alias("_k")).distinct(), "short-places")
        same = F.expr("doc_id <=> _doc AND k = _k")
        held = texts.join(places.side(), same, "left_semi").dropDuplicates(["doc_id", "k"]).select(
            F.col("doc_id").alias("_doc"), F.col("k").alias("_k"), sentences(F.col("text"), words).alias("s"))
        found = near.df.where("NOT short").withColumn("stands", F.lit(True)).unionByName(
            near.df.where("short").join(held, same).withColumn("stands", _stands("phrase", "n")).drop("_doc", "_k", "s"))
    zero = F.lit(0)
    return found.select(
        "doc_id", "k", "item_id", "shift", "n_windows", F.col("n_windows").cast("int").alias("n_hit"), F.lit(1.0).alias("coverage"),
        zero.alias("n_slots"), zero.alias("n_agree"), zero.alias("n_changed"), F.col("stands").alias("consistent"), F.lit("verbatim").alias("kind"))


def sentences(text: Column, tokens) -> Column:
    """Of each sentence or line, its tokens joined by blanks, and how many they are."""
    def one(part: Column) -> Column:
        return F.transform(F.array(tokens(part)), lambda t: F.struct(F.array_join(t, " ").alias("t"), F.size(t).alias("n")))[0]

    return F.transform(F.split(F.coalesce(text, F.lit("")), SENTENCE_END), one)


def _stands(phrase: str, n: str) -> Column:
    """Whether a phrase of ``n`` tokens makes up at least half of one of the sentences ``s``."""
    def holds(x: Column) -> Column:
        inside = F.concat(F.lit(" "), x["t"], F.lit(" ")).contains(F.concat(F.lit(" "), F.col(phrase), F.lit(" ")))
        return (x["n"] <= 2 * F.col(n)) & inside

    return F.exists("s", holds)


def _side_by_side(texts: DataFrame, near: Staged, items: Staged, agreement: float) -> DataFrame:
    found = near.df.select(F.col("doc_id").alias("_doc"), F.col("k").alias("_k")).distinct()
    found = stage(found, "aligned-documents")
    chosen = texts.join(found.side(), F.expr("doc_id <=> _doc AND k = _k"), "left_semi").dropDuplicates(["doc_id", "k"])
    own = words(F.col("text"))
    parts = sentences(F.col("text"), lambda part: run_template(words(part))) if items.metrics["shorts"] else F.lit(None).cast("array<struct<t:string,n:int>>")
    chosen = chosen.select(F.col("doc_id").alias("_doc"), F.col("k").alias("_k"), run_values(own).alias("dw"), run_template(own).alias("dt"), parts.alias("s"))
    pairs = near.df.join(chosen, F.expr("doc_id <=> _doc AND k = _k")).join(items.side(items.df.drop("w")), "item")
    pairs = pairs.withColumns({"phrase": F.array_join("bt", " "), "n": F.size("bt")})
    stands = ~F.col("short") | F.coalesce(_stands("phrase", "n"), F.lit(False))

    def shift_at(place: Column) -> Column:
        """The diagonal of the window that is nearest to a place of the item."""
        def distance(at: Column) -> Column:
            return F.greatest(F.lit(0), at - place, place - at - F.col("length") + 1)

        nearest = F.transform("lines", lambda x: F.struct(
            F.array_min(F.transform(x["ats"], distance)).alias("far"), F.abs(x["shift"] - F.col("shift")).alias("off"), x["shift"].alias("shift")))
        return F.array_min(nearest)["shift"]

    def slot(b: Column, i: Column) -> Column:
        return F.struct(b.alias("t"), F.get("bw", i).alias("b"), (i + shift_at(i)).alias("place"), (i == 0).alias("first"),
                        (i == F.size("bt") - 1).alias("last"))

    slots = F.filter(F.transform("bt", slot), lambda x: x["t"].isin(NUM, UNIT, NAME) & (F.get("dt", x["place"]) == x["t"]))

    def laid(x: Column) -> Column:
        d = F.get("dw", x["place"])
        # The document's run may start before the item, or end after it.
        d = F.when(x["first"] & d.endswith(F.concat(F.lit(" "), x["b"])) | x["last"] & d.startswith(F.concat(x["b"], F.lit(" "))), x["b"]).otherwise(d)
        return F.struct(x["t"], x["b"], d.alias("d"), x["first"], x["last"])

    pairs = pairs.withColumn("slots", F.transform(slots, laid))
    values = F.array_distinct(F.transform("slots", lambda x: F.struct(x["t"].alias("t"), x["b"].alias("b"))))

    def largest(value: Column) -> Column:
        mine = F.filter("slots", lambda x: (x["t"] == value["t"]) & (x["b"] == value["b"]))

        def same(one: Column, other: Column) -> Column:
            return ((other["d"] == one["d"]) | other["first"] & other["d"].endswith(F.concat(F.lit(" "), one["d"]))
                    | other["last"] & other["d"].startswith(F.concat(one["d"], F.lit(" "))))

        return F.array_max(F.transform(mine, lambda one: F.size(F.filter(mine, lambda other: same(one, other)))))

    agree = F.aggregate(values, F.lit(0), lambda total, value: total + largest(value))
    n_slots = F.size("slots")
    changed = F.size(F.filter("slots", lambda x: x["b"] != x["d"]))
    return pairs.select(
        "doc_id", "k", "item_id", "shift", "n_windows", "n_hit", (F.col("n_hit") / F.col("n_windows")).alias("coverage"),
        n_slots.alias("n_slots"), agree.alias("n_agree"), changed.alias("n_changed"),
        ((agree >= agreement * n_slots) & stands).alias("consistent"),
        F.when(changed == 0, "verbatim").otherwise("changed").alias("kind"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without those that hold a benchmark item."""
    doc, k, key = fresh(docs, "doc", "k", "key")
    leaks = matches(docs, benchmark, **options).where("consistent").select(F.col("doc_id").alias(doc), F.col("k").alias(k)).distinct()
    leaks = stage(leaks, "leaks")
    with_key = docs.withColumn(key, text_key(F.col("text").cast("string")))
    return with_key.join(leaks.side(), F.expr(f"CAST(doc_id AS BIGINT) <=> {doc} AND {key} = {k}"), "left_anti").drop(key)
