"""One registered query per operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import (
    alignment,
    ann,
    bbit,
    chat_tree,
    divergence,
    hilbert,
    langid,
    licenses,
    packing,
    substrings,
    templates,
    token_counts,
    url_filter,
)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence detections of every document."""
    return licenses.scan(_table(spark, sf_dir, "documents")).drop("detections")


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 runs of a Hilbert curve over source, language and size."""
    plan = hilbert.shard(_table(spark, sf_dir, "documents"), shards=24)
    return plan.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op3_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector."""
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, as they are or with other values in their slots."""
    found = templates.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "shift", "n_windows", "n_hit", "coverage", "n_slots", "n_agree",
                        "n_changed", "consistent", "kind")


def op5_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document after its repeated 50-word windows are removed."""
    docs = _table(spark, sf_dir, "documents")
    return substrings.digests(docs, substrings.repeats(docs, 50)).drop("starts", "ends")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals for every context limit, per language, from the exact histogram of token counts."""
    counts = token_counts.histogram(_table(spark, sf_dir, "documents"), tokenizer_path(), "lang")
    return token_counts.limits(counts)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op8_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return bbit.near_duplicates(_table(spark, sf_dir, "documents"), size=5, percent=75).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


def op10_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packing.pack(packing.pieces(_table(spark, sf_dir, "documents"), tokenizer_path(), 1024), 1024)


def op11_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings, formatted as prefix trees and read back."""
    control = "\\### Assistant: </turn> ok"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text"))
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat_tree.digests(chat_tree.format_conversations(rows, tokenizer_path()), tokenizer_path())


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers over every document, aligned, with corpus-wide counts of linked ids."""
    docs = _table(spark, sf_dir, "documents")
    return alignment.align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every source of a language: how far each other source is, and the terms it uses more."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


QUERIES = {
    q.__name__: q
    for q in (op1_license_scan, op2_hilbert_shards, op3_learned_partitions, op4_template_leaks, op5_repeated_windows,
              op6_token_counts, op7_url_filter, op8_bbit_minhash, op9_language_id, op10_swap_packing,
              op11_chat_tree, op12_token_alignment, op13_source_divergence)
}

SQL = {
    "op7_url_filter": """
        WITH cut AS (
            SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
            FROM pages),
        parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
            FROM cut),
        rules(rule_verdict, rule_host, rule_path) AS (
            VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
        best AS (
            SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                   arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
            FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY page_id)
        SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
        FROM parts LEFT JOIN best USING (page_id)
    """,
    "op13_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
            FROM documents),
        words AS (SELECT d, lang, source, unnest(words) AS term FROM docs),
        kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 10),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        counted AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        filled AS (
            SELECT lang, source, term, lang_n, coalesce(n, 0) AS n
            FROM groups JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)),
        sums AS (
            SELECT *, sum(n) OVER (PARTITION BY lang, source)::hugeint AS total, count(*) OVER (PARTITION BY lang, source) AS v,
                   sum(n) OVER (PARTITION BY lang)::hugeint AS lang_total
            FROM filled),
        shares AS (
            SELECT lang, source, term, n, 1 + 1000000000 * (n + 2)::hugeint // (total + 2 * v) AS p,
                   1 + 1000000000 * (lang_n + 2)::hugeint // (lang_total + 2 * v) AS q
            FROM sums),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::bigint AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        parts AS (
            SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(value, 0) AS value
            FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
            LEFT JOIN pairs ON pairs.lang = g.lang AND pairs.source = g.source AND pairs.item = o.source
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint FROM shares WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::int AS rank FROM parts)
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
    """,
}
