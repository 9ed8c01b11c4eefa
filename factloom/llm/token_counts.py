"""Token totals for every context limit, from one exact histogram of lengths.

Documents are counted by encoded length; nothing else is kept of them. Suffix sums
over the histogram then answer, for every limit, how many documents are longer,
how many tokens there are in all, and how many are left when every document is
cut at the limit. The sums run over buckets of lengths first and inside each
bucket after that, so no task holds more than a bucket.

Defined cases: a NULL or empty text has length 0 and is counted. Rows count one by
one, repeated ones too. An empty table gives an empty histogram. A NULL language
is a group of its own. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.texts import column, small_batches
from factloom.llm.tokens import encoder
from factloom.sources.staging import stage

BUCKET = 1024


def token_lengths(docs: DataFrame, tokenizer: str, group: str | None = None) -> DataFrame:
    """(grp, length) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            lengths = [len(encode(text.as_py())) for text in column(batch, "text")]
            yield pa.RecordBatch.from_arrays([column(batch, "grp"), pa.array(lengths, pa.int64())], names=["grp", "length"])

    grp = F.col(group).cast("string") if group else F.lit("all")
    return docs.select(grp.alias("grp"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "grp string, length long"
    )


def histogram(docs: DataFrame, tokenizer: str, group: str | None = None) -> DataFrame:
    """(grp, length, n_docs): the exact histogram, and all that is kept of the corpus."""
    return token_lengths(docs, tokenizer, group).groupBy("grp", "length").agg(F.count(F.lit(1)).alias("n_docs"))


def limits(counts: DataFrame) -> DataFrame:
    """Answers for every length that occurs, taken as a context limit:

    n_docs (of that length), n_shorter, n_longer, tokens_longer (of the longer
    documents), total_tokens and truncated_tokens (all documents cut at the limit),
    rank (share of documents up to the limit, from which quantiles follow).
    """
    rows = counts.select("grp", "length", "n_docs", (F.col("length") * F.col("n_docs")).alias("_tokens"),
                         F.floor(F.col("length") / BUCKET).alias("_bucket"))
    with small_batches(counts.sparkSession):
        rows = stage(rows, "length-histogram").df
    sums = [F.sum("n_docs").alias("_docs_here"), F.sum("_tokens").alias("_tokens_here")]
    after = Window.partitionBy("grp").orderBy("_bucket").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy("grp")
    buckets = rows.groupBy("grp", "_bucket").agg(*sums).select(
        "grp", "_bucket",
        F.coalesce(F.sum("_docs_here").over(after), F.lit(0)).alias("_docs_after"),
        F.coalesce(F.sum("_tokens_here").over(after), F.lit(0)).alias("_tokens_after"),
        F.sum("_docs_here").over(whole).alias("_docs"),
        F.sum("_tokens_here").over(whole).alias("total_tokens"),
    )
    inside = Window.partitionBy("grp", "_bucket").orderBy("length").rowsBetween(1, Window.unboundedFollowing)
    joined = rows.withColumns({
        "_n": F.coalesce(F.sum("n_docs").over(inside), F.lit(0)),
        "_t": F.coalesce(F.sum("_tokens").over(inside), F.lit(0)),
    }).alias("r").join(buckets.alias("b"), F.expr("r.grp <=> b.grp AND r._bucket = b._bucket"))
    longer, tokens_longer = F.col("_n") + F.col("_docs_after"), F.col("_t") + F.col("_tokens_after")
    return joined.select(
        F.col("r.grp").alias("grp"), F.col("length").alias("context_limit"), "n_docs",
        (F.col("_docs") - longer - F.col("n_docs")).alias("n_shorter"), longer.alias("n_longer"),
        tokens_longer.alias("tokens_longer"), "total_tokens",
        (F.col("total_tokens") - tokens_longer + longer * F.col("length")).alias("truncated_tokens"),
        ((F.col("_docs") - longer) / F.col("_docs")).alias("rank"),
    )


def quantile(answers: DataFrame, share: float) -> DataFrame:
    """The exact quantile per group: the smallest limit that ``share`` of the documents keep."""
    return answers.where(F.col("rank") >= share).groupBy("grp").agg(F.min("context_limit").alias("context_limit"))


def at_limit(answers: DataFrame, limit: int) -> DataFrame:
    """n_longer and truncated_tokens for any limit, also one no document has as its length."""
    over = answers.where(F.col("context_limit") > limit).groupBy("grp").agg(
        F.sum("n_docs").alias("_n"), F.sum(F.col("n_docs") * F.col("context_limit")).alias("_t"))
    totals = answers.groupBy("grp").agg(F.max("total_tokens").alias("total_tokens"))
    joined = totals.alias("t").join(over.alias("o"), F.expr("t.grp <=> o.grp"), "left")
    n, t = F.coalesce("_n", F.lit(0)), F.coalesce("_t", F.lit(0))
    return joined.select(F.col("t.grp").alias("grp"), F.lit(limit).cast("long").alias("context_limit"),
                         n.alias("n_longer"), "total_tokens", (F.col("total_tokens") - t + n * limit).alias("truncated_tokens"))
