"""Questions to search filters: keywords that must occur, and the rest."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.text import render
from factloom.operators.prompts import EXTRACTION_PROMPT
from factloom.operators.terms import ALL, find_terms, prefix_tree
from factloom.schemas import FILTERS

OK = "ok"
BAD_FILTERS = "bad_filters"


class Extractor(Protocol):
    """A remote model that answers an extraction prompt with JSON text."""

    def extract(self, prompt: str) -> str: ...


def vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The different values of some columns, as terms to look for. Duplicates
    are removed before the shuffle."""
    terms = F.explode(F.array(*[F.col(c).cast("string") for c in columns]))
    return df.select(terms.alias("term")).where("term IS NOT NULL").distinct()


def extract_filters(
    questions: DataFrame, terms: DataFrame, question: str = "question", overlaps: str = ALL
) -> DataFrame:
    """Add ``hard_keywords``, the vocabulary terms a question contains, and
    ``semantic_query``, the words that belong to none of them (the whole
    question if nothing is left).

    A term of any number of words matches whole words, whatever their case. The words
    of a question are cut at white space and freed of punctuation at both ends, those of
    a term are cut at blanks and taken as they are. Of terms that share words all are
    found; with ``overlaps="longest"`` only the leftmost and there the longest.
    """
    known = terms.select("term", F.split("term", " ").alias("words")).where("term IS NOT NULL").distinct()
    worded = questions.withColumn("_words", words(F.col(question)))
    texts = worded.where(F.col("_words").isNotNull()).select("qid", F.col("_words").alias("words"))
    found = find_terms(texts, prefix_tree(known), overlaps)
    found = found.select("qid", F.col("terms").alias("_terms"), F.col("covered").alias("_covered"))
    none = F.array().cast("array<string>")
    left = F.filter("_words", lambda w, i: ~F.array_contains(F.col("_covered"), i))
    rest = F.array_join(F.coalesce(left, F.col("_words")), " ")
    return worded.join(found, "qid", "left").select(
        *questions.columns,
        F.coalesce("_terms", none).alias("hard_keywords"),
        F.when(rest == "", F.col(question)).otherwise(rest).alias("semantic_query"),
    )


def words(text: Column) -> Column:
    """Words of a text, without punctuation at their ends."""
    trimmed = F.transform(
        F.split(text, r"\s+"),
        lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""),
    )
    return F.filter(trimmed, lambda w: w != "")


def request_filters(
    questions: DataFrame, make_extractor: Callable[[], Extractor], question: str = "question"
) -> DataFrame:
    """Add the raw ``response`` of a remote extractor. Its client is built once
    per task; write the result before using it, so that it is asked once."""

    @F.pandas_udf("string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        client = make_extractor()
        for prompts in batches:
            yield pd.Series([_response(client, p) for p in prompts], dtype=object)

    prompt = render(EXTRACTION_PROMPT, question=F.col(question))
    return questions.withColumn("response", ask(prompt))


def _response(client: Extractor, prompt: str | None) -> str | None:
    """NULL if the call fails, which ``parse_filters`` marks; the other questions go on."""
    try:
        return None if prompt is None else client.extract(prompt)
    except Exception:  # whatever a remote client may raise
        return None


def parse_filters(df: DataFrame, response: str = "response") -> DataFrame:
    """Add ``hard_keywords``, ``semantic_query`` and a ``status``. Both fields
    are required and hold no NULL; text that is no such JSON object gets ``bad_filters``."""
    parsed = F.from_json(response, FILTERS)
    columns = [c for c in df.columns if c not in ("hard_keywords", "semantic_query", "status")]
    fields = df.select(*columns, parsed.alias("_parsed")).select(*columns, "_parsed.*")
    whole = F.forall("hard_keywords", lambda word: word.isNotNull())
    complete = F.col("hard_keywords").isNotNull() & F.col("semantic_query").isNotNull() & whole
    return fields.withColumn("status", F.when(complete, OK).otherwise(BAD_FILTERS))
