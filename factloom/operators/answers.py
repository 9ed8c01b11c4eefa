"""Ranked documents to contexts, prompts and answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.text import render
from factloom.operators.filters import BAD_FILTERS, OK
from factloom.operators.prompts import CONTEXT_SEPARATOR, HYBRID, AnswerStyle

NO_MATCH = "no_match"
ERROR = "error"


class Generator(Protocol):
    """A model that answers a prompt."""

    def generate(self, prompt: str) -> str: ...


class PromptLength:
    """Stands in for a model where none is installed: says how long the prompt is."""

    def generate(self, prompt: str) -> str:
        return f"{len(prompt)} characters read"


def contexts(ranked: DataFrame, separator: str = CONTEXT_SEPARATOR) -> DataFrame:
    """The documents of each question in rank order, as one text. ``ranked`` is
    a top-k result, so a group has at most k rows."""
    pairs = F.array_sort(F.collect_list(F.struct("rank", "document")))
    text = F.array_join(F.transform(pairs, lambda p: p["document"]), separator)
    return ranked.groupBy("qid").agg(text.alias("context"), F.count(F.lit(1)).alias("matches"))


def prompts(questions: DataFrame, context: DataFrame, style: AnswerStyle = HYBRID) -> DataFrame:
    """The questions with a ``status``, the number of ``matches`` and, where the
    status is ``ok``, the ``prompt``. Without a match it is ``no_match``. A
    ``status`` other than ``ok`` that the questions bring along stays."""
    matches = F.coalesce("matches", F.lit(0))
    status = F.when(matches == 0, NO_MATCH).otherwise(OK)
    if "status" in questions.columns:
        status = F.when(F.col("status") != OK, F.col("status")).otherwise(status)
    prompt = render(style.prompt, context=F.col("context"), question=F.col("question"))
    return (
        questions.join(context, "qid", "left")
        .withColumns({"status": status, "matches": matches})
        .withColumn("prompt", F.when(F.col("status") == OK, prompt))
        .drop("context")
    )


def generate(
    prompted: DataFrame, make_generator: Callable[[], Generator], style: AnswerStyle = HYBRID
) -> DataFrame:
    """Add the ``answer`` to each prompt, or the text that stands for it.

    The client is built once per task. A question whose generation fails gets
    the status ``error``; the others go on.
    """

    @F.pandas_udf("reply string, failed boolean")
    def reply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        client = make_generator()
        for texts in batches:
            yield pd.DataFrame([_reply(client, t) for t in texts], columns=["reply", "failed"])

    tried = prompted.withColumn("_r", reply(F.col("prompt")))
    return settled(tried, F.col("_r.reply"), F.col("_r.failed"), style).drop("_r")


def settled(tried: DataFrame, reply: Column, failed: Column, style: AnswerStyle) -> DataFrame:
    """Add the ``answer`` by status: the reply, or the text that stands for it."""
    status = F.when(failed, ERROR).otherwise(F.col("status"))
    answer = (
        F.when(F.col("status") == NO_MATCH, style.no_match)
        .when(F.col("status").isin(ERROR, BAD_FILTERS), style.error)
        .otherwise(reply)
    )
    return tried.withColumn("status", status).withColumn("answer", answer)


def _reply(client: Generator, prompt: str | None) -> tuple[str | None, bool]:
    if prompt is None:
        return None, False
    try:
        return client.generate(prompt), False
    except Exception:  # whatever the client raises, it costs this answer only
        return None, True
