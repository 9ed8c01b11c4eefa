"""Replies of remote models, kept across runs.

The ledger is a table of ``(ask_id, model, reply, row_sk)``. A prompt is addressed by
the 128-bit MD5 of its text, a reply belongs to one version of a model. Each different
prompt that has no reply yet is asked once, with bounded retries and growing waits;
what fails in the end stays out of the ledger, so the next run asks it again and
nothing else. Replies are appended in rounds: a run that is killed loses the calls of
the round it was in, those of earlier rounds are never made again. So does a lost task
within a round, which Spark runs again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.functions.hashing import row_hash
from factloom.functions.text import render
from factloom.operators.answers import Generator, settled
from factloom.operators.filters import Extractor
from factloom.operators.prompts import EXTRACTION_PROMPT, HYBRID, AnswerStyle
from factloom.schemas import ROW_KEY
from factloom.sources import tables
from factloom.sources.staging import stage

ASK_ID, MODEL, REPLY = "ask_id", "model", "reply"
LEDGER = T.StructType([
    T.StructField(ASK_ID, T.StringType()), T.StructField(MODEL, T.StringType()),
    T.StructField(REPLY, T.StringType()), T.StructField(ROW_KEY, T.LongType()),
])
ROUND_ROWS = 100_000


@dataclass(frozen=True)
class Retries:
    """How often a prompt is tried, and the wait before the second try in seconds,
    doubled before each further one up to ``longest``."""

    tries: int = 3
    wait: float = 1.0
    longest: float = 30.0

    def waits(self) -> list[float]:
        return [min(self.wait * 2**i, self.longest) for i in range(self.tries - 1)]


@dataclass(frozen=True)
class Asked:
    """Different prompts of a run, how many of them the ledger held already, and how
    many of the others the model answered."""

    prompts: int
    known: int
    answered: int

    @property
    def failed(self) -> int:
        return self.prompts - self.known - self.answered


Call = Callable[[str], str | None]


def ask_id(prompt: Column) -> Column:
    """32 hexadecimal digits; NULL for NULL."""
    return F.md5(prompt)


def ask(
    rows: DataFrame,
    prompt: str,
    ledger: str,
    model: str,
    make_call: Callable[[], Call],
    retries: Retries = Retries(),
    tasks: int | None = None,
    round_rows: int = ROUND_ROWS,
    buckets: int = tables.DEFAULT_BUCKETS,
) -> Asked:
    """Make the ledger hold a reply to every ``prompt`` of the rows, as far as the model
    gives one. NULL prompts are not asked, and a NULL reply counts as none. ``make_call``
    builds the client once per task; ``tasks`` is how many clients ask at a time, and
    ``round_rows`` how many prompts a round has at most, on average."""
    spark = rows.sparkSession
    if not tables.exists(spark, ledger):
        tables.create_or_replace(spark, ledger, LEDGER, buckets)
    # Copies of a prompt are reduced in the tasks, before the shuffle.
    asked = rows.where(F.col(prompt).isNotNull()).select(ask_id(F.col(prompt)).alias(ASK_ID), F.col(prompt).alias("_text"))
    asked = asked.distinct().withColumn(MODEL, F.lit(model))
    asked = stage(asked.withColumn(ROW_KEY, row_hash([ASK_ID, MODEL])), "asked-prompts")
    known = tables.read_current(spark, ledger).where(F.col(MODEL) == model).select(ASK_ID)
    if asked.small:
        # A small batch goes to the ledger, which then needs no shuffle.
        known = known.join(F.broadcast(asked.df.select(ASK_ID)), ASK_ID, "left_semi")
    missing = stage(asked.df.join(known, ASK_ID, "left_anti"), "missing-prompts")
    rounds = -(-missing.rows // round_rows)
    answered = 0
    for number in range(rounds):
        todo = missing.df.where(F.pmod(F.xxhash64(ASK_ID), F.lit(rounds)) == number)
        if tasks:
            todo = todo.repartition(tasks)
        replied = todo.withColumn(REPLY, _replies(make_call, retries)(F.col("_text")))
        # Written before it is filtered and gathered, so that both ask nothing again.
        got = stage(replied.select(*LEDGER.fieldNames()), "replies", {"answered": F.count(REPLY)})
        if got.metrics["answered"]:
            answered += tables.append(got.df.where(F.col(REPLY).isNotNull()), ledger, ROW_KEY)
    return Asked(asked.rows, asked.rows - missing.rows, answered)


def _replies(make_call: Callable[[], Call], retries: Retries):
    @F.pandas_udf("string")
    def replies(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        call = make_call()
        for prompts in batches:
            yield pd.Series([_tried(call, p, retries.waits()) for p in prompts], dtype=object)

    return replies.asNondeterministic()


def _tried(call: Call, prompt: str, waits: list[float]) -> str | None:
    """NULL if no try succeeds; the other prompts go on."""
    for wait in [*waits, None]:
        try:
            return call(prompt)
        except Exception:  # whatever a remote client may raise
            if wait is not None:
                time.sleep(wait)
    return None


def with_replies(rows: DataFrame, prompt: str, ledger: str, model: str, out: str = REPLY) -> DataFrame:
    """The rows with the kept reply to their prompt; NULL where there is none. A
    prompt that many rows share is split by adaptive execution."""
    held = tables.read_current(rows.sparkSession, ledger).where(F.col(MODEL) == model)
    held = held.select(F.col(ASK_ID).alias("_id"), F.col(REPLY).alias(out))
    return rows.join(held, ask_id(F.col(prompt)) == F.col("_id"), "left").drop("_id")


def generate_kept(
    prompted: DataFrame,
    ledger: str,
    model: str,
    make_generator: Callable[[], Generator],
    style: AnswerStyle = HYBRID,
    **how,
) -> tuple[DataFrame, Asked]:
    """As ``answers.generate``, with replies from the ledger; ``how`` goes to ``ask``.
    Write ``prompted`` before, or it is computed twice."""
    done = ask(prompted, "prompt", ledger, model, lambda: make_generator().generate, **how)
    tried = with_replies(prompted, "prompt", ledger, model, "_reply")
    missed = F.col("prompt").isNotNull() & F.col("_reply").isNull()
    return settled(tried, F.col("_reply"), missed, style).drop("_reply"), done


def request_filters_kept(
    questions: DataFrame,
    ledger: str,
    model: str,
    make_extractor: Callable[[], Extractor],
    question: str = "question",
    **how,
) -> tuple[DataFrame, Asked]:
    """As ``filters.request_filters``, with responses from the ledger."""
    prompted = questions.withColumn("_prompt", render(EXTRACTION_PROMPT, question=F.col(question)))
    done = ask(prompted, "_prompt", ledger, model, lambda: make_extractor().extract, **how)
    return with_replies(prompted, "_prompt", ledger, model, "response").drop("_prompt"), done
