"""Question answering jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators.answers import Generator, contexts, generate, prompts
from factloom.operators.embed import EmbedderFactory, HashingEmbedder, embed
from factloom.operators.filters import OK
from factloom.operators.prompts import GREETING, HYBRID, VECTOR_ONLY, AnswerStyle
from factloom.operators.search import attach_documents, hybrid_topk, vector_topk
from factloom.schemas import DOCUMENT, ROW_KEY, VECTOR
from factloom.sources.staging import stage


def documents_of(vector_table: DataFrame) -> DataFrame:
    """The vector table as documents to search."""
    return vector_table.select(
        F.col(ROW_KEY).alias("doc_key"), F.col(DOCUMENT).alias("document"), F.col(VECTOR).alias("vector")
    )


def vector_retrieval(
    docs: DataFrame, questions: DataFrame, make_embedder: EmbedderFactory = HashingEmbedder, k: int = 3
) -> DataFrame:
    """Best documents of each ``(qid, question)``, by the whole question."""
    asked = embed(questions, "question", "question_vector", make_embedder)
    return attach_documents(vector_topk(docs, asked, k, make_embedder=make_embedder), docs)


def hybrid_retrieval(
    docs: DataFrame,
    filtered: DataFrame,
    make_embedder: EmbedderFactory = HashingEmbedder,
    k: int = 5,
    literal: bool = False,
    distinct_documents: bool = False,
) -> DataFrame:
    """Best documents of each ``(qid, hard_keywords, semantic_query)`` that hold
    all the keywords. Only the semantic part is embedded. Documents may come
    without vectors; then those that hold the keywords are embedded."""
    if "status" in filtered.columns:
        filtered = filtered.where(F.col("status") == OK)
    asked = embed(filtered, "semantic_query", "question_vector", make_embedder)
    found = hybrid_topk(docs, asked, k, literal, distinct_documents, make_embedder=make_embedder)
    return attach_documents(found, docs)


def answer(
    questions: DataFrame,
    retrieved: DataFrame,
    make_generator: Callable[[], Generator] | None = None,
    style: AnswerStyle = HYBRID,
) -> DataFrame:
    """Prompts of the questions and, given a generator, their answers. The
    prompts are written first, so that a retry does not search again."""
    prompted = prompts(questions, contexts(retrieved), style)
    if make_generator is None:
        return prompted
    return generate(stage(prompted, "prompts").df, make_generator, style)


def answer_by_vector(
    docs: DataFrame,
    questions: DataFrame,
    make_generator: Callable[[], Generator] | None = None,
    make_embedder: EmbedderFactory = HashingEmbedder,
    k: int = 3,
) -> DataFrame:
    """Answers of ``(qid, question)`` by vector search alone."""
    return answer(questions, vector_retrieval(docs, questions, make_embedder, k), make_generator, VECTOR_ONLY)


def answer_hybrid(
    docs: DataFrame,
    filtered: DataFrame,
    make_generator: Callable[[], Generator] | None = None,
    make_embedder: EmbedderFactory = HashingEmbedder,
    k: int = 5,
) -> DataFrame:
    """Answers of ``(qid, question, hard_keywords, semantic_query)`` by keyword
    and vector search."""
    return answer(filtered, hybrid_retrieval(docs, filtered, make_embedder, k), make_generator, HYBRID)


def user_questions(conversations: DataFrame) -> DataFrame:
    """The user turns of ``(conv_id, turn, role, text)``; each is a question of
    its own, earlier turns play no part."""
    asked = conversations.where(F.col("role") == "user")
    qid = F.concat_ws("/", "conv_id", "turn")
    return asked.select(qid.alias("qid"), "conv_id", "turn", F.col("text").alias("question"))


def transcripts(answered: DataFrame, greeting: str = GREETING) -> DataFrame:
    """Transcripts ``(conv_id, turn, role, text)`` of ``(conv_id, turn, question,
    answer)``: the greeting, then every question followed by its answer.

    Turn numbers follow from those of the questions and keep their order, so a
    long conversation need not be gathered to be numbered.
    """
    rows = F.array(
        F.struct(
            (F.col("turn") * 2 + 1).alias("turn"),
            F.lit("user").alias("role"),
            F.col("question").alias("text"),
        ),
        F.struct(
            (F.col("turn") * 2 + 2).alias("turn"),
            F.lit("assistant").alias("role"),
            F.col("answer").alias("text"),
        ),
    )
    turns = answered.select("conv_id", F.explode(rows).alias("t")).select("conv_id", "t.*")
    opening = answered.select("conv_id").distinct().select(
        "conv_id",
        F.lit(0).cast("long").alias("turn"),
        F.lit("assistant").alias("role"),
        F.lit(greeting).alias("text"),
    )
    return opening.unionByName(turns)
