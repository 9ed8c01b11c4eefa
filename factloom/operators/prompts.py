"""Prompt and answer texts."""

from __future__ import annotations

from dataclasses import dataclass

CONTEXT_SEPARATOR = "\n\n---\n\n"


@dataclass(frozen=True)
class AnswerStyle:
    """Texts of one kind of answer: the prompt, and what to say instead."""

    prompt: str
    no_match: str
    error: str


# --- Fixed values: prompts, each line indented by eight blanks (four for the
# extraction prompt), beginning and ending with a line break --------------------
HYBRID_PROMPT = """
        You are a professional sports data analyst. Answer the user's question based EXCLUSIVELY on the provided context below.
        If the answer cannot be found in the context, simply state: "I don't have this data in my knowledge base."
        
        Database Context (best matches):
        {context}
        
        User Question: {question}
        """

VECTOR_PROMPT = """
        You are a sports assistant and football expert.
        Answer the user's question based EXCLUSIVELY on the context provided below.
        If the context does not contain enough information to answer, say honestly that you do not know. Do not make things up (do not hallucinate).

        DATABASE CONTEXT:
        {context}

        USER QUESTION:
        {question}
        """

EXTRACTION_PROMPT = """
    You are a database assistant. Analyze the user's query.
    Extract hard keywords from it (e.g., country names, company names, dates),
    and keep the rest as a semantic query.
    
    Query: "{question}"
    """

# --- Fixed values: answers when there is no match, or on an error ---------------
HYBRID = AnswerStyle(
    prompt=HYBRID_PROMPT,
    no_match="🤖 AI Response: I couldn't find any relevant information in the database.",
    error="🛠️ Sorry, our AI system is currently experiencing technical difficulties.",
)
VECTOR_ONLY = AnswerStyle(
    prompt=VECTOR_PROMPT,
    no_match="🤖 AI Response: I couldn't find any relevant information.",
    error="🛠️ Sorry, our AI system is currently experiencing technical difficulties.",
)

# The first turn of every transcript; an application sets its own.
GREETING = "Hi! Ask me anything about the players."
