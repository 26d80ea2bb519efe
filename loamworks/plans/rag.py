"""Answers to questions from a collection, with numbered and cited context."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamworks.config import Settings
from loamworks.functions.embedding import embed_with_retry, get_embedder
from loamworks.operators.collection import Collection
from loamworks.operators.search import search

NOTHING = "No indexed content found."
SYSTEM_PROMPT = "Answer from the numbered passages only. After each statement name its passage as [n]. If they don't hold the answer, say that you don't know."
SEPARATOR = "\n\n---\n\n"


class LLM(Protocol):
    def complete(self, system: str, user: str, temperature: float = 0.1) -> str: ...


class ExtractiveLLM:
    """Offline stand-in: the first sentence of the first passage, with its mark."""

    def complete(self, system: str, user: str, temperature: float = 0.1) -> str:
        passage = user.partition("[1] ")[2].partition("\n")[2].partition(SEPARATOR)[0]
        return f"{passage.strip().partition('. ')[0].strip().rstrip('.')}. [1]"


@dataclass(frozen=True)
class Answer:
    answer: str
    sources: list[dict] = field(default_factory=list)


def passage(rank, url, section, text):
    """Column of one numbered passage."""
    where = F.when(F.coalesce(section, F.lit("")) != "", F.concat(F.lit(" — "), section)).otherwise("")
    return F.concat(F.lit("["), rank.cast("string"), F.lit("] "), F.coalesce(url, F.lit("")), where, F.lit("\n"), text)


def contexts(found: DataFrame) -> DataFrame:
    """(qid, context) of found passages (qid, rank, source_url, section, text), in order of rank."""
    one = found.select("qid", "rank", passage(F.col("rank"), F.col("source_url"), F.col("section"), F.col("text")).alias("p"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", "p"))), lambda x: x["p"])
    return one.groupBy("qid").agg(F.array_join(ordered, SEPARATOR).alias("context"))


def user_prompt(question: str, context: str) -> str:
    return f"Passages:\n{context}\n\nQuestion: {question}\n\nAnswer with citations:"


def ask(collection: Collection, question: str, k: int | None = None, settings: Settings | None = None, llm: LLM | None = None, where: dict | None = None) -> Answer:
    """Answer to one question; a fixed answer, without asking the model, if nothing is indexed."""
    settings = settings or Settings()
    collection.ensure()
    vector = embed_with_retry(get_embedder(settings=settings), [question], "query", settings.embedding_retries)[0]
    found = search(collection.read(), vector, settings.top_k if k is None else k, settings.vector_backend, settings.namespace, where)
    meta = lambda f: F.get_json_object("metadata", f"$.{f}")
    sources = [r.asDict() for r in found.withColumn("passage", passage(F.col("rank"), meta("source_url"), meta("section"), F.col("text"))).orderBy("rank").collect()]
    if not sources:
        return Answer(NOTHING)
    context = SEPARATOR.join(s.pop("passage") for s in sources)
    return Answer((llm or ExtractiveLLM()).complete(SYSTEM_PROMPT, user_prompt(question, context)).strip(), sources)
