"""Embedders. A provider is a class with ``embed``; it is made once for each task and called with batches."""

from __future__ import annotations

import hashlib
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import replace
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from loamworks.config import Settings


class Embedder(Protocol):
    dimension: int

    def embed(self, texts: list[str], purpose: str) -> list[list[float]]:
        """Vectors of texts in their order; purpose is "document" or "query"."""


class HashingEmbedder:
    """Feature hashing of words with L2 norm 1: deterministic, offline. A text without words is the zero vector."""

    def __init__(self, dimension: int = 256) -> None:
        self.dimension = dimension
        self._bucket: dict[str, int] = {}

    def bucket(self, word: str) -> int:
        if word not in self._bucket:
            if len(self._bucket) > 500_000:
                self._bucket.clear()
            self._bucket[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self.dimension
        return self._bucket[word]

    def embed(self, texts: list[str], purpose: str = "document") -> list[list[float]]:
        out = np.zeros((len(texts), self.dimension), np.float32)
        for i, text in enumerate(texts):
            at = [self.bucket(w) for w in text.lower().split()]
            if at:
                counts = np.bincount(at, minlength=self.dimension)
                out[i] = counts / np.linalg.norm(counts)
        return out.tolist()


#: Factories by provider. Providers that need a network are plugged in with ``register``.
PROVIDERS: dict[str, Callable[[Settings], Embedder]] = {"hashing": lambda s: HashingEmbedder(s.embedding_dimension)}
#: Names of providers that answer questions but offer no embeddings, and what to tell who asks for them (names: fixed values).
CHAT_ONLY = {"anthropic": "it recommends voyage", "claude": "it recommends voyage", "groq": "choose openai, gemini, voyage or cohere"}
#: Model that settings name unless told otherwise, and that of each provider that a network backend has by default (fixed values).
DEFAULT_MODELS = {"openai": "text-embedding-3-large", "gemini": "gemini-embedding-001", "voyage": "voyage-3-large", "cohere": "embed-v4.0"}


def register(name: str, factory: Callable[[Settings], Embedder]) -> None:
    PROVIDERS[name] = factory


def model_for(backend: str, model: str) -> str:
    """The model of a backend: OpenAI's default named for another provider means that provider's own default."""
    return DEFAULT_MODELS.get(backend, model) if model == DEFAULT_MODELS["openai"] else model


def get_embedder(name: str | None = None, settings: Settings | None = None, model: str | None = None) -> Embedder:
    settings = settings or Settings()
    name = (name or settings.embedding_backend).lower()
    if name in CHAT_ONLY:
        raise ValueError(f"{name} only chats and has no embeddings: {CHAT_ONLY[name]}")
    if name in DEFAULT_MODELS and name not in PROVIDERS:
        raise ValueError(f"{name} needs a network: plug its client in with register({name!r}, factory)")
    if name not in PROVIDERS:
        raise ValueError(f"unknown embedding backend {name!r}; known: {sorted(PROVIDERS)}")
    return PROVIDERS[name](replace(settings, embedding_backend=name if name in DEFAULT_MODELS else settings.embedding_backend, embedding_model=model_for(name, model or settings.embedding_model)))


def embed_with_retry(embedder: Embedder, texts: list[str], purpose: str, attempts: int, wait: Callable[[float], None] = time.sleep) -> list[list[float]]:
    """Vectors of one batch; tried again after growing random pauses; an answer of another length is an error."""
    for attempt in range(1, attempts + 1):
        try:
            vectors = embedder.embed(texts, purpose)
            break
        except (ValueError, TypeError, KeyError, AttributeError):
            raise  # a wrong request stays wrong
        except Exception:
            if attempt == attempts:
                raise
            wait(random.uniform(0, min(30, 2**attempt)))
    if len(vectors) != len(texts):
        raise ValueError(f"{len(vectors)} vectors for {len(texts)} texts")
    return vectors


def embedding(text: Column, settings: Settings | None = None, purpose: str = "document", name: str | None = None) -> Column:
    """Vector of each text, in batches of the setting's size; null for null."""
    settings = settings or Settings()

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        embedder = get_embedder(name, settings)
        for texts in batches:
            out: list[list[float] | None] = [None] * len(texts)
            some = [i for i, x in enumerate(texts) if x is not None]
            for at in range(0, len(some), settings.embedding_batch):
                part = some[at : at + settings.embedding_batch]
                for i, v in zip(part, embed_with_retry(embedder, [texts.iloc[i] for i in part], purpose, settings.embedding_retries)):
                    out[i] = v
            yield pd.Series(out)

    return run(text)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays in double precision; null for a zero vector."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)
