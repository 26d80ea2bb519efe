"""Settings, from the environment (``LOAMWORKS_…``) over the defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from typing import Literal, get_args

VectorBackend = Literal["pgvector", "pinecone", "qdrant", "weaviate", "milvus"]
EmbeddingBackend = Literal["hashing", "openai", "gemini", "voyage", "cohere"]


@dataclass(frozen=True)
class Settings:
    """All numbers a run depends on. A count of 0 or less given to a component means "use the setting"."""

    # Numbers and names that results depend on.
    embedding_backend: str = "hashing"
    embedding_model: str = "text-embedding-3-large"
    embedding_dimension: int = 256
    embedding_batch: int = 128
    embedding_retries: int = 6
    vector_backend: str = "pgvector"
    namespace: str = "default"
    crawl_max_depth: int = 1
    crawl_max_pages: int = 50
    crawl_min_words: int = 20
    crawl_same_domain: bool = True
    crawl_timeout: int = 30
    max_sitemaps: int = 50
    chunk_target_tokens: int = 1000
    chunk_max_tokens: int = 1200
    chunk_overlap_tokens: int = 175
    tokenizer: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    top_k: int = 5

    def __post_init__(self) -> None:
        for name, kind in (("vector_backend", VectorBackend), ("embedding_backend", EmbeddingBackend)):
            if getattr(self, name) not in get_args(kind):
                raise ValueError(f"unknown {name}: {getattr(self, name)!r}; one of {get_args(kind)}")
        if self.crawl_max_depth < 0 or self.crawl_max_pages < 1:
            raise ValueError("crawl_max_depth must be 0 or more, crawl_max_pages 1 or more")

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        env = dict(os.environ) if env is None else env
        values = {}
        for f in fields(cls):
            raw = env.get(f"LOAMWORKS_{f.name.upper()}")
            if raw is not None:
                kind = type(f.default)
                values[f.name] = raw.lower() in ("1", "true", "yes") if kind is bool else kind(raw)
        return cls(**values)
