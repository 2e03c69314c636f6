"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from tilewright.llm.pipeline import STAGES, run  # noqa: F401

#: The stages learn from labels and use a tokenizer, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None
