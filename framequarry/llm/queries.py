"""Importing this module registers every corpus query."""

from . import (  # noqa: F401
    conversations, decontaminate, jaccard_join, language, line_dedup, main_text, periodic_runs, pieces, quality, secrets, sentence_spans, toxicity, url_filter,
)
from .registry import QUERIES, SQL  # noqa: F401
