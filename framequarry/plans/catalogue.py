"""Importing this module registers every query."""

from . import file_queries, label_queries, lane_queries, path_queries, relation_queries, stream_queries  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
