"""Structured Streaming: bounded incremental loads."""

from .incremental import incremental_load, load_report
from .key_index import KeyIndex

__all__ = ["KeyIndex", "incremental_load", "load_report"]
