"""Structured Streaming use of the stateless cleaning steps."""
from .clean_stream import start_clean_stream  # noqa: F401
