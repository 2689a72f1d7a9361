"""Column expressions (no Python UDF)."""
from .text import clean_text, word_count, preview  # noqa: F401
from .labels import normalize_label  # noqa: F401
