"""String column expressions: tokenizer, blank test, path predicates.

All of them are built-in Spark expressions, so they stay inside the
JVM (and inside whole-stage codegen where Spark supports it).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must stay exactly as they are for results to match.
#
# Stop-words removed after tokenizing (81 words, alphabetical).
STOP_WORDS: tuple[str, ...] = (
    "a", "about", "above", "after", "against", "an", "and", "are", "as",
    "at", "be", "been", "before", "being", "below", "between", "but", "by",
    "can", "did", "do", "does", "doing", "down", "during", "else", "for",
    "from", "had", "has", "have", "having", "he", "her", "his", "i", "if",
    "in", "into", "is", "it", "its", "just", "my", "no", "nor", "not",
    "now", "of", "on", "or", "our", "she", "should", "so", "than", "that",
    "the", "their", "them", "then", "these", "they", "this", "those",
    "through", "to", "too", "up", "very", "was", "we", "were", "what",
    "which", "who", "whom", "will", "with", "you", "your",
)
# A token is a run of ASCII letters, digits and underscore, taken after
# Unicode lower-casing.
TOKEN_PATTERN = r"([A-Za-z0-9_]+)"
# Characters Python's str.strip() removes (whitespace per str.isspace):
# \t..\r, \x1c..\x1f, \x85 and the Unicode separators (category Z).
BLANK_PATTERN = r"\A[\t-\r\x1c-\x1f\x85\p{Z}]*\z"
# File suffixes, compared lower-cased.
CODE_SUFFIXES: tuple[str, ...] = (".py", ".pyi")
TEXT_SUFFIXES: tuple[str, ...] = (".md", ".rst", ".txt")
SUPPORTED_SUFFIXES: tuple[str, ...] = CODE_SUFFIXES + TEXT_SUFFIXES
# Paragraph break: two or more newlines.
PARAGRAPH_BREAK = r"\n{2,}"
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text: Column | str) -> Column:
    """ARRAY<STRING> of lower-cased tokens, stop-words removed, order kept."""
    runs = F.regexp_extract_all(F.lower(_col(text)), F.lit(TOKEN_PATTERN), 1)
    return F.filter(runs, lambda t: ~t.isin(*STOP_WORDS))


def is_blank(text: Column | str) -> Column:
    """True when the string is empty after Python-style strip()."""
    return _col(text).rlike(BLANK_PATTERN)


def normalize_newlines(text: Column | str) -> Column:
    r"""Turn ``\r\n`` and lone ``\r`` into ``\n`` (text-mode reading)."""
    return F.regexp_replace(_col(text), r"\r\n?", "\n")


def path_suffix(path: Column | str) -> Column:
    """Lower-cased suffix of the last path component ('' if none).

    Like a path object's suffix: a name that is only a dot-prefixed
    word (``.py``) has no suffix.
    """
    name = F.element_at(F.split(_col(path), "/"), -1)
    return F.lower(F.regexp_extract(name, r"^.+?(\.[^.]+)$", 1)).alias("suffix")


def _suffix_in(path: Column | str, suffixes: tuple[str, ...]) -> Column:
    return path_suffix(path).isin(*suffixes)


def is_supported_path(path: Column | str) -> Column:
    return _suffix_in(path, SUPPORTED_SUFFIXES)


def is_code_path(path: Column | str) -> Column:
    return _suffix_in(path, CODE_SUFFIXES)


def is_text_path(path: Column | str) -> Column:
    return _suffix_in(path, TEXT_SUFFIXES)


def corpus_order(path: Column | str) -> Column:
    """Sort key giving component-wise path order (``a/b`` < ``a-b/c``).

    ``/`` becomes U+0000, which sorts below every character a path
    component can hold, so plain string order of the key equals
    component-by-component order of the path (and a string key is far
    cheaper to sort than an array of components).
    """
    return F.replace(_col(path), F.lit("/"), F.lit("\u0000"))
