"""Column-expression helpers (string, path and span functions)."""

from lexispan.functions.text import (
    STOP_WORDS,
    corpus_order,
    is_blank,
    is_code_path,
    is_supported_path,
    is_text_path,
    normalize_newlines,
    path_suffix,
    tokenize,
)
from lexispan.functions.spans import interval_iou, slice_text

__all__ = [
    "STOP_WORDS", "corpus_order", "is_blank", "is_code_path",
    "is_supported_path", "is_text_path", "normalize_newlines",
    "path_suffix", "tokenize", "interval_iou", "slice_text",
]
