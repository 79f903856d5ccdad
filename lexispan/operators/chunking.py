"""Documents -> chunks with exact code-point offsets.

All chunking is a narrow projection plus one ``explode``: no shuffle.
Prose and code are two branches, of which only the second needs Python.
Offsets are left-inclusive,
right-exclusive code-point positions, so
``substring(text, first + 1, last - first)`` is the chunk text.

Strategies, chosen by file suffix:

* prose (.md .rst .txt): paragraphs are the non-empty pieces between
  runs of two or more newlines; they are packed greedily into buffers of
  at most ``n`` characters (an ordered fold per document, ``aggregate``);
* code (.py .pyi): one span per top-level statement (from the previous
  statement's end to the end of this statement's last line) and a tail;
  unparsable files are cut into fixed windows;
* every span that is not blank is cut into windows of ``n`` characters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.functions.text import (
    PARAGRAPH_BREAK,
    corpus_order,
    is_blank,
    is_code_path,
    is_text_path,
    path_suffix,
)
from lexispan.operators.code_bounds import statement_ends_udf

MAX_CHUNK_SIZE = 2000
DEFAULT_CHUNK_SIZE = 2000

SPAN_TYPE = "array<struct<s:bigint,e:bigint,keep:boolean>>"
BOUND_TYPE = "array<struct<s:bigint,e:bigint>>"
WINDOW_TYPE = "array<struct<s:bigint,e:bigint,text:string>>"


def check_chunk_size(n: int) -> int:
    """The chunk size must be an int in 1..2000 (checked eagerly)."""
    if isinstance(n, bool) or not isinstance(n, int):
        raise ValueError("max_chunk_size must be an integer.")
    if not 1 <= n <= MAX_CHUNK_SIZE:
        raise ValueError(
            f"max_chunk_size must be between 1 and {MAX_CHUNK_SIZE} characters.")
    return n


# --------------------------------------------------------------------------
# Column-level building blocks
# --------------------------------------------------------------------------

# Code points of a text block; a window of MAX_CHUNK_SIZE meets at most two.
BLOCK = 2048
# Paragraphs of one fold. A fold appends to arrays, so a long document's
# paragraphs go block by block.
FOLD_BLOCK = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def text_blocks(text: Column) -> Column:
    """The text cut once, in one pass, into blocks of BLOCK code points:
    a place is found by its block's number, not by counting from the
    start of the text."""
    return F.when(F.length(text) <= BLOCK, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))


def block_text(blocks: Column, s: Column, e: Column) -> Column:
    """Code points ``[s, e)``, at most BLOCK of them, of one or two blocks."""
    number = F.floor(s / BLOCK).cast("int")
    inside = e <= (number + 1).cast("bigint") * BLOCK
    near = F.when(inside, F.get(blocks, number)).otherwise(
        F.concat(F.get(blocks, number), F.get(blocks, number + 1)))
    return near.substr((s - number * BLOCK).cast("int") + 1, (e - s).cast("int"))


def fixed_windows(s: Column, e: Column, n: int) -> Column:
    """C1 on the span ``[s, e)``: windows of ``n`` code points, the last
    one shorter; an empty span gives no window."""
    step = F.lit(n).cast("bigint")
    wins = F.transform(
        F.sequence(s, e - 1, step),
        lambda w: F.struct(w.alias("s"), F.least(w + step, e).alias("e")))
    return F.when(e > s, wins).otherwise(F.array().cast(BOUND_TYPE))


def window_texts(blocks: Column, s: Column, e: Column, n: int) -> Column:
    """C1 on the span ``[s, e)``: windows with their text."""
    return F.transform(fixed_windows(s, e, n), lambda w: F.struct(
        w["s"].alias("s"), w["e"].alias("e"), block_text(blocks, w["s"], w["e"]).alias("text")))


def span_windows(text: Column, spans: Column, n: int) -> Column:
    """C2 over an array of spans: blank spans are dropped unless flagged
    ``keep`` (whole-file fallback), the rest are cut by C1. A span is
    blank if all its windows are. Windows carry their text; the work is
    in proportion to the text, however long it is."""
    def of_span(blocks: Column, sp: Column) -> Column:
        def kept(windows: Column) -> Column:
            blank = F.forall(windows, lambda w: is_blank(w["text"]))
            return F.when(blank & ~sp["keep"], F.array().cast(WINDOW_TYPE)).otherwise(windows)
        return _let(window_texts(blocks, sp["s"], sp["e"], n), kept)
    return _let(text_blocks(text), lambda blocks: F.flatten(
        F.transform(spans, lambda sp: of_span(blocks, sp))))


def _piece_lengths(text: Column) -> Column:
    """(piece length, following separator length) for the paragraph split."""
    pieces = F.split(text, PARAGRAPH_BREAK)
    seps = F.concat(F.regexp_extract_all(text, F.lit("(" + PARAGRAPH_BREAK + ")"), 1),
                    F.array(F.lit("")))
    return F.zip_with(pieces, seps, lambda p, q: F.struct(
        F.length(p).cast("bigint").alias("lp"), F.length(q).cast("bigint").alias("lq")))


def _folded(pieces: Column, zero: Column, step: Callable[[Column, Column], Column],
            emitted: Callable[[Column, Column], Column]) -> Column:
    """A fold over ``pieces`` that also gives bounds: ``step(state, piece)``
    is the next state, ``emitted(state, piece)`` an array of bounds.

    The states at the blocks' starts are found first, one small struct a
    block; then every block gives its rows from its own start, so that no
    array grows with the document while rows are appended to it. Returns
    (state at the end, rows).
    """
    def inside(i: Column) -> Column:
        return F.sequence(i * FOLD_BLOCK, F.least((i + 1) * FOLD_BLOCK, F.size(pieces)) - 1)

    def passed(state: Column, i: Column) -> Column:
        return F.aggregate(inside(i), state, lambda st, j: step(st, F.get(pieces, j)))

    def rows(state: Column, i: Column) -> Column:
        start = F.struct(state.alias("state"), F.array().cast(BOUND_TYPE).alias("rows"))
        return F.aggregate(inside(i), start, lambda acc, j: F.struct(
            step(acc["state"], F.get(pieces, j)).alias("state"),
            _appended(acc["rows"], emitted(acc["state"], F.get(pieces, j))).alias("rows")), lambda acc: acc["rows"])

    numbers = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / FOLD_BLOCK).cast("int"))
    first = F.struct(zero.alias("state"), F.slice(F.array(zero), 1, 0).alias("starts"))
    walked = F.aggregate(numbers, first, lambda acc, i: F.struct(
        passed(acc["state"], i).alias("state"), F.concat(acc["starts"], F.array(acc["state"])).alias("starts")))
    return _let(walked, lambda w: F.struct(
        w["state"].alias("state"),
        F.flatten(F.zip_with(w["starts"], numbers, rows)).alias("rows")))


def _appended(rows: Column, more: Column) -> Column:
    return F.when(F.size(more) > 0, F.concat(rows, more)).otherwise(rows)


def _bound(s: Column, e: Column) -> Column:
    return F.array(F.struct(s.alias("s"), e.alias("e")))


def paragraph_bounds(text: Column) -> Column:
    """C4: ``[s, e)`` of every non-empty paragraph, in order."""
    none = F.array().cast(BOUND_TYPE)
    return _let(_piece_lengths(text), lambda pieces: _folded(
        pieces, F.lit(0).cast("bigint"),
        lambda cur, x: cur + x["lp"] + x["lq"],
        lambda cur, x: F.when(x["lp"] > 0, _bound(cur, cur + x["lp"])).otherwise(none))["rows"])


def packed_paragraphs(text: Column, n: int) -> Column:
    """Greedy packing of paragraphs into buffers.

    A buffer grows while ``paragraph_end - buffer_start <= n`` (the
    separators inside count); otherwise it is flushed and a new one
    starts at that paragraph. Returns the buffer spans (before C2).
    """
    none = F.array().cast(BOUND_TYPE)
    # Place in the text; start and end of the buffer (-1: none yet).
    zero = F.struct(F.lit(0).cast("bigint").alias("cur"), F.lit(-1).cast("bigint").alias("bs"),
                    F.lit(-1).cast("bigint").alias("be"))

    def flushes(state: Column, x: Column) -> Column:
        return (x["lp"] > 0) & (state["bs"] >= 0) & (state["cur"] + x["lp"] - state["bs"] > n)

    def step(state: Column, x: Column) -> Column:
        end = state["cur"] + x["lp"]
        starts = (x["lp"] > 0) & ((state["bs"] < 0) | flushes(state, x))
        return F.struct((end + x["lq"]).alias("cur"),
                        F.when(starts, state["cur"]).otherwise(state["bs"]).alias("bs"),
                        F.when(x["lp"] > 0, end).otherwise(state["be"]).alias("be"))

    def flushed(state: Column, x: Column) -> Column:
        return F.when(flushes(state, x), _bound(state["bs"], state["be"])).otherwise(none)

    def finish(done: Column) -> Column:
        last = done["state"]
        return F.when(last["bs"] >= 0, F.concat(done["rows"], _bound(last["bs"], last["be"]))).otherwise(done["rows"])

    return _let(_piece_lengths(text), lambda pieces: _let(_folded(pieces, zero, step, flushed), finish))


def _flag(bounds: Column, keep: bool) -> Column:
    return F.transform(bounds, lambda b: F.struct(
        b["s"].alias("s"), b["e"].alias("e"), F.lit(keep).alias("keep")))


def code_spans(text: Column, ends: Column) -> Column:
    """C6 spans from statement ends: ``[prev_end, end)`` per statement and
    the tail ``[last_end, len)``; no ends -> the whole file, blanks kept."""
    length = F.length(text).cast("bigint")
    starts = F.concat(F.array(F.lit(0).cast("bigint")), ends)
    stops = F.concat(ends, F.array(length))
    spans = F.zip_with(starts, stops, lambda a, b: F.struct(
        a.alias("s"), b.alias("e"), F.lit(False).alias("keep")))
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("s"), length.alias("e"),
                             F.lit(True).alias("keep")))
    return F.when(ends.isNull(), whole).otherwise(spans)


def text_spans(text: Column, n: int) -> Column:
    return _flag(packed_paragraphs(text, n), False)


# --------------------------------------------------------------------------
# DataFrame operators
# --------------------------------------------------------------------------

def _explode_windows(df: DataFrame, windows: Column, keep: list[str]) -> DataFrame:
    """Explode windows with their texts into chunk rows."""
    return df.select(*keep, F.explode(windows).alias("w")).select(
        *keep,
        F.col("w.s").alias("first_character_index"),
        F.col("w.e").alias("last_character_index"),
        F.col("w.text").alias("text"),
    )


def split_fixed(documents: DataFrame, n: int) -> DataFrame:
    """C1 over whole documents (blank windows kept)."""
    check_chunk_size(n)
    text = F.struct(text_blocks(F.col("text")).alias("blocks"), F.length("text").cast("bigint").alias("length"))
    windows = _let(text, lambda t: window_texts(t["blocks"], F.lit(0).cast("bigint"), t["length"], n))
    return _explode_windows(documents, windows, ["file_path"])


def emit_spans(documents: DataFrame, n: int) -> DataFrame:
    """Documents ``(file_path, text, spans)``, the spans an array of
    (s, e) -> chunks; blank spans dropped, spans of ``n`` or more
    characters cut into windows."""
    check_chunk_size(n)
    spans = F.transform("spans", lambda sp: F.struct(
        sp["s"].cast("bigint").alias("s"), sp["e"].cast("bigint").alias("e"), F.lit(False).alias("keep")))
    return _explode_windows(documents, span_windows(F.col("text"), spans, n), ["file_path"])


def paragraphs(documents: DataFrame) -> DataFrame:
    """C4 as rows ``(file_path, para_pos, first, last)``."""
    return documents.select(
        "file_path", F.posexplode(paragraph_bounds(F.col("text"))).alias("para_pos", "b"))\
        .select("file_path", (F.col("para_pos") + 1).alias("para_pos"),
                F.col("b.s").alias("first_character_index"),
                F.col("b.e").alias("last_character_index"))


def pack_paragraphs(documents: DataFrame, n: int) -> DataFrame:
    """C5 + C2 for prose documents."""
    check_chunk_size(n)
    return _explode_windows(documents, span_windows(F.col("text"), text_spans(F.col("text"), n), n),
                            ["file_path"])


def chunk_code(documents: DataFrame, n: int) -> DataFrame:
    """C6 for Python documents."""
    check_chunk_size(n)
    parsed = documents.withColumn("_ends", statement_ends_udf(F.col("text")))
    spans = code_spans(F.col("text"), F.col("_ends"))
    return _explode_windows(parsed, span_windows(F.col("text"), spans, n), ["file_path"])


def _checked(file_path: str) -> Column:
    """True; an unsupported suffix fails the job."""
    known = F.coalesce(is_text_path(file_path), F.lit(False)) | _is_code(file_path)
    name = F.coalesce(F.nullif(path_suffix(file_path), F.lit("")), F.lit("no suffix"))
    failed = F.raise_error(F.concat(F.lit("cannot chunk a file of this type: "), name)).cast("boolean")
    return F.when(known, F.lit(True)).otherwise(failed)


def _is_code(file_path: str) -> Column:
    return F.coalesce(is_code_path(file_path), F.lit(False))


def chunk_documents(documents: DataFrame, n: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """C7 + C8: route every document by suffix and chunk it.

    Two branches by suffix: prose stays in native expressions, only code
    files pass the Python parser; an unsupported suffix fails the job.
    Output: ``file_path, first_character_index, last_character_index,
    text``; not ordered (use ``order_chunks`` for corpus order).
    """
    code = _is_code("file_path")
    prose = documents.where(~code).where(_checked("file_path"))
    return pack_paragraphs(prose, n).unionByName(chunk_code(documents.where(code), n))


def chunk_in_order(documents: DataFrame, n: int, paths: DataFrame) -> DataFrame:
    """C7 + C8 in one projection, so that chunks follow in the order of
    the documents' rows. ``paths`` is a plan of the same file paths that
    is cheap to read: where none is code, no Python runs."""
    check_chunk_size(n)
    text, code = F.col("text"), _is_code("file_path")
    documents = documents.where(_checked("file_path"))
    if paths.select("file_path").where(code).isEmpty():
        return pack_paragraphs(documents, n)
    ends = documents.withColumn("_ends", statement_ends_udf(F.when(code, text)))
    spans = F.when(code, code_spans(text, F.col("_ends"))).otherwise(text_spans(text, n))
    return _explode_windows(ends, span_windows(text, spans, n), ["file_path"])


def order_chunks(chunks: DataFrame) -> DataFrame:
    """Corpus order: path component-wise, then offset."""
    return chunks.orderBy(corpus_order("file_path"), "first_character_index")
