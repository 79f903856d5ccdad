"""Question sets and search-result files.

The reference format is one JSON document ``{"rag_questions": [...]}``.
It is parsed as VARIANT so JSON types stay visible: a numeric
``question`` is an error (Spark's JSON reader would turn it into a
string), offsets ``"5"`` and ``5.0`` coerce to 5, ``"z"`` does not.
Reading one document is one row, parsed by one task (writing streams it
line by line); for large sets use JSON Lines (one question object per
line), read in parallel and validated by the same expressions.

Validation result per question: ``is_valid`` (else ``reason``), and
``is_answered``: both ``sources`` and ``answer`` validate; otherwise
the question silently degrades to unanswered, as in the reference.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

SOURCE_TYPE = ("array<struct<file_path:string,first_character_index:bigint,"
               "last_character_index:bigint>>")


class InvalidDataset(ValueError):
    """The question set does not validate."""


def _type(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_string(v: Column) -> Column:
    return v.isNotNull() & (_type(v) == F.lit("STRING"))


def _as_int(v: Column) -> Column:
    """Lax integer: integral numbers and numeric strings of integral value."""
    t = _type(v)
    num = F.try_variant_get(v, "$", "double")
    as_str = F.try_variant_get(v, "$", "string")
    from_str = F.when(as_str.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(as_str).cast("bigint"))
    integral = F.when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.try_variant_get(v, "$", "bigint"))\
        .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"),
              F.when(num == F.floor(num), num.cast("bigint")))\
        .when(t == F.lit("STRING"), from_str)
    return integral


def _source_ok(s: Column) -> Column:
    return (_is_string(F.variant_get(s, "$.file_path", "variant"))
            & _as_int(F.variant_get(s, "$.first_character_index", "variant")).isNotNull()
            & _as_int(F.variant_get(s, "$.last_character_index", "variant")).isNotNull())


def validate_items(items: DataFrame, salt: str = "") -> DataFrame:
    """(input_pos, item VARIANT[, problem]) -> the validated question
    table. ``problem`` says why a line could not be read; its item is
    null. ``salt`` sets made-up ids of different sets apart."""
    item = F.col("item")
    problem = F.col("problem") if "problem" in items.columns else F.lit(None).cast("string")
    qv = F.variant_get(item, "$.question", "variant")
    idv = F.variant_get(item, "$.question_id", "variant")
    srcs = F.try_variant_get(item, "$.sources", "array<variant>")
    ans = F.variant_get(item, "$.answer", "variant")
    is_obj = F.coalesce(_type(item).startswith("OBJECT"), F.lit(False))
    id_ok = idv.isNull() | _is_string(idv)
    valid = problem.isNull() & is_obj & _is_string(qv) & id_ok
    reason = (F.when(problem.isNotNull(), problem)
              .when(~is_obj, F.lit("item is not an object"))
              .when(~_is_string(qv), F.lit("question must be a string"))
              .when(~id_ok, F.lit("question_id must be a string")))
    sources_ok = srcs.isNotNull() & F.forall(srcs, _source_ok)
    answered = valid & sources_ok & _is_string(ans)
    # Missing ids: a UUID-shaped id derived from the position and the
    # text, so a recomputed partition gets the same id.
    text = F.coalesce(F.try_variant_get(qv, "$", "string"), F.lit(""))
    h = F.sha2(F.concat_ws(":", F.lit("question"), F.lit(salt), F.col("input_pos").cast("string"), text), 256)
    made_id = F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), h.substr(13, 4), h.substr(17, 4),
                          h.substr(21, 12))
    sources = F.when(answered, F.transform(srcs, lambda s: F.struct(
        F.variant_get(s, "$.file_path", "string").alias("file_path"),
        _as_int(F.variant_get(s, "$.first_character_index", "variant")).alias("first_character_index"),
        _as_int(F.variant_get(s, "$.last_character_index", "variant")).alias("last_character_index"))))
    return items.select(
        "input_pos",
        F.coalesce(F.try_variant_get(idv, "$", "string"), made_id).alias("question_id"),
        F.when(valid, F.variant_get(qv, "$", "string")).alias("question"),
        sources.cast(SOURCE_TYPE).alias("sources"),
        F.when(answered, F.variant_get(ans, "$", "string")).alias("answer"),
        answered.alias("is_answered"), valid.alias("is_valid"), reason.alias("reason"))


def parse_document(doc: DataFrame, top_key: str = "rag_questions") -> DataFrame:
    """One-document JSON text (column ``value``) -> (input_pos, item)."""
    v = F.try_parse_json(F.col("value"))
    arr = F.try_variant_get(v, f"$.{top_key}", "array<variant>")
    checked = doc.select(v.alias("v"), arr.alias("arr")).select(
        F.when(F.col("v").isNull(), F.raise_error(F.lit("invalid RAG dataset: not valid JSON")))
        .when(F.col("arr").isNull(), F.raise_error(F.lit(f"invalid RAG dataset: '{top_key}' list missing")))
        .otherwise(F.col("arr")).cast("array<variant>").alias("arr"))
    return checked.select(F.posexplode("arr").alias("input_pos", "item"))


def _local(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document as one row (column ``value``), decoded strictly:
    a file that is not UTF-8 is an error (the text reader would silently
    put U+FFFD in place of bad bytes)."""
    if _local(path):
        local = path[len("file:"):] if path.startswith("file:") else path
        if not os.path.exists(local):
            raise FileNotFoundError(f"file not found: {path}")
        if os.path.isdir(local) and not os.path.exists(os.path.join(local, "_SUCCESS")):
            # A directory is only accepted when it is a Spark output folder.
            raise IsADirectoryError(f"expected a file, got directory: {path}")
    raw = spark.read.format("binaryFile").load(path).select("content")
    return raw.select(F.when(F.is_valid_utf8(F.col("content").cast("string")),
                             F.decode(F.col("content"), "UTF-8"))
                      .otherwise(F.raise_error(F.lit(f"dataset is not valid UTF-8: {path}")))
                      .alias("value"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """(input_pos, value) -> (input_pos, item, problem): one JSON value a
    line; a line that is no UTF-8 or no JSON keeps its place with the
    reason and a null item."""
    utf8 = F.is_valid_utf8("value")
    item = F.when(utf8, F.try_parse_json("value"))
    return lines.select("input_pos", item.alias("item"), F.when(~utf8, F.lit("not valid UTF-8")).when(
        item.isNull(), F.lit("not valid JSON")).alias("problem"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines files -> (input_pos, item, problem), in the order of
    file path, then line; blank lines are skipped.

    Spark deals out file splits in any order, so lines are numbered
    within their split, and splits by path and offset: the counts before
    a split are its offset (one row per split).
    """
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value")
    sizes = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("file", "block").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(W.partitionBy("file", "block").orderBy("seq")) - 1
    placed = lines.withColumn("nth", nth).join(starts, ["file", "block"])
    return parse_lines(placed.select((F.col("start") + F.col("nth")).alias("input_pos"), "value"))


def load_questions(spark: SparkSession, path: str, strict: bool = True,
                   json_lines: bool = False) -> DataFrame:
    """S5 + S6: read and validate a question set.

    ``strict``: an invalid question fails the load (``InvalidDataset``);
    otherwise invalid rows stay with ``is_valid = false`` and a reason.
    """
    items = read_lines(spark, path) if json_lines else parse_document(read_document(spark, path))
    table = validate_items(items, path)
    if strict:
        bad = table.where(~F.col("is_valid")).select("input_pos", "reason").limit(1).collect()
        if bad:
            raise InvalidDataset(f"invalid RAG dataset: question {bad[0]['input_pos']}: {bad[0]['reason']}")
    return table


def question_count(questions: DataFrame) -> DataFrame:
    """Number of questions."""
    return questions.agg(F.count(F.lit(1)).alias("n_questions"))


def gold_from_questions(questions: DataFrame) -> DataFrame:
    """Answered questions -> gold spans (question_id, gold_pos, file_path, first, last),
    duplicate ids resolved last-wins (E5)."""
    from lexispan.operators.evaluate import last_wins

    # Only answered questions enter the gold map, then the last one of
    # an id wins (an unanswered duplicate does not replace it).
    answered = last_wins(questions.where(F.col("is_valid") & F.col("is_answered")))
    return answered.select("question_id", F.posexplode("sources").alias("gold_pos", "s")).select(
        "question_id", (F.col("gold_pos") + 1).alias("gold_pos"), "s.file_path",
        "s.first_character_index", "s.last_character_index")


def _item_json() -> "Column":
    return F.when(F.col("is_answered"), F.to_json(F.struct(
        "question_id", "question", "sources", "answer"))).otherwise(
        F.to_json(F.struct("question_id", "question")))


def dataset_lines(questions: DataFrame) -> DataFrame:
    """The question table -> lines of one JSON document
    ``{"rag_questions": [...]}``, items in input order, streamed one per
    line (see ``sinks.document_lines``)."""
    from lexispan.sources.sinks import document_lines

    items = questions.where("is_valid").select(F.col("input_pos").alias("key"), _item_json().alias("j"))
    return document_lines(items, '{"rag_questions": [', "]}")


def save_questions(questions: DataFrame, path: str, json_lines: bool = False) -> None:
    """Write a validated question set."""
    if json_lines:
        questions.where("is_valid").orderBy("input_pos").select(_item_json().alias("value"))\
            .write.mode("overwrite").text(path)
    else:
        from lexispan.sources.sinks import write_document

        write_document(dataset_lines(questions), path)


def copy_questions(spark: SparkSession, src: str, dst: str, json_lines: bool = False) -> DataFrame:
    """Load, validate, save; returns the loaded table."""
    q = load_questions(spark, src, json_lines=json_lines)
    save_questions(q, dst, json_lines)
    return q


def load_results(spark: SparkSession, path: str, json_lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """A search-results document -> (flat results, header).

    Flat: (input_pos, question_id, question, rank, file_path, first,
    last[, answer]); header: one row with ``k``. A missing or non-list
    ``search_results`` or ``k``, and an invalid item or offset, raise
    ``InvalidDataset``. ``json_lines``: one result per line, each with
    its ``k``, as ``write_results`` writes them.
    """
    if json_lines:
        lines = read_lines(spark, path)
        res = lines.select("input_pos", "item")
        header = lines.select(_as_int(F.variant_get("item", "$.k", "variant")).alias("k"))
        header = header.agg(F.min("k").alias("k"), F.max("k").alias("most"), F.count_if(F.col("k").isNull()).alias("none"))
        hdr = header.first()
        if hdr["none"] or hdr["k"] != hdr["most"]:
            raise InvalidDataset("invalid search results: lines differ in k or have none")
        header = header.select("k")
    else:
        doc = read_document(spark, path).select(F.try_parse_json("value").alias("v"))
        header = doc.select(_as_int(F.variant_get("v", "$.k", "variant")).alias("k"))
        items = F.try_variant_get("v", "$.search_results", "array<variant>")
        hdr = doc.select(F.col("v").isNotNull().alias("json"), items.isNotNull().alias("list"),
                         _as_int(F.variant_get("v", "$.k", "variant")).alias("k")).first()
        if hdr is None or not hdr["json"]:
            raise InvalidDataset("invalid search results: not valid JSON")
        if not hdr["list"]:
            raise InvalidDataset("invalid search results: 'search_results' must be a list")
        if hdr["k"] is None:
            raise InvalidDataset("invalid search results: 'k' must be an integer")
        res = doc.select(F.posexplode(items).alias("input_pos", "item"))
    item = F.col("item")
    srcs = F.try_variant_get(item, "$.retrieved_sources", "array<variant>")
    ok = (_is_string(F.variant_get(item, "$.question_id", "variant"))
          & _is_string(F.variant_get(item, "$.question", "variant"))
          & srcs.isNotNull() & F.forall(srcs, _source_ok))
    checked = res.select("input_pos", item.alias("item"), srcs.alias("srcs"), F.coalesce(ok, F.lit(False)).alias("ok"))
    bad = checked.where(~F.col("ok")).limit(1).collect()
    if bad:
        raise InvalidDataset(f"invalid search results: item {bad[0]['input_pos']}")
    flat = checked.select(
        "input_pos",
        F.variant_get(item, "$.question_id", "string").alias("question_id"),
        F.variant_get(item, "$.question", "string").alias("question"),
        F.try_variant_get(item, "$.answer", "string").alias("answer"),
        F.posexplode_outer("srcs").alias("pos", "s"))
    flat = flat.select(
        "input_pos", "question_id", "question", "answer",
        F.when(F.col("s").isNotNull(), F.col("pos") + 1).alias("rank"),
        F.variant_get(F.col("s"), "$.file_path", "string").alias("file_path"),
        _as_int(F.variant_get(F.col("s"), "$.first_character_index", "variant")).alias("first_character_index"),
        _as_int(F.variant_get(F.col("s"), "$.last_character_index", "variant")).alias("last_character_index"))
    return flat, header
