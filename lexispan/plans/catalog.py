"""Registered checks: one Spark query and one DuckDB oracle per operator.

Every query reads the driver tables (or data Spark derives from them)
over their whole extent. Spark side: the library operators. Oracle
side: plain SQL written from the operator's definition (brute force
where that is the clearest statement of the rule, e.g. ranking every
chunk for every question). Integer outputs are BIGINT on both sides,
doubles are rounded (scores to 6 places, idf and IoU to 9).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.functions.text import (
    STOP_WORDS,
    is_code_path,
    is_supported_path,
    is_text_path,
    path_suffix,
    tokenize,
)
from lexispan.operators import chunking as ch
from lexispan.operators import context as cx
from lexispan.operators import evaluate as ev
from lexispan.operators import index as ix
from lexispan.operators import search as se
from lexispan.plans import fixtures as fx
from lexispan.sources import corpus as co
from lexispan.sources import questions as qs

N_SMALL = 400   # chunk size in the checks (forces packing and splits)
K = 10

# --------------------------------------------------------------------------
# Shared Spark pieces
# --------------------------------------------------------------------------


_INDEXES: dict[tuple[str, str], ix.BM25Index] = {}


def _index(spark: SparkSession, sf: str) -> ix.BM25Index:
    """The prose-corpus index at chunk size 400, built once per Spark
    application and data folder and shared by the checks (one cached
    copy instead of one per query)."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf))
    if key not in _INDEXES:
        _INDEXES[key] = ix.build_index(fx.prose_corpus(spark, sf), N_SMALL)
    return _INDEXES[key]


def _search(spark: SparkSession, sf: str, questions: DataFrame, k: int = K) -> DataFrame:
    return se.search(_index(spark, sf), questions, k)


def _bigint(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in cols else F.col(c) for c in df.columns])


# --------------------------------------------------------------------------
# Spark queries
# --------------------------------------------------------------------------

def _mixed_paths(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "documents")
    i = F.col("doc_id").cast("string")
    names = F.array(F.concat(i, F.lit(".md")), F.concat(i, F.lit(".PY")), F.concat(i, F.lit(".txt")),
                    F.concat(i, F.lit(".json")), F.concat(i, F.lit(".rst")), F.concat(i, F.lit(".pyi")),
                    i, F.concat(i, F.lit(".tar.md")), F.lit(".py"), F.concat(F.lit("_"), i, F.lit(".Md")))
    name = F.element_at(names, (F.pmod(F.col("doc_id"), F.lit(10)) + 1).cast("int"))
    return d.select("doc_id", F.concat(F.lit("corpus/"), F.col("source"), F.lit("/"), F.col("lang"),
                                       F.lit("/"), name).alias("file_path"))


def q_supported_files(spark, sf):
    p = _mixed_paths(spark, sf)
    return p.select("doc_id", "file_path", path_suffix("file_path").alias("suffix"),
                    is_supported_path("file_path").alias("is_supported"),
                    is_code_path("file_path").alias("is_code"),
                    is_text_path("file_path").alias("is_text"))


def q_relative_paths(spark, sf):
    p = _mixed_paths(spark, sf)
    absolute = F.concat(F.lit("/srv/project/"), F.col("file_path"))
    return p.select("doc_id", co.relative_path(absolute, "/srv/project").alias("relative_path"))


def q_split_fixed(spark, sf):
    d = fx.spread(fx.table(spark, sf, "documents")).select(
        F.col("doc_id").cast("string").alias("file_path"), "text")
    return ch.split_fixed(d, N_SMALL)


def _paragraph_rows(spark, sf):
    return ch.paragraphs(fx.prose_corpus(spark, sf))


def q_paragraph_bounds(spark, sf):
    return _bigint(_paragraph_rows(spark, sf), "para_pos")


def q_span_emit(spark, sf):
    corpus = fx.prose_corpus(spark, sf)
    bounds = corpus.select("file_path", "text", ch.paragraph_bounds(F.col("text")).alias("spans"))
    # Gaps between consecutive paragraphs are blank spans (the breaks).
    later = F.slice("spans", 2, F.greatest(F.size("spans") - 1, F.lit(0)))
    gaps = F.zip_with(F.slice("spans", 1, F.size(later)), later, lambda a, b: F.struct(
        a["e"].alias("s"), b["s"].alias("e")))
    return ch.emit_spans(bounds.select("file_path", "text", F.concat("spans", gaps).alias("spans")), N_SMALL)


def q_pack_paragraphs(spark, sf):
    return ch.pack_paragraphs(fx.prose_corpus(spark, sf), N_SMALL)


def q_chunk_code(spark, sf):
    return ch.chunk_code(fx.code_corpus(spark, sf), N_SMALL)


def q_chunk_corpus(spark, sf):
    return ch.chunk_documents(fx.mixed_corpus(spark, sf), N_SMALL)


def q_tokenize(spark, sf):
    d = fx.spread(fx.table(spark, sf, "documents"))
    t = d.select("doc_id", F.posexplode(tokenize("text")).alias("pos", "token"))
    return t.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "token")


def q_index_tokens(spark, sf):
    c = ch.chunk_documents(fx.prose_corpus(spark, sf), N_SMALL)
    t = c.select("file_path", "first_character_index", ix.index_tokens().alias("tokens"))
    return t.select("file_path", "first_character_index",
                    F.size("tokens").cast("bigint").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens"))


def q_postings(spark, sf):
    idx = _index(spark, sf)
    # The keys are dealt like the postings, which stay where they are, unsorted.
    keys = idx.chunks.select("chunk_id", "file_path", "first_character_index").hint("shuffle_hash")
    p = idx.postings.join(keys, "chunk_id")
    return _bigint(p.select("token", "file_path", "first_character_index", "tf", "dl"), "tf", "dl")


def q_chunk_lengths(spark, sf):
    c = _index(spark, sf).chunks
    return _bigint(c.select("file_path", "first_character_index", "last_character_index", "dl"), "dl")


def q_corpus_stats(spark, sf):
    s = _index(spark, sf).stats
    return s.select(F.col("n_chunks").cast("bigint").alias("n_chunks"),
                    F.round("avgdl", 9).alias("avgdl"))


def q_document_frequency(spark, sf):
    return _bigint(_index(spark, sf).terms.select("token", "df"), "df")


def q_idf_floor(spark, sf):
    t = _index(spark, sf).terms
    return t.select("token", F.col("df").cast("bigint").alias("df"), F.round("idf", 9).alias("idf"))


def q_build_index(spark, sf):
    idx = _index(spark, sf)
    st = idx.stats
    return idx.terms.select(
        "token", F.col("df").cast("bigint").alias("df"), F.round("idf", 9).alias("idf"),
        st.select(F.col("n_chunks").cast("bigint")).scalar().alias("n_chunks"),
        st.select(F.round("avgdl", 9)).scalar().alias("avgdl"),
        st.select(F.round("average_idf", 9)).scalar().alias("average_idf"))


def q_bm25_scores(spark, sf):
    idx = _index(spark, sf)
    s = se.with_spans(idx, se.bm25_scores(idx, fx.benchmark_questions(spark, sf)))
    return s.select("question_id", "file_path", "first_character_index",
                    F.round("score", 6).alias("score"))


def _topk_out(df: DataFrame) -> DataFrame:
    return _bigint(df.select("question_id", "rank", "file_path", "first_character_index",
                             "last_character_index", "score"), "rank")


def _topk_questions(spark, sf):
    return fx.benchmark_questions(spark, sf).unionByName(fx.conversation_questions(spark, sf))


def q_search_topk(spark, sf):
    return _topk_out(_search(spark, sf, _topk_questions(spark, sf)))


def q_search_zero_fill(spark, sf):
    return _topk_out(_search(spark, sf, fx.doc_id_questions(spark, sf)))


def _dataset_questions(spark, sf):
    b = fx.benchmark_questions(spark, sf)
    punct = b.select(F.concat(F.lit("p"), F.col("question_id")).alias("question_id"),
                     F.regexp_replace("question", "[A-Za-z0-9_]", "").alias("question"))
    return b.unionByName(punct)


def q_search_dataset(spark, sf):
    r = se.search_dataset(_index(spark, sf), _dataset_questions(spark, sf), K)
    return _bigint(r, "rank")


def _gold(spark, sf):
    return ev.gold_table(fx.gold_spans(spark, sf))


def _span_variants(spark, sf):
    g = _gold(spark, sf)
    v = F.explode(F.array(*[F.lit(x) for x in ("ok", "neg", "rev", "long", "nofile")])).alias("variant")
    g = g.select("question_id", "gold_pos", "file_path", "first_character_index", "last_character_index", v)
    first, last, path = F.col("first_character_index"), F.col("last_character_index"), F.col("file_path")
    return g.select(
        "question_id", "gold_pos", "variant",
        F.when(F.col("variant") == "nofile", F.concat(path, F.lit(".missing"))).otherwise(path).alias("file_path"),
        F.when(F.col("variant") == "neg", first - 100000).otherwise(first).alias("first_character_index"),
        F.when(F.col("variant") == "rev", first - 1).when(F.col("variant") == "long", last + 1000000)
        .otherwise(last).alias("last_character_index"))


def q_resolve_spans(spark, sf):
    r = cx.resolve_spans(_span_variants(spark, sf), fx.prose_corpus(spark, sf))
    return _bigint(r.select("question_id", "gold_pos", "variant", "file_path", "first_character_index",
                            "last_character_index", "source_text"), "gold_pos")


def q_build_prompt(spark, sf):
    g = cx.resolve_spans(_gold(spark, sf).withColumn("rank", F.col("gold_pos")),
                         fx.prose_corpus(spark, sf))
    p = cx.build_prompts(fx.benchmark_questions(spark, sf), g)
    return p.select("question_id", F.col("messages")[1]["content"].alias("user_content"))


def q_answer_dataset(spark, sf):
    b = fx.benchmark_questions(spark, sf)
    blank = b.select(F.concat(F.lit("w"), F.col("question_id")).alias("question_id"),
                     F.regexp_replace("question", r"\S", " ").alias("question"))
    questions = b.unionByName(blank)
    res = se.search(_index(spark, sf), questions, 3)
    located = cx.resolve_spans(res, fx.prose_corpus(spark, sf))
    prompts = cx.build_prompts(questions, located)
    return cx.answer_dataset(prompts, cx.first_line_answerer)


def _results(spark, sf):
    return _search(spark, sf, fx.benchmark_questions(spark, sf))


def q_interval_iou(spark, sf):
    p = ev.span_pairs(_gold(spark, sf), _results(spark, sf))
    return _bigint(p.select("question_id", "gold_pos", "rank", F.round("iou", 9).alias("iou")),
                   "gold_pos", "rank")


def q_span_match(spark, sf):
    p = ev.span_pairs(_gold(spark, sf), _results(spark, sf))
    return _bigint(p.select("question_id", "gold_pos", "rank", "is_match"), "gold_pos", "rank")


def q_recall_per_question(spark, sf):
    r = ev.recall_per_question(_gold(spark, sf), _results(spark, sf))
    return _bigint(r.select("question_id", "cutoff", F.round("recall", 9).alias("recall")), "cutoff")


def q_recall_at_k(spark, sf):
    r = ev.recall_at_k(_gold(spark, sf), _results(spark, sf))
    return _bigint(r.select("cutoff", F.round("mean_recall", 9).alias("mean_recall")), "cutoff")


def q_recall_report(spark, sf):
    r = ev.recall_report(ev.recall_at_k(_gold(spark, sf), _results(spark, sf)))
    return _bigint(r, "cutoff")


def q_last_wins(spark, sf):
    c = fx.table(spark, sf, "conversations")
    rows = c.select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("question_id"),
                    F.col("text").alias("question"), F.col("turn").alias("input_pos"))
    return ev.last_wins(rows).select("question_id", "question")


def _scratch(spark: SparkSession, name: str) -> str:
    from lexispan.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return tempfile.mkdtemp(prefix=f"{name}-", dir=base) if os.path.isdir(base) else f"{base}/{name}"


def q_question_count(spark, sf):
    """S5 + S7: benchmark questions written as JSON Lines, loaded, validated
    and counted."""
    items = fx.benchmark_questions(spark, sf).withColumn("input_pos", F.monotonically_increasing_id())
    table = items.select("input_pos", "question_id", "question",
                         F.lit(None).cast(qs.SOURCE_TYPE).alias("sources"),
                         F.lit(None).cast("string").alias("answer"),
                         F.lit(False).alias("is_answered"), F.lit(True).alias("is_valid"))
    path = _scratch(spark, "questions") + "/set.jsonl"
    qs.save_questions(table, path, json_lines=True)
    loaded = qs.load_questions(spark, path, json_lines=True)
    return qs.question_count(loaded)


def q_index_roundtrip(spark, sf):
    path = _scratch(spark, "index")
    saved = ix.save_index(ix.build_index(fx.prose_corpus(spark, sf), N_SMALL, materialize=False), path)
    again = ix.load_index(spark, path)
    del saved
    return _topk_out(se.search(again, _topk_questions(spark, sf), K))


def q_corpus_load(spark, sf):
    """S2 on a table corpus: newline normalisation + supported-suffix filter."""
    d = fx.table(spark, sf, "documents")
    paths = _mixed_paths(spark, sf)
    table = d.select("doc_id", "text").join(paths, "doc_id")
    return co.documents_from_table(table)


def q_search_stream(spark, sf):
    """R6 over a stream: benchmark questions land as JSON Lines files,
    Structured Streaming ranks each micro-batch against the saved index."""
    from lexispan.streaming.questions import read_stream_results, search_stream

    work = _scratch(spark, "stream")
    ix.save_index(ix.build_index(fx.prose_corpus(spark, sf), N_SMALL, materialize=False), f"{work}/idx")
    fx.benchmark_questions(spark, sf).repartition(4).write.mode("overwrite").json(f"{work}/in")
    run = search_stream(spark, f"{work}/idx", f"{work}/in", f"{work}/out", K,
                        checkpoint=f"{work}/ckpt", available_now=True)
    run.awaitTermination()
    if run.exception() is not None:
        raise RuntimeError(str(run.exception()))
    out = read_stream_results(spark, f"{work}/out")
    return _bigint(out.select("question_id", "question", "rank", "file_path", "first_character_index",
                              "last_character_index", "score"), "rank")


def _write_files(root: str):
    """mapInArrow function: write each (file_path, text) under ``root``."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path, text in zip(batch.column("file_path"), batch.column("text"), strict=True):
                full = os.path.join(root, path.as_py())
                os.makedirs(os.path.dirname(full), exist_ok=True)
                with open(full, "wb") as fh:
                    fh.write(text.as_buffer())
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})
    return run


def q_corpus_files(spark, sf):
    """S1 + S2 on files: the prose corpus is written out as a file tree by
    Spark tasks, then listed, read and strictly decoded back."""
    root = _scratch(spark, "files")
    written = fx.prose_corpus(spark, sf).mapInArrow(_write_files(root), "n long")
    written.agg(F.sum("n")).first()
    return co.load_documents(spark, os.path.join(root, "corpus"), project_root=root)


def q_results_roundtrip(spark, sf):
    """S10 + S9: ranked results nested per question, written as JSON Lines,
    loaded back (validated) and flattened."""
    from lexispan.sources import sinks as sk

    idx = _index(spark, sf)
    questions = fx.benchmark_questions(spark, sf).withColumn("input_pos", F.monotonically_increasing_id())
    flat = se.search_dataset(idx, questions.select("question_id", "question"), K)
    flat = flat.join(questions.select("question_id", "input_pos"), "question_id")
    path = sk.write_results(sk.nest_results(flat), _scratch(spark, "results"), "benchmark.jsonl", K, json_lines=True)
    back, _ = qs.load_results(spark, path, json_lines=True)
    return _bigint(back.where(F.col("rank").isNotNull()).select(
        "question_id", "rank", "file_path", "first_character_index", "last_character_index"), "rank")


def q_question_validation(spark, sf):
    """JSON Lines made of the benchmark passages, three of four broken."""
    b = fx.table(spark, sf, "benchmark")
    kind = F.pmod("item_id", F.lit(4))
    value = (F.when(kind == 0, F.to_json(F.struct(F.col("text").alias("question"))))
             .when(kind == 1, F.concat(F.lit('{"question": '), F.col("item_id").cast("string"), F.lit("}")))
             .when(kind == 2, F.concat(F.lit("not json "), F.col("text"))).otherwise(F.lit("[1]")))
    table = qs.validate_items(qs.parse_lines(b.select(F.col("item_id").alias("input_pos"), value.alias("value"))))
    return table.select("input_pos", "question", "is_valid", "reason")


def q_repeated_ids(spark, sf):
    """A set in which three ids repeat; every position has its result."""
    b = fx.table(spark, sf, "benchmark")
    questions = b.select(F.col("item_id").alias("input_pos"), F.concat(
        F.lit("r"), F.pmod("item_id", F.lit(3)).cast("string")).alias("question_id"), F.col("text").alias("question"))
    return _bigint(se.search_dataset(_index(spark, sf), questions, K), "rank")


def _first_question(spark, sf):
    """The passage a single query takes: its feature is one question."""
    return fx.table(spark, sf, "benchmark").orderBy("item_id").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("question_id"), "text").first()


def q_search_query(spark, sf):
    q = _first_question(spark, sf)
    return _topk_out(se.search_one(_index(spark, sf), q["text"], K, q["question_id"]))


def q_answer_query(spark, sf):
    """One query searched and answered from its chunks' texts."""
    q = _first_question(spark, sf)
    idx = _index(spark, sf)
    res = se.search_one(idx, q["text"], 3, q["question_id"])
    # Three rows at most: the chunks' texts stream past them.
    texts = F.broadcast(res).join(idx.chunks.select("file_path", "first_character_index", "text"),
                                  ["file_path", "first_character_index"])
    answer = cx.answer_one(q["text"], [r["text"] for r in texts.orderBy("rank").select("text").collect()],
                           cx.first_line_answerer)
    return res.where(F.col("rank") == 1).select("question_id", F.lit(answer).alias("answer"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "corpus_files": q_corpus_files,
    "results_roundtrip": q_results_roundtrip,
    "corpus_load": q_corpus_load,
    "search_stream": q_search_stream,
    "supported_files": q_supported_files,
    "relative_paths": q_relative_paths,
    "split_fixed": q_split_fixed,
    "span_emit": q_span_emit,
    "paragraph_bounds": q_paragraph_bounds,
    "pack_paragraphs": q_pack_paragraphs,
    "chunk_code": q_chunk_code,
    "chunk_corpus": q_chunk_corpus,
    "tokenize": q_tokenize,
    "index_tokens": q_index_tokens,
    "postings": q_postings,
    "chunk_lengths": q_chunk_lengths,
    "corpus_stats": q_corpus_stats,
    "document_frequency": q_document_frequency,
    "idf_floor": q_idf_floor,
    "build_index": q_build_index,
    "bm25_scores": q_bm25_scores,
    "search_topk": q_search_topk,
    "search_zero_fill": q_search_zero_fill,
    "search_dataset": q_search_dataset,
    "resolve_spans": q_resolve_spans,
    "build_prompt": q_build_prompt,
    "answer_dataset": q_answer_dataset,
    "interval_iou": q_interval_iou,
    "span_match": q_span_match,
    "recall_per_question": q_recall_per_question,
    "recall_at_k": q_recall_at_k,
    "recall_report": q_recall_report,
    "last_wins": q_last_wins,
    "question_validation": q_question_validation,
    "repeated_ids": q_repeated_ids,
    "search_query": q_search_query,
    "answer_query": q_answer_query,
    "question_count": q_question_count,
    "index_roundtrip": q_index_roundtrip,
}


# --------------------------------------------------------------------------
# DuckDB oracle SQL
# --------------------------------------------------------------------------

STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
BLANK_RE = r"'[\t-\r\x1c-\x1f\x85\p{Z}]*'"
NL = "chr(10)"


def _tok(x: str) -> str:
    return (f"list_filter(regexp_extract_all(lower({x}), '[A-Za-z0-9_]+'), "
            f"lambda t: NOT list_contains({STOP_SQL}, t))")


F1 = f"""f1 AS (
  SELECT 'corpus/' || source || '/' || CAST(doc_id AS VARCHAR) || '.md' AS file_path,
         replace(text, {NL}, {NL} || {NL}) AS text
  FROM documents)"""

F3 = f"""f3s AS (
  SELECT 'corpus/code/' || lower(replace(p_brand, '#', '')) || '/block'
           || CAST(p_partkey // 100 AS VARCHAR) || '.py' AS file_path,
         p_partkey,
         '# ' || p_type || {NL} || 'def f_' || CAST(p_partkey AS VARCHAR) || '(x):' || {NL}
           || '    return ' || CAST(p_size AS VARCHAR) || {NL} || {NL} AS snippet
  FROM part),
f3 AS (SELECT file_path, string_agg(snippet, '' ORDER BY p_partkey) AS text FROM f3s GROUP BY file_path)"""

PARAS = r"""pl AS (
  SELECT file_path, text, string_split_regex(text, '\n{2,}') AS pcs,
         regexp_extract_all(text, '\n{2,}') AS seps
  FROM f1),
pieces AS (
  SELECT file_path, u.piece, u.i, coalesce(length(seps[u.i]), 0) AS seplen
  FROM pl, unnest(pcs) WITH ORDINALITY AS u(piece, i)),
pbounds AS (
  SELECT file_path, i, length(piece) AS lp,
         coalesce(sum(length(piece) + seplen) OVER (
           PARTITION BY file_path ORDER BY i
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
  FROM pieces),
paras AS (
  SELECT file_path, row_number() OVER (PARTITION BY file_path ORDER BY i) AS para_pos,
         CAST(s AS BIGINT) AS s, CAST(s + lp AS BIGINT) AS e
  FROM pbounds WHERE lp > 0)"""


def _pack_sql(n: int) -> str:
    """Greedy packing as a recursive walk over each file's paragraphs."""
    return f"""walk(file_path, para_pos, bs, be, fs, fe) AS (
  SELECT file_path, para_pos, s, e, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM paras WHERE para_pos = 1
  UNION ALL
  SELECT p.file_path, p.para_pos,
         CASE WHEN p.e - w.bs <= {n} THEN w.bs ELSE p.s END,
         p.e,
         CASE WHEN p.e - w.bs <= {n} THEN NULL ELSE w.bs END,
         CASE WHEN p.e - w.bs <= {n} THEN NULL ELSE w.be END
  FROM walk w JOIN paras p ON p.file_path = w.file_path AND p.para_pos = w.para_pos + 1),
lastpara AS (SELECT file_path, max(para_pos) AS m FROM paras GROUP BY file_path),
bufs AS (
  SELECT file_path, fs AS s, fe AS e FROM walk WHERE fs IS NOT NULL
  UNION ALL
  SELECT w.file_path, w.bs, w.be FROM walk w JOIN lastpara l
    ON l.file_path = w.file_path AND w.para_pos = l.m)"""


def _windows_sql(spans: str, corpus: str, n: int, keep_blank: bool = False) -> str:
    """C2/C1 over a spans relation (file_path, s, e) -> chunk rows."""
    blank = "" if keep_blank else \
        f"WHERE NOT regexp_full_match(substring(c.text, sp.s + 1, sp.e - sp.s), {BLANK_RE})"
    return f"""(SELECT sp.file_path, CAST(g.w AS BIGINT) AS first_character_index,
          CAST(least(g.w + {n}, sp.e) AS BIGINT) AS last_character_index,
          substring(c.text, g.w + 1, least(g.w + {n}, sp.e) - g.w) AS text
   FROM (SELECT sp.* FROM {spans} sp JOIN {corpus} c USING (file_path) {blank}) sp
   JOIN {corpus} c USING (file_path),
   unnest(generate_series(sp.s, sp.e - 1, {n})) AS g(w))"""


CODE_SPANS = """cends AS (
  SELECT file_path, p_partkey,
         CAST(sum(length(snippet)) OVER (PARTITION BY file_path ORDER BY p_partkey
              ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS e
  FROM f3s),
cspans AS (
  SELECT file_path, coalesce(lag(e) OVER (PARTITION BY file_path ORDER BY p_partkey), 0) AS s, e
  FROM cends
  UNION ALL
  SELECT f.file_path, max(c.e), max(length(f.text)) FROM cends c JOIN f3 f USING (file_path)
  GROUP BY f.file_path)"""


def _chunks_cte(n: int = N_SMALL, with_code: bool = False) -> str:
    parts = [F1, PARAS, _pack_sql(n),
             f"prose_chunks AS {_windows_sql('bufs', 'f1', n)}"]
    if with_code:
        parts += [F3, CODE_SPANS, f"code_chunks AS {_windows_sql('cspans', 'f3', n)}",
                  "chunks AS (SELECT * FROM prose_chunks UNION ALL SELECT * FROM code_chunks)"]
    else:
        parts.append("chunks AS (SELECT * FROM prose_chunks)")
    return "WITH RECURSIVE " + ",\n".join(parts)


def _index_cte(n: int = N_SMALL) -> str:
    return _chunks_cte(n) + f""",
ctok AS (
  SELECT file_path, first_character_index, last_character_index,
         list_concat({_tok('file_path')}, {_tok('text')}) AS tokens
  FROM chunks),
clen AS (SELECT file_path, first_character_index, last_character_index,
         CAST(len(tokens) AS BIGINT) AS dl FROM ctok),
postings AS (
  SELECT u.token, c.file_path, c.first_character_index, c.last_character_index,
         CAST(count(*) AS BIGINT) AS tf, CAST(len(c.tokens) AS BIGINT) AS dl
  FROM ctok c, unnest(c.tokens) AS u(token)
  GROUP BY ALL),
stats AS (SELECT CAST(count(*) AS BIGINT) AS n_chunks, avg(CAST(dl AS DOUBLE)) AS avgdl FROM clen),
dfreq AS (SELECT token, CAST(count(*) AS BIGINT) AS df FROM postings GROUP BY token),
rawidf AS (
  SELECT token, df, ln(CAST(n_chunks AS DOUBLE) - CAST(df AS DOUBLE) + 0.5::DOUBLE)
                  - ln(CAST(df AS DOUBLE) + 0.5::DOUBLE) AS idf_raw
  FROM dfreq, stats),
avgidf AS (SELECT avg(idf_raw) AS average_idf FROM rawidf),
terms AS (
  SELECT token, df, CASE WHEN idf_raw < 0 THEN 0.25::DOUBLE * average_idf ELSE idf_raw END AS idf
  FROM rawidf, avgidf)"""


Q_BENCH = "SELECT 'b' || CAST(item_id AS VARCHAR) AS question_id, text AS question FROM benchmark"
Q_FIRST = f"{Q_BENCH} ORDER BY item_id LIMIT 1"
Q_CONV = ("SELECT 'c' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS question_id, "
          "text AS question FROM conversations WHERE role = 'user'")
Q_DOCID = "SELECT 'd' || CAST(doc_id AS VARCHAR) AS question_id, CAST(doc_id AS VARCHAR) AS question FROM documents"


def _scores_cte(questions: str) -> str:
    return f""",
qs AS ({questions}),
qt AS (
  SELECT question_id, u.token, CAST(count(*) AS BIGINT) AS qtf
  FROM qs, unnest({_tok('question')}) AS u(token) GROUP BY ALL),
sc AS (
  SELECT qt.question_id, p.file_path, p.first_character_index, p.last_character_index,
         sum(CAST(qt.qtf AS DOUBLE) * ((t.idf * (CAST(p.tf AS DOUBLE) * 2.0::DOUBLE))
             / (CAST(p.tf AS DOUBLE) + 1.0::DOUBLE * (0.6::DOUBLE
                + (0.4::DOUBLE * CAST(p.dl AS DOUBLE)) / s.avgdl)))) AS score
  FROM qt JOIN terms t USING (token) JOIN postings p USING (token) CROSS JOIN stats s
  GROUP BY ALL)"""


def _topk_cte(questions: str, k: int = K) -> str:
    """Reference ranking, brute force: every chunk is scored for every
    question that has a known token (0 when nothing matches), then a
    stable sort by score with corpus order as the tie-break."""
    return _index_cte() + _scores_cte(questions) + f""",
known AS (SELECT DISTINCT question_id FROM sc),
allpairs AS (
  SELECT kq.question_id, c.file_path, c.first_character_index, c.last_character_index,
         coalesce(sc.score, 0.0::DOUBLE) AS score
  FROM known kq CROSS JOIN clen c
  LEFT JOIN sc ON sc.question_id = kq.question_id AND sc.file_path = c.file_path
              AND sc.first_character_index = c.first_character_index),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY round(score, 9) DESC,
            string_split(file_path, '/'), first_character_index) AS rank
  FROM allpairs),
topk AS (SELECT question_id, CAST(rank AS BIGINT) AS rank, file_path, first_character_index,
                last_character_index, round(score, 6) AS score
         FROM ranked WHERE rank <= {k})"""


MIXED_PATHS = """mp AS (
  SELECT doc_id, 'corpus/' || source || '/' || lang || '/' ||
    ([CAST(doc_id AS VARCHAR) || '.md', CAST(doc_id AS VARCHAR) || '.PY',
      CAST(doc_id AS VARCHAR) || '.txt', CAST(doc_id AS VARCHAR) || '.json',
      CAST(doc_id AS VARCHAR) || '.rst', CAST(doc_id AS VARCHAR) || '.pyi',
      CAST(doc_id AS VARCHAR), CAST(doc_id AS VARCHAR) || '.tar.md', '.py',
      '_' || CAST(doc_id AS VARCHAR) || '.Md'])[(doc_id % 10) + 1] AS file_path
  FROM documents)"""

GOLD = f""",
gold0 AS (
  SELECT 'b' || CAST(b.item_id AS VARCHAR) AS question_id, f.file_path,
         CAST(strpos(f.text, replace(b.text, {NL}, {NL} || {NL})) - 1 AS BIGINT) AS first_character_index,
         CAST(strpos(f.text, replace(b.text, {NL}, {NL} || {NL})) - 1
              + length(replace(b.text, {NL}, {NL} || {NL})) AS BIGINT) AS last_character_index
  FROM f1 f CROSS JOIN benchmark b
  WHERE length(b.text) > 0 AND strpos(f.text, replace(b.text, {NL}, {NL} || {NL})) > 0),
gold AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY file_path,
         first_character_index, last_character_index) AS BIGINT) AS gold_pos
  FROM gold0)"""

PAIRS = """,
pairs AS (
  SELECT g.question_id, g.gold_pos, r.rank,
         g.first_character_index AS gf, g.last_character_index AS gl,
         r.first_character_index AS rf, r.last_character_index AS rl
  FROM gold g JOIN topk r ON r.question_id = g.question_id AND r.file_path = g.file_path),
ious AS (
  SELECT *, CASE WHEN least(gl, rl) - greatest(gf, rf) <= 0 THEN 0.0::DOUBLE
                 WHEN greatest(gl, rl) - least(gf, rf) > 0
                 THEN CAST(least(gl, rl) - greatest(gf, rf) AS DOUBLE)
                      / CAST(greatest(gl, rl) - least(gf, rf) AS DOUBLE)
                 ELSE 0.0::DOUBLE END AS iou
  FROM pairs),
best AS (
  SELECT g.question_id, g.gold_pos, min(i.rank) AS best_rank
  FROM gold g LEFT JOIN ious i ON i.question_id = g.question_id AND i.gold_pos = g.gold_pos
                               AND i.iou >= 0.05::DOUBLE
  GROUP BY ALL),
cuts AS (SELECT unnest([1, 3, 5, 10]) AS cutoff),
perq AS (
  SELECT b.question_id, CAST(c.cutoff AS BIGINT) AS cutoff,
         avg(CASE WHEN b.best_rank <= c.cutoff THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS recall
  FROM best b CROSS JOIN cuts c GROUP BY ALL),
means AS (
  SELECT CAST(c.cutoff AS BIGINT) AS cutoff, coalesce(avg(p.recall), 0.0::DOUBLE) AS mean_recall
  FROM cuts c LEFT JOIN perq p ON p.cutoff = c.cutoff GROUP BY c.cutoff)"""


def _sql_answer_dataset() -> str:
    qset = (f"{Q_BENCH} UNION ALL SELECT 'wb' || CAST(item_id AS VARCHAR), "
            r"regexp_replace(text, '\S', ' ', 'g') FROM benchmark")
    return _topk_cte(qset, 3) + f""",
top1 AS (SELECT question_id, file_path, first_character_index, last_character_index
         FROM topk WHERE rank = 1),
src AS (
  SELECT t.question_id,
         CASE WHEN f.text IS NOT NULL AND t.first_character_index >= 0
                   AND t.last_character_index >= t.first_character_index
                   AND t.last_character_index <= length(f.text)
              THEN substring(f.text, t.first_character_index + 1,
                             t.last_character_index - t.first_character_index)
              ELSE '' END AS text
  FROM top1 t LEFT JOIN f1 f USING (file_path))
SELECT q.question_id, q.question,
       CASE WHEN regexp_full_match(q.question, {BLANK_RE}) THEN 'Error: question must not be empty.'
            WHEN s.question_id IS NULL THEN ''
            ELSE split_part(s.text, {NL}, 1) END AS answer
FROM qs q LEFT JOIN src s USING (question_id)"""


SQL: dict[str, str] = {
    "corpus_files": f"WITH {F1}\nSELECT file_path, text FROM f1",
    "results_roundtrip": _topk_cte(Q_BENCH) + """
SELECT question_id, rank, file_path, first_character_index, last_character_index FROM topk""",
    "corpus_load": "WITH " + MIXED_PATHS + r""",
sfx AS (SELECT doc_id, file_path,
   lower(regexp_extract(string_split(file_path, '/')[-1], '^.+?(\.[^.]+)$', 1)) AS suffix FROM mp)
SELECT s.file_path, regexp_replace(d.text, '\r\n?', chr(10), 'g') AS text
FROM sfx s JOIN documents d USING (doc_id)
WHERE s.suffix IN ('.py', '.pyi', '.md', '.rst', '.txt')""",
    "search_stream": _topk_cte(Q_BENCH) + """
SELECT q.question_id, q.question, t.rank, t.file_path, t.first_character_index,
       t.last_character_index, t.score
FROM qs q LEFT JOIN topk t USING (question_id)""",
    "supported_files": "WITH " + MIXED_PATHS + r""",
sfx AS (SELECT doc_id, file_path,
   lower(regexp_extract(string_split(file_path, '/')[-1], '^.+?(\.[^.]+)$', 1)) AS suffix FROM mp)
SELECT doc_id, file_path, suffix,
       suffix IN ('.py', '.pyi', '.md', '.rst', '.txt') AS is_supported,
       suffix IN ('.py', '.pyi') AS is_code,
       suffix IN ('.md', '.rst', '.txt') AS is_text
FROM sfx""",
    "relative_paths": "WITH " + MIXED_PATHS + """
SELECT doc_id, file_path AS relative_path FROM mp""",
    "split_fixed": f"""WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS file_path, text FROM documents),
sp AS (SELECT file_path, 0 AS s, length(text) AS e FROM d)
SELECT * FROM {_windows_sql('sp', 'd', N_SMALL, keep_blank=True)}""",
    "paragraph_bounds": f"""WITH {F1}, {PARAS}
SELECT file_path, CAST(para_pos AS BIGINT) AS para_pos, s AS first_character_index,
       e AS last_character_index FROM paras""",
    "span_emit": f"""WITH {F1}, {PARAS},
gaps AS (SELECT file_path, e AS s, lead(s) OVER (PARTITION BY file_path ORDER BY para_pos) AS e
         FROM paras),
spans AS (SELECT file_path, s, e FROM paras UNION ALL SELECT file_path, s, e FROM gaps WHERE e IS NOT NULL)
SELECT * FROM {_windows_sql('spans', 'f1', N_SMALL)}""",
    "pack_paragraphs": _chunks_cte() + "\nSELECT * FROM prose_chunks",
    "chunk_code": f"WITH {F3}, {CODE_SPANS}\nSELECT * FROM {_windows_sql('cspans', 'f3', N_SMALL)}",
    "chunk_corpus": _chunks_cte(with_code=True) + "\nSELECT * FROM chunks",
    "tokenize": f"""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS pos,
       tok AS token
FROM documents, unnest(regexp_extract_all(lower(text), '[A-Za-z0-9_]+')) WITH ORDINALITY AS u(tok, i)
WHERE NOT list_contains({STOP_SQL}, tok)""",
    "index_tokens": _index_cte() + """
SELECT file_path, first_character_index, CAST(len(tokens) AS BIGINT) AS n_tokens,
       array_to_string(tokens, ' ') AS tokens FROM ctok""",
    "postings": _index_cte() + "\nSELECT token, file_path, first_character_index, tf, dl FROM postings",
    "chunk_lengths": _index_cte() + "\nSELECT * FROM clen",
    "corpus_stats": _index_cte() + "\nSELECT n_chunks, round(avgdl, 9) AS avgdl FROM stats",
    "document_frequency": _index_cte() + "\nSELECT token, df FROM dfreq",
    "idf_floor": _index_cte() + "\nSELECT token, df, round(idf, 9) AS idf FROM terms",
    "build_index": _index_cte() + """
SELECT t.token, t.df, round(t.idf, 9) AS idf, s.n_chunks, round(s.avgdl, 9) AS avgdl,
       round(a.average_idf, 9) AS average_idf
FROM terms t CROSS JOIN stats s CROSS JOIN avgidf a""",
    "bm25_scores": _index_cte() + _scores_cte(Q_BENCH) + """
SELECT question_id, file_path, first_character_index, round(score, 6) AS score FROM sc""",
    "search_topk": _topk_cte(f"{Q_BENCH} UNION ALL {Q_CONV}") + "\nSELECT * FROM topk",
    "search_zero_fill": _topk_cte(Q_DOCID) + "\nSELECT * FROM topk",
    "search_dataset": _topk_cte(
        f"{Q_BENCH} UNION ALL SELECT 'pb' || CAST(item_id AS VARCHAR), "
        "regexp_replace(text, '[A-Za-z0-9_]', '', 'g') FROM benchmark") + """
SELECT q.question_id, q.question, t.rank, t.file_path, t.first_character_index,
       t.last_character_index, t.score
FROM qs q LEFT JOIN topk t USING (question_id)""",
    "resolve_spans": f"WITH {F1}" + GOLD + f""",
v AS (
  SELECT question_id, gold_pos, u.variant,
         CASE WHEN u.variant = 'nofile' THEN file_path || '.missing' ELSE file_path END AS file_path,
         CASE WHEN u.variant = 'neg' THEN first_character_index - 100000
              ELSE first_character_index END AS first_character_index,
         CASE WHEN u.variant = 'rev' THEN first_character_index - 1
              WHEN u.variant = 'long' THEN last_character_index + 1000000
              ELSE last_character_index END AS last_character_index
  FROM gold, unnest(['ok', 'neg', 'rev', 'long', 'nofile']) AS u(variant))
SELECT v.question_id, v.gold_pos, v.variant, v.file_path, v.first_character_index,
       v.last_character_index,
       CASE WHEN f.text IS NOT NULL AND v.first_character_index >= 0
                 AND v.last_character_index >= v.first_character_index
                 AND v.last_character_index <= length(f.text)
            THEN substring(f.text, v.first_character_index + 1,
                           v.last_character_index - v.first_character_index)
            ELSE '' END AS source_text
FROM v LEFT JOIN f1 f USING (file_path)""",
    "build_prompt": f"WITH {F1}" + GOLD + f""",
st AS (
  SELECT g.question_id, g.gold_pos,
         substring(f.text, g.first_character_index + 1,
                   g.last_character_index - g.first_character_index) AS text
  FROM gold g JOIN f1 f USING (file_path)),
blocks AS (
  SELECT question_id, string_agg('[Source ' || CAST(gold_pos AS VARCHAR) || ']' || {NL} || text,
                                 {NL} || {NL} ORDER BY gold_pos) AS body
  FROM st GROUP BY question_id),
qs AS ({Q_BENCH})
SELECT q.question_id,
       CASE WHEN b.body IS NULL THEN 'No sources were retrieved.' || {NL} || {NL} || 'Question: ' || q.question
            ELSE 'Sources:' || {NL} || b.body || {NL} || {NL} || 'Question: ' || q.question END
         AS user_content
FROM qs q LEFT JOIN blocks b USING (question_id)""",
    "answer_dataset": _sql_answer_dataset(),
    "interval_iou": _topk_cte(Q_BENCH) + GOLD + PAIRS + """
SELECT question_id, gold_pos, rank, round(iou, 9) AS iou FROM ious""",
    "span_match": _topk_cte(Q_BENCH) + GOLD + PAIRS + """
SELECT question_id, gold_pos, rank, iou >= 0.05::DOUBLE AS is_match FROM ious""",
    "recall_per_question": _topk_cte(Q_BENCH) + GOLD + PAIRS + """
SELECT question_id, cutoff, round(recall, 9) AS recall FROM perq""",
    "recall_at_k": _topk_cte(Q_BENCH) + GOLD + PAIRS + """
SELECT cutoff, round(mean_recall, 9) AS mean_recall FROM means""",
    "recall_report": _topk_cte(Q_BENCH) + GOLD + PAIRS + """
SELECT cutoff, printf('Recall@%d: %.3f (%.1f%%)', cutoff, mean_recall, mean_recall * 100) AS line
FROM means""",
    "last_wins": """SELECT 'c' || CAST(conv_id AS VARCHAR) AS question_id, arg_max(text, turn) AS question
FROM conversations GROUP BY conv_id""",
    "question_validation": """
SELECT item_id AS input_pos, CASE WHEN item_id % 4 = 0 THEN text END AS question, item_id % 4 = 0 AS is_valid,
       ['question must be a string', 'not valid JSON', 'item is not an object'][item_id % 4] AS reason
FROM benchmark""",
    "repeated_ids": _topk_cte("SELECT CAST(item_id AS VARCHAR) AS question_id, text AS question FROM benchmark") + """
SELECT b.item_id AS input_pos, 'r' || CAST(b.item_id % 3 AS VARCHAR) AS question_id, b.text AS question,
       t.rank, t.file_path, t.first_character_index, t.last_character_index, t.score
FROM benchmark b LEFT JOIN topk t ON t.question_id = CAST(b.item_id AS VARCHAR)""",
    "search_query": _topk_cte(Q_FIRST) + "\nSELECT * FROM topk",
    "answer_query": _topk_cte(Q_FIRST, 3) + f""",
top1 AS (SELECT question_id, file_path, first_character_index, last_character_index FROM topk WHERE rank = 1)
SELECT t.question_id, split_part(substring(f.text, t.first_character_index + 1,
       t.last_character_index - t.first_character_index), {NL}, 1) AS answer
FROM top1 t JOIN f1 f USING (file_path)""",
    "question_count": "SELECT CAST(count(*) AS BIGINT) AS n_questions FROM benchmark",
    "index_roundtrip": _topk_cte(f"{Q_BENCH} UNION ALL {Q_CONV}") + "\nSELECT * FROM topk",
}
