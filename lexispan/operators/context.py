"""Context assembly and batch answers.

Ranking moves only span locations; text is joined back once, after
top-k (one join instead of a file read per source), the prompt is
built with native array/string functions, and the answer function is
called in one ``mapInPandas`` stage, set up once per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.functions.spans import slice_text
from lexispan.functions.text import is_blank

# Prompt text.
SYSTEM_PROMPT = (
    "You are a helpful assistant answering questions about the vLLM "
    "codebase. Answer only using the provided sources. If the sources "
    "do not contain the answer, say so instead of guessing."
)
NO_SOURCES = "No sources were retrieved."
BLANK_QUESTION_ANSWER = "Error: question must not be empty."

SOURCE_COLUMNS = ["file_path", "first_character_index", "last_character_index"]
# Distinct spans up to this count are broadcast to the document scan.
BROADCAST_SPANS = 1_000_000


def resolve_spans(results: DataFrame, documents: DataFrame) -> DataFrame:
    """G1: add ``source_text`` = ``text[first:last]`` of each located span.

    A missing file or an invalid range gives '' and the row is kept.
    ``documents``: (file_path, text).
    """
    # The distinct spans (counted, then broadcast) go to the documents as
    # these stream past; only slices come back, never whole texts.
    place = SOURCE_COLUMNS
    spans = results.select(*place).where(F.col("file_path").isNotNull()).distinct()
    n_spans = spans.count()
    spans = F.broadcast(spans) if n_spans <= BROADCAST_SPANS else spans
    slices = documents.select("file_path", F.col("text").alias("_doc_text")).join(spans, "file_path").select(
        *place, slice_text(F.col("_doc_text"), F.col("first_character_index"),
                           F.col("last_character_index")).alias("source_text"))
    return results.join(slices, place, "left").select(
        *[results[c] for c in results.columns], F.coalesce("source_text", F.lit("")).alias("source_text"))


def user_message(question: F.Column, sources: F.Column) -> F.Column:
    """The user message from the question and ARRAY<STRUCT<rank, text>>
    (any order; sorted by rank here)."""
    ordered = F.array_sort(sources)
    numbered = F.transform(ordered, lambda s, i: F.concat(
        F.lit("[Source "), (i + 1).cast("string"), F.lit("]\n"), s["text"]))
    with_sources = F.concat(F.lit("Sources:\n"), F.array_join(numbered, "\n\n"),
                            F.lit("\n\nQuestion: "), question)
    without = F.concat(F.lit(NO_SOURCES + "\n\nQuestion: "), question)
    return F.when(F.coalesce(F.size(sources), F.lit(0)) > 0, with_sources).otherwise(without)


def chat_messages(question: F.Column, sources: F.Column,
                  system_prompt: str = SYSTEM_PROMPT) -> F.Column:
    """ARRAY<STRUCT<role, content>> with the system and user messages."""
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content")),
        F.struct(F.lit("user").alias("role"), user_message(question, sources).alias("content")))


def gather_sources(located: DataFrame, text_col: str = "source_text") -> DataFrame:
    """Per question: ``sources`` = ARRAY<STRUCT<rank, text, file_path,
    first, last>> (at most k entries, so the group is bounded)."""
    src = F.struct(F.col("rank").alias("rank"), F.col(text_col).alias("text"),
                   *[F.col(c) for c in SOURCE_COLUMNS])
    return (located.groupBy("question_id")
            .agg(F.collect_list(F.when(F.col("rank").isNotNull(), src)).alias("sources")))


def build_prompts(questions: DataFrame, located: DataFrame) -> DataFrame:
    """G2 for a batch: (question_id, question, sources, messages)."""
    per_q = gather_sources(located)
    joined = questions.select("question_id", "question").join(per_q, "question_id", "left")
    sources = F.coalesce(F.col("sources"), F.array().cast(per_q.schema["sources"].dataType))
    return joined.select("question_id", "question", sources.alias("sources"),
                         chat_messages(F.col("question"), sources).alias("messages"))


AnswerFn = Callable[[list[str], list[list[str]]], list[str]]


def _wants_messages(fn: Callable) -> bool:
    import inspect

    try:
        params = inspect.signature(fn).parameters.values()
    except (TypeError, ValueError):
        return False
    positional = [p for p in params if p.kind in (p.POSITIONAL_ONLY, p.POSITIONAL_OR_KEYWORD)]
    return len(positional) >= 3 or any(p.kind == p.VAR_POSITIONAL for p in params)


def _answer_batches(make_answerer: Callable[[], AnswerFn]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answerer = None  # set up once per task, on first use
        for pdf in batches:
            answers = pd.Series([BLANK_QUESTION_ANSWER] * len(pdf), index=pdf.index, dtype=object)
            todo = ~pdf["blank"].astype(bool)
            if todo.any():
                if answerer is None:
                    answerer = make_answerer()
                    with_messages = _wants_messages(answerer)
                qs = pdf.loc[todo, "question"].tolist()
                texts = [[s["text"] for s in (srcs if srcs is not None else [])]
                         for srcs in pdf.loc[todo, "sources"]]
                if with_messages:
                    msgs = [[{"role": m["role"], "content": m["content"]} for m in ms]
                            for ms in pdf.loc[todo, "messages"]]
                    got = answerer(qs, texts, msgs)
                else:
                    got = answerer(qs, texts)
                if len(got) != len(qs):
                    raise ValueError("answer generation failed: wrong number of answers")
                answers.loc[todo] = list(got)
            out = pdf.drop(columns=["blank", "sources", "messages"])
            out["answer"] = answers
            yield out
    return run


def answer_dataset(prompts: DataFrame, make_answerer: Callable[[], AnswerFn]) -> DataFrame:
    """One answer per question.

    ``prompts`` comes from ``build_prompts``. ``make_answerer()`` is called
    once per task and returns ``f(questions, source_texts) -> answers``
    (a batch call; sources most relevant first), or
    ``f(questions, source_texts, messages)`` to also receive the chat
    messages of G2 (system + user, as role/content dicts). A blank question gets
    the fixed error answer without calling it; any exception raised by
    it fails the job (the whole batch), as in the reference.
    """
    sorted_sources = F.array_sort(F.col("sources"))
    inp = prompts.select("question_id", "question", sorted_sources.alias("sources"), "messages",
                         is_blank(F.coalesce(F.col("question"), F.lit(""))).alias("blank"))
    return inp.mapInPandas(_answer_batches(make_answerer),
                           "question_id string, question string, answer string")


def first_line_answerer() -> AnswerFn:
    """Deterministic extractive stand-in: first line of the best source."""
    def answer(questions: list[str], sources: list[list[str]]) -> list[str]:
        return [(s[0].split("\n", 1)[0] if s else "") for s in sources]
    return answer


def answer_one(question: str, chunk_texts: list[str], make_answerer: Callable[[], AnswerFn]) -> str:
    """G4 helper for one question whose sources are already chunk texts."""
    if not isinstance(question, str) or not question.strip():
        raise ValueError("query must not be empty.")
    return make_answerer()([question], [chunk_texts])[0]
