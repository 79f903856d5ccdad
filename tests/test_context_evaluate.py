import pytest

from lexispan.operators import context as cx
from lexispan.operators import evaluate as ev


def test_invalid_spans_resolve_to_empty(spark):
    documents = spark.createDataFrame([("a.md", "hello world")], "file_path string, text string")
    spans = spark.createDataFrame(
        [("ok", "a.md", 0, 5), ("neg", "a.md", -1, 3), ("rev", "a.md", 4, 3),
         ("long", "a.md", 0, 99), ("nofile", "b.md", 0, 1)],
        "question_id string, file_path string, first_character_index bigint, last_character_index bigint")
    got = {r.question_id: r.source_text for r in cx.resolve_spans(spans, documents).collect()}
    assert got == {"ok": "hello", "neg": "", "rev": "", "long": "", "nofile": ""}


def test_prompt_forms(spark):
    q = spark.createDataFrame([("q1", "Why?"), ("q2", "How?")], "question_id string, question string")
    located = spark.createDataFrame(
        [("q1", 2, "second", "a.md", 0, 1), ("q1", 1, "first", "a.md", 1, 2)],
        "question_id string, rank int, source_text string, file_path string, "
        "first_character_index bigint, last_character_index bigint")
    got = {r.question_id: r.messages for r in cx.build_prompts(q, located).collect()}
    assert got["q1"][1]["content"] == "Sources:\n[Source 1]\nfirst\n\n[Source 2]\nsecond\n\nQuestion: Why?"
    assert got["q2"][1]["content"] == "No sources were retrieved.\n\nQuestion: How?"
    assert got["q1"][0]["role"] == "system"


def test_blank_question_gets_error_answer_and_errors_abort(spark):
    q = spark.createDataFrame([("q1", "Why?"), ("q2", "  ")], "question_id string, question string")
    located = spark.createDataFrame([("q1", 1, "line one\nline two", "a.md", 0, 1)],
                                    "question_id string, rank int, source_text string, file_path string, "
                                    "first_character_index bigint, last_character_index bigint")
    prompts = cx.build_prompts(q, located)
    got = {r.question_id: r.answer for r in cx.answer_dataset(prompts, cx.first_line_answerer).collect()}
    assert got == {"q1": "line one", "q2": "Error: question must not be empty."}

    def failing():
        def f(questions, sources):
            raise RuntimeError("model failed")
        return f
    with pytest.raises(Exception, match="model failed"):
        cx.answer_dataset(prompts, failing).collect()


SCHEMA = "question_id string, file_path string, first_character_index bigint, last_character_index bigint"


def results(spark, rows):
    return spark.createDataFrame(rows, "question_id string, rank int, file_path string, "
                                       "first_character_index bigint, last_character_index bigint")


def test_iou_threshold_edges(spark):
    gold = ev.gold_table(spark.createDataFrame([("q", "a.md", 0, 100)], SCHEMA))
    res = results(spark, [("q", 1, "a.md", 95, 100), ("q", 2, "a.md", 96, 100), ("q", 3, "a.md", 100, 110),
                          ("q", 4, "b.md", 0, 100)])
    got = {r.rank: r.is_match for r in ev.span_pairs(gold, res).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_recall_rules(spark):
    gold = ev.gold_table(spark.createDataFrame(
        [("q1", "a.md", 0, 10), ("q1", "a.md", 0, 10), ("q1", "b.md", 0, 10), ("q2", "c.md", 0, 10)], SCHEMA))
    res = results(spark, [("q1", 1, "a.md", 0, 10), ("q1", 4, "b.md", 5, 10)])
    per = {(r.question_id, r.cutoff): r.recall for r in ev.recall_per_question(gold, res).collect()}
    assert per[("q1", 1)] == pytest.approx(2 / 3) and per[("q1", 5)] == 1.0
    assert per[("q2", 10)] == 0.0   # question absent from the results
    mean = {r.cutoff: r.mean_recall for r in ev.recall_at_k(gold, res).collect()}
    assert mean[1] == pytest.approx(1 / 3) and mean[10] == pytest.approx(0.5)
    lines = {r.cutoff: r.line for r in ev.recall_report(ev.recall_at_k(gold, res)).collect()}
    assert lines[10] == "Recall@10: 0.500 (50.0%)"


def test_empty_results_give_zero_at_every_cutoff(spark):
    gold = spark.createDataFrame([], SCHEMA)
    mean = {r.cutoff: r.mean_recall for r in ev.recall_at_k(ev.gold_table(gold), results(spark, [])).collect()}
    assert mean == {1: 0.0, 3: 0.0, 5: 0.0, 10: 0.0}


def test_last_wins(spark):
    df = spark.createDataFrame([("q", "old", 0), ("q", "new", 1), ("r", "only", 2)],
                               "question_id string, question string, input_pos int")
    got = {r.question_id: r.question for r in ev.last_wins(df).collect()}
    assert got == {"q": "new", "r": "only"}


def test_answer_function_can_receive_messages(spark):
    q = spark.createDataFrame([("q1", "Why?")], "question_id string, question string")
    located = spark.createDataFrame([("q1", 1, "src text", "a.md", 0, 1)],
                                    "question_id string, rank int, source_text string, file_path string, "
                                    "first_character_index bigint, last_character_index bigint")

    def with_messages():
        def f(questions, sources, messages):
            return [m[1]["content"] for m in messages]
        return f
    got = cx.answer_dataset(cx.build_prompts(q, located), with_messages).collect()
    assert got[0].answer == "Sources:\n[Source 1]\nsrc text\n\nQuestion: Why?"
