"""Repeated and missing question ids, JSON Lines sets, result validation,
and rejected stream lines."""

import json

import pytest

from lexispan.operators import context as cx
from lexispan.operators import evaluate as ev
from lexispan.operators import index as ix
from lexispan.plans import jobs
from lexispan.sources import questions as qs
from lexispan.streaming.questions import read_stream_rejects, read_stream_results, search_stream
from tests.conftest import docs

CORPUS = [("c/a.md", "lora adapters load weights"), ("c/b.md", "cache blocks and paging"),
          ("c/c.md", "tensor parallel lora")]


@pytest.fixture(scope="module")
def index_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ids") / "idx")
    ix.save_index(ix.build_index(docs(spark, CORPUS), 100, materialize=False), path)
    return path


def test_each_repeated_id_gets_its_own_result(spark, index_dir, tmp_path):
    items = [{"question_id": "x", "question": "lora weights"}, {"question": "paging cache"},
             {"question_id": "x", "question": "paging cache"}, {"question": "paging cache"}]
    source = tmp_path / "set.json"
    source.write_text(json.dumps({"rag_questions": items}))
    out = jobs.search_dataset(spark, str(source), str(tmp_path / "out"), 1, index_dir)
    results = json.loads(open(out, encoding="utf-8").read())["search_results"]
    assert [r["question"] for r in results] == [i["question"] for i in items]
    assert [r["retrieved_sources"][0]["file_path"] for r in results] == ["c/a.md", "c/b.md", "c/b.md", "c/b.md"]
    assert [r["question_id"] for r in results][::2] == ["x", "x"]
    assert len({r["question_id"] for r in results}) == 3
    answered = jobs.answer_dataset(spark, out, str(tmp_path / "answers"), cx.first_line_answerer,
                                   documents=docs(spark, CORPUS))
    answers = [r["answer"] for r in json.loads(open(answered, encoding="utf-8").read())["search_results"]]
    assert answers == [CORPUS[0][1], CORPUS[1][1], CORPUS[1][1], CORPUS[1][1]]


def test_json_lines_keep_file_and_line_order(spark, index_dir, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    many = [{"question_id": f"q{i}", "question": f"question {i}"} for i in range(3000)]
    (folder / "a.jsonl").write_text(json.dumps({"question_id": "x", "question": "first"}) + "\n\n")
    (folder / "b.jsonl").write_text("".join(json.dumps(m) + "\n" for m in many)
                                    + json.dumps({"question_id": "x", "question": "last"}) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        table = qs.load_questions(spark, str(folder), json_lines=True)
        rows = sorted((r.input_pos, r.question) for r in table.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == list(enumerate(["first", *(m["question"] for m in many), "last"]))
    kept = {r.question_id: r.question for r in ev.last_wins(table).collect()}
    assert kept["x"] == "last" and len(kept) == 3001
    one = tmp_path / "one.jsonl"
    one.write_text(json.dumps({"question_id": "x", "question": "lora weights"}) + "\n"
                   + json.dumps({"question_id": "x", "question": "paging cache"}) + "\n")
    out = jobs.search_dataset(spark, str(one), str(tmp_path / "res"), 1, index_dir, json_lines=True)
    flat, header = qs.load_results(spark, out, json_lines=True)
    assert header.first()["k"] == 1
    assert sorted((r.question, r.file_path) for r in flat.collect()) == [
        ("lora weights", "c/a.md"), ("paging cache", "c/b.md")]


BAD_LINES = [b'{"question": 5}', b'{"question_id": 1, "question": "a"}', b'{"no": 1}', b"not json", b'"text"',
             b'{"question": "\xff"}']


def test_bad_lines_stay_with_a_reason(spark, tmp_path):
    source = tmp_path / "bad.jsonl"
    source.write_bytes(b"\n".join([*BAD_LINES, b'{"question": "good"}']) + b"\n")
    rows = qs.load_questions(spark, str(source), strict=False, json_lines=True).orderBy("input_pos").collect()
    assert [r.is_valid for r in rows] == [False] * len(BAD_LINES) + [True]
    assert all(r.reason for r in rows[:-1]) and rows[5].reason == "not valid UTF-8"
    with pytest.raises(qs.InvalidDataset):
        qs.load_questions(spark, str(source), json_lines=True)


@pytest.mark.parametrize("text", ['{"k": 10}', '{"search_results": 5, "k": 1}', '{"search_results": {}, "k": 1}',
                                  '{"search_results": []}', "[]", "x", '{"search_results": [{}], "k": 1}'])
def test_invalid_results_are_errors(spark, tmp_path, text):
    path = tmp_path / "results.json"
    path.write_text(text)
    with pytest.raises(qs.InvalidDataset):
        qs.load_results(spark, str(path))


def test_stream_rejects_what_batch_rejects(spark, index_dir, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.jsonl").write_bytes(b"\n".join([*BAD_LINES, b'{"question": "lora weights"}',
                                                 b'{"question_id": "x", "question": "paging"}']) + b"\n")
    run = search_stream(spark, index_dir, str(source), str(tmp_path / "out"), k=1,
                        checkpoint=str(tmp_path / "ckpt"), available_now=True)
    run.awaitTermination(300)
    assert run.exception() is None
    found = read_stream_results(spark, str(tmp_path / "out")).collect()
    assert sorted((r.question, r.file_path) for r in found) == [("lora weights", "c/a.md"), ("paging", "c/b.md")]
    assert all(r.question_id for r in found)
    assert read_stream_rejects(spark, str(tmp_path / "out")).count() == len(BAD_LINES)
