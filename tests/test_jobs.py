import json

import pytest

from lexispan.operators import context as cx
from lexispan.plans import jobs


def _read_doc(path):
    return json.loads(open(path, encoding="utf-8").read())


@pytest.fixture()
def project(tmp_path, monkeypatch):
    root = tmp_path / "proj"
    raw = root / "data/raw"
    (raw / "docs").mkdir(parents=True)
    (raw / "docs/lora.md").write_text("LoRA adapters\n\nLoad many adapters at once.\n\nUnrelated tail.")
    (raw / "docs/cache.md").write_text("Prefix caching reuses KV blocks.")
    (raw / "pkg").mkdir()
    (raw / "pkg/__init__.py").write_text("import os\n\n\ndef lora_rank(x):\n    return x\n")
    monkeypatch.chdir(root)
    return root


def test_reference_commands_end_to_end(spark, project):
    idx_dir = str(project / "data/processed")
    index = jobs.index_corpus(spark, "data/raw", idx_dir, chunk_size=2000)
    assert index.stats.first()["n_chunks"] >= 4

    one = jobs.search_query(spark, "prefix caching", 2, idx_dir).orderBy("rank").collect()
    assert one[0].file_path == "data/raw/docs/cache.md"
    assert [r.rank for r in jobs.search_query(spark, "query", 0, idx_dir).collect()] == [None]
    with pytest.raises(ValueError):
        jobs.search_query(spark, "", 5, idx_dir)
    with pytest.raises(FileNotFoundError):
        jobs.search_query(spark, "test", 5, str(project / "nope"))

    ds = project / "questions.json"
    ds.write_text(json.dumps({"rag_questions": [
        {"question_id": "a", "question": "How do I load LoRA adapters?",
         "sources": [{"file_path": "data/raw/docs/lora.md", "first_character_index": 0,
                      "last_character_index": 40}], "answer": "x"},
        {"question_id": "b", "question": "prefix caching blocks",
         "sources": [{"file_path": "data/raw/docs/cache.md", "first_character_index": 0,
                      "last_character_index": 10}], "answer": "y"},
        {"question_id": "c", "question": "what is the"}]}))
    out = jobs.search_dataset(spark, str(ds), str(project / "out"), 3, idx_dir)
    doc = _read_doc(out)
    assert doc["k"] == 3 and [r["question_id"] for r in doc["search_results"]] == ["a", "b", "c"]
    assert doc["search_results"][2]["retrieved_sources"] == []

    ans = jobs.answer_dataset(spark, out, str(project / "answers"), cx.first_line_answerer)
    adoc = _read_doc(ans)
    assert {r["question_id"]: r["answer"] for r in adoc["search_results"]}["b"] == \
        "Prefix caching reuses KV blocks."

    recall, report = jobs.evaluate(spark, out, str(ds))
    assert {r.cutoff: r.mean_recall for r in recall.collect()}[3] == 1.0
    assert report.splitlines()[2] == "Recall@1: 1.000 (100.0%)"
    assert jobs.load_dataset(spark, str(ds)) == "Dataset loaded successfully: 3 questions."

    res, answer = jobs.answer_query(spark, "prefix caching", cx.first_line_answerer, 1, idx_dir)
    assert answer == "Prefix caching reuses KV blocks."


def test_output_directory_that_is_a_file(spark, project):
    f = project / "taken"
    f.write_text("x")
    with pytest.raises(NotADirectoryError):
        jobs.index_corpus(spark, "data/raw", str(f))
    with pytest.raises(ValueError):
        jobs.index_corpus(spark, "data/raw", str(project / "i"), chunk_size=0)


def test_commands_on_json_lines(spark, project):
    idx_dir = str(project / "data/processed")
    jobs.index_corpus(spark, "data/raw", idx_dir, chunk_size=2000)
    gold = [("data/raw/docs/lora.md", 0, 40), ("data/raw/docs/cache.md", 0, 10)]
    items = [{"question_id": i, "question": q, "answer": "x", "sources": [
        {"file_path": p, "first_character_index": s, "last_character_index": e}]}
        for i, q, (p, s, e) in zip("ab", ("How do I load LoRA adapters?", "prefix caching blocks"), gold)]
    # The last result of an id counts, in the order of the lines.
    items += [{"question_id": "a", "question": "what is the"}]
    ds = project / "questions.jsonl"
    ds.write_text("".join(json.dumps(i) + "\n" for i in items))
    out = jobs.search_dataset(spark, str(ds), str(project / "out"), 3, idx_dir, json_lines=True)
    recall, report = jobs.evaluate(spark, out, str(ds), json_lines=True)
    assert {r.cutoff: r.mean_recall for r in recall.collect()}[3] == 0.5
    assert report.splitlines()[2].startswith("Recall@1: 0.500")
    assert jobs.load_dataset(spark, str(ds), json_lines=True) == "Dataset loaded successfully: 3 questions."
    copy = str(project / "copy.jsonl")
    jobs.copy_dataset(spark, str(ds), copy, json_lines=True)
    assert jobs.load_dataset(spark, copy, json_lines=True) == "Dataset loaded successfully: 3 questions."
    lines = [json.loads(r.value) for r in spark.read.text(copy).collect()]
    assert sorted(x["question"] for x in lines) == sorted(x["question"] for x in items)
