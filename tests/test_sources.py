import json
import os

import pytest
from pyspark.sql import functions as F

from lexispan.sources import corpus as co
from lexispan.sources import questions as qs


def write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)


def test_hidden_names_are_listed(spark, tmp_path):
    root = tmp_path / "corpus"
    for rel in ["__init__.py", "_p/a.py", ".h/b.py", "q/d.py", "q/skip.json"]:
        write(str(root / rel), b"x = 1\n")
    got = sorted(os.path.relpath(r.path, root) for r in co.scan_corpus(spark, str(root)).collect())
    assert got == [".h/b.py", "__init__.py", "_p/a.py", "q/d.py"]


def test_suffix_rules(spark, tmp_path):
    root = tmp_path / "c"
    for rel in ["a.PY", ".py", "a.tar.md", "a.json"]:
        write(str(root / rel), b"t")
    got = sorted(os.path.basename(r.path) for r in co.scan_corpus(spark, str(root)).collect())
    assert got == ["a.PY", "a.tar.md"]


def test_bad_roots(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        co.scan_corpus(spark, str(tmp_path / "nope"))
    f = tmp_path / "file.md"
    f.write_text("x")
    with pytest.raises(NotADirectoryError):
        co.scan_corpus(spark, str(f))


def test_newlines_bom_and_relative_paths(spark, tmp_path):
    root = tmp_path / "proj"
    write(str(root / "data/raw/n.md"), b"a\r\nb\rc")
    write(str(root / "data/raw/bom.txt"), b"\xef\xbb\xbfhi")
    d = {r.file_path: r.text for r in co.load_documents(spark, str(root / "data/raw"), str(root)).collect()}
    assert d["data/raw/n.md"] == "a\nb\nc"
    assert d["data/raw/bom.txt"] == "﻿hi" and len(d["data/raw/bom.txt"]) == 3


def test_bad_utf8_fails_strict_and_is_quarantined(spark, tmp_path):
    root = tmp_path / "p"
    write(str(root / "raw/ok.md"), b"fine")
    write(str(root / "raw/bad.md"), b"\xff\xfe")
    with pytest.raises(Exception):
        co.load_documents(spark, str(root / "raw"), str(root)).collect()
    got = co.load_documents(spark, str(root / "raw"), str(root), mode="quarantine").collect()
    assert [r.file_path for r in got] == ["raw/ok.md"]


def test_path_outside_root_is_an_error(spark):
    df = spark.createDataFrame([("/elsewhere/a.md",)], "p string")
    with pytest.raises(Exception, match="outside the project"):
        df.select(co.relative_path("p", "/srv/project")).collect()


def _dataset(tmp_path, items, name="set.json", raw=None):
    p = tmp_path / name
    p.write_text(raw if raw is not None else json.dumps({"rag_questions": items}))
    return str(p)


def test_question_typing(spark, tmp_path):
    src = {"file_path": "a.md", "first_character_index": 0, "last_character_index": 5}
    items = [
        {"question_id": "q1", "question": "plain"},
        {"question_id": "q2", "question": "answered", "sources": [src], "answer": "x", "extra": 1},
        {"question_id": "q3", "question": "no answer key", "sources": [src]},
        {"question_id": "q4", "question": "coerced", "answer": "y",
         "sources": [{"file_path": "a.md", "first_character_index": "5", "last_character_index": 7.0}]},
        {"question_id": "q5", "question": "bad offset", "answer": "y",
         "sources": [{"file_path": "a.md", "first_character_index": "z", "last_character_index": 7}]},
        {"question": "no id"},
    ]
    got = {r.question_id: r for r in qs.load_questions(spark, _dataset(tmp_path, items)).collect()}
    assert not got["q1"].is_answered and got["q2"].is_answered and not got["q3"].is_answered
    assert got["q4"].is_answered and got["q4"].sources[0].first_character_index == 5
    assert got["q4"].sources[0].last_character_index == 7
    assert not got["q5"].is_answered
    made = [k for k in got if k not in {"q1", "q2", "q3", "q4", "q5"}]
    assert len(made) == 1 and len(made[0]) == 36


@pytest.mark.parametrize("items", [[{"question": 5}], [{}]])
def test_invalid_questions(spark, tmp_path, items):
    with pytest.raises(qs.InvalidDataset):
        qs.load_questions(spark, _dataset(tmp_path, items))


def test_malformed_documents(spark, tmp_path):
    with pytest.raises(Exception, match="invalid RAG dataset"):
        qs.load_questions(spark, _dataset(tmp_path, None, raw='{"rag_questions": [')).collect()
    with pytest.raises(Exception, match="list missing"):
        qs.load_questions(spark, _dataset(tmp_path, None, name="b.json", raw='{"x": []}')).collect()
    p = tmp_path / "nonutf8.json"
    p.write_bytes(b"\xff\xfe")
    with pytest.raises(Exception, match="UTF-8"):
        qs.load_questions(spark, str(p)).collect()
    with pytest.raises(FileNotFoundError):
        qs.load_questions(spark, str(tmp_path / "missing.json"))
    with pytest.raises(IsADirectoryError):
        qs.load_questions(spark, str(tmp_path))


def test_save_and_copy_roundtrip(spark, tmp_path):
    src = {"file_path": "a.md", "first_character_index": 0, "last_character_index": 5}
    items = [{"question_id": "q1", "question": "one"},
             {"question_id": "q2", "question": "two", "sources": [src], "answer": "x"}]
    path = _dataset(tmp_path, items)
    qs.copy_questions(spark, path, str(tmp_path / "copy.json"))
    back = qs.load_questions(spark, str(tmp_path / "copy.json"))
    cols = ["question_id", "question", "sources", "answer", "is_answered"]
    assert sorted(map(tuple, back.select(cols).collect())) == \
        sorted(map(tuple, qs.load_questions(spark, path).select(cols).collect()))
    assert qs.question_count(back).first()[0] == 2


def test_json_lines_questions(spark, tmp_path):
    p = tmp_path / "q.jsonl"
    p.write_text('{"question_id": "a", "question": "x"}\n{"question_id": "b", "question": "y"}\n')
    got = sorted(r.question_id for r in qs.load_questions(spark, str(p), json_lines=True).collect())
    assert got == ["a", "b"]


def test_non_strict_keeps_invalid_rows_with_reason(spark, tmp_path):
    path = _dataset(tmp_path, [{"question_id": "a", "question": "ok"}, {"question_id": "b", "question": 7},
                               {"question_id": 3, "question": "id is a number"}])
    got = {r.input_pos: (r.is_valid, r.reason) for r in qs.load_questions(spark, path, strict=False).collect()}
    assert got[0] == (True, None)
    assert got[1] == (False, "question must be a string")
    assert got[2] == (False, "question_id must be a string")


def test_results_as_json_lines(spark, tmp_path):
    from lexispan.sources import sinks as sk

    flat = spark.createDataFrame(
        [("q1", "Why?", 1, "a.md", 0, 5, 0), ("q1", "Why?", 2, "b.md", 1, 2, 0), ("q2", "How?", None, None, None, None, 1)],
        "question_id string, question string, rank int, file_path string, first_character_index bigint, "
        "last_character_index bigint, input_pos int")
    out = sk.write_results(sk.nest_results(flat), str(tmp_path / "out"), "r.json", 2, json_lines=True)
    rows = {r.question_id: r for r in spark.read.json(out).collect()}
    assert [s.file_path for s in rows["q1"].retrieved_sources] == ["a.md", "b.md"]
    assert rows["q2"].retrieved_sources == [] and rows["q1"].k == 2


def test_one_top_folder_spreads_over_partitions(spark, tmp_path):
    for i in range(120):
        folder = tmp_path / "corpus" / "only" / f"d{i % 3}" / "deep"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.md").write_text(f"text {i}")
    paths = co.scan_corpus(spark, str(tmp_path / "corpus"))
    sizes = [len(p) for p in paths.rdd.glom().collect()]
    assert sum(sizes) == 120 and max(sizes) <= 30 and sum(s > 0 for s in sizes) >= 8
    assert co.load_documents(spark, str(tmp_path / "corpus"), str(tmp_path)).count() == 120


def test_large_folders_are_listed_in_parts(tmp_path, monkeypatch):
    import pandas as pd

    (tmp_path / "flat").mkdir()
    (tmp_path / "deep" / "er").mkdir(parents=True)
    for i in range(25):
        (tmp_path / "flat" / f"{i}.md").write_text("x")
    (tmp_path / "deep" / "er" / "a.md").write_text("x")
    (tmp_path / "deep" / "link").symlink_to(tmp_path / "flat")
    monkeypatch.setattr(co, "LISTED", 10)
    tops = co._tops(str(tmp_path), 1000)
    # The driver does not list a folder of more entries; a task does, in parts.
    assert str(tmp_path / "flat") in tops and len(tops) <= 4
    frames = list(co._walk(iter([pd.DataFrame({"path": [str(tmp_path / "flat"), str(tmp_path / "deep" / "er")]})])))
    assert max(map(len, frames)) <= 10
    got = [p for f in frames for p, is_file in zip(f["path"], f["is_file"]) if is_file]
    assert sorted(got) == sorted([str(tmp_path / "flat" / f"{i}.md") for i in range(25)]
                                 + [str(tmp_path / "deep" / "er" / "a.md")])
    assert sorted(p for p, _ in co._files(str(tmp_path / "deep"))) == [str(tmp_path / "deep" / "er" / "a.md")]
