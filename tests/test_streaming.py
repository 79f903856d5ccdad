import json

from lexispan.operators import chunking as ch
from lexispan.operators import index as ix
from lexispan.operators import search as se
from lexispan.streaming.questions import read_stream_results, search_stream
from tests.conftest import docs


def test_stream_matches_batch_search(spark, tmp_path):
    corpus = docs(spark, [("c/a.md", "lora adapters load weights"), ("c/b.md", "cache blocks and paging"),
                          ("c/c.md", "tensor parallel lora")])
    index = ix.save_index(ix.build_index(corpus, 100, materialize=False), str(tmp_path / "idx"))
    src = tmp_path / "in"
    src.mkdir()
    qs = [("q1", "lora weights"), ("q2", "paging cache"), ("q3", "what is the")]
    for i, (qid, q) in enumerate(qs):
        (src / f"part{i}.json").write_text(json.dumps({"question_id": qid, "question": q}) + "\n")
    run = search_stream(spark, str(tmp_path / "idx"), str(src), str(tmp_path / "out"), k=2,
                        checkpoint=str(tmp_path / "ckpt"), available_now=True, max_files_per_trigger=1)
    run.awaitTermination(300)
    got = read_stream_results(spark, str(tmp_path / "out"))
    cols = ["question_id", "rank", "file_path", "first_character_index"]
    want = se.search_dataset(index, spark.createDataFrame(qs, "question_id string, question string"), 2)
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == \
        sorted(map(tuple, want.select(cols).collect()), key=str)
    assert got.select("epoch").distinct().count() == 3


def test_a_stream_survives_three_rebuilds(spark, tmp_path):
    import time

    path = str(tmp_path / "idx")

    def build(rows):
        ix.save_index(ix.build_index(docs(spark, rows), 100, materialize=False), path)
    build([("c/a.md", "lora adapters"), ("c/b.md", "cache blocks"), ("c/c.md", "tensor parallel"), ("c/d.md", "scheduler"),
           ("c/e.md", "decoding draft")])
    source, sink = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "1.jsonl").write_text('{"question_id": "q1", "question": "lora"}\n')
    run = search_stream(spark, path, str(source), sink, 1, checkpoint=str(tmp_path / "ckpt"))
    try:
        run.processAllAvailable()
        for i in range(3):
            build([("n/x.md", f"other text {i}")])
        (source / "2.jsonl").write_text('{"question_id": "q2", "question": "cache"}\n')
        deadline = time.time() + 60
        while time.time() < deadline:
            run.processAllAvailable()
            found = {r.question_id: r.file_path for r in read_stream_results(spark, sink).collect()}
            if len(found) == 2:
                break
        assert found == {"q1": "c/a.md", "q2": "c/b.md"}
    finally:
        run.stop()
