"""What ranking and postings move: no pairs of questions and chunks, no sorted joins."""

from lexispan.operators import index as ix
from lexispan.operators import search as se
from lexispan.plans import catalog
from tests.conftest import docs


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scores_of_pairs_are_not_shuffled(spark):
    rows = [(f"d/{i}.md", f"lora cache word{i}") for i in range(40)]
    index = ix.build_index(docs(spark, rows + [(f"e/{i}.md", "filler") for i in range(90)]), 400)
    questions = spark.createDataFrame([(f"q{i}", f"lora cache word{i}") for i in range(7)],
                                      "question_id string, question string")
    best = se.top_scores(index, questions, 3)
    plan = executed(best)
    assert "MapInArrow" in plan and "hashpartitioning(question_id" not in plan
    ranked = se.top_k(index, best, 3).where("rank = 1").join(index.chunks, "chunk_id").collect()
    assert {(r.question_id, r.file_path) for r in ranked} == {(f"q{i}", f"d/{i}.md") for i in range(7)}


def test_postings_meet_their_paths_unsorted(spark, tmp_path):
    texts = ["lora lora cache", "cache\nblocks", "", "the"]
    spark.createDataFrame([(i, t, "web") for i, t in enumerate(texts)], "doc_id long, text string, source string"
                          ).write.parquet(str(tmp_path / "documents.parquet"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = catalog.q_postings(spark, str(tmp_path))
        plan = executed(found)
        rows = {tuple(r) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    path = ["corpus", "web", "md"]
    want = {(t, f"corpus/web/{i}.md", 0, n, dl)
            for i, dl, own in ((0, 7, {"lora": 2, "cache": 1}), (1, 6, {"cache": 1, "blocks": 1}), (3, 4, {}))
            for t, n in [*own.items(), *((p, 1) for p in path), (str(i), 1)]}
    assert rows == want
