"""The pipeline against a brute-force version of its stages."""

import corpus_pipeline
from lexispan.llm import packing, quality
from tests.llm.test_free import brute_components, plain_best_fit
from tests.llm.test_native import shingle_set

DATA = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    good = {r.doc_id for r in quality.score_quality(docs, labels).where("predicted = 1").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    last = {}
    for i in sorted(texts):
        last[texts[i]] = i
    texts = {i: t for t, i in last.items()}
    ids = sorted(texts)
    texts = {ids[n]: texts[ids[n]] for n, (_, c) in enumerate(brute_components([texts[i] for i in ids])) if c == n}
    items = [shingle_set(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    left = {i: t for i, t in texts.items()
            if not any(s and len(s & shingle_set(t)) * 100 >= 75 * len(s) for s in items)}
    want, counts = set(), {}
    for i, t in left.items():
        length = len(packing.token_bytes(t or "", packing.tokenizer_path())) // 4
        for n, (start, size) in enumerate(packing.cut(length)):
            want.add((i, n, start, size))
            counts[size] = counts.get(size, 0) + 1
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert {(r.doc_id, r.piece, r.start, r.length) for r in rows} == want
    assert len({r.sequence_id for r in rows}) == plain_best_fit(counts, packing.CAPACITY)


def test_filter_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DATA).schema == docs.schema


def test_stages_on_odd_rows_and_clashing_names(spark):
    """Null and repeated ids, null and empty texts, equal rows, columns
    named like the stages' own, and an empty table."""
    good = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").where("lang = 'en'").limit(30).collect()]
    clash = ("_id string, _label int, _text string, _sha string, _own_0 int, _own_1 int, text_hash long, cid long, row int, "
             "doc_id long, text string")
    pad = ("i", 1, "t", "s", 2, 3, 4, 5, 6)
    rows = [(*pad, None if i % 3 == 0 else i, t) for i, t in enumerate(good)]
    rows += [(*pad, 1, good[1]), (*pad, 1, good[2]), (*pad, None, None), (*pad, None, ""), (*pad, None, good[0]), (*pad, 50, None)]
    docs = spark.createDataFrame(rows, clash)
    empty = docs.where("false")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, DATA)
        assert kept.schema == docs.schema
        left = sorted((r.doc_id, r.text) if r.doc_id is not None else (-1, r.text or "") for r in kept.collect() if r.text)
        assert set(left) <= {(-1 if r[-2] is None else r[-2], r[-1]) for r in rows}, name
        assert stage(spark, empty, DATA).count() == 0
    exact = corpus_pipeline.exact_copies(spark, docs, DATA).collect()
    texts = [r.text or "" for r in exact]
    assert len(texts) == len(set(texts)) == len({r[-1] or "" for r in rows})
    assert corpus_pipeline.packed(spark, docs, DATA).where("piece = 0").count() == len(rows)
    assert corpus_pipeline.packed(spark, empty, DATA).count() == 0
