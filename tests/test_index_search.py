import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lexispan.operators import chunking as ch
from lexispan.operators import index as ix
from lexispan.operators import search as se
from tests.conftest import docs
from tests.model import bm25_rank


def qdf(spark, rows):
    return spark.createDataFrame(rows, "question_id string, question string")


def ranked(df):
    return [(r.question_id, r.rank, r.file_path, r.first_character_index)
            for r in df.orderBy("question_id", "rank").collect()]


def build(spark, rows, n=2000):
    return ix.build_index_from_chunks(ch.chunk_documents(docs(spark, rows), n), chunk_size=n)


CORPUS = [("c/a.md", "lora adapters load weights"), ("c/b.md", "cache blocks and paging"),
          ("c/c.md", "tensor parallel lora"), ("c/d.md", "scheduler policy"),
          ("c/e.md", "speculative decoding draft")]


def test_stop_words_only_and_unknown_token_give_no_rows(spark):
    idx = build(spark, CORPUS)
    res = se.search_dataset(idx, qdf(spark, [("q1", "what is the"), ("q2", "zzzz_nonexistent_token"),
                                             ("q3", "lora")]), 3)
    rows = res.collect()
    by = {}
    for r in rows:
        by.setdefault(r.question_id, []).append(r.rank)
    assert by["q1"] == [None] and by["q2"] == [None]
    assert sorted(by["q3"]) == [1, 2, 3]


def test_k_zero_and_negative(spark):
    idx = build(spark, CORPUS)
    assert se.search(idx, qdf(spark, [("q", "lora")]), 0).count() == 0
    with pytest.raises(ValueError):
        se.search(idx, qdf(spark, [("q", "lora")]), -3)
    with pytest.raises(ValueError):
        se.search_one(idx, "   ", 3)


def test_repeated_token_doubles_score(spark):
    idx = build(spark, CORPUS)
    one = {r.chunk_id: r.score for r in se.bm25_scores(idx, qdf(spark, [("q", "lora")])).collect()}
    two = {r.chunk_id: r.score for r in se.bm25_scores(idx, qdf(spark, [("q", "lora lora")])).collect()}
    assert one
    for p in one:
        assert two[p] == pytest.approx(2 * one[p], rel=1e-9)


def test_tie_keeps_corpus_order(spark):
    idx = build(spark, [("z/x.md", "same words here"), ("a-b/y.md", "same words here"), ("a/c/y.md", "same words here"),
                        ("a/y.md", "same words here"), ("q/q.md", "other thing")])
    got = [r.file_path for r in se.search(idx, qdf(spark, [("q", "words")]), 4).orderBy("rank").collect()]
    # One path token more or less changes the length; equal lengths tie
    # and go by path components ("a/..." before "a-b/...").
    assert [p for p in got if p in ("a-b/y.md", "a/c/y.md")] == ["a/c/y.md", "a-b/y.md"]
    assert [p for p in got if p in ("a/y.md", "z/x.md")] == ["a/y.md", "z/x.md"]


def test_zero_fill_continues_in_corpus_order(spark):
    idx = build(spark, CORPUS)
    got = ranked(se.search(idx, qdf(spark, [("q", "scheduler")]), 3))
    assert [g[2] for g in got] == ["c/d.md", "c/a.md", "c/b.md"]


def test_negative_idf_general_path(spark):
    # Two chunks sharing every token: all raw idf < 0, so the floor is
    # negative and every score is negative; zero scores rank above them.
    rows = [("t/a.md", "alpha beta"), ("t/b.md", "alpha beta")]
    idx = build(spark, rows)
    avg = idx.stats.first()["average_idf"]
    assert avg < 0
    got = ranked(se.search(idx, qdf(spark, [("q", "alpha")]), 5))
    want = bm25_rank([(p, 0, len(t), t) for p, t in rows], "alpha", 5)
    assert [g[2] for g in got] == [w[0] for w in want]
    assert all(r.score < 0 for r in se.search(idx, qdf(spark, [("q", "alpha")]), 5).collect())


def test_negative_idf_with_zero_fill(spark):
    rows = [("t/a.md", "alpha beta"), ("t/b.md", "alpha beta gamma"), ("t/c.md", "alpha beta"),
            ("t/d.md", "zeta")]
    idx = build(spark, rows)
    got = ranked(se.search(idx, qdf(spark, [("q", "alpha"), ("r", "gamma")]), 4))
    for qid, text in (("q", "alpha"), ("r", "gamma")):
        want = bm25_rank([(p, 0, len(t), t) for p, t in rows], text, 4)
        assert [g[2] for g in got if g[0] == qid] == [w[0] for w in want]


def test_random_corpora_match_brute_force(spark):
    rng = random.Random(5)
    vocab = ["lora", "cache", "block", "the", "and", "kernel", "gpu", "token", "page", "x1", "y_2"]
    for trial in range(6):
        rows = [(f"r{trial}/{rng.choice(['a', 'b', 'a-b'])}/{i}.md",
                 " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 12))))
                for i in range(rng.randint(2, 15))]
        rows = list({p: (p, t) for p, t in rows}.values())
        chunks = ch.order_chunks(ch.chunk_documents(docs(spark, rows), 2000)).collect()
        if not chunks:
            continue
        idx = build(spark, rows)
        questions = [(f"q{j}", " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 4)))) for j in range(5)]
        k = rng.randint(1, 6)
        got = ranked(se.search(idx, qdf(spark, questions), k))
        model_chunks = [(c.file_path, c.first_character_index, c.last_character_index, c.text) for c in chunks]
        for qid, text in questions:
            want = bm25_rank(model_chunks, text, k)
            assert [(g[2], g[3]) for g in got if g[0] == qid] == [(w[0], w[1]) for w in want], (rows, text, k)


def test_empty_corpus_is_an_error(spark, tmp_path):
    idx = ix.build_index(docs(spark, [("a.md", "   ")]), 100)
    with pytest.raises(ValueError, match="No indexable chunks"):
        ix.save_index(idx, str(tmp_path / "idx"))


def test_index_roundtrip_and_errors(spark, tmp_path):
    idx = ix.build_index(docs(spark, CORPUS), 100)
    saved = ix.save_index(idx, str(tmp_path / "idx"))
    again = ix.load_index(spark, str(tmp_path / "idx"))
    q = qdf(spark, [("q", "lora cache"), ("r", "draft")])
    assert ranked(se.search(again, q, 3)) == ranked(se.search(idx, q, 3))
    assert saved.on_disk
    with pytest.raises(FileNotFoundError, match="index command first"):
        ix.load_index(spark, str(tmp_path / "missing"))
    bad = tmp_path / "bad"
    (bad / "v1" / "meta").mkdir(parents=True)
    (bad / "v1" / "meta" / "part-0.txt").write_text("not json")
    (bad / "published").mkdir()
    (bad / "published" / "1-v1").write_text("")
    with pytest.raises(FileNotFoundError, match="again"):
        ix.load_index(spark, str(bad))


def test_plan_has_no_cross_join_and_pruned_topk(spark):
    idx = build(spark, CORPUS)
    plan = se.search(idx, qdf(spark, [("q", "lora")]), 2)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    plan = se.top_k(idx, se.bm25_scores(idx, qdf(spark, [("q", "lora")])), 2)._jdf.queryExecution()\
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_zero_fill_from_saved_prefix(spark, tmp_path):
    saved = ix.save_index(ix.build_index(docs(spark, CORPUS), 2000, materialize=False), str(tmp_path / "idx"))
    assert saved.prefix is not None and saved.prefix_rows >= 3
    q = qdf(spark, [("q", "scheduler"), ("r", "lora")])
    assert ranked(se.search(saved, q, 4)) == ranked(se.search(build(spark, CORPUS), q, 4))
    assert [g[2] for g in ranked(se.search(saved, q, 4)) if g[0] == "q"] == \
        ["c/d.md", "c/a.md", "c/b.md", "c/c.md"]


def test_ties_across_the_border_keep_corpus_order(spark, tmp_path):
    rows = [(f"t/{i:03d}.md", "same words here") for i in random.Random(3).sample(range(300), 60)]
    rows += [("t/best.md", "words words words"), ("u/other.md", "nothing else"), *CORPUS]
    want = ["t/best.md", *sorted(p for p, t in rows if t == "same words here")]
    saved = ix.save_index(ix.build_index(docs(spark, rows), 2000, materialize=False), str(tmp_path / "idx"))
    for idx in (build(spark, rows), saved):
        for k in (1, 2, 5, 61):
            got = ranked(se.search(idx, qdf(spark, [("q", "words"), ("r", "lora")]), k))
            assert [g[2] for g in got if g[0] == "q"][:len(want)] == want[:k]
            assert [g[2] for g in got if g[0] == "r"][:1] == ["c/a.md"]


def test_a_failed_rebuild_leaves_the_published_index(spark, tmp_path):
    path = str(tmp_path / "idx")
    q = qdf(spark, [("q", "lora cache")])
    before = ranked(se.search(ix.save_index(ix.build_index(docs(spark, CORPUS), 100), path), q, 3))
    broken = ix.build_index(docs(spark, [("n/x.md", "lora cache new"), ("n/y.json", "{}")]), 100, materialize=False)
    with pytest.raises(Exception, match="cannot chunk"):
        ix.save_index(broken, path)
    assert ranked(se.search(ix.load_index(spark, path), q, 3)) == before
    for text in ("lora one", "lora two", "lora three"):
        ix.save_index(ix.build_index(docs(spark, [("n/x.md", text)]), 100, materialize=False), path)
    assert len(list((tmp_path / "idx" / "published").glob("0*"))) == ix.VERSIONS
    assert ix.load_index(spark, path).chunks.first().text == "lora three"


MIXED = [("a-b/y.md", "lora\n\n" * 30), ("a/c/y.py", "x = 1\n\ndef lora():\n    return x\n"), ("a/y.md", "cache lora"),
         ("z/empty.md", "  "), ("b/_x.py", "def broken(:\n"), ("b/x.md", "weights " * 90)]


def test_chunk_ids_are_numbers_in_corpus_order(spark, tmp_path):
    chunks = ch.order_chunks(ch.chunk_documents(docs(spark, MIXED), 20)).collect()
    want = [(i, c.file_path, c.first_character_index, c.last_character_index, c.text) for i, c in enumerate(chunks)]
    columns = ["chunk_id", "file_path", "first_character_index", "last_character_index", "text"]
    saved = ix.save_index(ix.build_index(docs(spark, MIXED), 20, materialize=False), str(tmp_path / "idx"))
    for idx in (saved, ix.build_index(docs(spark, MIXED), 20), build(spark, MIXED, 20)):
        assert [tuple(r) for r in idx.chunks.select(*columns).orderBy("chunk_id").collect()] == want
        assert idx.n_chunks == len(want) and idx.stats.first()["n_chunks"] == len(want)
    # The first chunks of the corpus are the smallest ids.
    assert [r.file_path for r in saved.prefix.where("pos <= 3").orderBy("pos").collect()] == [w[1] for w in want[:3]]


def test_postings_in_groups(spark, tmp_path):
    rows = [(f"g/{i:03d}.md", f"lora word{i % 7} cache{i % 3}") for i in range(90)]
    one = ix.save_index(ix.build_index(docs(spark, rows), 100, materialize=False), str(tmp_path / "one"), 4)
    many = ix.save_index(ix.build_index(docs(spark, rows), 100, materialize=False), str(tmp_path / "many"), 6, group_files=2)
    assert len(one.groups) == 1 and len(many.groups) == 3
    edges = [g.selectExpr("min(chunk_id)", "max(chunk_id)").first() for g in many.groups]
    assert all(a[1] < b[0] for a, b in zip(edges, edges[1:]))
    q = qdf(spark, [("q", "lora word3"), ("r", "cache1 word6 lora"), ("s", "word1")])
    assert ranked(se.search(many, q, 9)) == ranked(se.search(one, q, 9)) == ranked(se.search(build(spark, rows, 100), q, 9))
    plan = se.bm25_scores(many, q)._jdf.queryExecution().executedPlan().toString()
    # Sums per question and chunk need no exchange.
    assert not re.search(r"Exchange hashpartitioning\(question_id#\d+, chunk_id", plan)


def test_no_size_exceeds_the_limit_of_buckets():
    for files in (1, 49_999, 50_001, 781_250, 10**8):
        ranges, buckets = ix._grouped(10**13, files, ix.GROUP_FILES)
        assert buckets <= ix.GROUP_FILES and len(ranges) * buckets >= files
        assert ranges[0][0] == 0 and ranges[-1][1] == 10**13 and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
    assert ix._grouped(2, 9, 1) == ([(0, 1), (1, 2)], 5)


def test_bounded_scores_keep_every_result(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    rows = [(f"d/{i:04d}.md", " ".join(rng.choices(words, weights, k=rng.randint(1, 40)))) for i in range(120)]
    rows += [(f"e/{i}.md", rows[7][1]) for i in range(9)]
    questions = [(f"q{i}", " ".join(rng.choices(words, weights, k=rng.randint(1, 30)))) for i in range(12)]
    saved = ix.save_index(ix.build_index(docs(spark, rows), 2000, materialize=False), str(tmp_path / "idx"), 2, group_files=1)
    assert saved.nonnegative_idf
    q = qdf(spark, questions)
    every = se.bm25_scores(saved, q).persist()
    for k, first, pushdown in ((5, 2, True),):
        monkeypatch.setattr(se, "FIRST_PASS", first)
        weights, n, wanted = se.weighted_tokens(saved, q, se.Intermediates(), pushdown)
        assert (wanted is not None) == pushdown
        got = se.bounded_scores(saved, weights.persist(), n, k, wanted)
        assert [tuple(r)[:2] for r in se.top_k(saved, got, k).orderBy("question_id", "rank").collect()] == [
            tuple(r)[:2] for r in se.top_k(saved, every, k).orderBy("question_id", "rank").collect()]


def test_bounds_leave_pairs_unscored(spark, tmp_path, monkeypatch):
    from lexispan.plans import fixtures as fx

    sf = "/root/testdata/sf0.001"
    idx = ix.save_index(ix.build_index(fx.prose_corpus(spark, sf), 400, materialize=False), str(tmp_path / "idx"))
    q = fx.benchmark_questions(spark, sf)
    bounded = se.bounded_scores(idx, *se.weighted_tokens(idx, q, se.Intermediates())[:2], 10)
    assert 0 < bounded.count() < 0.8 * se.bm25_scores(idx, q).count()
    plain = ranked(se.search(idx, q, 10))
    monkeypatch.setattr(se, "BOUNDED_PAIRS", 0)
    assert ranked(se.search(idx, q, 10)) == plain


def test_a_leased_version_outlives_rebuilds(spark, tmp_path):
    path = str(tmp_path / "idx")
    first = ix.save_index(ix.build_index(docs(spark, CORPUS), 100, materialize=False), path)
    lease = ix.Lease(spark, first)

    def rebuild(times):
        for i in range(times):
            ix.save_index(ix.build_index(docs(spark, [("n/x.md", f"lora {i}")]), 100, materialize=False), path)
    rebuild(3)
    q = qdf(spark, [("q", "lora cache")])
    assert ranked(se.search(first, q, 3))[0][2] in ("c/a.md", "c/b.md", "c/c.md")
    assert (tmp_path / "idx" / first.version).exists()
    lease.renew()
    lease.release()
    rebuild(1)
    assert not (tmp_path / "idx" / first.version).exists()
    assert not spark.catalog.listTables(pattern=f"lexispan_postings_{first.version}*")
    # A lease that ran out holds nothing.
    now = ix.load_index(spark, path)
    ix.Lease(spark, now, seconds=-5)
    rebuild(2)
    assert not (tmp_path / "idx" / now.version).exists() and not list((tmp_path / "idx" / "leases").glob("[0-9]*"))


def test_a_failed_build_leaves_nothing_behind(spark, tmp_path):
    path = tmp_path / "idx"
    broken = ix.build_index(docs(spark, [("n/y.json", "{}")]), 100, materialize=False)
    with pytest.raises(Exception, match="cannot chunk"):
        ix.save_index(broken, str(path))
    assert not list(path.glob("*")) and not path.exists() or not [p for p in path.iterdir()]


def test_searches_release_their_own_intermediates(spark):
    idx = build(spark, CORPUS)
    one, two = se.Intermediates(), se.Intermediates()
    a = se.search(idx, qdf(spark, [("q", "lora")]), 2, kept=one)
    b = se.search(idx, qdf(spark, [("q", "cache")]), 2, kept=two)
    one.release()
    assert two._kept and all(d.storageLevel.useMemory for d in two._kept)
    assert ranked(a) and ranked(b)


def test_search_hands_on_few_chunks_of_a_question(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    rows = [(f"d/{i:03d}.md", " ".join(["lora"] + rng.choices(["cache", "paging", "draft"], k=rng.randint(0, 9))))
            for i in range(400)]
    rows += [(f"e/{i}.md", "filler words only " * 3) for i in range(900)]
    q = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(["lora", "lora cache", "paging draft lora lora", "zzz"])]
                              + [(None, "cache draft")], "question_id string, question string")
    saved = ix.save_index(ix.build_index(docs(spark, rows), 2000, materialize=False), str(tmp_path / "idx"), 2)
    for idx in (build(spark, rows), saved):
        assert idx.nonnegative_idf
        every = se.bm25_scores(idx, q)
        want = [tuple(r)[:2] for r in se.top_k(idx, every, 3).orderBy("question_id", "rank").collect()]
        best = se.top_scores(idx, q, 3)
        # Not a row for each of the 400 chunks that hold a token.
        assert best.count() <= 4 * 3 * 4 < every.count() / 20
        for width in (se.QUESTION_SLICE, 3):
            monkeypatch.setattr(se, "QUESTION_SLICE", width)
            got = se.top_k(idx, se.top_scores(idx, q, 3), 3)
            assert [tuple(r)[:2] for r in got.orderBy("question_id", "rank").collect()] == want
        assert len(want) == 12


def test_all_scores_meet_their_paths_unsorted(spark):
    idx = build(spark, CORPUS)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scores = se.with_spans(idx, se.bm25_scores(idx, qdf(spark, [("q", "lora cache")])))
        plan = scores._jdf.queryExecution().executedPlan().toString()
        assert scores.count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def asked_and_blocks(rng, n_chunks, n_blocks, n_questions):
    """Questions as ``asked_questions`` gives them, blocks of chunks, and
    every chunk's factors by token."""
    words = list(range(40))
    often = [1 / (i + 1) for i in words]
    chunks = [{t: rng.choice([0.8, 1.1, 1.1, 1.7]) for t in rng.choices(words, often, k=rng.randint(0, 12))} for _ in range(n_chunks)]
    chunks[-20:] = chunks[:20]  # equal scores: ties go by chunk id
    df = [sum(t in c for c in chunks) for t in words]
    rows = []
    for q in range(n_questions):
        asked = rng.choices(words, often, k=rng.randint(1, 15))
        rows += [(None if q == 3 else f"q{q}", f"t{t}", asked.count(t) * (0.0 if t == 39 else 6.0 - 5 * df[t] / n_chunks), df[t])
                 for t in sorted(set(asked))]
    rng.shuffle(rows)
    weights = pa.table({n: pa.array(c) for n, c in zip(("question_id", "token", "w", "df"), zip(*rows, strict=True), strict=True)})
    tokens, *asked = se.asked_questions(weights)
    number = {t: i for i, t in enumerate(tokens.to_pylist())}
    kind = pa.list_(pa.struct([("number", pa.int32()), ("tfn", pa.float64())]))
    dealt = rng.sample(range(n_chunks), n_chunks)
    hits = {c: [{"number": number[f"t{t}"], "tfn": f} for t, f in chunks[c].items() if f"t{t}" in number] for c in dealt}
    blocks = [pa.table({"chunk_id": own, "hits": pa.array([hits[c] for c in own], kind)})
              for own in ([c for c in dealt[i::n_blocks] if hits[c]] for i in range(n_blocks))]
    return (*asked, len(tokens)), blocks, rows, chunks


def best_by_brute_force(rows, chunks, k):
    want = {}
    for q in {r[0] for r in rows}:
        own = {t: w for i, t, w, _ in rows if i == q}
        scores = [(-round(sum(own[f"t{t}"] * f for t, f in c.items() if f"t{t}" in own), 9), i)
                  for i, c in enumerate(chunks) if any(f"t{t}" in own for t in c)]
        want[q] = [i for _, i in sorted(scores)[:k]]
    return want


@pytest.mark.parametrize(("k", "held"), [(5, 1 << 20), (5, 0), (60, 1 << 20)])
def test_a_task_hands_on_k_chunks_of_its_blocks(monkeypatch, k, held):
    rng = random.Random(k + held)
    asked, blocks, rows, chunks = asked_and_blocks(rng, 1500, 6, 25)
    monkeypatch.setattr(se, "HELD_ROWS", held)
    monkeypatch.setattr(se, "QUESTION_BATCH", 7)
    monkeypatch.setattr(se, "GROUP_CHUNKS", 8)
    best = se.BestChunks(k, *asked)
    out = pa.Table.from_batches([*(b for block in blocks for b in best.add(block)), *best.rows()])
    found = {}
    for q, c, s in zip(*(out[n].to_pylist() for n in ("question_id", "chunk_id", "score")), strict=True):
        found.setdefault(q, []).append((-round(s, 9), c))
    assert {q: [c for _, c in sorted(x)[:k]] for q, x in found.items()} == best_by_brute_force(rows, chunks, k)
    if held:
        assert all(len(x) <= k for x in found.values())  # not of each block


def test_frequent_tokens_are_not_summed_over_a_block(monkeypatch):
    # Every chunk of the second block holds the frequent token, none the rare one.
    ids, none = pa.array(["q"]), np.zeros(0)
    kind = pa.list_(pa.struct([("number", pa.int32()), ("tfn", pa.float64())]))
    first = pa.table({"chunk_id": range(3), "hits": pa.array([[{"number": 0, "tfn": 1.0}, {"number": 1, "tfn": 1.0}]] * 3, kind)})
    second = pa.table({"chunk_id": range(3, 99), "hits": pa.array([[{"number": 0, "tfn": 1.0}]] * 96, kind)})
    best = se.BestChunks(2, ids, np.array([0, 2]), np.array([0, 1], np.int32), np.array([1.0, 9.0]), 2)
    sums, bincount = [], np.bincount

    def counted(x, weights=none, minlength=0):
        sums.extend([len(x)] * (weights is not none and weights.dtype == float))
        return bincount(x, minlength=minlength) if weights is none else bincount(x, weights, minlength)
    monkeypatch.setattr(se.np, "bincount", counted)
    assert not list(best.add(first)) and not list(best.add(second)) and sums == [6]
    assert [b.to_pydict() for b in best.rows()] == [{"question_id": ["q", "q"], "chunk_id": [0, 1], "score": [10.0, 10.0]}]


def test_an_index_leaves_memory_to_the_tasks(spark):
    idx = build(spark, CORPUS)
    assert ranked(se.search(idx, qdf(spark, [("q", "lora")]), 2))
    for kept in (idx.tokenized, idx.groups[0], idx.terms):
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert "InMemoryRelation" in plan and "StorageLevel(disk, 1 replicas)" in plan and "memory" not in plan
