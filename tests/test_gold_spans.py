"""Passage location (gold spans): fingerprint join vs str.find."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lexispan.functions import fingerprints as fp
from lexispan.plans import fixtures as fx
from tests.conftest import docs


def brute(corpus, passages):
    out = []
    for qid, p in passages:
        if not p:
            continue
        for path, text in corpus:
            i = text.find(p)
            if i >= 0:
                out.append((qid, path, i, i + len(p)))
    return sorted(out)


def located(spark, corpus, passages):
    pas = spark.createDataFrame(passages, "question_id string, passage string")
    rows = fx.locate_passages(docs(spark, corpus), pas).collect()
    return sorted((r.question_id, r.file_path, r.first_character_index, r.last_character_index)
                  for r in rows)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab c\n\U0001F600é", max_size=300), st.data())
def test_winnow_selects_every_occurrence(text, data):
    if not text:
        return
    s = data.draw(st.integers(0, len(text) - 1))
    p = text[s:s + data.draw(st.integers(1, len(text) - s))]
    lvl = fp.level_of(len(p))
    ppos, ph = fp.winnow(p, lvl)
    assert len(ppos) > 0
    tpos, th = fp.winnow(text, lvl)
    occurrences = {i for i in range(len(text) - len(p) + 1) if text.startswith(p, i)}
    for o, h in zip(ppos.tolist(), ph.tolist()):
        starts = {int(t) - o for t, x in zip(tpos.tolist(), th.tolist()) if x == h}
        assert occurrences <= starts


def test_locate_passages_all_levels(spark):
    rnd = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "\U0001F600", "é", "x", "\n\n"]
    corpus = [(f"d{i}.md", " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 120))))
              for i in range(30)]
    corpus.append(("rep.md", "abababababababababab" * 5))
    passages = []
    for j in range(40):
        path, text = corpus[rnd.randrange(len(corpus))]
        if not text:
            continue
        s = rnd.randrange(len(text))
        passages.append((f"q{j}", text[s:s + rnd.choice([1, 3, 10, 11, 46, 47, 80, 200])]))
    passages += [("ab", "abab"), ("miss", "not in any file at all, long enough for the coarse level"),
                 ("empty", ""), ("emoji", "\U0001F600")]
    assert located(spark, corpus, passages) == brute(corpus, passages)


def test_locate_passages_first_occurrence_per_file(spark):
    corpus = [("a.md", "xx needle yy needle"), ("b.md", "needle"), ("c.md", "none")]
    passages = [("q", "needle"), ("q2", "needle yy needle")]
    assert located(spark, corpus, passages) == [
        ("q", "a.md", 3, 9), ("q", "b.md", 0, 6), ("q2", "a.md", 3, 19)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab c\n\U0001F600é", max_size=400), st.integers(0, 2), st.integers(1, 70))
def test_winnow_in_blocks_equals_one_piece(text, level, block):
    whole = fp.winnow(text, level, block=1 << 30)
    pieces = fp.winnow(text, level, block=block)
    assert whole[0].tolist() == pieces[0].tolist()
    assert whole[1].tolist() == pieces[1].tolist()


def test_fingerprints_are_handed_on_in_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(fx, "PRINT_ROWS", 50)
    texts = [f"text number {i} " * 20 if i % 7 else None for i in range(60)] + ["", "ab"]
    batch = pa.RecordBatch.from_pydict({"file_path": [f"f{i}" for i in range(len(texts))], "text": texts})
    parts = list(fx._text_prints([0, 1])(iter([batch])))
    assert len(parts) > 10 and max(p.num_rows for p in parts) < 50 + 330
    got = [tuple(r.values()) for p in parts for r in p.to_pylist()]
    want = [(f"f{i}", lvl, int(h), int(pos)) for i, t in enumerate(texts) if t is not None for lvl in (0, 1)
            for pos, h in zip(*fp.winnow(t, lvl))]
    assert got == want
