import random
import re

import pytest

from lexispan.operators import chunking as ch
from tests.conftest import docs
from tests.model import pack, paragraphs, windows


def spans(df):
    return sorted((r["file_path"], r["first_character_index"], r["last_character_index"])
                  for r in df.collect())


def test_empty_text_gives_no_chunk(spark):
    assert ch.chunk_documents(docs(spark, [("a.md", ""), ("b.py", "")]), 10).count() == 0


def test_blank_python_file_keeps_fixed_window(spark):
    assert spans(ch.chunk_documents(docs(spark, [("a.py", "\n\n")]), 10)) == [("a.py", 0, 2)]


def test_blank_prose_gives_no_chunk(spark):
    assert ch.chunk_documents(docs(spark, [("a.md", "   \t ")]), 10).count() == 0


def test_paragraph_of_exactly_n_is_one_chunk(spark):
    assert spans(ch.chunk_documents(docs(spark, [("a.md", "x" * 10)]), 10)) == [("a.md", 0, 10)]


def test_spaced_break_is_not_a_paragraph_break(spark):
    rows = ch.paragraphs(docs(spark, [("a.md", "a\n \nb")])).collect()
    assert [(r.first_character_index, r.last_character_index) for r in rows] == [(0, 5)]


def test_astral_offsets_are_code_points(spark):
    got = ch.chunk_documents(docs(spark, [("a.md", "😀a\n\nb")]), 2)
    assert spans(got) == [("a.md", 0, 2), ("a.md", 4, 5)]
    assert sorted(r.text for r in got.collect()) == ["b", "😀a"]


def test_syntax_error_falls_back_to_fixed_windows(spark):
    assert spans(ch.chunk_documents(docs(spark, [("a.py", "def (")]), 3)) == [("a.py", 0, 3), ("a.py", 3, 5)]


def test_comment_only_file_falls_back(spark):
    assert spans(ch.chunk_documents(docs(spark, [("a.py", "# c\n")]), 10)) == [("a.py", 0, 4)]


def test_two_statements_on_one_line(spark):
    assert spans(ch.chunk_documents(docs(spark, [("a.py", "x=1;y=2\n")]), 100)) == [("a.py", 0, 8)]


def test_form_feed_line_boundaries(spark):
    got = spans(ch.chunk_documents(docs(spark, [("a.py", "x=1\n\f\ny=2\n")]), 100))
    assert got == [("a.py", 0, 4), ("a.py", 6, 10)]


def test_statement_span_takes_leading_comment(spark):
    text = "import os\n\n# helper\ndef f():\n    return 1\n\n# tail\n"
    got = ch.chunk_documents(docs(spark, [("m.py", text)]), 100).orderBy("first_character_index").collect()
    assert [r.text for r in got] == ["import os\n", "\n# helper\ndef f():\n    return 1\n", "\n# tail\n"]


def test_unsupported_suffix_fails(spark):
    with pytest.raises(Exception, match="cannot chunk a file of this type"):
        ch.chunk_documents(docs(spark, [("a.json", "{}")]), 10).collect()


@pytest.mark.parametrize("n", [0, 2001, -1])
def test_chunk_size_guard(spark, n):
    with pytest.raises(ValueError):
        ch.chunk_documents(docs(spark, [("a.md", "x")]), n)


def test_corpus_order(spark):
    d = docs(spark, [("a-b/c.md", "x"), ("a/b.md", "y")])
    got = [r.file_path for r in ch.order_chunks(ch.chunk_documents(d, 10)).collect()]
    assert got == ["a/b.md", "a-b/c.md"]


def _random_text(rng):
    alphabet = ["a", "b", " ", "\n", "\n", "😀", "é", "\t", " ", "x"]
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))


def test_prose_packing_matches_plain_fold(spark):
    rng = random.Random(7)
    rows = [(f"d/{i}.md", _random_text(rng)) for i in range(300)]
    n_by = {r[0]: (i % 7) + 1 for i, r in enumerate(rows)}
    for n in sorted(set(n_by.values())):
        subset = [r for r in rows if n_by[r[0]] == n]
        got = spans(ch.chunk_documents(docs(spark, subset), n))
        want = sorted((p, s, e) for p, t in subset for s, e in pack(t, n))
        assert got == want


def test_paragraphs_and_fixed_split_match_plain(spark):
    rng = random.Random(11)
    rows = [(f"d/{i}.md", _random_text(rng)) for i in range(200)]
    got = sorted((r.file_path, r.first_character_index, r.last_character_index)
                 for r in ch.paragraphs(docs(spark, rows)).collect())
    assert got == sorted((p, s, e) for p, t in rows for s, e in paragraphs(t))
    got = spans(ch.split_fixed(docs(spark, rows), 7))
    assert got == sorted((p, s, e) for p, t in rows for s, e in windows(0, len(t), 7))


def test_chunk_text_equals_substring(spark):
    rng = random.Random(3)
    rows = [(f"d/{i}.md", _random_text(rng)) for i in range(100)]
    by = dict(rows)
    for r in ch.chunk_documents(docs(spark, rows), 5).collect():
        assert by[r.file_path][r.first_character_index:r.last_character_index] == r.text
        assert 0 < len(r.text) <= 5


@pytest.mark.parametrize("block", [1, 2, 7, 256])
def test_paragraph_positions_do_not_depend_on_the_fold_block(spark, monkeypatch, block):
    rng = random.Random(13)
    rows = [(f"m/{i}.md", _random_text(rng) * 3) for i in range(60)]
    monkeypatch.setattr(ch, "FOLD_BLOCK", block)
    got = sorted((r.file_path, r.first_character_index, r.last_character_index)
                 for r in ch.paragraphs(docs(spark, rows)).collect())
    want = sorted((p, s, e) for p, t in rows for s, e in paragraphs_of(t))
    assert got == want
    assert spans(ch.chunk_documents(docs(spark, rows), 6)) == sorted(
        (p, s, e) for p, t in rows for s, e in pack(t, 6))


def paragraphs_of(text):
    """Pieces between runs of two or more newlines."""
    breaks = [(0, 0), *(m.span() for m in re.finditer(r"\n{2,}", text)), (len(text), len(text))]
    return [(a[1], b[0]) for a, b in zip(breaks, breaks[1:]) if b[0] > a[1]]


def test_prose_needs_no_python(spark):
    plan = ch.pack_paragraphs(docs(spark, [("a.md", "x")]), 10)._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan


def test_windows_over_block_borders(spark, monkeypatch):
    monkeypatch.setattr(ch, "BLOCK", 7)
    rng = random.Random(23)
    rows = [(f"d/{i}.md", _random_text(rng) * rng.randint(1, 4)) for i in range(80)]
    by = dict(rows)
    for n in (1, 3, 7):
        got = ch.chunk_documents(docs(spark, rows), n).collect()
        assert spans_of_rows(got) == sorted((p, s, e) for p, t in rows for s, e in pack(t, n))
        assert all(by[r.file_path][r.first_character_index:r.last_character_index] == r.text for r in got)
    fixed = ch.split_fixed(docs(spark, rows), 5).collect()
    assert spans_of_rows(fixed) == sorted((p, s, e) for p, t in rows for s, e in windows(0, len(t), 5))
    assert all(by[r.file_path][r.first_character_index:r.last_character_index] == r.text for r in fixed)


def spans_of_rows(rows):
    return sorted((r.file_path, r.first_character_index, r.last_character_index) for r in rows)


def test_long_texts_take_time_in_proportion(spark):
    import time

    def seconds(text, n):
        t = time.time()
        chunks = ch.chunk_documents(docs(spark, [("a.md", "😀" + text)]), n)
        assert chunks.selectExpr("sum(length(text))").first()[0] > len(text) / 2
        return time.time() - t
    for text in ("word " * 100_000, "some words of a paragraph\n\n" * 20_000, "x" * 500_000):
        seconds(text, 400)
        short, long = seconds(text * 2, 400), seconds(text * 4, 400)
        assert long < 3.5 * short + 1, (text[:10], short, long)


def test_spans_of_a_document(spark):
    text = "one\n\n  \n\nthree and more"
    got = ch.emit_spans(spark.createDataFrame(
        [("a.md", text, [(0, 3), (5, 7), (9, 23)])], "file_path string, text string, spans array<struct<s:int,e:int>>"), 6)
    assert sorted(r.text for r in got.collect()) == sorted(["one", "three ", "and mo", "re"])


def test_chunks_in_order_need_python_for_code_only(spark):
    prose, mixed = docs(spark, [("b.md", "x"), ("a.md", "y\n\nz")]), docs(spark, [("b.py", "x=1\n\ny=2\n"), ("a.md", "y")])
    plain = ch.chunk_in_order(prose, 1, prose)
    assert "ArrowEvalPython" not in plain._jdf.queryExecution().toString()
    assert [r.text for r in plain.coalesce(1).collect()] == ["x", "y", "z"]
    both = ch.chunk_in_order(mixed, 100, mixed)
    assert spans_of_rows(both.collect()) == spans_of_rows(ch.chunk_documents(mixed, 100).collect())
    with pytest.raises(Exception, match="cannot chunk a file of this type"):
        odd = docs(spark, [("a.json", "{}")])
        ch.chunk_in_order(odd, 10, odd).collect()
