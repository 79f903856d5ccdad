"""Cases that the operators once lost or took too long over."""

import time

import pytest

from lexispan.llm import decontamination, html_text, near_dedup, pii

LABELLED = ("<html><body><nav><ul><li><a>a b c</a></ul></nav><article><h1>A b</h1>" + "<p>c d e f g</p>" * 9
            + "</article><footer>x y z</footer><ul><li><a>u v</a></ul></body></html>")


@pytest.mark.parametrize("start", ["<div class=sidebar>", "<div class=comment>", "<div class='notice wide'>",
                                   "<div class=newsletter>", "<div class=related><h3>Related posts</h3>", "<div class=promo>",
                                   "<div id=banner>", "<ol class=comment-list>", "<aside class=related>"])
def test_furniture_in_the_article_goes(start):
    learnt = html_text.weights(html_text.count_kinds(LABELLED))
    tag = start[1:].split()[0].rstrip(">")
    page = (f"<body><nav>menu</nav><article><h1>Title</h1><p>{'word ' * 30}</p>{start}<p>{'more of it ' * 20}</p></{tag}>"
            "<p>The end.</p></article></body>")
    assert html_text.main_text(page, learnt) == "Title\n" + ("word " * 30).strip() + "\nThe end."


@pytest.mark.parametrize("part", ["<section class=related><h2>Related work</h2><p>Text of it.</p></section>",
                                  "<div id=notice><h2>Notice</h2><p>Text of it.</p></div>",
                                  "<p class=notice>Text of it.</p>", "<h2 id=sidebar>On sidebars</h2>"])
def test_headed_sections_and_headings_stay(part):
    learnt = html_text.weights(html_text.count_kinds(LABELLED))
    page = f"<article><h1>Title</h1><p>{'word ' * 30}</p>{part}</article>"
    assert html_text.main_text(page, learnt).count("\n") == 1 + part.count("</")  - part.count("</section") - part.count("</div")


def test_deep_and_long_pages_take_time_in_proportion():
    def seconds(page):
        t = time.perf_counter()
        html_text.main_text(page, {})
        return time.perf_counter() - t
    for part in ("<div>x y", "<p>some words</p>", "<ul><li><a href=x>y</a>"):
        seconds(part * 1000)
        assert seconds(part * 16_000) < 3.5 * seconds(part * 8_000) + 0.2


def test_items_of_few_words_are_found(spark):
    docs = spark.createDataFrame([(1, "about Lora  cache and more of the words"), (2, "lora and cache"), (3, "LORA cache"),
                                  (4, "x"), (5, None), (6, "one two three four five six")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "lora cache"), (2, "X"), (3, "two three four five"), (4, "one two three four five six"),
                                   (5, ""), (6, None)], "item_id long, text string")
    found = decontamination.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (3, 1), (4, 2), (6, 3), (6, 4)}
    assert {r.doc_id for r in decontamination.drop_contaminated(docs, items).collect()} == {2, 5}


def test_ibans_end_where_their_country_says(spark):
    texts = ["AT61 1904 3002 3457 3201 BIC", "AT611904300234573201 BANK", "pay DE89370400440532013000 NOW OR NEVER",
             "NO93 8601 1117 947 X", "AT611904300234573202 BANK", "ZZ61 1904 3002 3457 3201"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.match) for s in r.spans if s.kind == "iban"] for r in pii.find_pii(docs).collect()}
    assert [len(found[i]) for i in range(6)] == [1, 1, 1, 1, 0, 0]
    assert found[0][0][1] == "AT61 1904 3002 3457 3201" and found[3][0][1] == "NO93 8601 1117 947"


def test_many_matches_take_time_in_proportion(spark):
    def seconds(n):
        docs = spark.createDataFrame([(1, " ".join(f"a{i}@b.cd" for i in range(n)))], "doc_id long, text string")
        t = time.time()
        row = pii.pii_digest(pii.find_pii(docs)).first()
        assert row.n_email == n
        return time.time() - t
    seconds(1000)
    short, long = seconds(10_000), seconds(20_000)
    assert long < 3 * short + 1


@pytest.mark.parametrize("same", ["null", "one"])
def test_repeated_ids_are_not_paired_by_id(spark, monkeypatch, same):
    """A third of the rows share an id: of each class one text is read again."""
    words = [f"w{i}" for i in range(60)]
    key = None if same == "null" else 7
    rows = [(key, " ".join([*words, f"x{i}"])) for i in range(40)] + [
        (100 + i, " ".join(f"y{i}z{k}" for k in range(20))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = near_dedup._Classes(docs, "doc_id", "text", 0.75)
    assert classes.sets.count() == classes.members.select("cid").distinct().count() == 40
    kept = near_dedup.drop_near_copies(docs)
    if same == "null":
        assert kept.where("doc_id is not null").count() == 80
