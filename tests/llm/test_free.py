"""Operators with NumPy inside tasks: packing, near-dedup, html, models."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexispan.llm import html_text, langid, near_dedup, packing, quality, toxicity, words

TEXT = "doc_id long, text string"
CLASH = "doc_id long, text string, score string, n int, id string, cid long, component string, length int, lang string"
DATA, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def clashing(spark, texts):
    return spark.createDataFrame([(i, t, "s", 1, "id", 3, "c", 4, None) for i, t in enumerate(texts)], CLASH)


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    texts = pa.array(["a b c", None, "", "  one\ttwo\nthree ", "A b C", "x" * 100 + " y", "日本 é"])
    whole = words.word_views(texts, (2, -2), letters=True)
    monkeypatch.setattr(words, "BLOCK_BYTES", 7)
    cut = words.word_views(texts, (2, -2), letters=True)
    assert all((a == b).all() for a, b in zip(whole[0], cut[0], strict=True)) and (whole[1] == cut[1]).all()
    assert np.diff(whole[1]).tolist() == [3, 0, 0, 3, 3, 2, 2]


def plain_best_fit(counts, capacity):
    room = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [r for r in room if r >= length]
            if fits:
                room.remove(min(fits))
                room.append(min(fits) - length)
            else:
                room.append(capacity - length)
    return len(room)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(4)
    for _ in range(150):
        counts = {rng.randint(1, 64): rng.randint(1, 50) for _ in range(rng.randint(1, 20))}
        bins, seen = defaultdict(list), Counter()
        for length, rank, number, first, each, offset in packing.plan(counts, 64):
            assert rank == seen[length]
            seen[length] += number
            for i in range(number):
                bins[first + i // each].append((offset + i % each * length, length))
        assert seen == counts and len(bins) == plain_best_fit(counts, 64) == max(bins) + 1
        for held in bins.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= 64


def test_token_units_give_the_tokenizers_ids():
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    rng = random.Random(8)
    parts = [" ", "  ", "\n", "\t", " ", "a", "B", "é", "1", "23", ".", "'s", "'", "\u0085", " ", "\x1f", "'re",
             "日", "​", "²", "Ⅷ", "<|endoftext|>", "\U0001f600", "　", ","]
    texts = ["", *["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(2000)]]
    for text in texts:
        ids = np.frombuffer(packing.token_bytes(text, path), "<u4").tolist()
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_words_are_merged_once_whatever_marks_follow(monkeypatch):
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    monkeypatch.setattr(packing, "REMEMBERED", 8)
    ids = packing._Ids(path)
    monkeypatch.setitem(packing._LOADED, path, ids)
    plain, encoded = Tokenizer.from_file(path), []
    plain.encode_special_tokens = True
    missed = ids._encoded
    ids._encoded = lambda unit: encoded.append(unit) or missed(unit)
    for text in ["w lora w lora, (lora) lora!!! lora___ lora&&&", "it's lora' lora's lora's, x2, ½!», don't.", "w \n\n, été, été."]:
        ids_of = plain.encode(text, add_special_tokens=False).ids + [packing.END]
        assert np.frombuffer(packing.token_bytes(text, path), "<u4").tolist() == ids_of
    assert encoded.count(" lora") == 1 and not {" lora,", " lora!!!", " lora___", " lora&&&"} & set(encoded)
    # A unit that comes again outlives the rare ones around it.
    encoded.clear()
    for i in range(40):
        packing.token_bytes(f"often rare{i}x", path)
    assert encoded.count("often") <= 1 and len(encoded) >= 40 and len(ids) + len(ids.old) <= 16


@pytest.mark.parametrize("size", [1, 7, 60, 1 << 22])
def test_texts_of_a_batch_are_told_apart_together(monkeypatch, size):
    from tokenizers import Tokenizer

    class Counted(packing._Ids):
        asked = 0

        def __getitem__(self, unit):
            self.asked += 1
            return super().__getitem__(unit) if unit in self else self.__missing__(unit)
    path = packing.tokenizer_path()
    ids = Counted(path)
    monkeypatch.setitem(packing._LOADED, path, ids)
    monkeypatch.setattr(packing, "SLICE", size)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    rng = random.Random(size)
    parts = ["lora ", "lora", " ", "\n", "\t", "_", "é", "日", "1", ", ", "'s", "\u3000", "\x1f", "a b c", "<|endoftext|>"]
    texts = ["", None, " a", "a ", " ", "lora " * 500,
             *["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(300)], None, ""]
    batch = pa.array([*texts, "left out"]).slice(1, len(texts) - 1)
    want = [[*plain.encode(t or "", add_special_tokens=False).ids, packing.END] for t in texts[1:]]
    assert [np.frombuffer(b, "<u4").tolist() for b in packing.texts_ids(batch, path)] == want
    if size == 1 << 22:  # a unit is looked up once, however often it occurs
        assert len(ids) == ids.asked
    schema = ["id", "text"]
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(batch))), batch], names=schema)
    assert sum(b.num_rows for b in packing._pieces(path, 1024)(iter([rows]))) == len(batch)
    assert not ids and not ids.old  # the worker may go on to other work
    assert list(packing.texts_ids(pa.array([], pa.string()), path)) == []


def test_pack_documents(spark):
    rng = random.Random(2)
    texts = [None, "", "word " * 5000, *["tok " * rng.randint(1, 700) for _ in range(60)], "same", "same"]
    rows = packing.pack_documents(clashing(spark, texts), capacity=256).collect()
    path = packing.tokenizer_path()
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    counts = Counter()
    for i, text in enumerate(texts):
        ids = packing.token_bytes(text or "", path)
        want = [(n, a, k, zlib.crc32(ids[4 * a:4 * (a + k)])) for n, (a, k) in enumerate(packing.cut(len(ids) // 4, 256))]
        assert sorted(by_doc[i]) == want
        assert all(k == 256 for _, _, k, _ in want[1:]) and (len(want) == 1 or len(ids) // 4 > 256)
        counts.update(k for _, _, k, _ in want)
    assert len(bins) == plain_best_fit(counts, 256)
    for held in bins.values():
        ends = list(itertools.accumulate(k for _, k in sorted(held)))
        assert [0, *ends[:-1]] == [a for a, _ in sorted(held)] and ends[-1] <= 256


def test_pack_repeated_rows_and_empty_table(spark):
    rows = packing.pack_documents(spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], TEXT)).collect()
    assert len(rows) == 3 and len({(r.sequence_id, r.offset) for r in rows}) == 3
    assert packing.pack_documents(spark.createDataFrame([], TEXT)).collect() == []


def shingle_set(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(found[i:i + 5]) for i in range(max(len(found) - 4, 1))} if found else set()


def brute_components(texts):
    sets = [shingle_set(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def near_copies(seed, families, copies, length=120, edits=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for _ in range(families):
        base = rng.choices(vocabulary, k=length) + (passage if rng.random() < 0.7 else [])
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    rng.shuffle(texts)
    return texts


def test_near_dedup_matches_brute_force(spark):
    texts = [None, "", " \n", "a", "A", "a b", *near_copies(1, 40, 6), *near_copies(2, 2, 90, 80, 7),
             "Same Text of five words here", "same  text of FIVE words\there"]
    rows = near_dedup.near_dedup(clashing(spark, texts)).collect()
    want = brute_components(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {
        i: (n, c, c == i) for i, (n, c) in enumerate(want)}
    stays = near_dedup.drop_near_copies(clashing(spark, texts)).collect()
    assert sorted(r.doc_id for r in stays) == sorted({c for _, c in want})


def test_near_dedup_repeated_null_ids_and_empty_table(spark):
    rows = near_dedup.near_dedup(spark.createDataFrame(
        [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, "zz"), (5, None)], TEXT)).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in rows) == [
        ("3", "3", True), ("3", "3", True), ("5", "5", True), ("None", "3", False), ("None", "None", True)]
    assert near_dedup.near_dedup(spark.createDataFrame([], TEXT)).collect() == []


def test_near_copies_of_null_and_repeated_ids_go_by_their_text(spark):
    one, other, third = "a b c d e f", "z y x w v u", "q r s t o p"
    docs = spark.createDataFrame([(3, one), (None, one), (None, "zz"), (None, None), (9, one), (9, other), (9, other),
                                  (7, third), (8, third + " "), (8, "")], TEXT)
    left = near_dedup.drop_near_copies(docs).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in left) == [
        ("3", one), ("7", third), ("8", ""), ("9", other), ("9", other), ("None", "None"), ("None", "zz")]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.sort(pool[:2000]), np.sort(pool[500:2500])
    sketch = [near_dedup.registers(s, np.array([0, len(s)]))[0] for s in (a, b, np.union1d(a, b))]
    assert (np.maximum(sketch[0], sketch[1]) == sketch[2]).all()
    estimates = []
    for _ in range(40):
        pool = rng.integers(0, 2**63, 2500, dtype=np.uint64)
        pair = np.r_[np.sort(pool[:2000]), np.sort(pool[500:])]
        one, two = near_dedup.registers(pair, np.array([0, 2000, 4000]))
        estimates.append(near_dedup.likely(one[None], two[None], np.array([2000]), np.array([2000]))[0])
    assert abs(np.mean(estimates) - 0.6) < 0.03 and np.std(estimates) < 0.07


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150)] + [(300, i) for i in range(301, 340)]
    labels = near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 0 for i in range(61)} | {100: 100, 200: 100, 150: 100} | {i: 300 for i in range(300, 340)}
    assert {r.id: r.label for r in labels} == want


PAGES = {
    "marked": ("<html><head><title>t</title><script>var a='</p>';</script></head><body><header>Site</header><nav><ul>"
               "<li><a href=x>Home</a></ul></nav><div class='ad'>Buy</div><article><h1>Head</h1><p>One  two\n three &amp; "
               "four.<p>Fi<b>v</b>e &eacute;<br>six</article><aside>more</aside><footer>&copy;</footer></body></html>",
               "Head\nOne two three & four.\nFive é\nsix"),
    "soup": ("<body class='with-sidebar'><div id=top-menu><a>Home</a></div><div class=content><h1>Title</h1><div>First "
             "paragraph with many words</div><div class='ad-box'>Buy</div><p>Another one.</p><form>Mail</form></div>"
             "<div class=sidebar>side</div><div id=comments><p>" + "very long comment " * 30 + "</p></div>",
             "Title\nFirst paragraph with many words\nAnother one."),
    "cut": ("<nav>menu</nav><article><p>Some text and mo", "Some text and mo"),
    "cut tag": ("<article><p>Some text</p><a hre", "Some text"),
    "notice": ("<div class='cookie-notice'>We use cookies</div><main><p>Text of a page.</p></main>", "Text of a page."),
    "none": ("<nav>menu</nav>", ""), "plain": ("no tags at all", "no tags at all"), "empty": ("", ""), "null": (None, ""),
    "lt": ("<p>a &lt; b and 3 > 2 &am", "a < b and 3 > 2 &am"),
}


def test_extract_text(spark):
    rows = [(i, n, html, "x", 0) for i, (n, (html, _)) in enumerate(PAGES.items())]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    labelled = ("<html><body><nav><ul><li><a>a b c</a></ul></nav><article><h1>A b</h1>" + "<p>c d e f g</p>" * 9
                + "</article><footer>x y z</footer></body></html>")
    more = spark.createDataFrame([(100 + i, "", labelled, "x", 0) for i in range(30)], pages.schema)
    found = {r.url: r for r in html_text.extract_text(pages.unionByName(more)).collect() if r.page_id < 100}
    for name, (_, want) in PAGES.items():
        assert (found[name].text, found[name].n_chars) == (want, len(want)), name
    alone = html_text.extract_text(pages.where("url in ('plain', 'null', 'soup')")).collect()
    assert {r.url: r.text for r in alone} == {k: PAGES[k][1] for k in ("plain", "null", "soup")}
    assert html_text.extract_text(pages.where("false")).collect() == []


KEPT = {
    "section": ("<article><h1>T</h1><section id=discussion><h2>Discussion</h2><p>Text of it.</p></section></article>",
                "T\nDiscussion\nText of it."),
    "headings": ("<article><h1 class=entry-header>One</h1><h2 id=related-work>Two</h2><h2 class=section-header>Three</h2>"
                 "<p id=search>Four</p></article>", "One\nTwo\nThree\nFour"),
    "header": ("<article><header class=entry-header><h2>Title</h2></header><p>Text.</p></article>", "Title\nText."),
    "math": ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</p></article>", "Let x=2 be."),
    "closed": ("<article><p>One <svg width='1'/>two.</p><script src='a.js'/><p>Three.</p><svg><text>no</text></svg>"
               "<script src='b/c'></script><p>Four.</p></article>", "One two.\nThree.\nFour."),
    "dropped": ("<article><p>Text.</p><div class='ad-box'>Buy</div><div id=comments><h3>Comments</h3><p>Me too</p></div>"
                "<div class='cookie-notice wide'>We use</div><ul class=share><li><a>Tweet</a></li></ul><p>End.</p>"
                "</article>", "Text.\nEnd."),
    "unmarked": ("<body><div class=main-menu><a>Home</a></div><div class=content><h1>T</h1><p>Some text of it.</p>"
                 "<section id=discussion><h2>Discussion</h2><p>More text.</p></section><h2 class=header>End</h2></div>"
                 "<div class=left-sidebar>" + "side " * 40 + "</div>", "T\nSome text of it.\nDiscussion\nMore text.\nEnd"),
}


@pytest.mark.parametrize("name", KEPT)
def test_article_text_is_kept_whatever_its_class(name):
    labelled = ("<html><body><nav><ul><li><a>a b c</a></ul></nav><article><h1>A b</h1>" + "<p>c d e f g</p>" * 9
                + "</article><footer>x y z</footer><ul><li><a>u v</a></ul></body></html>")
    source, want = KEPT[name]
    assert html_text.main_text(source, html_text.weights(html_text.count_kinds(labelled))) == want


def test_best_region_matches_all_pairs():
    rng = random.Random(6)
    for _ in range(200):
        scores = [rng.randint(-5, 5) for _ in range(rng.randint(0, 14))]
        first, end = html_text.best_region(scores)
        best = max([0, *(sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))])
        assert sum(scores[first:end]) == best


def held(spark, scored, label):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", label)
    return scored.join(labels, "doc_id").where("held_out").collect()


def test_toxicity_on_held_out_rows(spark):
    # Insults of the invented languages are learnt from labels alone, so
    # this needs the larger table's labels.
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_toxicity(docs.join(labels, "doc_id", "left_semi"), labels)
    rows = rows.join(labels, "doc_id").where("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit >= 0.9 * sum(r.toxic for r in rows) and hit >= 0.95 * sum(r.predicted for r in rows)


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = held(spark, quality.score_quality(docs, labels), "quality")
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    kept = {r.doc_id for r in quality.drop_poor(docs, labels).collect()}
    assert sum(r.doc_id in kept for r in rows if r.quality) >= 0.97 * sum(r.quality for r in rows)


def test_poor_texts_of_null_and_repeated_ids_go_alone(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score_quality(docs, labels).select("doc_id", "predicted").join(docs, "doc_id").collect()
    good = [r.text for r in rows if r.predicted][:6]
    poor = [r.text for r in rows if not r.predicted][:2]
    assert len(set(good)) == 6 and len(set(poor)) == 2
    more = [(None, poor[0]), *[(None, t) for t in good[:3]], (-5, poor[1]), *[(-5, t) for t in good[3:]]]
    own = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, TEXT))
    left = quality.drop_poor(own, labels).where("doc_id is null or doc_id = -5").collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == sorted(
        [*[(0, t) for t in good[:3]], *[(-5, t) for t in good[3:]]])


@pytest.mark.parametrize("score", [toxicity.score_toxicity, quality.score_quality])
def test_classifiers_on_odd_tables(spark, score):
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(8)], "doc_id long, quality int, t boolean")
    labels = labels.select("doc_id", "quality", F.col("t").cast("int").alias("toxic"))
    texts = [None, "", "a", "good text here", "good text here", "x " * 50_000, "\u0000 �", "|| !!"]
    rows = score(clashing(spark, texts), labels).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    again = {r.doc_id: r.score for r in rows}
    assert again[3] == again[4]
    assert len(score(clashing(spark, texts), labels.where("false")).collect()) == len(texts)
    assert score(spark.createDataFrame([], CLASH), labels).collect() == []
    assert len(score(spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], TEXT), labels).collect()) == 3


def test_factorisation_machine_sums_all_pairs():
    rng = np.random.default_rng(1)
    inputs = quality.BUCKETS + len(quality.STATISTICS) * quality.BINS
    model = quality.Model(np.zeros((len(quality.STATISTICS), quality.BINS - 1)), 0.3,
                          rng.normal(size=inputs), rng.normal(size=(inputs, quality.RANK)))
    index, value, begins = quality._inputs(pa.array(["a b c", "", "d d e"]), model.edges)
    for n, margin in enumerate(quality._margins(index, value, begins, model)):
        i, x = index[begins[n]:begins[n + 1]], value[begins[n]:begins[n + 1]]
        want = model.bias + model.weights[i] @ x + sum(
            model.vectors[i[a]] @ model.vectors[i[b]] * x[a] * x[b] for a, b in itertools.combinations(range(len(i)), 2))
        assert abs(margin - want) < 1e-6


def test_label_model_finds_good_and_dependent_voters():
    rng = np.random.default_rng(2)
    truth = rng.random(3000) < 0.2

    def voter(hit, alarm):
        said = rng.random(len(truth)) < np.where(truth, hit, alarm)
        return said.astype(int)
    good = voter(0.8, 0.02)
    votes = np.column_stack([good, good, good, voter(0.75, 0.03), voter(0.7, 0.05), voter(0.3, 0.3)])
    annotated = voter(*toxicity.ANNOTATORS).astype(bool)  # as accurate as the model is told
    posterior = toxicity.label_model(votes, annotated)
    assert ((posterior > 0.5) == truth).mean() >= (annotated == truth).mean() > 0.95
    assert toxicity._spanning_tree(np.array([[0, 3, 1], [3, 0, 2], [1, 2, 0]])) == [-1, 0, 1]


@pytest.mark.parametrize("noise", [0.1, 0.2])
def test_label_model_learns_how_noisy_the_annotators_are(noise):
    rng = np.random.default_rng(2)
    truth = rng.random(3000) < 0.2

    def voter(hit, alarm):
        said = rng.random(len(truth)) < np.where(truth, hit, alarm)
        return said.astype(int)
    good = voter(0.8, 0.02)
    votes = np.column_stack([good, good, good, voter(0.75, 0.03), voter(0.7, 0.05), voter(0.3, 0.3)])
    annotated = np.where(rng.random(len(truth)) < noise, ~truth, truth)
    posterior = toxicity.label_model(votes, annotated)
    assert ((posterior > 0.5) == truth).mean() > 0.95


def test_forward_backward_in_chunks_is_exact(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(langid, "CHUNK", 3)
    for n in (1, 2, 3, 4, 5, 8):
        scores, step = rng.normal(size=(n + 2, 3)), rng.normal(size=(3, 3))
        got = langid.word_posteriors(scores, np.array([0, n, n, n + 2]), step)[:n]
        mass = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=n):
            weight = np.exp(sum(scores[t, y] for t, y in enumerate(path)) + sum(step[a, b] for a, b in itertools.pairwise(path)))
            for t, y in enumerate(path):
                mass[t, y] += weight
        assert np.allclose(got, mass / mass.sum(axis=1, keepdims=True))


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)


def test_language_of_odd_texts(spark):
    rng = random.Random(5)
    own = {"aa": ["tak", "tok", "kat"], "bb": ["mil", "lim", "nil"]}
    rows = [(i, " ".join(rng.choices(own[n], k=40)), n) for i, n in enumerate(["aa", "bb"] * 40)]
    rows += [(100, None, None), (101, "", None), (102, "12 -- 3", None), (103, "mil lim nil " * 9000, None),
             (104, "tak tok", None), (None, "nil", None), (103, "mil", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    found = {}
    for r in langid.identify(docs).collect():
        found.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert all(found[i] == [("und", 0.0)] for i in (100, 101, 102))
    assert [n for n, _ in found[103]] == ["bb", "bb"] and found[104][0][0] == "aa" and found[None][0][0] == "bb"
    assert all(n == found[i][0][0] for i, (_, _, n) in enumerate(rows[:80]))
    nothing = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert langid.identify(docs.where("false")).collect() == []
