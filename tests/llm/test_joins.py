"""License scan, cross-tokenizer alignment and periodic runs."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from lexispan.llm import alignment, licenses, queries, runs

CLASH = ("doc_id long, text string, row int, part int, words string, places int, runs string, label string, "
         "template int, id string, n_words int, best int, task int")
DATA = "/root/testdata/sf0.001"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "w", 3, "r", "l", 4, "id", 5, 6, 7) for i, t in rows], CLASH)


# Periodic runs

def plain_runs(words, shortest=24, exponent=3):
    best = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(shortest, exponent * q) and i > start:
                best.setdefault((start, i + q), q)
            i = max(i, start + 1)
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    letters, out = rng.choice([1, 2, 2, 3, 5]), []
    while len(out) < rng.choice([0, 30, 80, 200, 400]):
        if rng.random() < 0.6:
            period = [b"%d" % rng.randrange(letters) for _ in range(rng.randint(1, 12))]
            out += (period * 40)[:rng.randint(1, int(len(period) * rng.choice([1, 3.2, 5, 9])) + 1)]
        else:
            out += [b"%d" % rng.randrange(letters) for _ in range(rng.randint(1, 10))]
    return out


def test_maximal_pairs_are_the_runs():
    rng = random.Random(7)
    for _ in range(150):
        rows = [random_words(rng) for _ in range(rng.randint(1, 6))]
        shortest, exponent = rng.choice([(24, 3), (24, 3), (6, 3), (10, 4), (3, 3)])
        assert runs.text_runs(rows, shortest, exponent) == [plain_runs(r, shortest, exponent) for r in rows]


def test_one_word_for_a_whole_long_text():
    assert runs.text_runs([[b"a"] * 100_000, [b"a"] * 23, []]) == [[(0, 100_000, 1)], [], []]


def test_repeats_far_apart_cost_no_pairs():
    line = [b"%d" % i for i in range(30)]
    words = [w for i in range(4000) for w in (b"x%d" % i, *line)]
    assert runs.text_runs([words]) == [[]]


def test_run_query_against_plain_version(spark):
    rng = random.Random(3)
    texts = [None, "", " \t ", "a " * 40, "a b " * 30 + "c", *[b" ".join(random_words(rng)).decode() for _ in range(40)]]
    rows = [(i % 44, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    found = runs.run_digest(runs.find_runs(clashing(spark, rows))).collect()
    expected = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        own = plain_runs(words)
        gone = {i for s, n, q in own for i in range(s + q, s + n)}
        best = min(own, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        expected.append((doc_id, len(own), *best, own and 1000 * best[1] // best[2] or None,
                         hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in own).encode()).hexdigest(),
                         hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert runs.find_runs(clashing(spark, [])).count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(clashing(spark, []), exponent=2)


def test_looped_texts(spark):
    import zlib
    rows = [(i, " ".join(f"w{k}" for k in range(i % 60))) for i in range(300)] + [(None, "a b"), (10, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = docs.select("doc_id", "text", runs.looped(docs["doc_id"], docs["text"]).alias("made")).collect()
    changed = 0
    for doc_id, text, got in made:
        h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
        words, g = (text or "").split(), h // 10
        n = len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        assert got == (" ".join(words) if h % 10 == 0 else text or "")
    assert changed > 10


# Alignment

def plain_alignment(text, tools):
    a, b, bytes_a, bytes_b = tools
    if not text:
        return (0, 0, 0, 0, ""), []
    whole = (" " + text).encode()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    if b"".join(bytes_a[i] for i in ids_a) != whole or b"".join(bytes_b[i] for i in ids_b) != whole:
        return (0, 0, 0, 0, ""), []
    ends_a, ends_b = (np.cumsum([len(t[i]) for i in ids]) for t, ids in ((bytes_a, ids_a), (bytes_b, ids_b)))
    groups, links, at_a, at_b = [], [], 0, 0
    for end in np.intersect1d(ends_a, ends_b):
        to_a, to_b = np.searchsorted(ends_a, end, "right"), np.searchsorted(ends_b, end, "right")
        groups.append(",".join(map(str, ids_a[at_a:to_a])) + "|" + ",".join(map(str, ids_b[at_b:to_b])))
        links.append((ids_b[to_b - 1], ids_a[to_a - 1]))
        at_a, at_b = to_a, to_b
    digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
    return (len(ids_a), len(ids_b), len(groups), len(links), digest), links


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = alignment.tokenizer_paths()
    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    known = alignment._Aligned(path_a, path_b)
    return a, b, known.bytes_a, known.bytes_b


ODD = ["", None, " ", "\r", "a\r", " \r\n x", "a  b", "<|endoftext|> </s> <0x41>", "a▁b", "x\x00y", "日本 é é ﬁ",
       "don't stop...  \n\n\t go　on", "a\xa0b", "😀" * 40, "z" * 5000, "\n" * 300]


def test_texts_align_as_wholes(tools, monkeypatch):
    rng = random.Random(5)
    letters = "ab é.,;!1\n\t\r 　\xa0▁ 日本<s></s>\x00😀's"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    monkeypatch.setattr(alignment, "PIECE_CHARS", 11)
    monkeypatch.setattr(alignment, "REMEMBERED", 100)
    for text in texts:
        counts, links = alignment.aligned(text, *alignment.tokenizer_paths())
        plain, expected = plain_alignment(text, tools)
        assert counts == plain, text
        assert links.tolist() == [b << 32 | a for b, a in expected]


def test_packed_runs_round_trip(monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 1 << 50, 100))
    values = rng.integers(-5, 1 << 40, 100)
    back = alignment._unpacked(alignment._packed(keys, values), 2)
    assert (back[0] == keys).all() and (back[1] == values).all()


@pytest.mark.parametrize("fan_in", [2, 64])
def test_alignment_query_against_plain_version(spark, tools, monkeypatch, fan_in):
    source = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in source] + [(7, t) for t in ODD] + [(None, "the the the")] * 3
    plain = [(i, *plain_alignment(t, tools)) for i, t in rows]
    counts = Counter(link for _, _, links in plain for link in links)
    most = {}
    for (b, _), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    expected = [(i, *c[:4], sum(counts[k] == most[k[0]] for k in links), sum(counts[k] for k in links), c[4])
                for i, c, links in plain]
    # Small tasks: partitions of several copies of their counts.
    monkeypatch.setattr(alignment, "TASK_RECORDS", 500)
    found = alignment.align_documents(clashing(spark, rows).repartition(5), partitions=3, fan_in=fan_in).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_alignment_of_nothing(spark):
    assert alignment.align_documents(clashing(spark, [])).count() == 0
    only = alignment.align_documents(clashing(spark, [(1, None), (2, "")])).collect()
    assert sorted(map(tuple, only)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


# Licenses

def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_scan(text, templates, n_base):
    words, labels, base, places, score = plain_words(text), set(), set(), [], 0.0
    for n, t in enumerate(templates):
        own = plain_words(t.text)
        if t.phrase:
            at = [i for i in range(len(words)) if words[i:i + len(own)] == own]
            best = 1.0 if at else 0.0
            if n < n_base and at:
                places += at
                base.add(t.label)
        else:
            held = [len(set(own) & set(words[b:b + 2 * t.half])) for b in range(0, len(words), t.half)]
            best = max((h / len(set(own)) for h in held if h >= t.threshold * len(set(own)) - 1e-9), default=0.0)
        if best:
            labels.add(t.label)
            score = max(score, round(best, 6))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score)


def test_license_query_against_plain_version(spark):
    rng = random.Random(11)
    templates = [*licenses.BASE, *licenses.FURTHER]
    texts = [None, "", "UNDER The\tMIT-License.", "cc by nc cc by nc", "cc-by-nc" * 50, "éunder the mit license",
             "word " * 20_000 + "Apache License, Version 2.0 " + "word " * 3, "the mit license under"]
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 6)):
            words = rng.choice(templates).words
            kind = rng.random()
            if kind < 0.4:
                words = [w for w in words if rng.random() > rng.choice([0.05, 0.2, 0.4])]
            elif kind < 0.6:
                words = rng.choices("the of and license free software x y z".split(), k=rng.randint(0, 40))
            parts.append(rng.choice([" ", "\n", ", "]).join(words))
        texts.append(" ".join(parts))
    rows = [(i // 2, t) for i, t in enumerate(texts)]
    found = licenses.scan_licenses(clashing(spark, rows)).collect()
    expected = [(i, *plain_scan(t, templates, len(licenses.BASE))) for i, t in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert licenses.scan_licenses(clashing(spark, [])).count() == 0


def test_blocks_that_hold_a_template(spark):
    text = "intro " * 100 + next(t.text for t in licenses.FURTHER if t.label == "isc")
    read = licenses.template_words(clashing(spark, [(1, text)]), licenses.FURTHER)
    found = licenses.template_matches(read, licenses.FURTHER).where("label = 'isc'").collect()
    assert max(r.containment for r in found) == 1.0
    assert {(r.first_word, r.last_word) for r in found if r.containment == 1.0} == {(100, 100 + 36)}


def test_registered():
    assert {"op11_licenses", "op12_alignment", "op13_runs"} <= set(queries.QUERIES)
    assert {"op11_licenses", "op13_runs"} <= set(queries.SQL)
