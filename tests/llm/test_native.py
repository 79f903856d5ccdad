"""Native operators: exact dedup, sharding, personal data, decontamination."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lexispan.llm import decontamination as dc
from lexispan.llm import exact_dedup as ed
from lexispan.llm import pii
from lexispan.llm import sharding as sh

TEXT = "doc_id long, text string"
#: Extra columns whose names clash with those the operators use.
CLASH = "doc_id long, text string, kept string, bucket int, shard int, id string, uid long, spans int, lang string"


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), TEXT)


def clashing(spark, texts):
    rows = [(i, t, "x", 1, 2, "id", 3, 4, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, CLASH)


def equal_texts(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    return groups


TEXTS = ["a", "b", "a", None, "", "ab" * 40, "ab" * 40, "ab" * 39 + "ba", "é" * 30, "é" * 30, "x" * 33, "long " * 900,
         "long " * 900, "long " * 899 + "lonG "]


@pytest.mark.parametrize("buckets", [None, 3, 1])
def test_exact_dedup_names_without_collisions(spark, buckets):
    # Three buckets or one for everything: ranks alone tell texts apart.
    bucket = F.xxhash64 if buckets is None else (lambda *c: F.pmod(F.xxhash64(*c), F.lit(buckets)).cast("long"))
    size = 16 if buckets is None else 900
    found = ed.exact_dedup(clashing(spark, TEXTS), block_bytes=size, bucket=bucket).collect()
    groups = equal_texts(enumerate(TEXTS))
    assert len(found) == len(TEXTS)
    for r in found:
        same = groups[TEXTS[r.doc_id] or ""]
        digest = hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest()
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (
            max(same), len(same), r.doc_id == max(same), digest)


def test_exact_dedup_ranks_every_level(spark):
    texts = ["aabb", "aabc", "abbb", "aabb", "bbaa", "aabbaabb", "aabbaab", "aabbaabc"]
    found = ed.exact_dedup(table(spark, texts), block_bytes=1, bucket=lambda *c: F.lit(7).cast("long")).collect()
    groups = equal_texts(enumerate(texts))
    assert {r.doc_id: r.group_size for r in found} == {i: len(groups[t]) for i, t in enumerate(texts)}


def test_exact_dedup_repeated_rows_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b"), (2, "c"), (2, "d")]
    docs = spark.createDataFrame(rows, TEXT)
    found = ed.exact_dedup(docs).collect()
    assert sum(r.kept for r in found) == 4 and len(found) == 7
    assert sorted((str(r.keep_id), r.group_size) for r in found if r.kept) == [
        ("1", 3), ("2", 1), ("2", 1), ("None", 2)]
    stays = ed.drop_copies(docs).collect()
    assert sorted((str(r.doc_id), r.text) for r in stays) == [("1", "a"), ("2", "c"), ("2", "d"), ("None", "b")]


def test_exact_dedup_empty_table(spark):
    assert ed.exact_dedup(spark.createDataFrame([], TEXT)).collect() == []
    assert ed.drop_copies(spark.createDataFrame([], CLASH)).collect() == []


def jump(key, shards):
    """Jump consistent hash, straight from its definition."""
    b, j, key = -1, 0, key & (2**64 - 1)
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 16, 100])
def test_jump_shards_match_definition(spark, shards):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *random.Random(5).sample(range(10**12), 200)]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sh.jump_shards(F.col("k"), shards).alias("s"))
    assert all((r.s.shard, r.s.grown) == (jump(r.k, shards), jump(r.k, shards + 1)) for r in rows.collect())


def test_shards_move_only_into_the_new_one(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = sh.shard_documents(docs).collect()
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert all(r.grown_shard == 16 for r in moved) and 150 < len(moved) < 330
    for shard in range(16):
        slots = sorted((r.slot, r.doc_id) for r in rows if r.shard == shard)
        assert [s for s, _ in slots] == list(range(len(slots))) and 180 < len(slots) < 320
        assert [i for _, i in slots] == sorted(i for _, i in slots)


def test_shards_of_nulls_repeats_and_extra_columns(spark):
    texts = [None, "", "é", "same", "same"]
    rows = sh.shard_documents(clashing(spark, texts)).collect()
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.shard) == (len(raw) + 1, zlib.crc32(raw), jump(r.doc_id, 16))
    again = spark.createDataFrame([(None, "a"), (None, "a"), (0, None), (0, None)], TEXT)
    rows = sh.shard_documents(again).collect()
    assert {r.shard for r in rows} == {jump(0, 16)} and sorted(r.slot for r in rows) == [0, 1, 2, 3]
    assert sh.shard_documents(spark.createDataFrame([], TEXT)).collect() == []


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    found = []
    for n, (kind, pattern) in enumerate(pii.PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                found.append((m.start(), n, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


PIECES = ["a@b.c", "a.b@c-d.e.f", "x@y", "@", "%", "a@b.c%x@d.e", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0001.02.3.4",
          "4111 1111 1111 1111", "4111111111111112", "4111-1111-1111-1111", "+1 (706) 555-3138", "+49 30 1234567",
          "+1", "++12345678901", "12", " ", " ", "\n", "é", "日本", "\U0001f600", ".", "DE89370400440532013000",
          "GB82 WEST 1234 5698 7654 32", "DE89370400440532013001", "word", "99999999999999999999"]


def test_spans_match_plain_patterns(spark):
    rng = random.Random(3)
    texts = [None, "", *["".join(rng.choices(PIECES, k=rng.randint(1, 14))) for _ in range(400)]]
    for r in pii.pii_digest(pii.find_pii(clashing(spark, texts))).collect():
        want = base_spans(texts[r.doc_id] or "")
        mine = [s for s in r.spans.split(",") if s and not s.startswith("iban")]
        assert mine == want, texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        kinds = [s.split(":")[0] for s in want]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in pii.BASE]


def test_spans_iban_and_context(spark):
    texts = ["pay to IBAN DE89370400440532013000 now", "code DE89370400440532013001 here",
             "GB82 WEST 1234 5698 7654 32", "call my mobile +1 706 555 3138", "for example +1 706 555 3138"]
    found = {r.doc_id: r.spans for r in pii.find_pii(table(spark, texts)).collect()}
    assert [s.kind for s in found[0]] == ["iban"] and found[0][0].match == "DE89370400440532013000"
    assert [s.kind for s in found[1]] == [] and [s.kind for s in found[2]] == ["iban"]
    assert found[3][0].score > found[4][0].score


def test_spans_of_long_runs_are_linear(spark):
    n = 20_000
    texts = ["a" * n, "1" * n, "1." * n, "a." * n + "@", "x@" + "a." * n, "+1" + "(" * n, "1 " * n]
    rows = pii.pii_digest(pii.find_pii(table(spark, texts))).collect()
    assert len(rows) == len(texts)
    assert pii.find_pii(spark.createDataFrame([], TEXT)).collect() == []


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))}


def test_contaminated_matches_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 40))) for _ in range(25)] + [None, "", " ", "W1 w2"]
    texts = [None, "", "w1 w2"]
    for _ in range(120):
        words = rng.choices(vocabulary, k=rng.randint(1, 300))
        if rng.random() < 0.7 and (item := (rng.choice(items) or "").split()):
            for _ in range(rng.randint(0, 2)):
                item[rng.randrange(len(item))] = "changed"
            at = rng.randrange(len(words))
            words[at:at] = item
        texts.append(" ".join(words).upper() if rng.random() < 0.2 else " ".join(words))
    texts += ["w9 " * 3000 + (items[0] + " ") * 3]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    want = set()
    for i, text in enumerate(texts):
        for j, item in enumerate(items):
            sets = shingle_set(text), shingle_set(item)
            if sets[1] and len(sets[0] & sets[1]) * 100 >= len(sets[1]) * 75:
                want.add((i, j, len(sets[1]), len(sets[0] & sets[1])))
    docs = clashing(spark, texts)
    found = {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in dc.contaminated(docs, benchmark).collect()}
    assert found == want and len(want) > 20
    left = {r.doc_id for r in dc.drop_contaminated(docs, benchmark).collect()}
    assert left == set(range(len(texts))) - {w[0] for w in want}


def test_contaminated_empty_tables(spark):
    none, one = spark.createDataFrame([], TEXT), table(spark, ["a b c d e f"])
    items = one.withColumnRenamed("doc_id", "item_id")
    assert dc.contaminated(none, items).collect() == []
    assert dc.contaminated(one, items.where("false")).collect() == []
    assert len(dc.contaminated(one.unionByName(one), items).collect()) == 1
    assert dc.drop_contaminated(one, items.where("false")).count() == 1
