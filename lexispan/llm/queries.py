"""Registered queries of the operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexispan.llm import alignment as _al
from lexispan.llm import decontamination as _dc
from lexispan.llm import exact_dedup as _ed
from lexispan.llm import html_text as _ht
from lexispan.llm import langid as _li
from lexispan.llm import licenses as _lc
from lexispan.llm import near_dedup as _nd
from lexispan.llm import packing as _pk
from lexispan.llm import pii as _pii
from lexispan.llm import quality as _ql
from lexispan.llm import runs as _rn
from lexispan.llm import sharding as _sh
from lexispan.llm import toxicity as _tx
from lexispan.llm.common import read_table, with_workers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with_workers(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@_register
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a weakly supervised classifier."""
    return _tx.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_register
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents by block naming."""
    return _ed.exact_dedup(read_table(spark, sf_dir, "documents"))


SQL["op2_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_register
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return _pk.pack_documents(read_table(spark, sf_dir, "documents"))


@_register
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    found = _dc.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


SQL["op4_decontamination"] = """
WITH words AS (
  SELECT 0 AS side, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w
  FROM documents
  UNION ALL
  SELECT 1, item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') FROM benchmark
), widths AS (
  SELECT DISTINCT CAST(least(len(w), 5) AS BIGINT) AS k FROM words WHERE side = 1 AND len(w) > 0 UNION SELECT 5
), shingles AS (
  SELECT DISTINCT side, id, unnest(list_transform(
           range(1, greatest(len(w) - k + 2, 2)), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
  FROM words JOIN widths ON side = 0 OR k = least(len(w), 5) WHERE len(w) > 0
), items AS (
  SELECT id AS item_id, s, count(*) OVER (PARTITION BY id) AS n_item FROM shingles WHERE side = 1
)
SELECT d.id AS doc_id, i.item_id, CAST(any_value(i.n_item) AS INTEGER) AS n_item,
       CAST(count(*) AS INTEGER) AS n_shared, round(count(*) / any_value(i.n_item), 6) AS containment
FROM items i JOIN shingles d ON d.side = 0 AND d.s = i.s
GROUP BY d.id, i.item_id
HAVING count(*) * 100 >= any_value(i.n_item) * 75
"""


@_register
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 16 shards by jump consistent hashing of the id."""
    return _sh.shard_documents(read_table(spark, sf_dir, "documents"))


SQL["op5_sharding"] = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(0, 8), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END,
              CAST(i AS BIGINT)) ORDER BY i) AS t FROM range(0, 256) r(i)),
d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS raw FROM documents),
sums AS (
  SELECT r, doc_id, CAST(octet_length(raw) + 1 AS BIGINT) AS size,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
           regexp_extract_all(hex(raw), '..'), lambda b: CAST('0x' || b AS BIGINT))),
           lambda c, x: xor(c // 256, t[1 + xor(c, x) % 256])), 4294967295) AS crc
  FROM d, crc_table),
jumps AS (
  SELECT r, (CAST(coalesce(doc_id, 0) AS HUGEINT) + 18446744073709551616) % 18446744073709551616 AS state,
         CAST(0 AS BIGINT) AS jump, 0 AS shard, 0 AS grown
  FROM d
  UNION ALL
  SELECT r, (state * 2862933555777941757 + 1) % 18446744073709551616,
         CAST(floor((jump + 1) * (CAST(2147483648 AS DOUBLE) / CAST(
           ((state * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592 + 1 AS DOUBLE))) AS BIGINT),
         CASE WHEN jump < 16 THEN jump ELSE shard END, jump
  FROM jumps WHERE jump <= 16),
ended AS (SELECT r, CAST(max(shard) AS INTEGER) AS shard, CAST(max(grown) AS INTEGER) AS grown_shard FROM jumps GROUP BY r)
SELECT doc_id, size, crc AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, crc) - 1 AS slot, grown_shard
FROM sums JOIN ended USING (r)
"""


@_register
def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a conditional random field."""
    return _li.identify(read_table(spark, sf_dir, "documents"))


@_register
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents by SetSketch registers."""
    return _nd.near_dedup(read_table(spark, sf_dir, "documents"))


@_register
def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by maximum-scoring subsequence."""
    return _ht.extract_text(read_table(spark, sf_dir, "pages"))


@_register
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data of every document."""
    return _pii.pii_digest(_pii.find_pii(read_table(spark, sf_dir, "documents")))


@_register
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a factorisation machine."""
    return _ql.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_register
def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document by a set-similarity join."""
    return _lc.scan_licenses(read_table(spark, sf_dir, "documents"))


@_register
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two tokenizers, linked and counted."""
    return _al.align_documents(read_table(spark, sf_dir, "documents"))


@_register
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, a tenth made to repeat."""
    docs = read_table(spark, sf_dir, "documents")
    return _rn.run_digest(_rn.find_runs(docs.select("doc_id", _rn.looped(docs["doc_id"], docs["text"]).alias("text"))))


def _license_sql() -> str:
    """Every template against every block, and every place of a phrase."""
    templates = [*_lc.BASE, *_lc.FURTHER]

    def listed(words: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = ", ".join(f"({n}, '{t.label}', {t.half}, {t.need}, {t.phrase}, {listed(t.words)}, {listed(sorted(set(t.words)))})"
                     for n, t in enumerate(templates))
    return f"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
templates(n, label, half, need, phrase, seq, own) AS (VALUES {rows}),
starts AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM t),
places AS (
  SELECT r, n, label, i - 1 AS place FROM starts JOIN templates ON w[i] = seq[1] AND phrase
  WHERE w[i:i + len(seq) - 1] = seq),
halves AS (SELECT DISTINCT half FROM templates WHERE NOT phrase),
blocks AS (
  SELECT r, half, list_distinct(w[b + 1:b + 2 * half]) AS held
  FROM (SELECT r, half, w, unnest(range(0, len(w), half)) AS b FROM t, halves)),
holds AS (
  SELECT r, n, label, round(len(list_intersect(held, own)) / len(own), 6) AS containment
  FROM blocks JOIN templates USING (half) WHERE NOT phrase AND len(list_intersect(held, own)) >= need),
found AS (
  SELECT r, n, label, place, 1.0 AS containment FROM places
  UNION ALL SELECT r, n, label, NULL, containment FROM holds)
SELECT doc_id, CAST(len(any_value(w)) AS BIGINT) AS n_words,
       count(*) FILTER (n < {len(_lc.BASE)}) AS n_base,
       min(place) FILTER (n < {len(_lc.BASE)}) AS first_word, max(place) FILTER (n < {len(_lc.BASE)}) AS last_word,
       coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (n < {len(_lc.BASE)})), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (n >= 0)), ','), '') AS labels,
       CAST(coalesce(max(containment), 0) AS DOUBLE) AS score
FROM t LEFT JOIN found USING (r) GROUP BY r, doc_id
"""


SQL["op11_licenses"] = _license_sql()

#: Places that share their first 16 words, by distance: stretches of such
#: places one after the other are the maximal repeats.
SQL["op13_runs"] = """
WITH crc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         xor(list_reduce(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
                                        lambda k: CAST(ord(CAST(doc_id AS VARCHAR)[k]) AS BIGINT)),
             lambda c, x: list_reduce(range(0, 8), lambda v, k:
               CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, xor(c, x)),
             CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM documents),
split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, h // 10 AS g FROM crc),
shape AS (SELECT *, len(w) AS n, g % greatest(len(w), 1) AS a FROM split),
t AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(0, n), lambda i:
           w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w
  FROM shape),
places AS (SELECT r, n, unnest(range(0, n - 15)) AS i, w FROM t WHERE n >= 24),
keyed AS (SELECT r, n, i, md5(array_to_string(w[i + 1:i + 16], ' ')) AS s FROM places),
pairs AS (
  SELECT a.r, a.i, b.i - a.i AS q FROM keyed a JOIN keyed b ON a.r = b.r AND a.s = b.s AND b.i > a.i
  WHERE 3 * (b.i - a.i) <= a.n),
stretches AS (
  SELECT r, q, min(i) AS s, max(i) - min(i) + 16 AS l
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs)
  GROUP BY r, q, island),
runs AS (
  SELECT r, s, l + q AS length, min(q) AS period
  FROM (SELECT r, s, l, q FROM stretches WHERE l >= 2 * q AND l + q >= 24) GROUP BY r, s, l + q),
best AS (
  SELECT r, count(*) AS n_runs, arg_min(struct_pack(s, length, period), struct_pack(o := -length / period, s, period)) AS b,
         string_agg(s || ',' || length || ',' || period || chr(10), '' ORDER BY s, period) AS lines
  FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + period, s + length)) AS i FROM runs),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS text
  FROM (SELECT r, unnest(range(0, n)) AS i, unnest(w) AS word FROM t) LEFT JOIN gone USING (r, i)
  WHERE gone.r IS NULL GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.length AS length, b.period AS period,
       1000 * b.length // b.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM t LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""


def _pii_sql() -> str:
    """Spans by running sums of the lengths of matches and of the text
    between them, as ``find_pii`` defines them."""
    found = " UNION ALL ".join(
        f"SELECT doc_id, {n} AS kind, '{kind}' AS name, regexp_extract_all(text, '{pattern}', 0) AS f, "
        f"regexp_split_to_array(text, '{pattern}') AS b FROM t"
        for n, (kind, pattern) in enumerate({**_pii.PLAIN, "iban": _pii.IBAN}.items()))
    pick = lambda values: "[" + ", ".join(values) + "][kind + 1]"
    prior = pick(str(_pii.PRIOR[k]) for k in _pii.KINDS)
    words = pick(f"'{_pii.CONTEXT[k]}'" for k in _pii.KINDS)
    n = _pii.CONTEXT_CHARS
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({found}),
each AS (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM found WHERE len(f) > 0),
placed AS (
  SELECT doc_id, kind, name, f[i] AS m, lower(right(b[i], {n}) || ' ' || left(b[i + 1], {n})) AS near,
         CAST(list_sum(list_transform(b[1:i], lambda x: length(x)))
              + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
  FROM each),
parts AS (
  SELECT *, s + length(m) AS e, regexp_replace(m, '[^0-9]', '', 'g') AS d, replace(m, ' ', '') AS p FROM placed),
sums AS (
  SELECT *, list_sum(list_transform(range(0, length(d)), lambda k:
             CASE WHEN k % 2 = 0 THEN CAST(d[length(d) - k] AS INT)
                  WHEN CAST(d[length(d) - k] AS INT) > 4 THEN CAST(d[length(d) - k] AS INT) * 2 - 9
                  ELSE CAST(d[length(d) - k] AS INT) * 2 END)) AS luhn,
         list_reduce(list_prepend(0, list_transform(string_split(p[5:] || p[1:4], ''), lambda c:
             CASE WHEN ord(c) >= 65 THEN ord(c) - 55 ELSE ord(c) - 48 END)),
             lambda a, x: CASE WHEN x >= 10 THEN (a * 100 + x) % 97 ELSE (a * 10 + x) % 97 END) AS rest
  FROM parts),
good AS (
  SELECT * FROM sums WHERE CASE kind
    WHEN 1 THEN list_bool_and(list_transform(string_split(m, '.'), lambda x:
                length(ltrim(x, '0')) <= 3 AND CAST('0' || ltrim(x, '0') AS HUGEINT) <= 255))
    WHEN 2 THEN length(d) BETWEEN 14 AND 19 AND luhn % 10 = 0
    WHEN 3 THEN length(d) BETWEEN 10 AND 15
    WHEN 4 THEN length(p) BETWEEN 15 AND 34 AND rest = 1 ELSE true END),
scored AS (
  SELECT doc_id, kind, name, s, e, name || ':' || s || ':' || e AS label,
         round(least(1.0, CAST({prior} AS DOUBLE)
           + CASE WHEN regexp_matches(near, '\\b(?:' || {words} || ')') THEN {_pii.RAISE} ELSE 0 END
           - CASE WHEN regexp_matches(near, '\\b(?:{_pii.EXAMPLES})') THEN {_pii.LOWER} ELSE 0 END), 2) AS score
  FROM good)
SELECT t.doc_id, count(*) FILTER (name = 'email') AS n_email, count(*) FILTER (name = 'ip') AS n_ip,
       count(*) FILTER (name = 'card') AS n_card, count(*) FILTER (name = 'phone') AS n_phone,
       sha256(coalesce(string_agg(label, ',' ORDER BY s, kind) FILTER (kind < 4), '')) AS base_sha256,
       coalesce(string_agg(label, ',' ORDER BY s, kind), '') AS spans,
       coalesce(string_agg(label || ':' || CAST(CAST(score AS DOUBLE) AS VARCHAR), ',' ORDER BY s, kind), '')
         AS scored_spans
FROM t LEFT JOIN scored USING (doc_id) GROUP BY t.doc_id
"""


SQL["op9_pii"] = _pii_sql()
