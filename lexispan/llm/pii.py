"""Personal data: patterns propose spans, checksums confirm them and
nearby context words adjust a score. Native expressions throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.llm.common import let

# The base kinds in their listed order. The patterns find
# what the plain ones in PLAIN find; possessive repeats and the demand
# that a match starts where a run starts (or where the last match ended)
# only keep the search linear on long runs of one character class.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Characters of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC",
}


def _iban_of(length: int, countries: str) -> str:
    groups, rest = divmod(length - 4, 4)
    tail = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{groups}}}{tail}"


# Added kind: a country, two check digits and as many letters or digits
# as the country has, also in groups of four, confirmed by the mod-97
# checksum. What follows in capitals is no part of it.
IBAN = r"\b(?:" + "|".join(_iban_of(n, c) for n, c in IBAN_LENGTHS.items()) + r")\b"
# A character without which a kind cannot occur: rows without it skip the pattern.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "iban": None}
BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban"]

# A kind's score before context, and words near a span that
# raise it (the kind's own words) or lower it (words of examples).
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9}
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|host|server|address|login",
    "card": "card|visa|credit|payment|karte|tarjeta|carte",
    "phone": "phone|call|tel|mobile|fax|telefon|telefono",
    "iban": "iban|bank|account|konto|cuenta|compte",
}
EXAMPLES = "example|sample|test|version|beispiel|ejemplo|exemple"
CONTEXT_CHARS, RAISE, LOWER = 40, 0.2, 0.3


def _luhn(digits: Column) -> Column:
    """Luhn's check on a string of digits."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -1 - i, F.lit(1)).cast("int")
        twice = d * 2
        folded = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when(i % 2 == 1, folded).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)
    return total % 10 == 0


def _mod97(iban: Column) -> Column:
    """ISO 7064 check: first four characters moved to the end, letters
    as 10 to 35, remainder 1."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _confirmed(kind: str, match: Column) -> Column:
    """Whether a proposed span is kept."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        # Leading zeros aside, a part of over three digits is over 255.
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        fits = lambda p: (F.length(part(p)) <= 3) & (F.substring(part(p), 1, 3).cast("int") <= 255)
        return F.forall(F.split(match, r"\."), fits)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        plain = F.length(F.replace(match, F.lit(" "), F.lit("")))
        return F.when(plain.between(15, 34), _mod97(match)).otherwise(F.lit(False))
    return F.lit(True)


def _score(kind: str, before: Column, after: Column) -> Column:
    """Prior of the kind, moved by words in the text around the span, up
    to the kind's neighbouring matches."""
    near = F.lower(F.concat(F.right(before, F.lit(CONTEXT_CHARS)), F.lit(" "), F.left(after, F.lit(CONTEXT_CHARS))))
    up = F.when(near.rlike(rf"\b(?:{CONTEXT[kind]})"), RAISE).otherwise(0.0)
    down = F.when(near.rlike(rf"\b(?:{EXAMPLES})"), LOWER).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), F.lit(PRIOR[kind]) + up - down), 2)


#: Matches whose places are summed up together.
PLACE_BLOCK = 64


def _starts(before: Column, found: Column) -> Column:
    """Start of every match: the lengths of the matches before it and of
    the text between them, summed block by block so that the time is in
    proportion to the number of matches."""
    def length(i: Column) -> Column:
        return F.length(F.get(before, i)) + F.length(F.get(found, i))

    def summed(low: Column, high: Column) -> Column:
        # Up to, not with, high.
        return F.when(high > low, F.aggregate(F.sequence(low, high - 1), F.lit(0), lambda t, i: t + length(i))).otherwise(0)

    def bases(sums: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(sums, first, lambda acc, n: F.struct(
            (acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    n = F.size(found)
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / PLACE_BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: summed(b * PLACE_BLOCK, F.least((b + 1) * PLACE_BLOCK, n)))

    def place(base: Column) -> Column:
        def one(i: Column) -> Column:
            block = F.floor(i / PLACE_BLOCK).cast("int")
            return F.get(base, block) + summed(block * PLACE_BLOCK, i) + F.length(F.get(before, i))
        return F.transform(F.sequence(F.lit(0), n - 1), one)
    return F.when(n > 0, let(bases(sums), place)).otherwise(F.array().cast("array<int>"))


def _spans(kind: str, text: Column) -> Column:
    """Array of (start, kind number, end, match, score) of one kind.

    Text between matches and the matches themselves, taken by the same
    pattern, give every position by a running sum of lengths.
    """
    pattern = PATTERNS.get(kind, IBAN)
    number = KINDS.index(kind)

    def scored(parts: Column) -> Column:
        before, found = parts["before"], parts["found"]

        def one(start: Column, i: Column) -> Column:
            match = F.get(found, i)
            return F.struct(start.alias("start"), F.lit(number).alias("kind"), (start + F.length(match)).alias("end"),
                            match.alias("match"), i.alias("i"))
        spans = F.filter(F.transform(_starts(before, found), one), lambda s: _confirmed(kind, s["match"]))
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["match"].alias("match"),
            _score(kind, F.get(before, s["i"]), F.get(before, s["i"] + 1)).alias("score")))

    parts = F.struct(F.split(text, pattern, -1).alias("before"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,match:string,score:double>>")
    may = text.contains(NEEDS[kind]) if NEEDS[kind] else F.lit(True)
    if kind != "email":
        may = may & text.rlike("[0-9]")
    return F.when(may, let(parts, scored)).otherwise(none)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data, one row per input row.

    Returns doc_id and spans, an array of (start, kind, end, match,
    score) sorted by start, then kind in the order of ``KINDS``.
    Positions are code points, end exclusive. Null or empty text gives
    an empty array; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    for kind in KINDS:
        found = found.withColumn(f"_{kind}", _spans(kind, F.col("_text")))
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.concat(*[F.col(f"_{k}") for k in KINDS]))
    return found.select("doc_id", F.transform(ordered, lambda s: F.struct(
        s["start"].alias("start"), F.get(names, s["kind"]).alias("kind"), s["end"].alias("end"),
        s["match"].alias("match"), s["score"].alias("score"))).alias("spans"))


def pii_digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of ``find_pii``."""
    def joined(spans: Column, score: bool = False) -> Column:
        def label(s: Column) -> Column:
            parts = [s["kind"], s["start"].cast("string"), s["end"].cast("string")]
            return F.concat_ws(":", *parts, *([s["score"].cast("string")] if score else []))
        return F.concat_ws(",", F.transform(spans, label))
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), joined(F.col("spans"), True).alias("scored_spans"))
