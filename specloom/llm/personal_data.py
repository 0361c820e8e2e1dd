"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

Built-in functions only; nothing is shuffled.  ``RULES`` is a table: what a
pattern proposes is dropped if its check fails; what is left has the rule's
score, and more if a context word stands close by.  Matches of the base rules
stay whatever their score, others from ``LEAST_SCORE`` on.

Matches of one rule are leftmost and do not overlap, and a match that fails its
check is dropped without trying a shorter one.  They are found by cutting the
text at the pattern: the lengths of the matches and of what stands between them
give all positions in one pass over the text.  Patterns are written so that no
text makes them quadratic or deep: runs are taken whole, from where they begin.

Defined results: a null text is like an empty one and has no spans; repeated
rows keep their row; a null doc_id stays null; further columns are not looked
at.  Memory is that of one text and its matches; very long texts are searched
whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds, in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
#: What a span of a rule that is not a base rule needs.
LEAST_SCORE = 0.5
#: Code points before and after a match in which context words count.
BEFORE, AFTER = 40, 20
#: Matches whose positions are summed up at a time.
_BLOCK = 128

# Length of account numbers by country.
IBAN_LENGTHS = {
    15: ("NO",), 16: ("BE",), 18: ("DK", "FI", "FO", "GL", "NL", "SD"), 19: ("MK", "SI"),
    20: ("AT", "BA", "EE", "KZ", "LT", "LU", "XK"), 21: ("CH", "HR", "LI", "LV"),
    22: ("BG", "BH", "CR", "DE", "GB", "GE", "IE", "ME", "RS", "VA"), 23: ("AE", "GI", "IL", "IQ", "OM", "SO", "TL"),
    24: ("AD", "CZ", "ES", "MD", "PK", "RO", "SA", "SE", "SK", "TN", "VG"), 25: ("LY", "PT", "ST"), 26: ("IS", "TR"),
    27: ("BI", "DJ", "FR", "GR", "IT", "MC", "SM"), 28: ("AL", "AZ", "BY", "CY", "DO", "GT", "HU", "LB", "NI", "PL", "SV"),
    29: ("BR", "EG", "PS", "QA", "UA"), 30: ("JO", "KW", "MU"), 31: ("MT", "SC"), 32: ("LC",), 33: ("RU",),
}

# Words that speak for a kind when they begin close to a match, in lower case.
CARD_WORDS = r"(^|[^a-z])(card|credit|debit|visa|amex|mastercard|kreditkarte|carte|tarjeta)"
PHONE_WORDS = r"(^|[^a-z])(phone|tel[.: ]|telef|telep|t\x{e9}l|tel\x{e9}f|call|mobil|m\x{f3}vil|handy|fax|cell)"
IBAN_WORDS = r"(^|[^a-z])(iban|bank|account|konto|compte|cuenta)"
SSN_WORDS = r"(^|[^a-z])(ssn|social)"
MAIL_WORDS = r"(^|[^a-z])(mail|e-mail|email|contact|write|courriel|correo)"
IP_WORDS = r"(^|[^a-z])(ip|host|server|address|login|adresse)"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is what is searched; ``plain`` says the same without possessive and looking-back parts."""

    kind: str
    pattern: str
    plain: str
    #: characters without one of which a text has no match
    needs: str
    check: str
    score: float
    words: str
    bonus: float
    base: bool = False
    #: the match must not touch letters, digits or number parts
    apart: bool = False


_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_IBAN = "(?:" + "|".join(
    rf"(?:{'|'.join(names)})[0-9][0-9](?:[\x20-]?[A-Z0-9]){{{length - 4}}}" for length, names in IBAN_LENGTHS.items()
) + ")"
_NATIONAL = r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"
_SSN = "[0-9]{3}-[0-9]{2}-[0-9]{4}"

RULES = (
    Rule("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
         rf"{_LOCAL}+@{_LABEL}+(\.{_LABEL}+)+", "@", "any", 0.9, MAIL_WORDS, 0.1, base=True),
    Rule("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", ".", "octets", 0.6, IP_WORDS, 0.3, base=True),
    Rule("card", r"[0-9](?:[\x20-]?[0-9]){15,}+",
         r"[0-9]([\x20-]?[0-9])+", "0123456789", "luhn 16 19", 0.8, CARD_WORDS, 0.2, base=True),
    Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         r"\+[0-9][\x20().0-9-]+[0-9]", "+", "digits 8 15", 0.6, PHONE_WORDS, 0.3, base=True),
    Rule("card", r"[0-9](?:[\x20-]?[0-9]){12,}+",
         r"[0-9]([\x20-]?[0-9])+", "0123456789", "luhn 13 15", 0.3, CARD_WORDS, 0.4, apart=True),
    Rule("phone", _NATIONAL, _NATIONAL, "0123456789", "any", 0.3, PHONE_WORDS, 0.4, apart=True),
    Rule("iban", _IBAN, _IBAN, "0123456789", "mod 97", 0.8, IBAN_WORDS, 0.2, apart=True),
    Rule("ssn", _SSN, _SSN, "-", "ssn", 0.3, SSN_WORDS, 0.4, apart=True),
)

_OCTET = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
OCTETS = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"
NO_SSN = "^(000|666|9[0-9][0-9])|-00-|-0000$"
#: What must not stand before and after a match that has to stand apart.
TOUCHES_BEFORE, TOUCHES_AFTER = r"([A-Za-z_@]|[0-9+][\x20().-]{0,8})$", r"^([A-Za-z_@]|[\x20().-]{0,8}[0-9])"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _remainder_97(found: Column) -> Column:
    """Of an account number with its first four characters at the end, letters as 10 to 35."""
    plain = F.regexp_replace(found, r"[\x20-]", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    return F.aggregate(
        F.split(moved, ""), F.lit(0),
        lambda acc, c: F.when(c < "A", (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97),
    )


def _passes(check: str, found: Column) -> Column:
    name, *bounds = check.split(" ")
    if name == "octets":
        return found.rlike(OCTETS)
    if name == "luhn":
        digits = _digits(found)
        return F.when(F.length(digits).between(*map(int, bounds)), F.call_function("luhn_check", digits)).otherwise(False)
    if name == "digits":
        return F.length(_digits(found)).between(*map(int, bounds))
    if name == "mod":
        return _remainder_97(found) == 1
    if name == "ssn":
        return ~found.rlike(NO_SSN)
    return F.lit(True)


def _running(values: Column) -> Column:
    """Sums of the values up to and including each, a block at a time so that long arrays are not copied each step."""

    def sums(block: Column) -> Column:
        return F.aggregate(
            block, F.array().cast("array<long>"),
            lambda acc, x: F.array_append(acc, F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + F.coalesce(x, F.lit(0))),
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK)), lambda b: sums(F.slice(values, b * _BLOCK + 1, _BLOCK))
    )
    totals = sums(F.transform(blocks, lambda b: F.element_at(b, -1)))
    placed = F.transform(
        F.arrays_zip(blocks.alias("b"), totals.alias("t")),
        lambda z: F.transform(z["b"], lambda x: x + z["t"] - F.element_at(z["b"], -1)),
    )
    return F.when(F.size(values) > 0, F.flatten(placed)).otherwise(F.array().cast("array<long>"))


def _lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _lengths(found: str, between: str) -> Column:
    """How far it is from the end of one match to the end of the next; null for what follows the last one."""
    return F.zip_with(found, between, lambda x, g: (F.length(x) + F.length(g)).cast("long"))


def _spans(rule: Rule, found: str, between: str, ends: str) -> Column:
    """Spans of a rule from the columns of its matches, of what stands between them, and of where they end.

    Columns are zipped, not looked up by place: a lookup inside a lambda would
    have its column worked out again for each element where Spark moves it there.
    """
    at = F.arrays_zip(
        F.col(found).alias("x"), F.col(ends).alias("end"), F.col(between).alias("before"),
        F.slice(between, 2, F.greatest(F.size(between) - 1, F.lit(0))).alias("after"),
    )
    passed = F.filter(at, lambda s: s["x"].isNotNull() & _passes(rule.check, s["x"]))
    if rule.apart:
        passed = F.filter(
            passed,
            lambda s: ~F.right(s["before"], F.lit(BEFORE)).rlike(TOUCHES_BEFORE)
            & ~F.left(s["after"], F.lit(AFTER)).rlike(TOUCHES_AFTER),
        )

    def scored(s: Column) -> Column:
        near = _lowered(F.right(s["before"], F.lit(BEFORE))).rlike(rule.words) | _lowered(
            F.left(s["after"], F.lit(AFTER))
        ).rlike(rule.words)
        return F.struct(
            F.lit(KINDS.index(rule.kind)).alias("place"),
            (s["end"] - F.length(s["x"])).cast("long").alias("start"),
            s["end"].cast("long").alias("end"),
            F.lit(rule.kind).alias("kind"),
            F.when(near, round(rule.score + rule.bonus, 3)).otherwise(rule.score).alias("score"),
            F.lit(rule.base).alias("base"),
            s["x"].alias("text"),
        )

    spans = F.transform(passed, scored)
    return spans if rule.base else F.filter(spans, lambda s: s["score"] >= LEAST_SCORE)


def find_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and ``spans``: place of the kind, start, end (exclusive, in code points), kind, score, base, text."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    cut = []
    for i, rule in enumerate(rules):
        possible = F.col("text").contains(rule.needs) if len(rule.needs) == 1 else F.col("text").rlike(f"[{rule.needs}]")
        cut.append(F.when(possible, F.regexp_extract_all("text", F.lit(rule.pattern), 0)).otherwise(none).alias(f"x{i}"))
    found = text.select("*", *cut)
    numbers = range(len(rules))
    parted = found.select(
        "doc_id", *[f"x{i}" for i in numbers],
        *[
            F.when(F.size(f"x{i}") > 0, F.split("text", rule.pattern, -1)).otherwise(none).alias(f"g{i}")
            for i, rule in enumerate(rules)
        ],
    )
    steps = parted.select("*", *[_lengths(f"x{i}", f"g{i}").alias(f"l{i}") for i in numbers])
    placed = steps.select("*", *[_running(F.col(f"l{i}")).alias(f"e{i}") for i in numbers])
    spans = [_spans(rule, f"x{i}", f"g{i}", f"e{i}") for i, rule in enumerate(rules)]
    return placed.select("doc_id", F.sort_array(F.concat(*spans)).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, number of base spans of each base kind, digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])

    def counted(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", "spans", base.alias("base")).select(
        "doc_id", *map(counted, ("email", "ip", "card", "phone")),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )


def _sql_check(check: str) -> str:
    name, *bounds = check.split(" ")
    digits = "regexp_replace(x, '[^0-9]', '', 'g')"
    if name == "octets":
        parts = " AND ".join(f"CAST(split_part(x, '.', {i}) AS HUGEINT) <= 255" for i in (1, 2, 3, 4))
        return f"(CASE WHEN regexp_matches(x, '[0-9]{{30}}') THEN regexp_matches(x, '{OCTETS}') ELSE {parts} END)"
    if name == "luhn":
        total = (
            f"list_sum([CASE WHEN i % 2 = 1 THEN CAST(reverse({digits})[i] AS INT) ELSE "
            f"CAST(reverse({digits})[i] AS INT) * 2 - CASE WHEN reverse({digits})[i] > '4' THEN 9 ELSE 0 END END "
            f"for i in range(1, length({digits}) + 1)])"
        )
        return f"(length({digits}) BETWEEN {bounds[0]} AND {bounds[1]} AND {total} % 10 = 0)"
    if name == "digits":
        return f"length({digits}) BETWEEN {bounds[0]} AND {bounds[1]}"
    if name == "mod":
        plain = r"regexp_replace(x, '[\x20-]', '', 'g')"
        value = "CASE WHEN c < 'A' THEN ascii(c) - 48 ELSE ascii(c) - 55 END"
        number = f"list_aggregate([CAST({value} AS VARCHAR) for c in string_split({plain}[5:] || {plain}[:4], '')], 'string_agg', '')"
        # up to 70 digits: the remainder of the first 30 goes before the others
        first = f"CAST(CAST({number}[:30] AS HUGEINT) % 97 AS VARCHAR) || {number}[31:60]"
        return f"(CAST(CAST({first} AS HUGEINT) % 97 AS VARCHAR) || {number}[61:])::HUGEINT % 97 = 1"
    if name == "ssn":
        return f"NOT regexp_matches(x, '{NO_SSN}')"
    return "true"


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same in DuckDB's SQL, from the plain patterns."""
    parts = []
    for i, rule in enumerate(rules):
        before, after = f"right(before, {BEFORE})", f"left(after, {AFTER})"
        lowered = [f"translate({side}, '{_UPPER}', '{_LOWER}')" for side in (before, after)]
        near = f"(regexp_matches({lowered[0]}, '{rule.words}') OR regexp_matches({lowered[1]}, '{rule.words}'))"
        keep = _sql_check(rule.check)
        if rule.apart:
            keep += (
                f" AND NOT regexp_matches({before}, '{TOUCHES_BEFORE}') AND NOT regexp_matches({after}, '{TOUCHES_AFTER}')"
            )
        if not rule.base:
            keep += f" AND CASE WHEN {near} THEN {rule.score + rule.bonus:.3f} ELSE {rule.score} END >= {LEAST_SCORE}"
        parts.append(
            f"SELECT rid, {KINDS.index(rule.kind)} AS place, '{rule.kind}' AS kind, {rule.base} AS base, "
            f"stop - length(x) AS start, stop FROM ("
            f"SELECT rid, xs[i] AS x, gs[i] AS before, gs[i + 1] AS after, "
            f"list_sum([length(v) for v in gs[:i]]) + list_sum([length(v) for v in xs[:i]]) AS stop "
            f"FROM (SELECT *, unnest(range(1, len(xs) + 1)) AS i FROM ("
            f"SELECT rid, regexp_extract_all(text, '{rule.plain}') AS xs, regexp_split_to_array(text, '{rule.plain}') AS gs FROM d"
            f"))) WHERE {keep}"
        )
    spans = "\nUNION ALL\n".join(parts)
    label = "kind || ':' || CAST(start AS VARCHAR) || ':' || CAST(stop AS VARCHAR)"
    counts = ", ".join(
        f"count(*) FILTER (WHERE base AND kind = '{kind}') AS n_{kind}" for kind in ("email", "ip", "card", "phone")
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({spans})
SELECT any_value(doc_id) AS doc_id, {counts},
  sha256(coalesce(string_agg({label}, ',' ORDER BY place, start, stop) FILTER (WHERE base), '')) AS base_sha256,
  coalesce(string_agg({label}, ',' ORDER BY place, start, stop) FILTER (WHERE kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN s USING (rid) GROUP BY rid
"""
