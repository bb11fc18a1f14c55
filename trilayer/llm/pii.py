"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust a score.

All in column expressions.  A pattern's matches and the pieces between them give the positions: a match starts where the
pieces and matches before it end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.llm.common import id_and_text

# Patterns of the base kinds.  The guard before email and ip starts a match only where its run of characters starts or
# where the last match ended; a start inside a run can only fail like the run's own start, so matches are the same, and
# time stays linear in long runs.  For cards the guards at both ends do the same, and only runs of 13 to 19 digits match.
LOCAL = r"A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Account numbers: two letters, two check digits, 8 to 31 letters and digits, also in groups of four.  A match is the first
# four characters, the group behind them the longest rest that ends where letters and digits end; it may hold a word or the
# next number behind a space, so `_account` tries the ends before it.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])))"
#: Lengths of account numbers by country, as registered.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
        31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
# Nine-digit identity numbers, written 3-2-4.
IDENTITY = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"

#: Kind, pattern, a text that any match holds, score without context, words that raise it.
KINDS = (
    ("email", EMAIL, "@", 0.9, r"(?i)mail|contact|write|reach"),
    ("ip", IP, ".", 0.6, r"(?i)address|host|server|login"),
    ("card", CARD, None, 0.8, r"(?i)card|visa|credit|payment"),
    ("phone", PHONE, "+", 0.6, r"(?i)phone|call|mobile|fax"),
    ("iban", IBAN, None, 0.8, r"(?i)iban|account|bank|transfer"),
    ("identity", IDENTITY, "-", 0.3, r"(?i)social security|identity|\bssn\b"),
)
#: Kinds whose spans always count; of the others those with this score at least.
BASE_KINDS = 4
THRESHOLD = 0.5
CONTEXT_BONUS = 0.3
CONTEXT_CHARS = 40

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def _luhn(digits: Column) -> Column:
    """Sum of digits, every second one from the right doubled, divisible by ten."""
    reversed_digits = F.split(F.reverse(digits), "")

    def weighted(digit: Column, place: Column) -> Column:
        value = digit.cast("int") * (1 + place % 2)
        return F.when(value > 9, value - 9).otherwise(value)

    total = F.aggregate(F.transform(F.filter(reversed_digits, lambda d: d != ""), weighted), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _mod97(account: Column) -> Column:
    """The account number with its first four characters last, letters as 10 to 35, leaves 1 modulo 97."""
    plain = F.regexp_replace(account, r"\x20", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _apart(text: Column, span: Column, joining: str) -> Column:
    """No character of the class before or behind the span."""
    before = F.substring(text, span["start"].cast("int"), F.when(span["start"] > 0, F.lit(1)).otherwise(F.lit(0)))
    return ~F.concat(before, F.substring(text, (span["end"] + 1).cast("int"), F.lit(1))).rlike(joining)


def _confirmed(kind: str, text: Column, span: Column) -> Column:
    match = span["match"]
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        # The checksum is asked only of strings of the right length.
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "identity":
        return _apart(text, span, "[0-9-]") & ~match.rlike("^(000|666|9)|-00-|0000$")
    return F.lit(True)


def _account(span: Column) -> Column:
    """The span cut at the end, among its match's own and those at spaces, where the number has its country's length and is
    confirmed, else at the last one where it is confirmed; null if there is none."""
    words = F.split(span["match"], "\\x20")
    numbers = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))

    def plain(number: Column) -> Column:
        return F.length(F.regexp_replace(number, "\\x20", ""))

    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    good = F.filter(numbers, lambda n: F.when(plain(n) >= 12, _mod97(n)).otherwise(False))
    registered = F.filter(good, lambda n: plain(n) == F.try_element_at(lengths, F.substring(n, 1, 2)))
    number = F.coalesce(F.get(registered, F.lit(0)), F.get(good, F.lit(0)))
    return F.struct(span["start"].alias("start"), (span["start"] + F.length(number)).alias("end"), number.alias("match"))


def _accounts(text: Column) -> Column:
    """Confirmed account numbers."""
    return F.filter(F.transform(_proposals(text, IBAN, None, 1), _account), lambda s: s["match"].isNotNull())


def _without_overlaps(spans: Column) -> Column:
    """Leftmost spans; the walk is for the rare texts where two of them overlap."""

    def add(state: Column, span: Column) -> Column:
        taken = F.struct(span["end"].alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))
        return F.when(span["start"] >= state["at"], taken).otherwise(state)

    pairs = F.arrays_zip(F.transform(spans, lambda s: s["end"]).alias("end"), F.slice(F.transform(spans, lambda s: s["start"]), F.lit(2), F.greatest(F.size(spans), F.lit(1))).alias("next"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as {_SPANS})").alias("spans"))
    return F.when(F.exists(pairs, lambda p: F.coalesce(p["next"] < p["end"], F.lit(False))), F.aggregate(spans, start, add)["spans"]).otherwise(spans)


_SPANS = "array<struct<start:long,end:long,match:string>>"
#: Matches summed in one go; more are summed block by block, so time stays linear in texts full of matches.
_BLOCK = 256


def _proposals(text: Column, pattern: str, sure: str | None, rest: int | None = None) -> Column:
    """Array of (start, end, match) in code points, leftmost and non-overlapping.  With `rest`, what this group of the
    pattern has looked ahead at is added to the match, and spans may overlap."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda piece: F.length(piece).cast("long"))
    # The last gap has no match.
    rests = F.regexp_extract_all(text, F.lit(pattern), F.lit(rest)) if rest else F.transform(matches, lambda _: F.lit(""))
    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), matches.alias("match"), rests.alias("rest")), lambda p: p["match"].isNotNull())
    none = F.expr(f"cast(array() as {_SPANS})")

    def add(state: Column, pair: Column) -> Column:
        first = state["at"] + pair["gap"]
        end = first + F.length(pair["match"])
        whole = F.concat(pair["match"], pair["rest"])
        span = F.struct(first.alias("start"), (first + F.length(whole)).alias("end"), whole.alias("match"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def of_block(block: Column, at: Column) -> Column:
        return F.aggregate(block, F.struct(at.alias("at"), none.alias("spans")), add)["spans"]

    def add_block(state: Column, block: Column) -> Column:
        length = F.aggregate(block, F.lit(0).cast("long"), lambda n, p: n + p["gap"] + F.length(p["match"]))
        return F.struct((state["at"] + length).alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts"))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / _BLOCK).cast("int")), lambda b: F.slice(pairs, b * _BLOCK + 1, F.lit(_BLOCK))
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<long>)").alias("starts"))
    spans = F.flatten(F.zip_with(blocks, F.aggregate(blocks, start, add_block)["starts"], of_block))
    possible = F.size(pairs) > 0 if sure is None else F.contains(text, F.lit(sure)) & (F.size(pairs) > 0)
    return F.when(possible, spans).otherwise(none)


def _scored(kind: str, text: Column, span: Column, score: float, words: str) -> Column:
    begin = F.greatest(span["start"] - CONTEXT_CHARS, F.lit(0))
    before = F.substring(text, (begin + 1).cast("int"), (span["start"] - begin).cast("int"))
    after = F.substring(text, (span["end"] + 1).cast("int"), F.lit(CONTEXT_CHARS))
    raised = F.when(before.rlike(words) | after.rlike(words), F.lit(min(1.0, score + CONTEXT_BONUS))).otherwise(F.lit(score))
    return F.struct(F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"), raised.alias("score"))


def _checked(kind: str, score: float, words: str) -> Column:
    text = F.col("text")
    kept = _without_overlaps(F.col(kind)) if kind == "iban" else F.filter(F.col(kind), lambda s: _confirmed(kind, text, s))
    return F.transform(kept, lambda s: _scored(kind, text, s, score, words))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id and `spans`, an array of (kind, start, end, score) in the order of `KINDS`, then by start.

    Positions are code points, the end exclusive.  A null text is empty and has no spans.  A match that its checksum
    refuses is dropped and not tried again shorter, but account numbers are tried at every end that they can have.  Spans of
    base kinds always stay; a context word before or behind a span raises its score, and spans of the other kinds need
    `THRESHOLD`.
    """
    rows = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    found = rows.select("doc_id", "text", *[
        (_accounts(F.col("text")) if kind == "iban" else _proposals(F.col("text"), pattern, sure)).alias(kind) for kind, pattern, sure, _, _ in KINDS
    ])
    spans = []
    for place, (kind, _, _, score, words) in enumerate(KINDS):
        scored = _checked(kind, score, words)
        spans.append(scored if place < BASE_KINDS else F.filter(scored, lambda s: s["score"] >= THRESHOLD))
    return found.select("doc_id", F.concat(*spans).alias("spans"))


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, max_score."""
    base = [kind for kind, *_ in KINDS[:BASE_KINDS]]

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = find_personal_data(docs)
    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id",
        *[_count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(joined(of_base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.array_max(F.transform("spans", lambda s: s["score"])).alias("max_score"),
    )
