"""Personal data by patterns, checksum validators and context words; column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.arrays import let
from readloom.functions.texts import blocks_of, piece, running_max
from readloom.llm.common import matches

# Patterns are written so that no start is tried twice and no repetition is taken
# back: they find what the plain forms in the docstring of `find` find, in linear time.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Countries by the length of their account numbers (ISO 13616 register).
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
# A country fixes where its number ends, so what follows is left out; where that is no end, all that follows is taken.
IBAN_ENDS = [rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}+" for n, codes in IBAN_LENGTHS.items()]
IBAN_OTHER = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+"
IBAN = (
    rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:(?:{'|'.join(IBAN_ENDS)})(?![A-Za-z0-9])|{IBAN_OTHER}(?![A-Za-z0-9]))"
)

#: Kinds in the order of the results.
KINDS = ("email", "ip", "card", "phone", "iban")
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN}
#: Score of a confirmed span before its context counts.
CONFIDENCE = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.9}
#: Words nearby that speak for or against a kind.
FOR = {
    "email": r"\b(e-?mail|mail|contact|write|reach)\b",
    "ip": r"\b(ip|address|host|server|login|client)\b",
    "card": r"\b(card|visa|mastercard|credit|payment|cvv)\b",
    "phone": r"\b(phone|tel|call|mobile|fax|contact)\b",
    "iban": r"\b(iban|account|bank|transfer)\b",
}
AGAINST = r"\b(example|sample|dummy|version|isbn|test)\b"
CONTEXT_WEIGHT = 0.2


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    value = lambda x, i: let(
        x.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d)
    )
    total = F.aggregate(F.transform(F.split(F.reverse(number), ""), value), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without blanks leaves the remainder 1 of ISO 7064."""
    turned = F.concat(F.substring(account, 5, 64), F.left(account, F.lit(4)))
    step = lambda rest, c: F.when(
        F.ascii(c) >= 65, (rest * 100 + F.ascii(c) - 55) % 97
    ).otherwise((rest * 10 + F.ascii(c) - 48) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        low = lambda part: let(
            F.ltrim(part, F.lit("0")), lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= F.lit("255")))
        )
        return F.forall(F.split(value, r"\."), low)
    if kind == "card":
        return let(digits(value), lambda d: F.length(d).between(16, 19) & luhn(d))
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    if kind == "iban":
        return let(F.replace(value, F.lit(" "), F.lit("")), lambda v: F.length(v).between(15, 34) & mod97(v))
    return F.lit(True)


def spans_of(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind as ``array<struct<kind, start, stop, score>>`` in order of start."""

    def scored(m: Column) -> Column:
        near = F.lower(F.concat_ws(" ", m["before"], m["after"]))
        speaks = F.when(near.rlike(FOR[kind]), CONTEXT_WEIGHT).otherwise(0.0)
        speaks -= F.when(near.rlike(AGAINST), CONTEXT_WEIGHT).otherwise(0.0)
        return F.struct(
            F.lit(kind).alias("kind"),
            m["start"].alias("start"),
            m["stop"].alias("stop"),
            F.round(F.lit(CONFIDENCE[kind]) + speaks, 2).alias("score"),
        )

    found = F.filter(matches(text, PATTERNS[kind]), lambda m: confirmed(kind, m["value"]))
    return F.transform(found, scored)


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pii``: ``array<struct<kind, start, stop, score>>`` by kind, then start.

    Plain forms, leftmost and non-overlapping per kind: email
    ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``; ip: four runs of digits
    with dots, each at most 255; card: 16 to 19 digits, single blanks or hyphens
    between, passing Luhn; phone: ``+`` and 8 to 15 digits among blanks, brackets,
    dots and hyphens; iban: as many letters and digits as the country's numbers have
    (all that follow, 15 to 34, where the number does not end there), single blanks between, passing mod-97. What a
    validator fails is dropped and not tried again. Offsets are code points, ``stop``
    is exclusive. The score starts from the kind and moves with words within 48
    characters; it never removes a span. A null text is an empty one and has no
    spans. A column of the name ``pii`` is replaced; all other columns stay.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("pii", F.concat(*[spans_of(text, kind) for kind in KINDS]))


def redact(docs: DataFrame, min_score: float = 0.0) -> DataFrame:
    """``docs`` with every span of at least ``min_score`` replaced by ``<KIND>``; overlapping spans become one
    under the label of the first and longest.

    Null texts stay null, texts without spans stay as they are; ``n_chars`` follows
    the text if there is such a column.
    """
    text = F.col("text").cast("string")
    ordered = F.array_sort(
        F.transform(
            F.filter("pii", lambda s: s["score"] >= min_score),
            lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("back"), s["kind"].alias("kind")),
        )
    )

    def rebuilt(spans: Column, blocks: Column) -> Column:
        # The furthest stop before each span, and behind the last.
        stops = F.concat(F.transform(spans, lambda s: -s["back"]), F.array(F.lit(0)))
        whole = F.length(text)

        def parts(reach: Column) -> Column:
            # Text from the furthest stop so far to this start, then this span's label unless it begins inside another.
            shown = F.transform(
                spans,
                lambda s, i: F.when(
                    s["start"] >= reach[i],
                    F.concat(piece(blocks, reach[i], s["start"] - reach[i]), F.lit("<"), F.upper(s["kind"]), F.lit(">")),
                ).otherwise(F.lit("")),
            )
            last = reach[F.size(spans)]
            return F.array_join(F.concat(shown, F.array(piece(blocks, last, whole - last))), "")

        return let(running_max(stops, F.lit(0)), parts)

    cleaned = let(ordered, lambda spans: let(blocks_of(text), lambda blocks: rebuilt(spans, blocks)))
    changed = docs.withColumn("text", F.when(F.size("pii") > 0, cleaned).otherwise(text)).drop("pii")
    return changed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else changed


def digest(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:stop`` of the given kinds, comma-joined."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))),
        ",",
    )
