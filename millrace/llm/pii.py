"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import ROW, columns, with_row
from millrace.session import pin

# Characters on either side in which context words are looked for.
CONTEXT = 40


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    Patterns match what the plain definition beside them matches. Possessive counts, and a
    start that is not inside a run unless the last match ended there, keep them linear.
    """

    name: str
    gate: str  # a cheap test: where it fails, nothing can match
    pattern: str
    context: str
    score: float


KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         r"(?i)mail|contact|write|kontakt|correo|courriel", 0.8),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"(?i)\bip\b|address|host|server|adresse", 0.6),
    # [0-9]([\x20-]?[0-9])+ ; chains of fewer than 16 digits fail anyway
    Kind("card", r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){15,}+",
         r"(?i)card|visa|credit|carte|karte|tarjeta", 0.7),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", r"(?i)phone|call|tel|mobile|fax", 0.6),
    # Beyond the base kinds: international account numbers
    Kind("iban", r"[A-Z]{2}[0-9]{2}[A-Z0-9]", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])",
         r"(?i)iban|account|bank|konto|compte|cuenta", 0.7),
)
BASE = ("email", "ip", "card", "phone")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.reverse(digits)

    def step(total: Column, at: Column) -> Column:
        digit = F.substr(turned, at, F.lit(1)).cast("int")
        doubled = digit * 2
        return total + F.when(at % 2 == 1, digit).when(doubled > 9, doubled - 9).otherwise(doubled)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number passes the mod-97 check of ISO 13616."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def step(rest: Column, at: Column) -> Column:
        code = F.ascii(F.substr(moved, at, F.lit(1)))
        letter = code >= 65
        return (rest * F.when(letter, 100).otherwise(10) + code - F.when(letter, 55).otherwise(48)) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def confirmed(kind: Column, value: Column) -> Column:
    """Whether the validator of its kind accepts a match."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    octet = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", value.rlike(rf"^{octet}(?:\.{octet}){{3}}$"))
        .when(kind == "card", F.when(F.length(digits) <= 19, luhn(digits)).otherwise(False))
        .when(kind == "phone", F.length(digits).between(8, 15))
        .when(kind == "iban", mod97(value))
        .otherwise(False)
    )


def _cut(text: Column, number: int, kind: Kind) -> Column:
    """The text cut at a kind's matches: length and edges of each part, and the match after it."""
    parts = F.arrays_zip(
        F.split(text, kind.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("value"),
    )
    rows = F.transform(parts, lambda x, i: F.struct(
        F.lit(number).alias("kind"), i.alias("i"), F.length(x["gap"]).cast("long").alias("gap"),
        F.left(x["gap"], F.lit(CONTEXT)).alias("head"), F.right(x["gap"], F.lit(CONTEXT)).alias("tail"),
        x["value"].alias("value"),
    ))
    # A text without a match is one part without a value, of no further use.
    matched = F.filter(rows, lambda x: x["value"].isNotNull() | (x["i"] > 0))
    none = F.array().cast("array<struct<kind: int, i: int, gap: bigint, head: string, tail: string, value: string>>")
    return F.when(text.rlike(kind.gate), matched).otherwise(none)


def find_spans(cut: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Confirmed spans from the cuts of each row: ROW, kind (its number), start, end, score."""
    in_order = Window.partitionBy(ROW, "kind").orderBy("i")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.select(ROW, F.inline("cuts")).select(
        "*",
        (F.sum("gap").over(in_order) + F.coalesce(F.sum(F.length("value")).over(before), F.lit(0))).alias("start"),
        F.lead("head").over(in_order).alias("after"),
    ).where(F.col("value").isNotNull())
    names, base = (F.array(*[F.lit(getattr(k, a)) for k in kinds]) for a in ("name", "score"))
    near, hit = F.concat_ws(" ", "tail", "after"), F.lit(False)
    for n, k in enumerate(kinds):
        hit = F.when(F.col("kind") == n, near.rlike(k.context)).otherwise(hit)
    return placed.where(confirmed(F.get(names, F.col("kind")), F.col("value"))).select(
        ROW, "kind", "start", (F.col("start") + F.length("value")).alias("end"),
        F.least(F.lit(1.0), F.get(base, F.col("kind")) + F.when(hit, 0.2).otherwise(0.0)).alias("score"),
    )


def scan_private_data(
    docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Find personal data in every whole text.

    Spans are given in code points, end exclusive, ordered by kind and start. The text is
    read once; only texts with a match leave rows for the shuffle, and of those only short
    edges. The score of a span rises by 0.2 if a context word of its kind stands within
    CONTEXT characters. NULL text counts as empty; repeated rows give a row each; further
    columns are ignored; an empty table gives no rows. Returns doc_id and found, an array
    of kind, start, end, score, empty where nothing was found.
    """
    cuts = F.concat(*[_cut(F.col("text"), n, k) for n, k in enumerate(kinds)])
    cut = pin(with_row(columns(docs, doc_id=id_col, text=text_col)).select(
        "doc_id", ROW, F.when(F.col("text").rlike("[0-9@]"), cuts).alias("cuts")
    ))
    names = F.array(*[F.lit(k.name) for k in kinds])
    span = F.struct("kind", "start", "end", "score")
    found = find_spans(cut, kinds).groupBy(ROW).agg(F.array_sort(F.collect_list(span)).alias("spans"))
    named = F.transform("spans", lambda s: F.struct(
        F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")
    ))
    none = F.array().cast("array<struct<kind: string, start: bigint, end: bigint, score: double>>")
    return cut.select("doc_id", ROW).join(found, ROW, "left").select(
        "doc_id", F.coalesce(named, none).alias("found")
    )
