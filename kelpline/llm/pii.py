"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.
DataFrame and SQL functions only; no shuffle.

Kinds of the base: email, ip (four parts of at most 255), card (16 to 19 digits that pass Luhn's check), phone
(8 to 15 digits). Added: iban (ISO 13616, mod 97), if its score is at least `LEAST_SCORE`. A span's score
is its kind's, raised by a word of its kind (English, German, French or Spanish) in the 40 characters before it and lowered by a word of other numbers.

Defined cases: null text is an empty text, without spans. Rows that repeat get the same spans. A text of any length is searched whole. Extra columns
pass through `find`; one with the name of the result is refused. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.llm.common import free
from kelpline.llm.spans import found, let, listed

# Fixed values. A look-behind and possessive quantifiers change no match; they keep long runs of digits or letters linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b",
}
BASE = ("email", "ip", "card", "phone")
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.5, "iban": 0.8}
CONTEXT = {
    "email": "e-?mail|courriel|correo|contact|kontakt|write|schreib|mailto|@",
    "ip": r"\bip\b|address|adresse|server|servidor|serveur|host|login",
    "card": "card|karte|carte|tarjeta|visa|master|credit|debit|payment|zahlung|paiement|pago",
    "phone": "phone|telefon|tel|call|anruf|appel|llam|mobile|handy|fax|contact|kontakt",
    "iban": "iban|account|konto|compte|cuenta|bank|banque|banco|transfer|berweisung|virement",
}
AGAINST = "version|isbn|order|invoice|serial|part no|bestell|rechnung|commande|facture|pedido|factura"
LEAST_SCORE, BEFORE = 0.5, 40


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda d, i: let(d.cast("int") * (1 + i % 2), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether letters and digits pass the check of an IBAN."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))
    number = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: (a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + number(c)) % 97)
    return rest == 1


_VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"),
    "card": lambda v: F.when(F.length(_digits(v)).between(16, 19), luhn(_digits(v))).otherwise(F.lit(False)),
    "phone": lambda v: F.length(_digits(v)).between(8, 15),
    "iban": mod97,
}
#: What a text must contain for the kind's pattern to be tried at all.
_HINTS = {"email": "@", "phone": "+"}


def _of(text: Column, kind: str) -> Column:
    spans = F.filter(found(text, PATTERNS[kind]), lambda s: _VALID[kind](s["value"]))

    def scored(s: Column) -> Column:
        before = F.lower(F.substring(text, F.greatest(s["start"] - BEFORE + 1, F.lit(1)).cast("int"), F.least(s["start"], F.lit(BEFORE)).cast("int")))
        score = F.lit(SCORES[kind]) + F.when(before.rlike(CONTEXT[kind]), 0.1).otherwise(0.0) - F.when(before.rlike(AGAINST), 0.4).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.round(score, 2).alias("score"))

    out = F.transform(spans, scored)
    if kind not in BASE:
        out = F.filter(out, lambda s: s["score"] >= LEAST_SCORE)
    if kind in _HINTS:
        out = F.when(text.contains(_HINTS[kind]), out).otherwise(F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>"))
    return out


def find(docs: DataFrame, column: str = "pii") -> DataFrame:
    """docs with an array of struct(kind, start, end, score), by kind and then start."""
    free(docs, column)
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn(column, F.concat(*[_of(text, kind) for kind in PATTERNS]))


def summary(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, all spans as text, and whether there are any."""
    out = find(docs.select("doc_id", "text"), "pii")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return out.select("doc_id", *[count(k) for k in BASE], F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"), (F.size("pii") > 0).alias("has_pii"))
