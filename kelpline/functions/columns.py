"""Column helpers: keys, exact arithmetic, cleaning and classification chains."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_NAMESPACE = "kelpline-key-v1"
UNKNOWN_NAMESPACE = "kelpline-unknown-v1"
UNKNOWN = "__UNKNOWN__"


def _joined(*parts: Column) -> Column:
    """SHA-256 of the parts with a NUL between; null if any part is."""
    out = []
    for i, p in enumerate(parts):
        out += [F.char(F.lit(0)), p] if i else [p]
    return F.sha2(F.concat(*out).cast("binary"), 256)


def gold_key(kind: str, natural: Column, version: Column | None = None) -> Column:
    return _joined(F.lit(KEY_NAMESPACE), F.lit(kind), natural, *([version] if version is not None else []))


def unknown_key(kind: str) -> Column:
    return _joined(F.lit(UNKNOWN_NAMESPACE), F.lit(kind))


def zip5(c: Column) -> Column:
    """Trimmed and padded to five places; longer ones are cut."""
    return F.lpad(F.trim(c), 5, "0")


def upper_or_unknown(c: Column) -> Column:
    return F.coalesce(F.nullif(F.upper(F.trim(c)), F.lit("")), F.lit("UNKNOWN"))


def date_key(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("bigint")


def seconds_between(a: Column, b: Column) -> Column:
    return F.timestamp_diff("SECOND", a, b)


def exact_ratio(num: Column, den: Column) -> Column:
    """num / den with 18 places, half up; null where den is 0."""
    return (num.cast("decimal(20,0)") / F.nullif(den.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))).cast("decimal(38,18)")


def exact_average(total: Column, count: Column) -> Column:
    """total / count with 6 places, half up; null without rows."""
    return F.round(total.cast("decimal(28,6)") / F.nullif(count.cast("decimal(10,0)"), F.lit(0).cast("decimal(10,0)")), 6).cast("decimal(38,6)")


def shown(x: Column) -> Column:
    """A double's 6 places as SQL has them: rounded half away from zero after it is multiplied, so that not all ties go up."""
    y = F.abs(x) * 1e6
    whole = F.floor(y).cast("double")
    return F.when(y < 2.0**52, F.signum(x) * (whole + (y - whole >= 0.5).cast("double")) / 1e6).otherwise(x)


def huge_double(c: Column) -> Column:
    """A whole number from 0 as the double that SQL makes of its 128 bits: both halves are rounded, and then their sum."""
    high = F.call_function("div", c.cast("decimal(38,0)"), F.lit(str(2**64)).cast("decimal(20,0)"))
    low = c.cast("decimal(38,0)") - high.cast("decimal(18,0)") * F.lit(str(2**64)).cast("decimal(20,0)")
    return low.cast("double") + high.cast("double") * 2.0**64


def shown_average(total: Column, count: Column) -> Column:
    """total / count of doubles as the models show it; null without rows. The exact quotient of a large total may end in another digit."""
    return shown(total.cast("double") / F.nullif(count.cast("double"), F.lit(0.0))).cast("decimal(38,6)")


UNIT = 10**18


def weight_units(ordinal: Column, n: Column) -> Column:
    """Share of one of n equal parts in units of 10^-18, cut off; the last part gets what is left. n = 0: all."""
    one = F.lit(UNIT).cast("bigint")
    part = F.floor(one.cast("decimal(20,0)") / F.greatest(n, F.lit(1)).cast("decimal(20,0)")).cast("bigint")
    return F.when(n == 0, one).when(ordinal == n, one - part * (n - 1)).otherwise(part)


# Fixed values, down to MAX_REVIEW_TEXT: redaction runs in this order, each on what the one before has left.
REDACTIONS = (
    ("EMAIL", r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"),
    ("URL", r"(?i)\b(?:https?://|www\.)[^\s<>()]+"),
    ("CPF", r"\b\d{3}[.\s-]?\d{3}[.\s-]?\d{3}[-\s]?\d{2}\b"),
    ("PHONE", r"(?<!\d)(?:\+?55[\s.-]?)?(?:\(?\d{2}\)?[\s.-]?)?9?\d{4}[\s.-]?\d{4}(?!\d)"),
)
DIRECT_ID = r"(?i)\b(?:order|customer|seller|review)[ _-]?id\s*[:=]"
SECRET_LIKE = r"(?i)\b(?:password|senha|api[ _-]?key|access[ _-]?token|private[ _-]?key)\b"
MAX_REVIEW_TEXT = 2000
_WORD = "[0-9A-Za-z_]"


def as_in_sql(pattern: str) -> str:
    r"""A pattern for Spark that finds what RE2 finds, and so SQL.

    Java's \b takes letters of all scripts for parts of words, its \s has the vertical tab, and its (?i) folds neither long s nor the Kelvin sign.
    """
    folds = pattern.startswith("(?i)")

    def token(m: re.Match) -> str:
        t = m[0]
        if t == r"\b":
            return f"(?:(?={_WORD})(?<!{_WORD})|(?!{_WORD})(?<={_WORD}))"
        if t in ("s", "k"):
            return {"s": "[s\u017f]", "k": "[k\u212a]"}[t] if folds else t
        spaces = t.replace(r"\s", r"\t\n\f\r ")
        if t[0] != "[":
            return f"[{spaces}]" if t == r"\s" else t
        return spaces.replace("A-Z", "A-Z\u017f\u212a") if folds else spaces

    return re.sub(r"\\.|\[[^\]]*\]|[sk]", token, pattern)


#: What a text has to have for a pattern to be looked for, which takes some five times as long as Java's own edges of words do.
_NEEDED = {"EMAIL": "@", "URL": "://|[wW]{3}[.]", "CPF": r"\d{3}"}


def redact(text: Column, kinds=("EMAIL", "URL", "CPF", "PHONE")) -> tuple[Column, Column]:
    """The redacted text and the number of redactions."""
    count = F.lit(0)
    for name, pattern in REDACTIONS:
        if name not in kinds:
            continue
        java = as_in_sql(pattern) if name in _NEEDED else pattern  # RE2 has no look-behind
        found, shown = F.regexp_count(text, F.lit(java)), F.regexp_replace(text, java, f"[REDACTED_{name}]")
        if name in _NEEDED:
            none = ~text.rlike(_NEEDED[name])
            found, shown = F.when(none, 0).otherwise(found), F.when(none, text).otherwise(shown)
        text, count = shown, count + found
    return text, count.cast("bigint")
