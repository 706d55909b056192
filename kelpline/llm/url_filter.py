"""URL filter: path rules first, then a weighted vocabulary counted by an Aho-Corasick automaton.

A rule is a host and the beginning of a path. It fits its host and all subdomains; the longest that fits decides.
Where none does, terms are looked for in the lower-cased url: a term counts if no letter or digit stands directly
before or after it. One strict term blocks, and so do `LEAST_SOFT` different soft terms whose weights come to `LEAST_WEIGHT`;
else the url is allowed. The terms below are a default; `vocabulary` takes a list of any language from a table.

Defined cases: a null page_id is passed on; a null url, or one without ://, has an empty host and path; no rule fits it; its text is
searched all the same (null: allowed). Rows that repeat are judged alike. A url of any length is searched whole. Extra columns pass through `judge`;
one with the name of the result is refused. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from kelpline.llm.common import free, row_of, unused

# Fixed values.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
STRICT = ("adult", "casino", "escort", "gambling", "jackpot", "porn", "sex", "spam", "viagra", "xxx")
SOFT = ("ads", "bet", "bets", "bonus", "cheap", "click", "coupon", "deal", "deals", "free", "loan", "offer", "pills", "poker", "popup", "promo", "slots", "track", "win", "winner")
#: Distinct soft terms that block, and the sum of their weights that is needed too.
LEAST_SOFT, LEAST_WEIGHT = 2, 2.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Vocabulary(NamedTuple):
    """Lower-case terms: those of which one blocks, and the weights of those of which several do."""

    strict: frozenset[str]
    soft: tuple[tuple[str, float], ...]


VOCABULARY = Vocabulary(frozenset(STRICT), tuple((t, 1.0) for t in SOFT))


def vocabulary(table: DataFrame, most: int = 2_000_000) -> Vocabulary:
    """The terms of a table (term, weight; a null weight: strict). Of a term that repeats, strict wins, then the largest weight.

    It is gathered and sent to all tasks, so more than `most` terms are an error.
    """
    rows = table.where("term <> ''").groupBy(F.translate("term", _UPPER, _LOWER).alias("term")).agg(F.max("weight").alias("weight"), F.max(F.col("weight").isNull()).alias("strict")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} terms")
    return Vocabulary(frozenset(r["term"] for r in rows if r["strict"]), tuple(sorted((r["term"], float(r["weight"])) for r in rows if not r["strict"])))


@functools.lru_cache(maxsize=4)
def _automaton(terms: Vocabulary):
    import ahocorasick

    out = ahocorasick.Automaton()
    for term, weight in [*terms.soft, *((t, None) for t in terms.strict)]:
        out.add_word(term, (term, weight))
    out.make_automaton()
    return out


_WORD = frozenset("0123456789" + _LOWER)


def _counter(terms):
    @arrow_udf(row_of(n_strict=T.LongType(), soft=T.ArrayType(T.StringType()), weight=T.DoubleType()))
    def counted(url: pa.Array) -> pa.Array:
        automaton = _automaton(terms.value)
        lower = str.maketrans(_UPPER, _LOWER)
        n_strict, softs, weights = [], [], []
        for text in url.to_pylist():
            text, n, own = (text or "").translate(lower), 0, {}
            for end, (term, weight) in automaton.iter(text) if len(automaton) else ():
                before, after = end - len(term), end + 1
                if (before < 0 or text[before] not in _WORD) and (after == len(text) or text[after] not in _WORD):
                    if weight is None:
                        n += 1
                    else:
                        own[term] = weight
            n_strict.append(n)
            softs.append(sorted(own))
            weights.append(float(sum(own[t] for t in softs[-1])))
        return pa.StructArray.from_arrays([pa.array(n_strict, pa.int64()), pa.array(softs, pa.list_(pa.string())), pa.array(weights, pa.float64())], fields=[pa.field("n_strict", pa.int64()), pa.field("soft", pa.list_(pa.string())), pa.field("weight", pa.float64())])

    return counted.asNondeterministic()


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without a ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def judge(pages: DataFrame, column: str = "url_verdict", rules=RULES, terms: Vocabulary = VOCABULARY, least_soft: int = LEAST_SOFT, least_weight: float = LEAST_WEIGHT) -> DataFrame:
    """pages with a struct: host, path, rule (null if none fits), n_strict, soft (distinct soft terms), weight (theirs) and verdict."""
    free(pages, column)
    host, path, hits = (unused(pages, n) for n in ("host_", "path_", "hits_"))
    h, p = split_url(F.col("url"))
    out = pages.withColumn(host, h).withColumn(path, p).withColumn(hits, _counter(pages.sparkSession.sparkContext.broadcast(terms))("url"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):  # later ones are longer and stand before
        own, slash, start = text.partition("/")
        fits = ((F.col(host) == own) | F.col(host).endswith("." + own)) & F.col(path).startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    n_strict, own_soft, weight = (F.col(f"{hits}.{c}") for c in ("n_strict", "soft", "weight"))
    by_terms = F.when((n_strict > 0) | ((F.size(own_soft) >= least_soft) & (weight >= least_weight)), "block").otherwise("allow")
    return out.select(*pages.columns, F.struct(F.col(host).alias("host"), F.col(path).alias("path"), rule.alias("rule"), n_strict.alias("n_strict"), own_soft.alias("soft"), weight.alias("weight"), F.coalesce(verdict, by_terms).alias("verdict")).alias(column))


def summary(pages: DataFrame) -> DataFrame:
    out = judge(pages.select("page_id", "url"), "v")
    return out.select("page_id", *[F.col(f"v.{n}").alias(n) for n in ("host", "path", "rule", "verdict")])


def keep_allowed(pages: DataFrame) -> DataFrame:
    name = unused(pages, "url_verdict")
    return judge(pages, name).where(F.col(f"{name}.verdict") == "allow").select(*pages.columns)
