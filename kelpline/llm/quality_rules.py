"""Quality rules, line first. DataFrame and SQL functions only; no shuffle.

Each line (parts between \\n that hold a word) is judged: it fails if it doesn't end in punctuation, if it is
navigation (separators, or a phrase of menus), or if it holds a phrase of boilerplate. Marks and phrases cover several scripts
and languages, and may come from a table (`phrases`). Failed lines are removed. A document is
rejected if less than `LEAST_LEFT` per cent of its word characters are left, if it has fewer than 50 words, or if
more than half of its words lie in repeated 3-word windows.

Defined cases: null text has no words and is rejected, as is an empty one. Rows that repeat are judged alike.
A text of any length is read whole. Extra columns pass through `judge` and `clean`;
`judge` refuses one with the name of its result. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.llm.common import free, unused
from kelpline.llm.spans import let

LEAST_WORDS, MOST_REPEATED, LEAST_LEFT = 50, 50, 30
WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
# Fixed values, read alike by Java's and RE2's engines. Lines come trimmed of white space.
#: Sentence ends, closing quotes and brackets of Latin, Greek, Cyrillic, CJK, Devanagari, Arabic, Armenian, Ethiopic and Khmer texts.
ENDS = ".!?:;…‥\"'”’“»›)]。．！？：；｡」』】）》〉।॥؟۔؛։።፧។"
#: Letters of scripts that end a sentence by a space or a mark of their own: Thai, Lao, Tibetan, Burmese.
UNMARKED = "\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f"
#: Lines that are nothing but one of these.
MENU = ("home", "menu", "login", "log in", "sign up", "next", "previous", "back", "search", "share", "read more", "contact us", "about us",
        "startseite", "menü", "anmelden", "weiter", "zurück", "suche", "accueil", "connexion", "suivant", "précédent", "rechercher", "inicio", "menú", "iniciar sesión", "siguiente", "anterior", "buscar",
        "首页", "登录", "上一页", "下一页", "搜索", "الرئيسية", "بحث", "главная", "войти", "поиск")
#: Lines that hold one of these.
BOILERPLATE = ("all rights reserved", "copyright", "cookie policy", "privacy policy", "terms of use", "terms of service", "javascript", "subscribe to", "lorem ipsum",
               "alle rechte vorbehalten", "datenschutzerklärung", "tous droits réservés", "politique de confidentialité", "todos los derechos reservados", "política de privacidad",
               "版权所有", "隐私政策", "جميع الحقوق محفوظة", "все права защищены")


class Rules(NamedTuple):
    """What lines are judged by: a pattern of the last character, one of navigation, and phrases in lower case."""

    ends: str
    navigation: str
    boilerplate: tuple[str, ...]


def rules(ends: str = ENDS, menu: Iterable[str] = MENU, boilerplate: Iterable[str] = BOILERPLATE) -> Rules:
    """The rules for given characters and phrases; phrases match in either case."""
    mark = lambda x: "".join(f"\\{c}" if c in "\\.[]{}()*+?^$|-" else c for c in x)
    return Rules(
        f"^[{mark(ends)}{UNMARKED}]\\z",
        f"\\|[^\\n]*\\||^[A-Za-z ]{{0,40}} > |^(?i:{'|'.join(map(mark, menu))})[.!]?\\z",
        tuple(x.lower() for x in boilerplate),
    )


RULES = rules()


def phrases(table: DataFrame, most: int = 500) -> Rules:
    """Rules from a table (kind: menu or boilerplate, phrase); more than `most` rows are an error."""
    rows = table.where("phrase <> ''").select("kind", "phrase").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} phrases")
    of = lambda kind: sorted(r["phrase"] for r in rows if r["kind"] == kind) or ["\n"]  # noqa: E731  no line holds that
    return rules(menu=of("menu"), boilerplate=of("boilerplate"))


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _repeated(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more. Hashes only tell which windows may be such; those are compared as words."""
    n = F.size(words)
    def again(windows: Column) -> Column:
        """Places `i` of the windows (x, i) whose x is not alone, in no order."""
        same = lambda a, b: F.coalesce(a["x"] == b["x"], F.lit(False))
        sorted_ = lambda p: F.transform(F.filter(F.transform(p, lambda s, i: F.struct(s["i"].alias("i"), (same(s, F.get(p, i - 1)) | same(s, F.get(p, i + 1))).alias("dup"))), lambda s: s["dup"]), lambda s: s["i"])
        return let(F.array_sort(windows), sorted_)

    def count(hashes: Column) -> Column:
        places = again(F.transform(hashes, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        spelled = lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(3)])  # noqa: E731  words hold no space
        places = again(F.transform(places, lambda i: F.struct(spelled(i).alias("x"), i.alias("i"))))
        # a window covers 3 words, or as many as lie before the next repeated one
        own = let(F.sort_array(places), lambda q: F.transform(q, lambda at, i: F.least(F.coalesce(F.get(q, i + 1) - at, F.lit(3)), F.lit(3))))
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda a, x: a + x)

    # most texts repeat no window: a set of hashes tells that without a sort
    hashes = F.transform(F.slice(words, F.lit(1), n - 2), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), count(h)).otherwise(F.lit(0).cast("bigint")))
    return F.when(n >= 4, some).otherwise(F.lit(0).cast("bigint"))


def _line_ok(line: Column, by: Rules) -> Column:
    holds = lambda x: functools.reduce(lambda a, p: a | x.contains(p), by.boilerplate, F.lit(False))
    return let(F.btrim(line, F.lit(WHITE)), lambda x: F.substring(x, -1, 1).rlike(by.ends) & ~x.rlike(by.navigation) & ~let(F.lower(x), holds))


def judge(docs: DataFrame, column: str = "quality", by: Rules = RULES) -> DataFrame:
    """docs with a struct: the counts, base_failed, left_chars, kept and the text of the lines that stay."""
    free(docs, column)
    lines = unused(docs, "lines_")
    t = F.coalesce("text", F.lit(""))
    with_word = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    counted = F.struct(t.alias("t"), with_word.alias("lines"))

    def measured(x: Column) -> Column:
        t, lines = x["t"], x["lines"]
        good = F.filter(lines, lambda x: _line_ok(x, by))
        return let(good, lambda g: let(_words(t), lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            _without(t, WHITE).cast("bigint").alias("word_chars"),
            (F.length(t) - _without(t, SYMBOLS)).cast("bigint").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            _repeated(w).alias("n_repeat_words"),
            _without(F.array_join(g, "\n"), WHITE).cast("bigint").alias("left_chars"),
            F.array_join(g, "\n").alias("text"),
        )))

    m = docs.withColumn(lines, let(counted, measured))
    c = lambda name: F.col(f"{lines}.{name}")
    failed = (c("n_words") < LEAST_WORDS) | (F.lit(100) * c("n_repeat_words") > F.lit(MOST_REPEATED) * c("n_words"))
    kept = ~failed & (F.lit(100) * c("left_chars") >= F.lit(LEAST_LEFT) * c("word_chars"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "left_chars", "text")
    return m.select(*docs.columns, F.struct(*[c(n).alias(n) for n in names], failed.alias("base_failed"), kept.alias("kept")).alias(column))


def summary(docs: DataFrame) -> DataFrame:
    out = judge(docs.select("doc_id", "text"), "q")
    return out.select("doc_id", *[F.col(f"q.{n}").alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def clean(docs: DataFrame, by: Rules = RULES) -> DataFrame:
    """The documents that are kept, with the lines that passed as their text."""
    name = unused(docs, "quality")
    out = judge(docs, name, by).where(F.col(f"{name}.kept"))
    return out.select(*[F.col(f"{name}.text").alias("text") if c == "text" else F.col(c) for c in docs.columns])
