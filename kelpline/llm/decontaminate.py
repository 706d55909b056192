"""Benchmark decontamination by winnowing.

Words are runs of digits, letters and non-ASCII characters after lower-casing A-Z. A window is 13
consecutive words of an item; an item of fewer words is one window.

* Fingerprints: of every 6 consecutive 8-gram hashes the least is kept, in items and documents alike.
  A shared span of 13 words has 6 such 8-grams in common, so both sides keep a common one.
* Items of fewer than 13 words are shorter than that guarantee: all n-grams of their length are looked up.
* Items of at most `BLOCK_CHARS` characters in all are sent to all tasks, and documents are looked up where they lie,
  without a shuffle. Larger benchmarks never meet the driver: the fingerprints of both sides are joined by a shuffle, and each
  document is then given the items that it has one in common with.
* A common fingerprint is only a candidate: it is extended word by word, on the words themselves, to the longest
  shared run, and counts if that run holds a window.

A document is contaminated if 5 in 100 of its words or more are hit.

Defined cases: null or empty text, or one without words: no words, no hits, clean. Items without words
(or null) match nothing; a null item_id takes part, but can't be listed. Ids may have any type that casts to a string. Items of equal words are found together. Rows that repeat are judged alike.
A text of any length is taken whole. Columns of the documents pass through `mark` and `clean` unchanged; `mark` refuses one with the name of its result. No items: all clean.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from kelpline.llm.common import Scratch, free, row_of, slices, unused
from kelpline.llm.wordhash import ALNUM, U64, Words, grams

WINDOW, GRAM = 13, 8
SPAN = WINDOW - GRAM + 1
#: characters of items that may be gathered and sent to all tasks
BLOCK_CHARS = 16 << 20
PARTS_PER_CENT = 5

_HITS = row_of(n_words=T.LongType(), n_hit=T.LongType(), items=T.ArrayType(T.StringType()))


def winnowed(hashes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Places whose hash is the least of some SPAN consecutive ones of one group; all of them if there are ties."""
    n = len(hashes) - SPAN + 1
    kept = np.zeros(len(hashes), dtype=bool)
    if n <= 0:
        return np.flatnonzero(kept)
    least = hashes[:n].copy()
    for j in range(1, SPAN):
        np.minimum(least, hashes[j : j + n], out=least)
    whole = group[:n] == group[SPAN - 1 :]
    for j in range(SPAN):
        kept[j : j + n] |= whole & (hashes[j : j + n] == least)
    return np.flatnonzero(kept)


class Items:
    """Benchmark items, by their words: fingerprints of long ones and the whole of short ones."""

    def __init__(self, rows: list[tuple[str | None, str | None]]):
        words = Words(pa.array([t for _, t in rows], pa.string()), ALNUM)
        ids, seen = defaultdict(list), {}
        for i, (item, _) in enumerate(rows):
            own = tuple(words.text(j) for j in range(words.first[i], words.first[i + 1]))
            if own:
                ids[own].append(item)
                seen.setdefault(own, i)
        self.words = list(seen)
        self.ids = [ids[own] for own in self.words]
        long, place, short = [], [], defaultdict(list)
        for k, own in enumerate(self.words):
            hashes = words.hash[words.first[seen[own]] : words.first[seen[own] + 1]]
            if len(own) >= WINDOW:
                g = grams(hashes, GRAM)
                at = winnowed(g, np.zeros(len(g), np.int8))
                long.append(g[at])
                place += [(k, int(j)) for j in at]
            else:
                short[len(own)].append((grams(hashes, len(own))[0], k))
        flat = np.concatenate(long) if long else np.zeros(0, U64)
        order = np.argsort(flat, kind="stable")
        self.prints, self.places = flat[order], [place[i] for i in order]
        self.short = {n: (np.array([h for h, _ in sorted(v)], U64), [k for _, k in sorted(v)]) for n, v in short.items()}


def _looked_up(table: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of places in hashes and in the sorted table that are equal."""
    if not len(table) or not len(hashes):
        return
    low = np.searchsorted(table, hashes)
    for i in np.flatnonzero(table[np.minimum(low, len(table) - 1)] == hashes):
        j = low[i]
        while j < len(table) and table[j] == hashes[i]:
            yield int(i), int(j)
            j += 1


def _found(words: Words, items: Items) -> tuple[dict[int, list[tuple[int, int]]], dict[int, set[int]]]:
    """By row of the batch: runs of hit words (from, to; in the text), and the items found."""
    runs, found = defaultdict(list), defaultdict(set)
    g = grams(words.hash, GRAM)
    own = words.doc[: len(g)]
    inside = own == words.doc[GRAM - 1 :][: len(g)] if len(g) else np.zeros(0, bool)
    g, own, at = g[inside], own[inside], np.flatnonzero(inside)
    kept = winnowed(g, own)
    done: dict[tuple[int, int, int], int] = {}
    for i, j in _looked_up(items.prints, g[kept]):
        p, (k, q) = int(at[kept[i]]), items.places[j]
        doc = int(words.doc[p])
        first, last, item = int(words.first[doc]), int(words.first[doc + 1]), items.words[k]
        if done.get((doc, k, p - q), -1) > p:
            continue  # in a run that is known
        lo, hi = 0, 0
        while p - lo > first and q - lo > 0 and words.text(p - lo - 1) == item[q - lo - 1]:
            lo += 1
        while p + hi < last and q + hi < len(item) and words.text(p + hi) == item[q + hi]:
            hi += 1
        done[doc, k, p - q] = p + max(hi, 1)
        if lo + hi >= WINDOW:
            runs[doc].append((p - lo - first, p + hi - first))
            found[doc].add(k)
    for n, (table, which) in items.short.items():
        g = grams(words.hash, n)
        for p, j in _looked_up(table, g):
            doc = int(words.doc[p])
            if p + n <= words.first[doc + 1] and tuple(words.text(p + x) for x in range(n)) == items.words[which[j]]:
                runs[doc].append((p - int(words.first[doc]), p + n - int(words.first[doc])))
                found[doc].add(which[j])
    return runs, found


def _union(runs: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(runs):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _judged(rows: Iterator[tuple[pa.Array, Items]]) -> pa.Array:
    """For parts of a column of texts, each with its items: what _HITS says."""
    n_words, n_hit, items_of = [], [], []
    for part, items in rows:
        words = Words(part, ALNUM)
        runs, found = _found(words, items)
        n_words.append(np.diff(words.first))
        for i in range(len(part)):
            own = _union(runs[i]) if i in runs else []
            n_hit.append(sum(own[1::2]) - sum(own[0::2]))
            items_of.append(sorted({x for k in found[i] for x in items.ids[k] if x is not None}) if i in found else [])
    n = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
    fields = [pa.field("n_words", pa.int64()), pa.field("n_hit", pa.int64()), pa.field("items", pa.list_(pa.string()))]
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items_of, pa.list_(pa.string()))], fields=fields)


def _by_block(block):
    @arrow_udf(_HITS)
    def hits(text: pa.Array) -> pa.Array:
        return _judged((part, block.value) for part in slices(text))

    return hits.asNondeterministic()  # else a later filter would run it twice


@arrow_udf(_HITS)
def _by_candidates(text: pa.Array, items: pa.Array) -> pa.Array:
    """Each text with the items (item_id, text) that it may hold."""
    return _judged((text.slice(i, 1), Items([(x["item_id"], x["text"]) for x in items[i].as_py() or []])) for i in range(len(text)))


_PRINTS, _LONGS = T.ArrayType(T.LongType()), pa.list_(pa.int64())


@arrow_udf(_PRINTS)
def _item_prints(text: pa.Array) -> pa.Array:
    """Fingerprints of each item, with the number of its words in the low 4 bits if it is a short one, else 0."""
    out = []
    for part in slices(text):
        words = Words(part, ALNUM)
        for i in range(len(part)):
            hashes = words.hash[words.first[i] : words.first[i + 1]]
            n = len(hashes)
            g = grams(hashes, GRAM if n >= WINDOW else max(n, 1))
            kept = g[winnowed(g, np.zeros(len(g), np.int8))] if n >= WINDOW else g[:1]
            out.append(np.unique((kept & ~U64(15)) | U64(n if n < WINDOW else 0)).view(np.int64))
    return pa.array(out, _LONGS)


def _doc_prints(lengths: list[int]):
    @arrow_udf(_PRINTS)
    def prints(text: pa.Array) -> pa.Array:
        out = []
        for part in slices(text):
            words = Words(part, ALNUM)
            for i in range(len(part)):
                hashes = words.hash[words.first[i] : words.first[i + 1]]
                g = grams(hashes, GRAM)
                own = [g[winnowed(g, np.zeros(len(g), np.int8))] & ~U64(15)]
                own += [(grams(hashes, n) & ~U64(15)) | U64(n) for n in lengths]
                out.append(np.unique(np.concatenate(own)).view(np.int64))
        return pa.array(out, _LONGS)

    return prints.asNondeterministic()


def _joined(docs: DataFrame, items: DataFrame, column: str) -> DataFrame:
    """docs with the struct of _HITS, by a shuffled join of fingerprints. items: item_id (a string), text."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    rid, cands = unused(docs, "rid_"), unused(docs, "items_")
    docs_ = scratch.save(docs.withColumn(rid, F.monotonically_increasing_id()))
    prints = scratch.save(items.withColumn("key", F.monotonically_increasing_id()).withColumn("prints", _item_prints("text")).where(F.size("prints") > 0))
    prints_ = prints.select("key", F.explode("prints").alias("print"))
    lengths = [r[0] for r in prints_.select((F.col("print").bitwiseAND(15)).cast("int")).distinct().collect()]  # 13 at most
    own = docs_.select(F.col(rid).alias("rid"), _doc_prints(sorted(n for n in lengths if n))("text").alias("prints")).select("rid", F.explode("prints").alias("print"))
    # prints that no item has are dropped before any text is moved
    pairs = scratch.save(own.join(prints_, "print").select("rid", "key").distinct())
    lists = pairs.join(prints.select("key", "item_id", "text"), "key").groupBy("rid").agg(F.collect_list(F.struct("item_id", "text")).alias(cands))
    lists = lists.withColumnRenamed("rid", f"{rid}r")
    out = docs_.join(lists, F.col(rid) == F.col(f"{rid}r"), "left")
    return out.select(*docs.columns, _by_candidates.asNondeterministic()("text", cands).alias(column))


def mark(docs: DataFrame, benchmark: DataFrame, column: str = "contamination") -> DataFrame:
    """docs with one more column, a struct: n_words, n_hit, items (found item_ids as sorted strings), contaminated."""
    free(docs, column)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    hits = unused(docs, "hits_")
    if (items.agg(F.sum(F.length("text") + 100)).first()[0] or 0) <= BLOCK_CHARS:
        rows = [(r[0], r[1]) for r in items.collect()]
        out = docs.withColumn(hits, _by_block(docs.sparkSession.sparkContext.broadcast(Items(rows)))("text"))
    else:
        out = _joined(docs, items, hits)
    n_words, n_hit = F.col(f"{hits}.n_words"), F.col(f"{hits}.n_hit")
    contaminated = (n_hit > 0) & (F.lit(100 // PARTS_PER_CENT) * n_hit >= n_words)
    return out.select(*docs.columns, F.struct(n_words.alias("n_words"), n_hit.alias("n_hit"), F.col(f"{hits}.items").alias("items"), contaminated.alias("contaminated")).alias(column))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that aren't contaminated, with all their columns."""
    name = unused(docs, "contamination")
    return mark(docs, benchmark, name).where(~F.col(f"{name}.contaminated")).select(*docs.columns)
