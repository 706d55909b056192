"""Line dedup by content-defined chunks, and by windows for what the chunks' borders lose.

Lines are hashed, and a rolling hash over the last `WIDTH` line hashes sets a boundary after a line where it is 0
modulo `DIVISOR`. Boundaries depend on nearby lines only, so a passage that stands elsewhere in another document
is cut at the same lines, but for its edges. A chunk is what lies between boundaries. Chunks of at least `LEAST_LINES`
lines with a word that occur more than once in all documents are removed but for their first occurrence (by
doc_id, then place), after their bytes have been compared.

Chunks at a passage's edges merge with foreign lines, and a short passage holds no whole chunk. With `over`, so do
windows: from each line with a word the fewest lines on, and to each the fewest lines back, that have more than
`over` words. A run of equal lines of more than `over` words starts with a window and has one ending at each later line
that none from its start reaches, all inside it. So every line of a run that stood before (and does not overlap that place) goes, also a
long line alone. Chunks and windows are blocks below. The first occurrence of a line is never removed, but a first
occurrence of a block may lose lines that are a later occurrence of another. Equal words on unequal lines stay.

1. Blocks of all documents, by a 128-bit hash and place, without their bytes: counted, and those that repeat found.
2. Each document is joined once with the list of its repeated blocks, and saved so; only these blocks' bytes are
   compared, by grouping on the hash: the least and the greatest text are equal if all are. (A hash that two texts share removes neither.)
3. The saved documents are returned without the lines of the blocks that repeat.

Defined cases: null text stays null, an empty one empty. Rows that repeat a doc_id and a text are one document: they
are cleaned alike, and not against each other. A null doc_id sorts first. A line is what \\n separates, a word what
ASCII white space does. A block that overlaps its first occurrence stays. A text of any length is taken whole. Columns of the
documents pass through `dedup`; one with the name of the result is refused. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from kelpline.llm.common import Scratch, free, row_of, slices, unused
from kelpline.llm.wordhash import BASE, U64, mix

WIDTH, DIVISOR, LEAST_LINES = 2, 4, 2
#: Runs of equal lines of more words than these are found wholly.
OVER = 50
_WHITE = b" \t\n\x0b\f\r"


def _line_hash(line: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(line, digest_size=8).digest(), "little")


def _lines(text: bytes) -> list[bytes]:
    return text.splitlines(keepends=True) if not set(text) & {0x0B, 0x0C, 0x0D} else [x + b"\n" for x in text.split(b"\n")[:-1]] + [x for x in text.split(b"\n")[-1:] if x]


def _ends(lines: list[bytes]) -> list[int]:
    """Where the chunks end."""
    if not lines:
        return []
    own = np.array([_line_hash(x.rstrip(b"\n")) for x in lines], dtype=U64)
    rolling = own.copy()
    for j in range(1, WIDTH):
        rolling[j:] = rolling[j:] + own[:-j] * U64(pow(int(BASE), j, 1 << 64))
    cut = mix(rolling) % U64(DIVISOR) == 0
    cut[-1] = True
    return (np.flatnonzero(cut) + 1).tolist()


def chunks(text: bytes) -> list[list[bytes]]:
    """The lines of a text (with their \\n), chunk by chunk."""
    lines = _lines(text)
    ends = _ends(lines)
    return [lines[a:b] for a, b in zip([0, *ends], ends)]


def _windows(words: np.ndarray, over: int) -> set[tuple[int, int]]:
    """First line and one past the last of all windows: the least ones of more than `over` words from a line, and to a line."""
    at = np.flatnonzero(words)
    total = np.concatenate([[0], np.cumsum(words[at])])
    n = len(at)
    ends = np.searchsorted(total, total[:-1] + over, side="right")
    starts = np.searchsorted(total, total[1:] - over, side="left") - 1
    on = zip(at[ends <= n], at[ends[ends <= n] - 1] + 1)
    back = zip(at[starts[starts >= 0]], at[starts >= 0] + 1)
    return {(int(a), int(b)) for pairs in (on, back) for a, b in pairs}


def _blocks(text: bytes, over: int | None) -> list[dict]:
    """first (line), past (one past the last) and key of the chunks that count and of the windows."""
    lines = _lines(text)
    ends = _ends(lines)
    words = [len(x.split()) for x in lines]
    some = np.concatenate([[0], np.cumsum(np.array(words, dtype=np.int64) > 0)])
    spans = {(a, b) for a, b in zip([0, *ends], ends) if some[b] - some[a] >= LEAST_LINES}
    if over is not None and sum(words) > over:
        spans |= _windows(np.array(words, dtype=np.int64), over)
    at = np.cumsum([0, *map(len, lines)])
    return [{"first": a, "past": b, "key": hashlib.blake2b(text[at[a] : at[b]].rstrip(b"\n"), digest_size=16).digest()} for a, b in sorted(spans)]


@arrow_udf(T.ArrayType(row_of(first=T.IntegerType(), past=T.IntegerType(), key=T.BinaryType())))
def _block_keys(text: pa.Array, over: pa.Array) -> pa.Array:
    out, n = [], 0
    for part in slices(text):
        for x in part.to_pylist():
            out.append(_blocks((x or "").encode(), over[n].as_py()))
            n += 1
    return pa.array(out, pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32()), ("key", pa.binary())])))


@arrow_udf(T.ArrayType(T.BinaryType()))
def _block_texts(text: pa.Array, found: pa.Array) -> pa.Array:
    out = []
    for x, spans in zip(text, found):
        x = (x.as_py() or "").encode()
        at = np.cumsum([0, *map(len, _lines(x))])
        out.append([x[at[s["first"]] : at[s["past"]]].rstrip(b"\n") for s in spans.as_py()])
    return pa.array(out, pa.list_(pa.binary()))


@arrow_udf(T.StringType())
def _without(text: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for x, gone in zip(text, spans):
        x, gone = x.as_py(), {i for s in gone.as_py() or () for i in range(s["first"], s["past"])}
        out.append(x if not gone or x is None else b"".join(line for i, line in enumerate(_lines(x.encode())) if i not in gone).decode())
    return pa.array(out, pa.string())


def dedup(docs: DataFrame, column: str = "line_dedup", over: int | None = None) -> DataFrame:
    """docs with text cleaned, and a struct: n_removed, the blocks that repeat an earlier one. Without `over`, only chunks are blocks."""
    free(docs, column)
    scratch = Scratch(docs.sparkSession, "line_dedup")
    # a row is known by its id and a hash of its text
    mark = F.xxhash64("text")
    own = docs.select(F.col("doc_id"), mark.alias("mark"), F.explode(_block_keys("text", F.lit(over).cast("int"))).alias("c")).select("doc_id", "mark", "c.*")
    own = scratch.save(own)
    place = F.struct("doc_id", "mark", "first", "past")
    # rows that repeat wholly have one place: least and greatest are the same if no other document has the block, nor another place
    repeated = own.groupBy("key").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where(~F.col("lo").eqNullSafe(F.col("hi")))
    repeated = scratch.save(repeated.select("key", "lo"))
    same = F.col("doc_id").eqNullSafe(F.col("lo.doc_id")) & F.col("mark").eqNullSafe(F.col("lo.mark"))
    found = own.join(repeated, "key").select("doc_id", "mark", "first", "past", "key", (same & (F.col("first") < F.col("lo.past"))).alias("keeps"))
    lists = scratch.save(found.distinct().groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list(F.struct("first", "past", "key", "keeps"))).alias("found")))
    scratch.drop(own)
    d, m, g, h = (unused(docs, x) for x in ("d_", "m_", "found_", "mark_"))
    with_mark = docs.withColumn(h, mark)

    def placed(lists: DataFrame) -> DataFrame:
        """docs, each with its repeated blocks. Always a shuffled join: the lists grow with the documents."""
        right = lists.select(F.col("doc_id").alias(d), F.col("mark").alias(m), F.col("found").alias(g)).hint("merge")
        return scratch.save(with_mark.join(right, F.col("doc_id").eqNullSafe(F.col(d)) & F.col(h).eqNullSafe(F.col(m)), "left").drop(d, m, h))

    out = placed(lists)
    some = out.where(F.col(g).isNotNull()).select(F.col(g).alias("found"), _block_texts("text", F.transform(g, lambda x: F.struct(x["first"].alias("first"), x["past"].alias("past")))).alias("bytes"))
    pairs = some.select(F.explode(F.arrays_zip(F.transform("found", lambda x: x["key"]).alias("key"), F.col("bytes"))).alias("z")).select("z.key", "z.bytes")
    clash = scratch.save(pairs.groupBy("key").agg(F.min("bytes").alias("a"), F.max("bytes").alias("b")).where("a <> b").select("key"))
    if not clash.isEmpty():
        bad = lists.select("doc_id", "mark", F.explode("found").alias("f")).select("doc_id", "mark", "f.*").join(clash, "key", "left_anti")
        scratch.drop(out)
        out = placed(bad.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list(F.struct("first", "past", "key", "keeps"))).alias("found")))
    scratch.drop(lists, repeated)
    gone = F.transform(F.filter(g, lambda x: ~x["keeps"]), lambda x: F.struct(x["first"].alias("first"), x["past"].alias("past")))
    text = unused(docs, "text_")
    out = out.withColumn(g, F.coalesce(gone, F.array().cast("array<struct<first:int,past:int>>")))
    out = out.withColumn(text, F.when(F.size(g) == 0, F.col("text")).otherwise(_without("text", g)))
    removed = F.size(g).cast("bigint")
    return out.select(*[F.col(text).alias("text") if c == "text" else F.col(c) for c in docs.columns], F.struct(removed.alias("n_removed")).alias(column))
