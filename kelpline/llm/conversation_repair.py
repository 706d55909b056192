"""Conversation structure repair: faults of turns, and the cheapest edits that make roles alternate.

1. Rows are put into the order of conversation and turn by range partitions, so that a conversation may hold any share of the rows, and the
   order is cut into blocks of 2^BLOCK_BITS rows.
2. A conversation inside one block is solved there: Dial's bucket queue (repair_paths.py) gives the distances to the end, and a walk along
   tight arcs, the least letter first, the audit.
3. Of one that spans blocks, each block's rows become a matrix of the least costs from state to state. A scan from the end gives each
   block the distances behind it, and one from the beginning the state in which it is entered; both take groups of at most
   2^FAN_BITS matrices. Then each block walks its own arcs. The rows that remain pass one task in order, as SHA-256 has to see them, which keeps nothing
   but the digest and the audit.

Edits: keep a row for 0, give it the role user or assistant for 3 (and 3 more if it stays truncated, as for keeping), delete it for 4, insert an empty user or assistant row
anywhere for 3. Blank rows and duplicates have to be deleted.

Defined cases: a null role or text is one space, which is no role that may stay, and a blank text. Null turns come first and count for no gap; a null conv_id is a
conversation. Rows of one turn go by role and then by text, and rows equal in all are duplicates of the first. A role counts by its first
character, and an empty one may not stay. Texts of any length are taken whole. A conversation all of whose rows are gone has zeros, an empty audit and the digest of
an empty text. gaps is at most the largest long. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpline.llm import repair_paths as paths
from kelpline.llm.common import Scratch, row_of, small
from kelpline.llm.ordering import in_order

BLOCK_BITS = 10
FAN_BITS = 10
WHITE = "[\\x20\\x09-\\x0D]"
_STRIPPED = " \t\n\x0b\x0c\r"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = [*row_of(**{c: T.LongType() for c in _COUNTS}, audit=T.StringType(), repaired_sha256=T.StringType())]
_LEGAL = ("su", "ua", "au")
_MOST = (1 << 63) - 1


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and gone of the rows, damaged by the CRC-32 of `conv_id:turn` modulo 20 (nulls: one space).

    0 drops the row (it stays, marked gone), 1 empties its text, 2 removes its ends of sentences, 3 repeats it, 4 makes it a user's.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), (F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20).alias("hurt"))
    text = F.when(F.col("hurt") == 1, "").when(F.col("hurt") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("hurt") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("hurt") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("hurt") == 0).alias("gone"), copies.alias("copy")).drop("copy")


def _kinds(roles: list[str], texts: list[str]) -> bytes:
    """A code for each row: its fault, and the initial of its role."""
    seen: set[tuple[str, str]] = set()
    out = bytearray()
    for role, text in zip(roles, texts):
        rest = text.strip(_STRIPPED)
        fault = 8 if not rest else 12 if (role, text) in seen else 4 if rest[-1] not in ".!?" else 0
        seen.add((role, text))
        out.append(fault + (paths.ROLES.find(role[:1]) % 4 if role else 3))
    return bytes(out)


def _codes(kinds: bytes) -> bytes:
    """The codes of repair_paths: blank rows and duplicates (8 and 12 on) are the same there."""
    return bytes(min(k, 8 + k % 4) for k in kinds)


def _counted(kinds: bytes, roles: list[str], turns: list[int | None]) -> tuple[int, int, int, int, int]:
    known = {t for t in turns if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    illegal = sum(a[:1] + b[:1] not in _LEGAL for a, b in zip(roles, roles[1:]))
    fault = [k // 4 for k in kinds]
    return min(gaps, _MOST), fault.count(2), fault.count(3), fault.count(1), illegal


def _runs(t: pa.Table) -> Iterator[tuple[int, int]]:
    """Where the conversations of a block, sorted by place, begin and end."""
    ids = t["conv_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    cuts = [0, *(np.nonzero(np.diff(ids))[0] + 1).tolist(), len(ids)] if len(ids) else [0]
    return zip(cuts, cuts[1:])


def _present(t: pa.Table, start: int, end: int) -> tuple[list, list[str], list[str]]:
    part = t.slice(start, end - start)
    part = part.filter(pc.invert(part["gone"]))
    return part["turn"].to_pylist(), part["role"].to_pylist(), part["text"].to_pylist()


def _solved(t: pa.Table) -> pa.Table:
    """One row for each conversation of a block."""
    t = t.sort_by("at")
    starts, out = [], {f.name: [] for f in _RESULT}
    for start, end in _runs(t):
        turns, roles, texts = _present(t, start, end)
        kinds = _kinds(roles, texts)
        audit, _ = paths.walk(_codes(kinds), paths.START, paths.GOAL, True)
        lines = [f"{role}:{text}" for x, role, text in paths.edited(audit, paths.START, roles, texts) if x != "D"]
        found = [*_counted(kinds, roles, turns), paths.cost_of(audit, _codes(kinds)), audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()]
        starts.append(start)
        for f, x in zip(_RESULT, found):
            out[f.name].append(x)
    kinds_of = [pa.string() if isinstance(f.dataType, T.StringType) else pa.int64() for f in _RESULT]
    return pa.table({"conv_id": t["conv_id"].take(pa.array(starts, pa.int64()))} | {f.name: pa.array(out[f.name], k) for f, k in zip(_RESULT, kinds_of)})


_EDIT = [*row_of(block=T.LongType(), k=T.LongType(), letter=T.StringType(), role=T.StringType(), text=T.StringType(), cost=T.LongType())]


def _edit_rows(conv, block: int, letters: str, start: int, codes: bytes, roles: list[str], texts: list[str]) -> list[tuple]:
    out, i = [], 0
    for k, (letter, role, text) in enumerate(paths.edited(letters, start, roles, texts)):
        own = b"" if letter == "I" else codes[i : i + 1]
        out.append((conv, block, k, letter, role, text, paths.cost_of(letter, own)))
        i += letter != "I"
    return out


def _edit_table(rows: list[tuple], conv: pa.DataType) -> pa.Table:
    kinds = [conv, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.table({name: pa.array(list(c), k) for name, c, k in zip(["conv_id", *[f.name for f in _EDIT]], columns, kinds)})


def _scan(scratch: Scratch, pieces: DataFrame, combine: Callable, apply: Callable, start: tuple[int, ...], backward: bool, bits: int) -> DataFrame:
    """conv_id, key and `carry` of pieces (conv_id, key, value): `apply` of all values before it (behind it, if backward) to `start`.

    Values of neighbouring keys are combined in groups of at most 2^bits, level by level, until each conversation has one; then
    carries go down the same levels.
    """
    group = F.shiftright("key", bits).alias("up")
    conv = pieces.schema["conv_id"]
    longs = T.ArrayType(T.LongType())
    levels = [pieces]
    while not levels[-1].groupBy("conv_id").count().where("count > 1").isEmpty():

        def fold(t: pa.Table) -> pa.Table:
            values = [tuple(v) for v in t.sort_by("key")["value"].to_pylist()]
            out = values[0]
            for v in values[1:]:
                out = combine(out, v)
            return pa.table({"conv_id": t["conv_id"][:1], "key": t["up"][:1], "value": pa.array([out], pa.list_(pa.int64()))})

        up = levels[-1].select("conv_id", group, "key", "value").groupBy("conv_id", "up").applyInArrow(fold, T.StructType([conv, T.StructField("key", T.LongType()), T.StructField("value", longs)]))
        levels.append(scratch.save(up))
    carried = levels[-1].select("conv_id", "key", F.lit(list(start)).cast(longs).alias("carry"))

    def deal(t: pa.Table) -> pa.Table:
        t = t.sort_by([("key", "descending" if backward else "ascending")])
        carry, out = tuple(t["carry"][0].as_py()), []
        for v in t["value"].to_pylist():
            out.append(carry)
            carry = apply(tuple(v), carry)
        return pa.table({"conv_id": t["conv_id"], "key": t["key"], "carry": pa.array(out, pa.list_(pa.int64()))})

    for level in reversed(levels[:-1]):
        above = small(carried).select(F.col("conv_id").alias("conv_"), F.col("key").alias("up_"), "carry")
        rows = level.select("conv_id", group, "key", "value")
        rows = rows.join(above, rows["conv_id"].eqNullSafe(above["conv_"]) & (rows["up"] == above["up_"])).select("conv_id", "up", "key", "value", "carry")
        carried = scratch.save(rows.groupBy("conv_id", "up").applyInArrow(deal, T.StructType([conv, T.StructField("key", T.LongType()), T.StructField("carry", longs)])))
    return carried


_PIECE = [*row_of(
    key=T.LongType(), value=T.ArrayType(T.LongType()), blank=T.LongType(), duplicate=T.LongType(), truncated=T.LongType(), illegal=T.LongType(), first=T.StringType(), last=T.StringType(),
    low=T.LongType(), high=T.LongType(), turns=T.LongType(),
)]


class _Spanning:
    """Conversations whose rows span blocks: rows (conv_id, at, block, turn, role, text) that are not gone."""

    def __init__(self, scratch: Scratch, rows: DataFrame, fan_bits: int):
        self.conv, self.scratch = rows.schema["conv_id"], scratch
        name = F.sha2("text", 256)
        firsts = rows.groupBy(F.col("conv_id").alias("conv_"), F.col("role").alias("role_"), name.alias("name_")).agg(F.min("at").alias("first"))
        both = rows.join(firsts, rows["conv_id"].eqNullSafe(firsts["conv_"]) & (rows["role"] == firsts["role_"]) & (name == firsts["name_"]))
        last = F.substring(F.regexp_replace("text", f"{WHITE}+$", ""), -1, 1)
        fault = F.when(~F.col("text").rlike("[^\\x20\\x09-\\x0D]"), 8).when(F.col("at") != F.col("first"), 12).when(~last.isin(".", "!", "?"), 4).otherwise(0)
        initial = F.substring("role", 1, 1)
        code = fault + F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
        self.rows = scratch.save(both.select("conv_id", "at", "block", "turn", "role", "text", code.alias("kind")))
        pieces = self.rows.select("conv_id", "block", "at", "turn", F.substring("role", 1, 1).alias("role"), "kind")
        self.pieces = scratch.save(pieces.groupBy("conv_id", "block").applyInArrow(self._piece, T.StructType([self.conv, *_PIECE])))
        ends = _scan(scratch, self.pieces.select("conv_id", "key", "value"), paths.combined, paths.before, paths.GOAL, True, fan_bits)
        finals = self.pieces.groupBy("conv_id").agg(F.max("key").alias("final"))
        ends = self._beside(ends.withColumnRenamed("carry", "end"), finals)
        joined = self._beside(self.rows, ends.withColumnRenamed("key", "block_of"), ("block", "block_of"))
        self.placed = scratch.save(joined.withColumn("last", F.col("block") == F.col("final")).drop("block_of", "final"))
        exits = self.placed.select("conv_id", "block", "at", "kind", "end", "last").groupBy("conv_id", "block").applyInArrow(self._exits, T.StructType([self.conv, *_PIECE[:2]]))
        entered = lambda a, b: tuple(b[s] for s in a)
        states = _scan(scratch, scratch.save(exits), entered, lambda v, s: (v[s[0]],), (paths.START,), False, fan_bits)
        self.states = states.select("conv_id", F.col("key").alias("block_of"), F.get("carry", F.lit(0)).alias("state"))

    @staticmethod
    def _beside(a: DataFrame, b: DataFrame, more: tuple[str, str] | None = None) -> DataFrame:
        b = small(b.withColumnRenamed("conv_id", "conv_"))
        on = a["conv_id"].eqNullSafe(b["conv_"])
        return a.join(b, on & (a[more[0]] == b[more[1]]) if more else on).drop("conv_")

    @staticmethod
    def _piece(t: pa.Table) -> pa.Table:
        t = t.sort_by("at")
        kinds, roles, turns = bytes(t["kind"].to_pylist()), t["role"].to_pylist(), t["turn"].to_pylist()
        _, blank, duplicate, truncated, illegal = _counted(kinds, roles, [])
        known = {x for x in turns if x is not None}
        found = [t["block"][0].as_py(), list(paths.matrix(_codes(kinds))), blank, duplicate, truncated, illegal, roles[0], roles[-1], min(known, default=None), max(known, default=None), len(known)]
        types = [pa.int64(), pa.list_(pa.int64()), *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int64()] * 3]
        return pa.table({"conv_id": t["conv_id"][:1]} | {f.name: pa.array([x], k) for f, x, k in zip(_PIECE, found, types)})

    @staticmethod
    def _exits(t: pa.Table) -> pa.Table:
        """The state behind the rows for each state before them."""
        t = t.sort_by("at")
        codes, end, last = _codes(bytes(t["kind"].to_pylist())), tuple(t["end"][0].as_py()), t["last"][0].as_py()
        out = [paths.walk(codes, s, end, last)[1] for s in range(4)]
        return pa.table({"conv_id": t["conv_id"][:1], "key": t["block"][:1], "value": pa.array([out], pa.list_(pa.int64()))})

    def edits(self) -> DataFrame:
        def walk(t: pa.Table) -> pa.Table:
            t = t.sort_by("at")
            roles, texts, codes = t["role"].to_pylist(), t["text"].to_pylist(), _codes(bytes(t["kind"].to_pylist()))
            state = t["state"][0].as_py()
            letters, _ = paths.walk(codes, state, tuple(t["end"][0].as_py()), t["last"][0].as_py())
            return _edit_table(_edit_rows(t["conv_id"][0].as_py(), t["block"][0].as_py(), letters, state, codes, roles, texts), t.schema.field("conv_id").type)

        joined = self._beside(self.placed, self.states, ("block", "block_of")).drop("block_of")
        return joined.groupBy("conv_id", "block").applyInArrow(walk, T.StructType([self.conv, *_EDIT]))

    def results(self) -> DataFrame:
        order = Window.partitionBy("conv_id").orderBy("key")
        before = lambda c: F.lag(c).over(order)
        pieces = self.pieces.withColumn("met", (~F.concat(before("last"), F.col("first")).isin(*_LEGAL)).cast("bigint")).withColumn("again", (before("high") == F.col("low")).cast("bigint"))
        gaps = F.max("high").cast("decimal(20,0)") - F.min("low") + 1 - F.sum("turns") + F.coalesce(F.sum("again"), F.lit(0))
        counts = pieces.groupBy("conv_id").agg(
            F.least(F.coalesce(gaps, F.lit(0)), F.lit(_MOST)).cast("bigint").alias("gaps"), F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"),
            F.sum("truncated").alias("truncated"), (F.sum("illegal") + F.coalesce(F.sum("met"), F.lit(0))).alias("illegal"),
        )
        told = row_of(cost=T.LongType(), audit=T.StringType(), repaired_sha256=T.StringType())
        one = self.edits().repartition("conv_id").sortWithinPartitions("conv_id", "block", "k").mapInArrow(_told, T.StructType([self.conv, *told]))
        joined = self._beside(counts, self.scratch.save(one))
        return joined.select("conv_id", *[f.name for f in _RESULT])


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cost, audit and digest of each conversation whose edits pass by in order."""
    open_, conv = None, None

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([conv, pa.array([open_[0]], pa.int64()), pa.array(["".join(open_[1])], pa.string()), pa.array([open_[2].hexdigest()], pa.string())], ["conv_id", "cost", "audit", "repaired_sha256"])

    for batch in batches:
        for start, end in _runs(pa.Table.from_batches([batch])):
            if open_ is None or conv[0].as_py() != batch["conv_id"][start].as_py():
                if open_ is not None:
                    yield closed()
                open_, conv, empty = [0, [], hashlib.sha256()], batch["conv_id"].slice(start, 1), True
            part = batch.slice(start, end - start)
            open_[0] += sum(part["cost"].to_pylist())
            open_[1].append("".join(part["letter"].to_pylist()))
            for role, text in zip(part["role"].to_pylist(), part["text"].to_pylist()):
                if role is not None:
                    open_[2].update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                    empty = False
    if open_ is not None:
        yield closed()


def _cut(scratch: Scratch, rows: DataFrame, block_bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows of conversations inside one block, and of those that span blocks, with `at` and `block`."""
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), name("role").alias("role"), F.when(gone, "").otherwise(name("text")).alias("text"), gone.alias("gone"))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    ordered = in_order(scratch, rows, *keys, F.col("text"), dealt_by=[*keys, F.substring("text", 1, 64)])
    ordered = ordered.withColumn("block", F.shiftright("at", block_bits))
    spans = ordered.groupBy("conv_id").agg(F.min("block").alias("low"), F.max("block").alias("high")).where("low < high").select(F.col("conv_id").alias("conv_"))
    spans = small(scratch.save(spans))
    on = ordered["conv_id"].eqNullSafe(spans["conv_"])
    return ordered.join(spans, on, "left_anti"), ordered.join(spans, on, "left_semi")


def repair(rows: DataFrame, block_bits: int = BLOCK_BITS, fan_bits: int = FAN_BITS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every conversation of rows
    (conv_id, turn, role, text, and perhaps gone: rows that count for nothing but their conv_id)."""
    with Scratch(rows.sparkSession, "repair") as scratch:
        inside, spanning = _cut(scratch, rows, block_bits)
        kind = T.StructType([inside.schema["conv_id"], *_RESULT])
        out = inside.groupBy("block").applyInArrow(_solved, kind)
        present = scratch.save(spanning.where("not gone").drop("gone"))
        if spanning.isEmpty():
            return out
        # a conversation of which only gone rows span blocks is solved without rows
        left = spanning.groupBy("conv_id").agg(F.min("at").alias("at"), F.bool_and("gone").alias("gone")).where("gone")
        left = left.select("conv_id", "at", F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), "gone", F.shiftright("at", block_bits).alias("block"))
        out = out.unionByName(left.groupBy("block").applyInArrow(_solved, kind))
        return out.unionByName(_Spanning(scratch, present, fan_bits).results()) if not present.isEmpty() else out


def edits(rows: DataFrame, block_bits: int = BLOCK_BITS, fan_bits: int = FAN_BITS) -> DataFrame:
    """The edits themselves in their order: conv_id, block and k, letter, the role and text that stay (null if deleted), cost."""
    with Scratch(rows.sparkSession, "repair") as scratch:
        inside, spanning = _cut(scratch, rows, block_bits)
        kind = T.StructType([inside.schema["conv_id"], *_EDIT])

        def solved(t: pa.Table) -> pa.Table:
            t, out = t.sort_by("at"), []
            for start, end in _runs(t):
                _, roles, texts = _present(t, start, end)
                codes = _codes(_kinds(roles, texts))
                letters, _ = paths.walk(codes, paths.START, paths.GOAL, True)
                out += _edit_rows(t["conv_id"][start].as_py(), t["block"][start].as_py(), letters, paths.START, codes, roles, texts)
            return _edit_table(out, t.schema.field("conv_id").type)

        out = inside.groupBy("block").applyInArrow(solved, kind)
        present = scratch.save(spanning.where("not gone").drop("gone"))
        return out if present.isEmpty() else out.unionByName(_Spanning(scratch, present, fan_bits).edits())
