"""Merkle manifest of a dataset by superblock reduction, with a proof for each row.

1. Leaves get their place in their group from range partitions (ordering.py), so that one group may hold any share of the rows.
2. Nodes are bucketed by place // fanout^k. A task collapses k levels of one bucket, of at most fanout^k nodes, and gives
   each node its siblings on the way; bucket roots are reduced likewise until one node is left.
3. A row's proof is the proof inside its bucket, then that of its bucket's root, and so on, and at last that of its group
   among the groups, which are reduced in the same way.

H is the lowercase hexadecimal SHA-256 of its inputs one after the other. A field enters as `-` if null, else as the number of its
UTF-8 bytes, `:` and its value; digests enter as their hexadecimal text. While a level has several nodes, every `fanout` consecutive ones
become the H of them; the last run may have fewer, even one. A lone leaf is its group's root, and a lone group's root is the root.

Defined cases: nulls in fields are `-`. A null group is a group, and comes first; a null id comes first in its group. Rows that
repeat an id are leaves of their own, in the order of their leaves; equal rows take neighbouring places, whose proofs may differ.
A text of any length enters whole. Columns not named are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from kelpline.llm.common import Scratch, row_of, small
from kelpline.llm.ordering import in_order, places

FANOUT, LEVELS = 2, 10
#: Bucket roots with their proofs (some hundred bytes each) that are broadcast; more are joined by a shuffle.
BROADCAST_PROOFS = 20_000


def digest(*fields: Column) -> Column:
    """H of a row's fields, as 32 bytes."""
    one = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*map(one, fields)).cast("binary"), 256))


def as_text(h: Column) -> Column:
    return F.lower(F.hex(h))


def _h(nodes: list[bytes]) -> bytes:
    return hashlib.sha256("".join(x.hex() for x in nodes).encode()).digest()


def depth(total: int, fanout: int) -> int:
    """Levels above the leaves of a tree of `total` leaves."""
    out = 0
    while total > 1:
        total, out = -(-total // fanout), out + 1
    return out


def _collapse(nodes: list[bytes], levels: int, fanout: int) -> tuple[bytes, list[bytes]]:
    """The root of a bucket's nodes after so many levels, and each node's siblings level by level.

    A level of a proof is the number of siblings on the left and on the right, a byte each, and then the siblings.
    """
    steps: list[list[bytes]] = []
    level = nodes
    for _ in range(levels):
        own, above = [], []
        for start in range(0, len(level), fanout):
            run = level[start : start + fanout]
            own += [bytes([i, len(run) - 1 - i]) + b"".join(run[:i] + run[i + 1 :]) for i in range(len(run))]
            above.append(_h(run))
        steps.append(own)
        level = above
    (root,) = level
    return root, [b"".join(own[i // fanout**up] for up, own in enumerate(steps)) for i in range(len(nodes))]


def _folded(node: bytes, proof: bytes) -> tuple[bytes, str]:
    """The root that a node and its proof lead to, and H of the siblings."""
    at, siblings = 0, []
    while at < len(proof):
        left, right = proof[at], proof[at + 1]
        run = [proof[at + 2 + 32 * i : at + 34 + 32 * i] for i in range(left + right)]
        at += 2 + 32 * (left + right)
        siblings += run
        node = _h(run[:left] + [node] + run[left:])
    return node, _h(siblings).hex()


@arrow_udf(row_of(root=T.BinaryType(), siblings=T.StringType()))
def folded(node: pa.Array, proof: pa.Array) -> pa.Array:
    """root: recomputed from the node up; siblings: H of the proof's digests."""
    found = [_folded(n.as_py(), p.as_py()) for n, p in zip(node, proof)]
    return pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.binary()), pa.array([x[1] for x in found], pa.string())], ["root", "siblings"])


def _bucketed(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """group, index, bucket, proof and `top`, the bucket's root, of nodes (group, index, total, h)."""
    width = fanout**levels
    kind = T.StructType([nodes.schema["group"], *row_of(index=T.LongType(), bucket=T.LongType(), proof=T.BinaryType(), top=T.BinaryType())])

    def collapse(t: pa.Table) -> pa.Table:
        t = t.sort_by("index")
        root, proofs = _collapse(t["h"].to_pylist(), min(levels, depth(t["total"][0].as_py(), fanout)), fanout)
        return pa.table({"group": t["group"], "index": t["index"], "bucket": t["bucket"], "proof": pa.array(proofs, pa.binary()), "top": pa.array([root] * len(t), pa.binary())})

    bucket = F.floor(F.col("index") / F.lit(width)).cast("bigint")
    return nodes.select("group", "index", "total", "h", bucket.alias("bucket")).groupBy("group", "bucket").applyInArrow(collapse, kind)


def _reduced(scratch: Scratch, nodes: DataFrame, fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """(group, index, proof) of all nodes (group, index, total, h), and (group, h) of the groups' roots."""
    width = fanout**levels
    if nodes.where("total > 1").isEmpty():
        return nodes.select("group", "index", F.lit(b"").alias("proof")), nodes.select("group", "h")
    done = scratch.save(_bucketed(nodes, fanout, levels))
    first = F.col("index") == F.col("bucket") * width
    total = nodes.select(F.col("group").alias("group_"), F.col("index").alias("index_"), "total")
    heads = done.where(first)
    heads = heads.join(total, heads["group"].eqNullSafe(total["group_"]) & (heads["index"] == total["index_"]))
    heads = scratch.save(heads.select("group", F.col("bucket").alias("index"), F.ceil(F.col("total") / width).alias("total"), F.col("top").alias("h")))
    above, roots = _reduced(scratch, heads, fanout, levels)
    above = above.select(F.col("group").alias("group_"), F.col("index").alias("index_"), F.col("proof").alias("rest"))
    above = small(scratch.save(above), BROADCAST_PROOFS)
    joined = done.join(above, done["group"].eqNullSafe(above["group_"]) & (done["bucket"] == above["index_"]))
    return joined.select("group", "index", F.concat("proof", "rest").alias("proof")), roots


def manifest(docs: DataFrame, leaf: Column, group: str, order: str, *more: Column, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """group, order and `more` of every row, with leaf, subroot, root (32 bytes each) and proof."""
    if not 2 <= fanout <= 256 or levels < 1:
        raise ValueError("a fanout of 2 to 256 and a level or more")
    with Scratch(docs.sparkSession, "merkle") as scratch:
        rows = docs.select(F.struct(F.col(group).alias("group"), F.col(order).alias("order")).alias("k"), leaf.alias("h"), F.struct(F.lit(0).alias("none_"), *more).alias("more"))
        rows = rows.select(F.col("k.group").alias("group"), F.col("k.order").alias("order"), "h", "more")
        ordered = in_order(scratch, rows, F.col("group").asc_nulls_first(), F.col("order").asc_nulls_first(), F.col("h"))
        leaves = scratch.save(places(scratch, ordered, "group"))
        proofs, roots = _reduced(scratch, leaves.select("group", "index", "total", "h"), fanout, levels)
        # the groups' roots are leaves of one more tree
        tops = in_order(scratch, roots.select(F.lit(0).alias("all"), F.col("group").alias("name"), "h"), F.col("name").asc_nulls_first())
        tops = scratch.save(places(scratch, tops, "all"))
        last, root = _reduced(scratch, tops.select(F.col("all").alias("group"), "index", "total", "h"), fanout, levels)
        last = last.select(F.col("index").alias("index_"), F.col("proof").alias("rest"))
        root = root.select(F.col("h").alias("root")).limit(1)  # of one group, thus one row
        tops = tops.join(last, tops["index"] == last["index_"]).select("name", F.col("h").alias("subroot"), "rest").join(F.broadcast(root))
        tops = small(scratch.save(tops), BROADCAST_PROOFS)
        whole = leaves.select(F.col("group").alias("g"), F.col("index").alias("i"), "order", "h", "more")
        out = whole.join(proofs, whole["g"].eqNullSafe(proofs["group"]) & (whole["i"] == proofs["index"]))
        out = out.join(tops, out["g"].eqNullSafe(tops["name"]))
        names = [f for f in rows.schema["more"].dataType.names if f != "none_"]
        return out.select(F.col("g").alias(group), F.col("order").alias(order), *[F.col("more")[f].alias(f) for f in names], F.col("h").alias("leaf"), "subroot", "root", F.concat("proof", "rest").alias("proof"))


def document_fields(n_chars: Column | None = None) -> list[Column]:
    return [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") if n_chars is None else n_chars, F.col("text")]


def audited(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """The manifest of documents, and whether each row as it is now leads to the root by its proof.

    Rows whose CRC-32 of the decimal doc_id is divisible by 7 are tampered with: their n_chars is one more (a null stays, and so
    does a row without an id).
    """
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    now = F.when(tampered, digest(*document_fields(F.col("n_chars").cast("decimal(20,0)") + 1))).alias("now")
    out = manifest(docs, digest(*document_fields()), "lang", "doc_id", now, fanout=fanout, levels=levels)
    out = out.withColumn("f", folded(F.coalesce("now", "leaf"), "proof"))
    return out.select("doc_id", *[as_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")], F.col("f.siblings").alias("proof_sha256"), as_text(F.col("f.root")).alias("folded_root"), (F.col("f.root") == F.col("root")).alias("verified"))
