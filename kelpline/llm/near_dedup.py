"""MinHash near-dedup: SuperMinHash signatures, banding, verification on full sets, and components.

1. Each text's set of distinct shingles (wordhash.shingles) becomes a digest and 32 band
   hashes of 4 slots. Texts with equal sets are one class, kept as one row from here on.
2. Classes that share a band are candidates. Every class is compared with the leader of its bucket, which
   joins most of a large group in linear work; then components are found.
3. The texts of buckets that still hold several components are paired by their rarest shingles: linked texts have one in common
   among a share of each that the threshold sets (_postings), and texts that share no more than a passage mostly have none.
   First the texts of one shingle are dealt out to parts of GROUPS[0], so that a group of n near copies is joined with a multiple of n
   comparisons; then those that are still outside a shingle's largest component are compared with all of the shingle.
   No bound on sizes is assumed, and nothing is dropped: a pair is left out only if sizes, places or parities of its
   shingles prove that it can't be linked.
4. Comparisons use the full sets of hashes, which are built for candidates only.
5. Components: hash-to-minimum contraction; each round replaces nodes by their least neighbour.

A pair at the threshold of 0.75 shares no band with a probability below 10^-5; that is all that can be missed.
Elements permute the slots by keyed bijections (superminhash.py), not by a table of random permutations.

Defined cases: null text, empty text or one without words: no shingles, linked with nothing, kept.
Fewer words than a shingle: the whole sequence is the one shingle. Rows that repeat a
doc_id and a text are one document; rows that repeat only the doc_id keep their own sets, and share
the component's least id if linked. A null doc_id takes part like any other and sorts last, so that a
component's id is null only if all its ids are. A text of any length is taken whole. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from kelpline.llm.common import Scratch, row_of, slices, small, unused
from kelpline.llm.superminhash import band_hashes, signatures
from kelpline.llm.wordhash import SPACED, U64, Words, shingles

BANDS, ROWS = 32, 4
PARITIES = 1024
#: Texts of one shingle that are compared with each other: parts of so many, then all that are in different components.
GROUPS = (64, None)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


@arrow_udf(row_of(n=T.LongType(), node=T.BinaryType(), bands=T.ArrayType(T.LongType())))
def _signed(text: pa.Array) -> pa.Array:
    sizes, nodes, bands = [], [], []
    for part in slices(text):
        sets, first = shingles(Words(part, SPACED))
        n = np.diff(first)
        sizes.append(n)
        nodes += [_digest(sets[first[i] : first[i + 1]]) if n[i] else None for i in range(len(n))]
        bands.append(band_hashes(signatures(sets, first, BANDS * ROWS), ROWS).view(np.int64))
    flat = np.concatenate(bands).ravel() if bands else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)), pa.array(flat))
    n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), lists], ["n", "node", "bands"])


@arrow_udf(row_of(node=T.BinaryType(), hashes=T.BinaryType()))
def _full_set(text: pa.Array) -> pa.Array:
    nodes, hashes = [], []
    for part in slices(text):
        sets, first = shingles(Words(part, SPACED))
        for i in range(len(part)):
            own = sets[first[i] : first[i + 1]]
            nodes.append(_digest(own))
            hashes.append(own.tobytes())
    return pa.StructArray.from_arrays([pa.array(nodes, pa.binary()), pa.array(hashes, pa.binary())], ["node", "hashes"])


@arrow_udf(T.ArrayType(T.LongType()))
def _parities(hashes: pa.Array) -> pa.Array:
    """For each of PARITIES classes of hashes, whether the set has an odd number of them; 64 to a number.

    An element that only one of two sets has changes one bit, so that the bits in which they differ are never
    more than the elements in which they differ.
    """
    out = []
    for x in hashes:
        counts = np.bincount((np.frombuffer(x.as_buffer(), dtype=np.uint64) & U64(PARITIES - 1)).astype(np.int64), minlength=PARITIES)
        out.append(np.packbits((counts & 1).astype(np.uint8)).view(np.int64))
    return pa.array(out, pa.list_(pa.int64()))


@arrow_udf(T.ArrayType(T.LongType()))
def _as_longs(hashes: pa.Array) -> pa.Array:
    return pa.array([np.frombuffer(x.as_buffer(), dtype=np.int64) for x in hashes], pa.list_(pa.int64()))


@arrow_udf(T.LongType())
def _common(a: pa.Array, b: pa.Array) -> pa.Array:
    """Size of the intersection of two sorted sets of hashes."""
    out = np.empty(len(a), dtype=np.int64)
    for i in range(len(a)):
        x, y = (np.frombuffer(v[i].as_buffer(), dtype=np.uint64) for v in (a, b))
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        out[i] = np.count_nonzero(y[at] == x) if len(y) else 0
    return pa.array(out)


def _buckets(scratch: Scratch, classes: DataFrame) -> DataFrame:
    """Members of bands with two classes or more: key, node, n and the bucket's leader, of node and n."""
    rows = classes.select("node", "n", F.explode("bands").alias("key"))
    keys = scratch.save(rows.groupBy("key").agg(F.count("*").alias("size"), F.min_by(F.struct("node", "n"), F.struct(F.abs(F.hash("node")), "node")).alias("leader")).where("size > 1"))
    members = scratch.save(rows.join(keys, "key").select("key", "node", "n", "leader"))
    scratch.drop(keys)
    return members


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b, na, nb and more) with 100 * intersection >= threshold * union on full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    both = pairs.join(left, "a").join(right, "b").select(*pairs.columns, _common("ha", "hb").alias("common"))
    return both.where(F.lit(100) * F.col("common") >= F.lit(threshold) * (F.col("na") + F.col("nb") - F.col("common"))).drop("common")


def _near_size(threshold: int) -> Column:
    return (F.lit(100) * F.least("na", "nb")) >= (F.lit(threshold) * F.greatest("na", "nb"))


def _postings(texts: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """One row for each of the rarest shingles of a text: token, node, n, its place `at`, `q` and the parities `bits`.

    All shingles are put in one order, those of fewer texts first. Two linked texts have so much in common that one of it stands among the
    first n - threshold * n / 100 + 1 shingles of the larger text, and among the first q of the smaller one: see _can_link.
    Shingles that no other of these texts has come first and need no row; most texts that only share a passage are left without rows.
    """
    t, own = F.lit(threshold), sets.join(texts.select("node"), "node", "left_semi")
    tokens = own.select("node", F.explode(_as_longs("hashes")).alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    shared = tokens.join(counts, "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("c", "token"))).alias("tokens"))
    rows = own.select("node", (F.length("hashes") / 8).cast("bigint").alias("n"), _parities("hashes").alias("bits")).join(shared, "node")
    alone = F.col("n") - F.size("tokens")
    p = F.col("n") - F.ceil(t * F.col("n") / 100) + 1
    q = F.col("n") - F.ceil(t * 2 * F.col("n") / (t + 100)) + 1
    rows = rows.select("node", "n", "bits", alone.alias("alone"), q.alias("q"), F.slice("tokens", 1, F.greatest(p - alone, F.lit(0)).cast("int")).alias("tokens"))
    return rows.select("node", "n", "bits", "q", "alone", F.posexplode("tokens").alias("at", "token")).select(F.col("token.token").alias("token"), "node", "n", (F.col("alone") + F.col("at")).alias("at"), "q", "bits")


def _can_link(threshold: int) -> Column:
    """Whether rows a and b of one token may be the first shingle that two linked texts have in common. Never false for that one."""
    least = F.ceil(F.lit(threshold) * (F.col("na") + F.col("nb")) / (threshold + 100))
    first = ((F.col("na") <= F.col("nb")) & (F.col("ata") < F.col("qa"))) | ((F.col("nb") <= F.col("na")) & (F.col("atb") < F.col("qb")))
    differ = sum((F.bit_count(F.get("bitsa", F.lit(i)).bitwiseXOR(F.get("bitsb", F.lit(i)))) for i in range(PARITIES // 64)), F.lit(0))
    return _near_size(threshold) & first & (F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb")) >= least) & (F.col("na") + F.col("nb") - differ >= least * 2)


def _meetings(rows: DataFrame, group: int | None, threshold: int) -> DataFrame:
    """What is compared: rows a that may stand for the smaller text of a pair, each with rows b of their token whose sizes may go with a's.

    Only a row with at < q can be the first that its text has in common with a larger one. Of texts that share a template to less than the threshold no
    row is such, so that none of them meet, however many they are. Sizes are dealt out by powers of the ratio that the threshold allows.
    """
    side = lambda x: [F.col(c).alias(f"{c}{x}") if c != "node" else F.col(c).alias(x) for c in ("node", "n", "at", "q", "bits", "label")]
    step, slack = math.log(100 / threshold) or 1.0, 1e-9
    power = F.log("n") / step
    reach = F.explode(F.sequence(F.floor(power - slack), F.floor(power + 1 + slack))).alias("power")
    part = F.pmod(F.hash("node"), F.ceil(F.col("size") / group)) if group else F.lit(0)
    own = F.col("label") != F.col("top")
    smaller, larger = (lambda x: x.where("at < q").select("token", part.alias("part"), reach, *side("a"))), (lambda x: x.select("token", part.alias("part"), F.floor(power).alias("power"), *side("b")))
    on = ["token", "part", "power"]
    if group:
        return smaller(rows).join(larger(rows), on)
    # two rows of the label that most have needn't meet
    return smaller(rows.where(own)).join(larger(rows), on).unionByName(smaller(rows.where(~own)).join(larger(rows.where(own)), on))


def _pairs(rows: DataFrame, group: int | None, threshold: int) -> DataFrame:
    """Pairs of different labels that may be linked, from rows of postings with `size` and `top` (the label of most rows) of their token.

    With a group: a token's rows are dealt out to parts of about so many, and compared within each. Without: all that don't have
    the token's top label are compared with all.
    """
    # of equal sizes both rows may have been the smaller one
    once = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & ((F.col("atb") >= F.col("qb")) | (F.col("a") < F.col("b"))))
    pairs = _meetings(rows, group, threshold).where((F.col("labela") != F.col("labelb")) & once & _can_link(threshold))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"), F.when(F.col("a") < F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb"), F.least("labela", "labelb").alias("la"), F.greatest("labela", "labelb").alias("lb")).distinct()


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """node and label (the node that stands for its component) of all nodes of the edges (a, b).

    Nodes are digests, so their order is random, and replacing each by its least neighbour leaves a fixed share
    of the nodes on average: rounds grow with the logarithm of a component's size.
    """
    edges = scratch.save(edges.where("a <> b").select("a", "b").distinct())
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    kept = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = scratch.save(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to")))
        ends = edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        rest = scratch.save(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if kept is None:
            new = step
            labels = step.withColumnRenamed("to", "label")
        else:
            new = scratch.save(labels.join(step.withColumnRenamed("node", "label"), "label", "left").select("node", F.coalesce("to", "label").alias("label")))
            scratch.drop(kept, step)
            labels = new
        scratch.drop(edges)
        edges, kept = rest, new
    return labels


def _relabelled(labels: DataFrame, merged: DataFrame) -> DataFrame:
    """labels (node, label) after some labels were joined: merged has these as nodes."""
    return labels.join(merged.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select("node", F.coalesce("to", "label").alias("label"))


def _grouped(docs: DataFrame, classes: DataFrame, scratch: Scratch, threshold: int, groups: Sequence[int | None]) -> DataFrame:
    """node and label of all classes that share a band with another."""
    members = _buckets(scratch, classes)
    nodes = scratch.save(members.select("node").distinct())
    # one text for each class: that of its first row
    wanted = classes.join(nodes, "node").select(F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key"))
    wanted = small(scratch.save(wanted))
    texts = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))
    texts = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["rep_id"]) & (texts["text_key"] == wanted["rep_key"]), "left_semi")
    sets = scratch.save(texts.select(_full_set("text").alias("s")).select("s.*").dropDuplicates(["node"]))

    star = members.where("node <> leader.node").select(F.col("node").alias("a"), F.col("leader.node").alias("b"), F.col("n").alias("na"), F.col("leader.n").alias("nb"))
    star = scratch.save(star.where(_near_size(threshold)).distinct())
    merged = components(scratch, _verified(star, sets, threshold))
    labels = scratch.save(_relabelled(nodes.select("node", F.col("node").alias("label")), merged))
    placed = members.join(labels, "node")
    mixed = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    texts = scratch.save(placed.join(mixed, "key", "left_semi").select("node").distinct())
    postings = scratch.save(_postings(texts, sets, threshold))
    scratch.drop(members, star, wanted, texts)
    for group in groups:
        placed = scratch.save(postings.join(labels, "node"))
        sizes = placed.groupBy("token", "label").agg(F.count("*").alias("c")).groupBy("token").agg(F.sum("c").alias("size"), F.count("*").alias("labels"), F.max_by("label", F.struct("c", "label")).alias("top"))
        rows = scratch.save(placed.join(sizes.where("labels > 1").drop("labels"), "token"))
        pairs = scratch.save(_pairs(rows, group, threshold))
        if not pairs.isEmpty():
            edges = _verified(pairs, sets, threshold).select(F.col("la").alias("a"), F.col("lb").alias("b"))
            labels = scratch.save(_relabelled(labels, components(scratch, edges)))
        scratch.drop(placed, rows, pairs)
    scratch.drop(sets, postings, nodes)
    return labels


def _decided(docs: DataFrame, threshold: int, groups: Sequence[int | None]) -> DataFrame:
    """What near_dedup returns; text_key, and `first`: whether the row is the one of its component that stays, or like it in both."""
    with Scratch(docs.sparkSession, "near_dedup") as scratch:
        signed = scratch.save(docs.select("doc_id", text_key(F.col("text")).alias("text_key"), _signed("text").alias("s")).select("doc_id", "text_key", "s.*"))
        rep = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
        classes = scratch.save(signed.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.min(rep).alias("rep"), F.first("bands").alias("bands")))
        labels = _grouped(docs, classes, scratch, threshold, groups)
        whole = classes.select("node", "rep").join(labels, "node", "left").select("node", "rep", F.coalesce("label", "node").alias("label"))
        firsts = whole.groupBy("label").agg(F.min("rep").alias("head"))
        found = scratch.save(whole.join(firsts, "label").select("node", "head"))
        out = signed.select("doc_id", "text_key", "n", "node").join(found, "node", "left")
        component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("head.doc_id"))
        first = (F.col("n") == 0) | (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_key") == F.col("head.text_key")))
        return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key", first.alias("first"))


def near_dedup(docs: DataFrame, threshold: int = 75, groups: Sequence[int | None] = GROUPS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs (doc_id, text)."""
    return _decided(docs, threshold, groups).drop("text_key", "first")


def keep_one(docs: DataFrame, threshold: int = 75, groups: Sequence[int | None] = GROUPS) -> DataFrame:
    """The rows of docs without the near copies: of each component one document stays, with all its columns.

    It is the one of least doc_id (null last), and of the least digest of the text among rows that repeat that id. A document
    is a doc_id with a text: rows that repeat both stay or go together, and rows that repeat the id with another text are judged by it.
    """
    gone = _decided(docs, threshold, groups).where("not first").select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    gone = small(Scratch(docs.sparkSession, "near_copies").save(gone))
    key = unused(docs, "text_key_")
    keyed = docs.withColumn(key, text_key(docs["text"]))
    gone = gone.withColumnsRenamed({c: unused(docs, c) for c in gone.columns})
    a, b = gone.columns
    return keyed.join(gone, keyed["doc_id"].eqNullSafe(gone[a]) & (keyed[key] == gone[b]), "left_anti").select(docs.columns)
