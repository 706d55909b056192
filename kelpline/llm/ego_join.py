"""Embedding near-dedup by an epsilon grid order join.

Vectors of length one have a cosine of t or more if they are not farther apart than eps = sqrt(2 - 2 t).

1. Vectors equal in all components are one class, kept as one row with its number of copies from here on.
2. Classes are put into the epsilon grid order: by their cells of width eps on the leading principal directions, from the first
   to the last, and by finer cells after that. The directions come from all vectors, in one pass; a task adds up d x SKETCH numbers.
3. The sequence is cut into intervals of equal length, of at most SEGMENT_BYTES each. Each has its box on the leading directions, and the ball around its mean.
4. Intervals are paired by the cells that they span on the first direction. A pair is left out if boxes or balls are farther apart than eps, and
   needs no vectors if everything in it must be linked.
5. A task joins one pair: it halves the intervals as long as their parts are neither provably apart nor provably linked, and compares
   the vectors of the smallest parts, in single precision with a bound on its error and then, within that bound, in double precision.
   It returns a count and a link for each class that has any, not the pairs.
6. Components: near_dedup.components over these links.

The result is exact. How much is skipped depends on the vectors: where they spread alike in all of many directions, eps is wider than
the spread in any one of them, and most pairs of intervals have to be compared, which takes time that grows with the square of the rows.

Defined cases: null vectors, empty ones, those of zeros only, and those with a null or non-finite component have no links and are kept. Vectors of
different lengths are never linked. Equal vectors are linked with each other. Rows that repeat a vec_id are vectors of
their own. A null vec_id sorts last, so that a component's id is null only if all its ids are. Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from kelpline.llm.common import Scratch, row_of, small
from kelpline.llm.near_dedup import components
from kelpline.llm.ordering import in_order, places

THRESHOLD = 0.95
LEADING = 8
SKETCH = 64
SEGMENT_BYTES = 4 << 20
LEAF = 256
#: Far above the rounding of double precision, far below eps.
SLACK = 1e-6
#: A fine cell is this part of eps.
FINE = 8
_KEY = 16


def _packed(single: bool):
    kind = np.float32 if single else np.float64

    @arrow_udf(T.BinaryType())
    def pack(embedding: pa.Array) -> pa.Array:
        """The components as bytes; null for a vector that is linked with nothing."""
        out = []
        for x in embedding:
            v = None if x.as_py() is None or not len(x) or x.values.null_count else x.values.to_numpy(zero_copy_only=False).astype(kind)
            out.append(v.tobytes() if v is not None and np.isfinite(v).all() and v.any() else None)
        return pa.array(out, pa.binary())

    return pack


def _unit(data: np.ndarray) -> np.ndarray:
    x = data.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _rows(column: pa.ChunkedArray | pa.Array, dim: int, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, dim)


def _probe(dim: int) -> np.ndarray:
    """dim x min(dim, SKETCH); all directions if there are few."""
    return np.eye(dim) if dim <= SKETCH else np.random.default_rng(0).standard_normal((dim, SKETCH))


def directions(scratch: Scratch, classes: DataFrame, kind: type) -> dict[int, np.ndarray]:
    """Orthogonal directions of most variance, for each length of vectors: dim x min(dim, LEADING).

    Any orthogonal directions give right results. The driver gets dim x (SKETCH + 1) sums for each length.
    """

    def add_up(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            t = pa.Table.from_batches([batch])
            for dim in set(t["dim"].to_pylist()):
                x = _unit(_rows(t.filter(pc.equal(t["dim"], dim))["data"], dim, kind))
                more = np.vstack([(x.T @ (x @ _probe(dim))).T, x.sum(axis=0), np.full(dim, float(len(x)))])
                sums[dim] = sums.get(dim, 0) + more
        for dim, s in sums.items():
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim] * len(s), pa.int32()), "i": pa.array(range(len(s)), pa.int32()), "s": pa.array(list(s), pa.list_(pa.float64()))})

    parts = classes.select("dim", "data").mapInArrow(add_up, row_of(dim=T.IntegerType(), i=T.IntegerType(), s=T.ArrayType(T.DoubleType())))
    sums = parts.select("dim", "i", F.posexplode("s").alias("j", "x")).groupBy("dim", "i", "j").agg(F.sum("x").alias("x"))
    found: dict[int, list] = {}
    for dim, i, row in sums.groupBy("dim", "i").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "x"))), lambda c: c["x"])).collect():
        found.setdefault(dim, []).append((i, row))
    out = {}
    for dim, rows in found.items():
        s = np.array([r for _, r in sorted(rows)])
        n, mean = s[-1, 0], s[-2] / s[-1, 0]
        spread = s[:-2].T / n - np.outer(mean, mean @ _probe(dim))
        out[dim] = np.linalg.svd(spread, full_matrices=False)[0][:, :LEADING]
    return out


def _grid(axes: dict[int, np.ndarray], eps: float, kind: type):
    @arrow_udf(T.ArrayType(T.IntegerType()))
    def cells(dim: pa.Array, data: pa.Array) -> pa.Array:
        """The cells of width eps on the leading directions, and then those of eps / FINE."""
        out: list = [None] * len(dim)
        dims = dim.to_numpy(zero_copy_only=False)
        for d in np.unique(dims):
            at = np.nonzero(dims == d)[0]
            p = _unit(_rows(data.take(pa.array(at)), int(d), kind)) @ axes[int(d)]
            both = np.hstack([np.floor(p / eps), np.floor(p * FINE / eps)]).astype(np.int32)
            for i, row in zip(at, both):
                out[i] = row
        return pa.array(out, pa.list_(pa.int32()))

    return cells


_SEGMENT = row_of(
    dim=T.IntegerType(), seg=T.LongType(), n=T.LongType(), weight=T.LongType(), keys=T.BinaryType(), weights=T.BinaryType(), data=T.BinaryType(),
    low=T.ArrayType(T.DoubleType()), high=T.ArrayType(T.DoubleType()), mean=T.ArrayType(T.DoubleType()), radius=T.DoubleType(),
)


def _segments(ordered: DataFrame, axes: dict[int, np.ndarray], kind: type) -> DataFrame:
    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("index")
        dim = t["dim"][0].as_py()
        data = b"".join(t["data"].to_pylist())
        x = _unit(np.frombuffer(data, dtype=kind).reshape(-1, dim))
        p, mean = x @ axes[dim], x.mean(axis=0)
        w = t["w"].to_numpy()
        one = dict(dim=dim, seg=t["seg"][0].as_py(), n=len(t), weight=int(w.sum()), keys=b"".join(t["key"].to_pylist()), weights=w.astype(np.int64).tobytes(), data=data)
        one |= dict(low=p.min(axis=0), high=p.max(axis=0), mean=mean, radius=float(np.sqrt(((x - mean) ** 2).sum(axis=1).max())))
        schema = pa.schema([("dim", pa.int32()), *[(c, pa.int64()) for c in ("seg", "n", "weight")], *[(c, pa.binary()) for c in ("keys", "weights", "data")], *[(c, pa.list_(pa.float64())) for c in ("low", "high", "mean")], ("radius", pa.float64())])
        return pa.table({f.name: pa.array([one[f.name]], f.type) for f in schema}, schema=schema)

    return ordered.groupBy("dim", "seg").applyInArrow(pack, _SEGMENT)


def _apart(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def _interval_pairs(segments: DataFrame, eps: float) -> DataFrame:
    """dim, a, b (a <= b) of the intervals that may hold linked vectors, and `near` where all their vectors must be linked."""
    cell = lambda c: F.floor(F.get(c, F.lit(0)) / eps)
    own = segments.select("dim", "seg", "low", "high", "mean", "radius", cell("low").alias("first"), cell("high").alias("last"))
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("seg", "low", "high", "mean", "radius", "first")]
    a = own.select("dim", *side("a"), F.explode(F.sequence("first", "last")).alias("cell"))
    b = own.select("dim", *side("b"), F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)).alias("cell"))
    once = F.col("cell") == F.greatest("first_a", F.col("first_b") - 1)  # the first cell in common
    gaps = F.zip_with(F.zip_with("low_a", "high_b", lambda x, y: x - y), F.zip_with("low_b", "high_a", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    box = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x))
    balls, radii = _apart(F.col("mean_a"), F.col("mean_b")), F.col("radius_a") + F.col("radius_b")
    pairs = a.join(b, ["dim", "cell"]).where((F.col("seg_a") <= F.col("seg_b")) & once & (box <= eps + SLACK))
    pairs = pairs.select("dim", F.col("seg_a").alias("a"), F.col("seg_b").alias("b"), balls.alias("balls"), radii.alias("radii"))
    return pairs.where(F.col("balls") - F.col("radii") <= eps + SLACK).select("dim", "a", "b", (F.col("balls") + F.col("radii") < eps - SLACK).alias("near"))


class _Sequence:
    """An interval with the boxes and balls of its halves, quarters and so on down to parts of LEAF."""

    def __init__(self, data: np.ndarray, weights: np.ndarray, axes: np.ndarray):
        self.x, self.w = _unit(data), weights
        self.x32, self.p, self.parts = self.x.astype(np.float32), self.x @ axes, {}

    def part(self, start: int, end: int) -> tuple:
        if (start, end) not in self.parts:
            x, p = self.x[start:end], self.p[start:end]
            mean = x.mean(axis=0)
            self.parts[start, end] = p.min(axis=0), p.max(axis=0), mean, float(np.sqrt(((x - mean) ** 2).sum(axis=1).max()))
        return self.parts[start, end]


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of a[i] and b[i] for all i; a root is the least of its set."""
    while True:
        for x in (a, b):
            while (parent[x] != parent[parent[x]]).any():
                parent[x] = parent[parent[x]]
        a, b = parent[a], parent[b]
        differ = a != b
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def joined(a: _Sequence, b: _Sequence, threshold: float, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of each vector of a and of b (weighed), and the roots of all of them (those of b come after those of a).

    If a is b, each pair in it counts once for both of its vectors.
    """
    same, eps, shift = a is b, math.sqrt(2 - 2 * threshold), 0 if a is b else len(a.x)
    count_a = np.zeros(len(a.x), np.int64)
    count_b = count_a if same else np.zeros(len(b.x), np.int64)
    parent = np.arange(shift + len(b.x))
    error = (a.x.shape[1] + 8) * 2.0**-23
    todo = [(0, len(a.x), 0, len(b.x))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        diagonal = same and a0 == b0
        (la, ha, ma, ra), (lb, hb, mb, rb) = a.part(a0, a1), b.part(b0, b1)
        gap = np.maximum(np.maximum(la - hb, lb - ha), 0)
        far = float(np.linalg.norm(ma - mb))
        if float(np.sqrt(gap @ gap)) > eps + SLACK or far - ra - rb > eps + SLACK:
            continue
        if far + ra + rb < eps - SLACK:
            if diagonal:
                count_a[a0:a1] += a.w[a0:a1].sum() - a.w[a0:a1]
            else:
                count_a[a0:a1] += b.w[b0:b1].sum()
                count_b[b0:b1] += a.w[a0:a1].sum()
                _merge(parent, np.arange(a0, a1), np.full(a1 - a0, shift + b0))
            _merge(parent, np.arange(b0, b1) + shift, np.full(b1 - b0, a0))
        elif max(a1 - a0, b1 - b0) > leaf:
            half = lambda s, e: (s + (e - s + 1) // 2,)
            if diagonal:
                (m,) = half(a0, a1)
                todo += [(a0, m, a0, m), (a0, m, m, a1), (m, a1, m, a1)]
            elif a1 - a0 >= b1 - b0:
                (m,) = half(a0, a1)
                todo += [(a0, m, b0, b1), (m, a1, b0, b1)]
            else:
                (m,) = half(b0, b1)
                todo += [(a0, a1, b0, m), (a0, a1, m, b1)]
        else:
            cos = a.x32[a0:a1] @ b.x32[b0:b1].T
            if float(cos.max()) < threshold - error:
                continue
            i, j = np.nonzero(cos >= threshold - error)
            if diagonal:
                i, j = i[i < j], j[i < j]
            unsure = cos[i, j] <= threshold + error
            i, j = i + a0, j + b0
            ok = np.ones(len(i), bool)
            ok[unsure] = np.einsum("ij,ij->i", a.x[i[unsure]], b.x[j[unsure]]) >= threshold
            i, j = i[ok], j[ok]
            np.add.at(count_a, i, b.w[j])
            np.add.at(count_b, j, a.w[i])
            _merge(parent, i, j + shift)
    while (parent != parent[parent]).any():
        parent = parent[parent]
    return count_a, count_b, parent


_LINKS = row_of(key=T.BinaryType(), links=T.LongType(), to=T.BinaryType())


def _compared(segments: DataFrame, pairs: DataFrame, axes: dict[int, np.ndarray], kind: type, threshold: float) -> DataFrame:
    """key, links and `to` (a class of the same component) of the classes with links, for each of the pairs."""
    ends = lambda c: pairs.select("dim", F.col(c).alias("seg"), "a", "b")
    sides = small(ends("a").unionByName(ends("b").where("a <> b")))

    def join(t: pa.Table) -> pa.Table:
        read = lambda name, r, k: np.frombuffer(t[name][r].as_py(), dtype=k)
        dim, order = t["dim"][0].as_py(), np.argsort(t["seg"].to_numpy())
        seqs = [_Sequence(read("data", int(r), kind).reshape(-1, dim), read("weights", int(r), np.int64), axes[dim]) for r in order]
        keys = b"".join(t["keys"][int(r)].as_py() for r in order)
        counts_a, counts_b, root = joined(seqs[0], seqs[-1], threshold)
        counts = counts_a if len(seqs) == 1 else np.concatenate([counts_a, counts_b])
        at = np.nonzero(counts)[0]
        name = lambda x: pa.array([keys[_KEY * i : _KEY * (i + 1)] for i in x.tolist()], pa.binary())
        return pa.table({"key": name(at), "links": pa.array(counts[at], pa.int64()), "to": name(root[at])})

    sent = segments.select("dim", "seg", "keys", "weights", "data").join(sides, ["dim", "seg"])
    return sent.groupBy("dim", "a", "b").applyInArrow(join, _LINKS)


def _all_linked(segments: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same for pairs of intervals in which everything is linked, from one sum an interval."""
    sums = segments.select("dim", "seg", "weight", F.substring("keys", 1, _KEY).alias("head"))
    a, b = (sums.select("dim", F.col("seg").alias(x), F.col("weight").alias(f"weight_{x}"), F.col("head").alias(f"head_{x}")) for x in "ab")
    both = pairs.select("dim", "a", "b").join(a, ["dim", "a"]).join(b, ["dim", "b"])
    out = both.select("dim", F.col("a").alias("seg"), F.col("weight_b").alias("links"), (F.col("a") == F.col("b")).alias("own"), F.least("head_a", "head_b").alias("to"))
    back = both.where("a <> b").select("dim", F.col("b").alias("seg"), F.col("weight_a").alias("links"), F.lit(False).alias("own"), F.least("head_a", "head_b").alias("to"))
    sums = out.unionByName(back).groupBy("dim", "seg").agg(F.sum("links").alias("links"), F.max("own").alias("own"), F.min("to").alias("to"))
    # each interval is tied to the least head it meets, and so is its own head
    rows = segments.select("dim", "seg", "n", "keys", "weights").join(small(sums), ["dim", "seg"])

    def spread(batches):
        for batch in batches:
            for r in batch.to_pylist():
                w = np.frombuffer(r["weights"], dtype=np.int64)
                keys = [r["keys"][_KEY * i : _KEY * (i + 1)] for i in range(r["n"])]
                yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "links": pa.array(r["links"] - w * r["own"], pa.int64()), "to": pa.array([r["to"]] * len(keys), pa.binary())})

    heads = both.select(F.col("head_a").alias("key"), F.lit(0).cast("bigint").alias("links"), F.col("head_b").alias("to"))
    return rows.mapInArrow(spread, _LINKS).unionByName(heads)


def linked(vectors: DataFrame, threshold: float = THRESHOLD, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of vectors (vec_id, embedding)."""
    element = vectors.schema["embedding"].dataType.elementType
    single = isinstance(element, T.FloatType)
    kind, width = (np.float32, 4) if single else (np.float64, 8)
    eps = math.sqrt(2 - 2 * threshold)
    with Scratch(vectors.sparkSession, "ego_join") as scratch:
        embedding = F.col("embedding") if isinstance(element, T.FloatType | T.DoubleType) else F.col("embedding").cast("array<double>")
        rows = vectors.select("vec_id", _packed(single)(embedding).alias("data"))
        rows = scratch.save(rows.withColumn("key", F.unhex(F.md5("data"))))
        head = F.min(F.struct(F.col("vec_id").isNull().alias("no_id"), "vec_id")).alias("head")
        classes = rows.where("data is not null").groupBy("key").agg(F.count("*").alias("w"), head, F.first("data").alias("data"))
        classes = scratch.save(classes.withColumn("dim", (F.length("data") / width).cast("int")))
        axes = directions(scratch, classes, kind)
        placed = classes.select("dim", _grid(axes, eps, kind)("dim", "data").alias("cells"), "key", "w", "data")
        ordered = in_order(scratch, placed, F.col("dim"), F.col("cells"), F.col("key"))
        each = F.greatest(F.lit(segment_bytes) / (F.col("dim") * width), F.lit(2))
        ordered = places(scratch, ordered, "dim").withColumn("seg", F.floor(F.col("index") / F.floor(each)))
        segments = scratch.save(_segments(ordered.select("dim", "seg", "index", "key", "w", "data"), axes, kind))
        pairs = scratch.save(_interval_pairs(segments, eps))
        links = scratch.save(_compared(segments, pairs.where("not near"), axes, kind, threshold).unionByName(_all_linked(segments, pairs.where("near"))))
        labels = components(scratch, links.select(F.least("key", "to").alias("a"), F.greatest("key", "to").alias("b")))
        counts = links.groupBy("key").agg(F.sum("links").alias("links"))
        found = classes.select("key", "w", "head").join(counts, "key", "left").join(labels.withColumnRenamed("node", "key"), "key", "left")
        found = scratch.save(found.select("key", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), "head", F.coalesce("label", "key").alias("label")))
        heads = found.groupBy("label").agg(F.min("head").alias("least"))
        found = small(scratch.save(found.join(heads, "label").select("key", "n_links", "least")))
        component = F.when(F.col("data").isNull(), F.col("vec_id")).otherwise(F.col("least.vec_id"))
        out = rows.join(found, "key", "left")
        return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
