"""Token-ID output: length-delimited binary records with masked checksums, and an offset index.

A shard is a sequence of records, framed like the public TFRecord format, but with zlib's CRC-32:

    uint64  length of the payload             uint32  masked CRC-32 of those 8 bytes
    payload                                   uint32  masked CRC-32 of the payload

masked(c) = ((c >> 15 | c << 17) + 0xa282ead8) mod 2^32. All numbers are little-endian. A payload is
int64 document id, uint8 flags (bit 0: the id is not null; bit 1: ids take 4 bytes, else 2), and the ids.
Ids take 2 bytes where the vocabulary has at most 65,536 entries.

Shards hold the documents in ascending order of their ids; each has a range of them. The index is a
Parquet table beside them: shard, path, ordinal in the shard, byte offset, record length, doc_id,
n_tokens and start (ids of all documents before). A reader that wants a shuffled order sorts or
samples the index and seeks; see `read_records`.

A task writes its shard under a name of its own and returns its index rows; only shards named by the index
belong to the dataset, so that a task that is repeated after the loss of an executor does no harm; others are deleted at the end.
Files are read and written through pyarrow's file systems, so the folder may be local, HDFS or an
object store; it must be one that executors share.

Defined cases: null text is an empty text; an empty text has only the end id. Rows that repeat a doc_id are
ordered by a hash of their texts and then by these, and equal rows are all written. A text of any length is one record. Null ids come first. Extra columns are ignored.
An empty table gives no records.
"""

from __future__ import annotations

import functools
import gc
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelpline.llm.common import Scratch, slices

MASK_DELTA = 0xA282EAD8
#: what stands before the ids in a payload: the document id and flags
_HEAD = "<qB"
_HEAD_SIZE = struct.calcsize(_HEAD)
_INDEX = "shard int, path string, ordinal int, offset bigint, length bigint, doc_id bigint, n_tokens bigint"


def masked(c: int) -> int:
    return (((c >> 15) | (c << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(zlib.crc32(head))), payload, struct.pack("<I", masked(zlib.crc32(payload)))))


def unframe(data: bytes) -> bytes:
    """The payload of one whole record; ValueError if a length or checksum is wrong."""
    if len(data) < 16:
        raise ValueError("record cut off")
    (n,) = struct.unpack_from("<Q", data)
    if struct.unpack_from("<I", data, 8)[0] != masked(zlib.crc32(data[:8])) or len(data) != n + 16:
        raise ValueError("record length is damaged")
    payload = data[12:-4]
    if struct.unpack_from("<I", data, 12 + n)[0] != masked(zlib.crc32(payload)):
        raise ValueError("record is damaged")
    return payload


# Texts within these ranges can be split exactly as the tokenizer's own pattern splits them, as the
# categories of these characters are settled. Any other text is encoded whole.
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_N = "0-9²³¹¼-¾"
_S = "\t-\r \u0085 "
_KNOWN = re.compile(r"[\t-\r -~\u0085 -ɏ]*")
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: pieces that a worker remembers, twice at most, and characters of one; about 150 bytes each
_REMEMBERED, _LONGEST = 300_000, 64


class Encoder:
    """Whole texts to ids. Pieces that byte-level BPE keeps apart are encoded once and remembered."""

    def __init__(self, path: str, end_id: int, remembered: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = t = Tokenizer.from_file(path)
        size = max(t.get_vocab_size(), end_id + 1)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        model = json.loads(t.to_str())
        pre = model.get("pre_tokenizer") or {}
        #: byte-level BPE with the common pattern can be given pieces
        self.split = model.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.special = [str(x.content) for x in t.get_added_tokens_decoder().values()]
        #: ids of tokens that begin with a space: in a row of pieces that do, a piece begins at each
        self.spaced = np.zeros(size, dtype=bool)
        self.spaced[[i for token, i in t.get_vocab().items() if token.startswith("\u0120")]] = True

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces; those of a space and more are put in a row, which the tokenizer parts again."""
        row = [p for p in pieces if p[0] == " " and not p.isspace()]
        ids = self._encode(["".join(row)])[0]
        starts = np.flatnonzero(self.spaced[ids])
        if len(starts) == len(row) and (not len(row) or starts[0] == 0):
            data, k = ids.tobytes(), self.dtype.itemsize
            bounds = (np.append(starts, len(ids)) * k).tolist()
            self.known.update(zip(row, map(data.__getitem__, map(slice, bounds, bounds[1:]))))
        rest = [p for p in pieces if p not in self.known]
        self.known.update(zip(rest, (x.tobytes() for x in self._encode(rest))))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The little-endian ids of each text, with the end id."""
        gc.disable()  # nothing here makes cycles, and lists of pieces are long to walk
        try:
            return self._ids(texts)
        finally:
            gc.enable()

    def _ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        pieces: dict[int, list[str]] = {}
        whole = []
        for i, text in enumerate(texts):
            if self.split and _KNOWN.fullmatch(text) and not any(t in text for t in self.special):
                pieces[i] = _PIECES.findall(text)
            else:
                whole.append(i)
        if len(self.known) > (_REMEMBERED if self.remembered is None else self.remembered):  # what wasn't used since the last time goes
            self.known, self.older = {}, self.known
        new = set().union(*pieces.values()).difference(self.known)
        for p in [p for p in new if p in self.older]:
            self.known[p] = self.older[p]
            new.remove(p)
        if new:
            self._learn(list(new))
        for i, own in pieces.items():
            out[i] = b"".join([*map(self.known.__getitem__, own), self.end])
        for p in [p for p in new if len(p) > _LONGEST]:
            del self.known[p]
        for i, ids in zip(whole, self._encode([texts[i] for i in whole])):
            out[i] = ids.tobytes() + self.end
        return out


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer: str, end_id: int, remembered: int | None = None) -> Encoder:
    """A worker process keeps its encoder, and what that has learned, for its next tasks."""
    return Encoder(tokenizer, end_id, remembered)


def _writer(folder: str, tokenizer: str, end_id: int, remembered: int | None = None):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        shard = TaskContext.get().partitionId()
        store, at = fs.FileSystem.from_uri(folder)
        path, out, offset, ordinal = f"shard-{shard:06d}-{uuid.uuid4().hex}.rec", None, 0, 0
        encode = _encoder(tokenizer, end_id, remembered)
        wide = encode.dtype.itemsize == 4
        for batch in batches:
            ids, column = batch.column("doc_id"), batch.column("text")
            row = 0
            for part in slices(column):
                rows = {k: [] for k in ("offset", "length", "n")}
                records = []
                for tokens in encode([x or "" for x in part.to_pylist()]):
                    doc = ids[row].as_py()
                    row += 1
                    record = frame(struct.pack(_HEAD, doc or 0, (doc is not None) | 2 * wide) + tokens)
                    rows["offset"].append(offset)
                    rows["length"].append(len(record))
                    rows["n"].append(len(tokens) // encode.dtype.itemsize)
                    offset += len(record)
                    records.append(record)
                if out is None:
                    store.create_dir(at, recursive=True)
                    out = store.open_output_stream(f"{at}/{path}")
                out.write(b"".join(records))
                n = len(records)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * n, pa.int32()), pa.array([path] * n), pa.array(range(ordinal, ordinal + n), pa.int32()), *(pa.array(rows[k], pa.int64()) for k in ("offset", "length")), ids.slice(row - n, n).cast(pa.int64()), pa.array(rows["n"], pa.int64())],
                    names=["shard", "path", "ordinal", "offset", "length", "doc_id", "n_tokens"],
                )
                ordinal += n
        if out is not None:
            out.close()

    return write


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, by_id: bool = True, remembered: int | None = None) -> DataFrame:
    """Tokenise docs (doc_id, text), write shards and index below `folder` (a URI), and return the index.

    The texts are dealt by ranges of doc_id into as many shards as Spark has shuffle partitions. With by_id=False every partition
    of docs becomes a shard in the order that its rows have: what was shuffled before stays so, and nothing is moved.
    """
    spark = docs.sparkSession
    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if by_id:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # rows with one id have the same place in the order of ids; their texts' hashes spread them
        ordered = ordered.withColumn("part", F.xxhash64("text")).repartitionByRange(n, "doc_id", "part").sortWithinPartitions("doc_id", "part", "text").drop("part")
    raw = f"{folder}/index-local"
    ordered.mapInArrow(_writer(f"{folder}/shards", tokenizer, end_id, remembered), _INDEX).write.parquet(raw)
    rows = spark.read.schema(_INDEX).parquet(raw)
    # one row for each shard: as many as there are files, however many documents
    before = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    # within a shard the tokens before a record are known from its place: no window over documents of different shards
    own = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1))
    index = rows.withColumn("own", F.coalesce(own, F.lit(0))).join(F.broadcast(before), "shard").withColumn("start", F.col("before") + F.col("own")).drop("own", "before")
    index.write.parquet(f"{folder}/index")
    index = read_index(spark, folder)
    sweep(index, folder)
    return index


def sweep(index: DataFrame, folder: str) -> int:
    """Delete the shards that no index row names, left by attempts that failed; how many. Only names of files are gathered."""
    named = {r["path"] for r in index.select("path").distinct().collect()}
    store, at = fs.FileSystem.from_uri(f"{folder}/shards")
    left = [f.path for f in store.get_file_info(fs.FileSelector(at, allow_not_found=True)) if f.base_name not in named]
    for path in left:
        store.delete_file(path)
    return len(left)


def read_index(spark, folder: str) -> DataFrame:
    return spark.read.schema(f"{_INDEX}, start bigint").parquet(f"{folder}/index")


def _reader(folder: str, digest: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = fs.FileSystem.from_uri(folder)
        path, source = None, None
        for batch in batches:
            docs, ids, sums, counts = [], [], [], []
            for p, offset, length in zip(batch.column("path").to_pylist(), batch.column("offset").to_pylist(), batch.column("length").to_pylist()):
                if p != path:
                    path, source = p, store.open_input_file(f"{at}/{p}")
                payload = unframe(source.read_at(length, offset))
                doc, flags = struct.unpack_from(_HEAD, payload)
                tokens = np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=_HEAD_SIZE).astype("<u4")
                docs.append(doc if flags & 1 else None)
                counts.append(len(tokens))
                if digest:
                    sums.append(zlib.crc32(tokens.tobytes()))
                else:
                    ids.append(tokens)
            kept = batch.column("start")
            last = pa.array(sums, pa.int64()) if digest else pa.array(ids, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), kept, pa.array(counts, pa.int64()), last], names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    return read


def read_records(index: DataFrame, folder: str, digest: bool = False) -> DataFrame:
    """Read the records that `index` names, in its order and partitions: doc_id, start, n_tokens and ids.

    digest: CRC-32 of the ids, as unsigned 32-bit numbers, in place of the ids.
    For a shuffled read order the index by a hash first, and its partitions by that.
    """
    kind = "ids_crc32 bigint" if digest else "ids array<bigint>"
    return index.select("path", "offset", "length", "start").mapInArrow(_reader(f"{folder}/shards", digest), f"doc_id bigint, start bigint, n_tokens bigint, {kind}")


def written_and_read(docs: DataFrame, tokenizer: str, end_id: int = 0, by_id: bool = True, remembered: int | None = None) -> DataFrame:
    """Write docs as records in the shared folder and read them back: doc_id, start, n_tokens, ids_crc32.

    remembered: pieces that a worker remembers, for jobs whose workers hold other things too; ids don't depend on it.
    """
    folder = Scratch(docs.sparkSession, "token_records").path
    return read_records(write_records(docs, folder, tokenizer, end_id, by_id, remembered), folder, digest=True)
