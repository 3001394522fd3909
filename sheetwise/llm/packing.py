"""Packing along a space-filling curve."""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, partitions
from .tokens import WordTokenizer, tokenizer_path
from .words import mix, per_text, slices, texts_of, word_hashes

DIMS, BITS, HASHED = 3, 12, 512


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of integer points (n, d), each coordinate below 2**bits (Skilling's transform)."""
    x = points.T.astype(np.int64).copy()
    d = len(x)
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[d - 1] >> b) & 1, (1 << b) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(codes: np.ndarray, bounds: np.ndarray, hashes: np.ndarray, dims: int = DIMS, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of hashed word vectors: a signed bucket for each word, a fixed projection of the buckets, the mean over the text."""
    project = np.random.default_rng(20).standard_normal((HASHED, dims))
    sign = np.where((hashes >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    vectors = project[(hashes % np.uint64(HASHED)).astype(np.int64)] * sign[:, None]
    if not len(vectors):
        vectors = np.zeros((1, dims))
    n = np.maximum(np.diff(bounds), 1)[:, None]
    mean = np.stack([per_text(vectors[codes, k], bounds, np.float64) for k in range(dims)], axis=1) / n
    unit = 0.5 + 0.5 * np.tanh(2.5 * mean)
    return hilbert_key(np.minimum((unit * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


def _tokenise(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    tokenizer, row = WordTokenizer(path), TaskContext.get().partitionId() << 40
    for whole in batches:
        for batch in slices(whole, "text", 6 << 20):
            ids, bounds, codes, words_at, words = tokenizer.encode(texts_of(batch), end)
            key = curve_keys(codes, words_at, word_hashes(words))
            packed, at = ids.astype("<u4").tobytes(), bounds * 4
            tie = np.fromiter((zlib.crc32(packed[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)), np.uint64, len(key))
            tie = mix(tie ^ mix(np.nan_to_num(batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64).astype(np.uint64)))
            key = (key << 24) | (tie >> np.uint64(40)).astype(np.int64)
            narrow = ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else packed
            at = at * len(narrow) // max(len(packed), 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(key), pa.array(np.diff(bounds)), pa.array([narrow[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()), pa.array(row + np.arange(len(key)))], ["doc_id", "key", "doc_tokens", "ids", "row"])
            row += len(key)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the part of the range sort and the tokens before each row in it."""
    from pyspark import TaskContext

    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column("doc_tokens").to_numpy()
        ends = before + np.cumsum(n)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(n), part, np.int32)), pa.array(ends - n)], [*batch.schema.names, "part", "before"])
        before = int(ends[-1]) if len(n) else before


def _pieces(batches: Iterator[pa.RecordBatch], base: dict[int, int], length: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, parts = batch.column("doc_tokens").to_numpy(), batch.column("part").to_numpy()
        at = batch.column("before").to_numpy() + np.fromiter((base[p] for p in parts.tolist()), np.int64, len(parts))
        first, last = at // length, (at + n - 1) // length
        count = last - first + 1
        row = np.repeat(np.arange(len(n)), count)
        seq = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        lo = np.maximum(seq * length, at[row])
        hi = np.minimum((seq + 1) * length, (at + n)[row])
        start = lo - at[row]
        blobs, cut, crc = batch.column("ids").to_pylist(), [], []
        for r, a, b in zip(row.tolist(), start.tolist(), (start + hi - lo).tolist(), strict=True):
            width = len(blobs[r]) // int(n[r])
            piece = np.frombuffer(blobs[r], "<u2" if width == 2 else "<u4", b - a, a * width).astype("<u4").tobytes()
            crc.append(zlib.crc32(piece))
            if with_ids:
                cut.append(piece)
        columns = {"doc_id": batch.column("doc_id").take(pa.array(row)), "start": pa.array(start), "length": pa.array(hi - lo), "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(n[row]), "sequence_id": pa.array(seq), "offset": pa.array(lo - seq * length)}
        if with_ids:
            columns["ids"] = pa.array(cut, pa.binary())
        yield pa.RecordBatch.from_pydict(columns)


def pack_documents(docs: DataFrame, length: int = 4096, end: int = 2, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Pack every document into sequences of `length` ids, neighbours on the curve side by side.

    Each text (null: empty) becomes its ids and then `end`. A hashed word vector of the text,
    projected to three dimensions, gives a Hilbert key; documents are range-sorted by it, exact
    copies spread by a hash of ids and doc_id (equal rows by their number, so no part of the sort grows with them), and their ids laid end to end over all parts of the
    sort. Sequences are the consecutive runs of `length` ids, so only the last one is padded.
    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with
    `with_ids` the piece's little-endian 32-bit ids. Null and repeated doc_id are kept as they
    are, repeated rows are packed again, other columns are ignored, and an empty table has no pieces.
    Only one number for each part of the sort reaches the driver.
    """
    spark = docs.sparkSession
    path = path or tokenizer_path()
    tables = Scratch(spark, "packing")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    tokens = tables.put(rows.mapInArrow(lambda it: _tokenise(it, path, end), "doc_id long, key long, doc_tokens long, ids binary, row long"), "tokens")
    total = tokens.agg(F.sum("doc_tokens")).first()[0] or 0
    parts = max(partitions(spark), int(total) // (8 << 20) + 1)
    ranged = tokens.repartitionByRange(parts, "key", "doc_id", "row").sortWithinPartitions("key", "doc_id", "row").drop("row")
    laid = tables.put(ranged.mapInArrow(_running, "doc_id long, key long, doc_tokens long, ids binary, part int, before long"), "laid")
    base, so_far = {}, 0
    for part, n in sorted(map(tuple, laid.groupBy("part").agg(F.sum("doc_tokens")).collect())):
        base[part], so_far = so_far, so_far + n
    tables.drop("tokens")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    return laid.select("doc_id", "doc_tokens", "ids", "part", "before").mapInArrow(lambda it: _pieces(it, base, length, with_ids), schema)


def op5_pack_curve(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
