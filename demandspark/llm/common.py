"""Helpers shared by the operators: byte views of Arrow text, words, hashes, folds.

Python code runs inside Spark tasks only, over Arrow batches that are cut into
pieces of bounded size, so that memory does not depend on the batch settings.
"""

from __future__ import annotations

import ctypes
import math
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

U64 = np.uint64
#: Text bytes that a vectorised step works on at once (one longer text goes alone).
PIECE_BYTES = 1 << 21
#: An odd 64-bit multiplier for rolling hashes, and the one that mixes bits.
BASE = U64(0x9E3779B97F4A7C15)
MIXER = U64(0xD6E8FEB86659FD93)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """The fold rule of the labelled queries; a null doc_id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def replacing(df: DataFrame, fields: str) -> DataFrame:
    """``df`` without the columns that results of a DDL string will replace."""
    new = {f.name.lower() for f in T.StructType.fromDDL(fields)}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in new])


def with_fields(schema: T.StructType, fields: str) -> T.StructType:
    """``schema`` and the fields of a DDL string, of which none may be there already."""
    new = T.StructType.fromDDL(fields)
    clash = {f.name.lower() for f in new} & {f.name.lower() for f in schema}
    if clash:
        raise ValueError(f"the input already has {sorted(clash)}")
    return T.StructType([*schema.fields, *new.fields])


def renamed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: extra columns can't clash."""
    return df.select(*[F.col(f"`{c}`").alias(k) for k, c in columns.items()])


def total_bytes(df: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and text bytes, to size partitions by what is there."""
    row = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(text)).cast("long"))).first()
    return row[0], row[1] or 0


def shards(n_bytes: int, each: int) -> int:
    return max(1, math.ceil(n_bytes / each))


# --- Arrow text as bytes -------------------------------------------------------------------


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows in one array, and the offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    if len(column) == 0 or at is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``limit`` text bytes, each with its bytes and offsets."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(text))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
            hi = min(hi, batch.num_rows)
            yield batch.slice(lo, hi - lo), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            lo = hi


def per_worker(key, make: Callable):
    """What a task leaves for the next tasks of its Python process: one object that is costly to make.

    A method ``forget`` of that object drops what it holds of a task's rows (``lean`` calls it).
    """
    kept = sys.modules.setdefault("_demandspark_llm_kept", types.ModuleType("_demandspark_llm_kept")).__dict__
    if kept.get("key") != key:
        kept["value"], kept["key"] = make(), key
    return kept["value"]


def lean(run: Callable, key=None) -> Callable:
    """The task function ``run`` as one that leaves no more than ``key``'s object in its Python process.

    Processes outlive their tasks, and an idle one keeps what was freed in it.  What a task of another
    operator kept goes first, and that object forgets the task's rows at the end; freed memory then returns to
    the system (groups of few bytes skip that).
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 0

        def counted():
            nonlocal size
            for batch in batches:
                size += batch.nbytes
                yield batch

        left = sys.modules.get("_demandspark_llm_kept")
        if left is not None and left.__dict__.get("key") != key:
            left.__dict__.pop("value", None), left.__dict__.pop("key", None)
        try:
            yield from run(counted())
        finally:
            left = sys.modules.get("_demandspark_llm_kept")
            forget = left is not None and getattr(left.__dict__.get("value"), "forget", None)
            if forget:
                forget()
            if size >= PIECE_BYTES:
                pa.default_memory_pool().release_unused()
                trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
                if trim is not None:
                    trim(0)

    return task


class Shared:
    """A broadcast object that travels by value, so that executors need no copy of the library."""

    def __init__(self, spark: SparkSession, value) -> None:
        self.sent, self.kept = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    @property
    def value(self):
        if self.kept is None:
            self.kept = cloudpickle.loads(self.sent.value)
        return self.kept

    def __getstate__(self) -> dict:
        return {"sent": self.sent, "kept": None}


def shared(spark: SparkSession, value) -> Shared:
    return Shared(spark, value)


# --- hashes --------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> U64(32))) * MIXER
    x = (x ^ (x >> U64(32))) * MIXER
    return x ^ (x >> U64(32))


def byte_values() -> np.ndarray:
    """A random-looking 64-bit value for each byte."""
    return mix((np.arange(256, dtype=U64) + U64(1)) * BASE)


def power(k: int) -> np.ndarray:
    """BASE to the k, wrapping, as an array of one."""
    return np.array([pow(int(BASE), k, 1 << 64)], dtype=U64)


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of all runs of ``k`` values, by doubling and joining."""
    if len(values) < k:
        return np.zeros(0, U64)
    done, have, block, size = None, 0, values, 1
    while True:
        if k & size:
            # the part hashed so far, followed by this block
            if done is None:
                done, have = block, size
            else:
                n = len(values) - have - size + 1
                done = done[:n] * power(size) + block[have : have + n]
                have += size
        if size * 2 > k:
            return done
        block = block[:-size] * power(size) + block[size:]
        size *= 2


# --- words ---------------------------------------------------------------------------------


def class_table(kind: str) -> np.ndarray:
    """True for bytes of words: ``space`` splits at ASCII white space, ``plain`` keeps 0-9, a-z (after lower-casing) and all non-ASCII characters."""
    t = np.ones(256, bool)
    if kind == "space":
        t[[0x20, *range(0x09, 0x0E)]] = False
    else:
        t[:0x80] = False
        t[0x30:0x3A] = True
        t[0x61:0x7B] = True
    return t


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def word_bounds(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row its first word (one more at the end)."""
    n = len(is_word)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    inside = np.zeros(n + 1, bool)
    inside[1:] = is_word
    starts = np.flatnonzero(is_word & (~inside[:-1] | edge[:-1]))
    after = np.zeros(n + 1, bool)
    after[:n] = is_word
    ends = np.flatnonzero(is_word & (~after[1:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


#: Words of up to this many bytes are hashed byte by byte, all at once; longer ones by pieces.
LONG_WORD = 64


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes; words of one length block are folded together.

    The hash is a polynomial in BASE.  A long word's polynomial is a sum over its bytes with
    their powers, so that no step is made byte by byte.
    """
    lengths = ends - starts
    out = np.zeros(len(starts), U64)
    if not len(starts):
        return out
    values, k = byte_values(), 0
    long = np.flatnonzero(lengths > LONG_WORD)
    for i in long.tolist():
        part = values[data[starts[i] : ends[i]]]
        out[i] = (part * powers(len(part))[::-1]).sum(dtype=U64)
    short = np.flatnonzero(lengths <= LONG_WORD)
    order = short[np.argsort(-lengths[short], kind="stable")]
    by_length, at = lengths[order], starts[order]
    sorted_out = np.zeros(len(order), U64)
    live = len(order)
    while live:
        sorted_out[:live] = sorted_out[:live] * BASE + values[data[at[:live] + k]]
        k += 1
        live = int(np.searchsorted(-by_length[:live], -k, "left"))
    out[order] = sorted_out
    return mix(out)


def powers(n: int) -> np.ndarray:
    """BASE to the 0, 1, ... n - 1, wrapping, by doubling."""
    out = np.ones(n, U64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * power(done)
        done += more
    return out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of all the runs, one after the other."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - first, counts)

