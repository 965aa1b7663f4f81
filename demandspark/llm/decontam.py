"""Benchmark decontamination by suffix arrays over the training documents.

Every task builds a suffix array over the word sequence of its shard of documents:
word positions ordered by the first words of their suffix.  Every suffix of the
benchmark is looked up in it by binary search, the suffixes found are extended word
by word to the longest verbatim match, and matches that span a whole window (13
words, or a shorter item as a whole) mark the words they cover.

The benchmark reaches the tasks in blocks of bounded size; a larger benchmark means
more passes over the documents, not larger tasks.

Defined results: a null or empty text, or one without words, has no words, no items
and is not contaminated; so has every document if the benchmark is empty.  Items
with null or wordless text match nothing.  Repeated documents are judged one by one;
rows of one item_id form one item.  A null item_id is the item ``null``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import (
    BASE, U64, class_table, lean, lower_table, mix, pieces, ranges, renamed, replacing, shards, text_bytes, total_bytes, with_fields, word_bounds, word_hashes,
)

WINDOW = 13
#: Benchmark text that one pass over the documents carries along.
BLOCK_BYTES = 16 << 20
#: Words of a suffix that order the array; items of fewer words are looked up as a whole.
KEY_WORDS = 4


@dataclass
class Tests:
    """The suffixes of a benchmark block, ordered by the hash of their first ``q`` words."""

    q: int
    words: np.ndarray
    key: np.ndarray
    at: np.ndarray
    left: np.ndarray
    need: np.ndarray
    item: np.ndarray
    names: list[str]
    #: Items of fewer than q words: by length and hash of the whole text, their names.
    short: dict[int, dict[int, list[str]]]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = lower_table()[data]
    starts, ends, first = word_bounds(class_table("plain")[data], offsets)
    return word_hashes(data, starts, ends), first


def _suffix_keys(words: np.ndarray, q: int) -> np.ndarray:
    """Hash of the first q words of each suffix, as if the sequence went on with zeros."""
    padded = np.concatenate([words, np.zeros(q, U64)])
    key = np.zeros(len(words), U64)
    for j in range(q):
        key = key * BASE + padded[j : j + len(words)]
    return mix(key)


def test_suffixes(names: list[str], texts: list[str | None], window: int = WINDOW) -> Tests | None:
    words, first = _words(*text_bytes(pa.array(texts, pa.string())))
    lengths = np.diff(first)
    if not lengths.any():
        return None
    q = min(KEY_WORDS, window)
    item = np.repeat(np.arange(len(names)), lengths)
    left = np.repeat(first[1:], lengths) - np.arange(len(words))
    need = np.repeat(np.minimum(lengths, window), lengths)
    # Items of fewer than q words are looked up whole; else a suffix of fewer is part of a longer match.
    short: dict[int, dict[int, list[str]]] = {}
    for i in np.flatnonzero((lengths > 0) & (lengths < q)).tolist():
        m = int(lengths[i])
        key = int(_suffix_keys(words[first[i] : first[i] + m], m)[0])
        short.setdefault(m, {}).setdefault(key, []).append(names[i])
    at = np.flatnonzero(left >= q)
    key = _suffix_keys(words, q)[at]
    order = np.argsort(key, kind="stable")
    at = at[order]
    return Tests(q, words, key[order], at, left[at], need[at], item[at], names, short)


def match_short(words: np.ndarray, first: np.ndarray, tests: Tests) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[list[str]], np.ndarray]]:
    """For each length of short items: length, word positions, rows, the names of each text found, and which text is where."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    left = first[1:][row] - np.arange(len(words)) if len(words) else np.zeros(0, np.int64)
    for m, items in sorted(tests.short.items()):
        known = np.array(sorted(items), U64)
        key = _suffix_keys(words, m)
        which = np.minimum(np.searchsorted(known, key), len(known) - 1)
        p = np.flatnonzero((left >= m) & (known[which] == key))
        yield m, p, row[p], [items[int(k)] for k in known], which[p]


def match_piece(words: np.ndarray, first: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All (word position, row, test suffix, length in words) of longest matches of at least q words."""
    n = len(words)
    if not len(tests.key):
        z = np.zeros(0, np.int64)
        return z, z, z, z
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    left = first[1:][row] - np.arange(n) if n else np.zeros(0, np.int64)
    key = _suffix_keys(words, tests.q)
    distinct = np.unique(tests.key)
    # Only suffixes that begin like a benchmark suffix need a place in the array.
    at = np.flatnonzero((left >= tests.q) & (distinct[np.minimum(np.searchsorted(distinct, key), len(distinct) - 1)] == key))
    suffixes = at[np.argsort(key[at], kind="stable")]
    ordered = key[suffixes]
    lo, hi = np.searchsorted(ordered, tests.key, "left"), np.searchsorted(ordered, tests.key, "right")
    t = np.repeat(np.arange(len(lo)), hi - lo)
    p = suffixes[ranges(lo, hi - lo)]
    if not len(p):
        z = np.zeros(0, np.int64)
        return z, z, z, z
    most = np.minimum(left[p], tests.left[t])
    length = np.zeros(len(p), np.int64)
    alive = np.arange(len(p))
    k = 0
    while len(alive):
        alive = alive[most[alive] > k]
        alive = alive[words[p[alive] + k] == tests.words[tests.at[t[alive]] + k]]
        k += 1
        length[alive] = k
    keep = length >= tests.q
    return p[keep], row[p[keep]], t[keep], length[keep]


STATE = "n_words long, n_hit long, items array<string>, longest_match int, longest_at int, longest_item string, __hits binary"


def scanner(tests: Tests | None, kept: list[str], later: bool):
    """A function for mapInArrow: one benchmark block's pass over the documents.

    ``later``: the rows carry the state of an earlier pass, with which finds are joined.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            words, first = _words(data, offsets)
            rows = batch.num_rows
            steps = np.zeros(len(words) + 1, np.int32)
            items: list[set[str]] = [set() for _ in range(rows)]
            longest, place, name = np.zeros(rows, np.int64), np.full(rows, -1), [None] * rows
            if tests is not None and len(words):
                p, r, t, length = match_piece(words, first, tests)
                order = np.lexsort((t, p, -length, r))
                top, at = np.unique(r[order], return_index=True)
                longest[top], place[top] = length[order][at], (p - first[r])[order][at]
                for i, j in zip(top, tests.item[t][order][at], strict=True):
                    name[i] = tests.names[j]
                whole = length >= tests.need[t]
                p, r, t = p[whole], r[whole], t[whole]
                np.add.at(steps, p, 1)
                np.add.at(steps, p + tests.need[t], -1)
                for i, j in np.unique(np.stack([r, tests.item[t]], 1), axis=0):
                    items[i].add(tests.names[j])
                for m, p, r, known, which in match_short(words, first, tests):
                    np.add.at(steps, p, 1)
                    np.add.at(steps, p + m, -1)
                    pairs, at = np.unique(np.stack([r, which], 1), axis=0, return_index=True)
                    for (i, k), a in zip(pairs.tolist(), at.tolist(), strict=True):
                        items[i].update(known[k])
                        if m > longest[i]:
                            longest[i], place[i], name[i] = m, p[a] - first[i], min(known[k])
            covered = np.cumsum(steps[:-1]) > 0
            bits = [np.packbits(covered[first[i] : first[i + 1]]) if items[i] else None for i in range(rows)]
            if later:
                for i, old in enumerate(batch.select(["items", "longest_match", "longest_at", "longest_item", "__hits"]).to_pylist()):
                    items[i].update(old["items"])
                    if old["__hits"]:
                        before = np.frombuffer(old["__hits"], np.uint8)
                        bits[i] = before if bits[i] is None else bits[i] | before
                    if (old["longest_match"], -old["longest_at"]) >= (longest[i], -place[i]):
                        longest[i], place[i], name[i] = old["longest_match"], old["longest_at"], old["longest_item"]
            n_hit = [0 if b is None else int(np.unpackbits(b).sum()) for b in bits]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    pa.array(longest, pa.int32()),
                    pa.array(place, pa.int32()),
                    pa.array(name, pa.string()),
                    pa.array([None if b is None else b.tobytes() for b in bits], pa.binary()),
                ],
                names=[*kept, "n_words", "n_hit", "items", "longest_match", "longest_at", "longest_item", "__hits"],
            )

    return scan


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` with n_words, n_hit, items, longest match and contaminated.

    ``docs`` needs ``text``; ``benchmark`` has ``item_id`` and ``text``.  A document is
    contaminated if it has a hit and ``share * n_hit >= n_words``.  longest_match is the
    length in words of the longest verbatim match with any item (0 below the key length, unless
    it is a whole item), longest_at its first word (-1: none) and longest_item its item.
    """
    tests = renamed(benchmark, item_id="item_id", text="text").select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    blocks = shards(total_bytes(tests)[1], block_bytes)
    docs = replacing(docs, f"{STATE}, contaminated boolean")
    schema, out = with_fields(docs.schema, STATE), docs
    for b in range(blocks):
        rows = tests.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()  # about block_bytes
        block = test_suffixes([r.item for r in rows], [r.text for r in rows], window)
        out = out.mapInArrow(lean(scanner(block, docs.columns, b > 0)), schema)
    return out.drop("__hits").withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without its contaminated rows."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "text")  # its columns may have the results' names
    return find_contamination(packed, benchmark, **options).where(~F.col("contaminated")).select("__row.*")


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: counts, the digest of its items, the verdict and the longest match."""
    found = find_contamination(renamed(docs, doc_id="doc_id", text="text"), benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )
