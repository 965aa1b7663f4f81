"""Spelling variants: each word's near words, its most frequent form and the root of its forms.

1. *Words.*  Each task counts the words of its texts in a dictionary of bounded size; the
   counts meet by word.
2. *Meeting.*  Two words that differ by one code point have, for the length m of the shorter,
   the first m // 2 or the last m - m // 2 code points in common.  So each word goes into the
   buckets of its beginnings and endings of these lengths, three or four in all, and a near
   pair is judged in exactly one of them.  Buckets are dealt into shards of a bounded number of
   words; a bucket larger than that is cut into blocks of stored words, each of which meets
   all of the bucket's words.
3. *Search.*  A bit-sliced position index holds, for every position and letter, the set of
   stored words with that letter there, one bit a word.  All words of a block walk along their
   letters at once, with four sets each: stored words that agree so far, and those that agree
   but for one replaced letter, one letter of the word left out (positions shift down) or one
   letter of the stored word left out (positions shift up).
4. *Forms.*  Tasks return counts and the best near word of each word only, no pairs.  Roots
   follow forms by pointer doubling: n grows fivefold with each step, so that a chain has at
   most 27 steps and five doublings reach its end.

Defined results: a null text has no words; a null doc_id reads as empty in the hash.  Rows that
repeat a doc_id are counted one by one.  Words of any length take part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.stage import stage
from demandspark.llm.common import U64, renamed, shards

MIN_LENGTH, MIN_COUNT, RATIO, EVERY = 6, 5, 5, 199
#: Words that a task counts before it hands its counts on, and text bytes that are split at once.
COUNTED, SPLIT_BYTES = 200_000, 1 << 20
#: Entries of a shard; a bucket with more is cut into blocks of stored words.
SHARD = 1 << 15
#: Words that are stored and that are searched at once (fewer if they are long).
BLOCK, BLOCK_LETTERS = 2048, 1 << 22
BROADCAST_ROWS = 100_000
DOUBLINGS = 5


# --- step 1: words ---------------------------------------------------------------------------


def letter_table() -> bytes:
    """Latin-1 bytes: A-Z lower-cased, a-z and U+00C0 to U+00FF kept, all others a blank."""
    return bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str, table: bytes) -> Iterator[list[bytes]]:
    """The letter runs of ``text`` in Latin-1, in lists of about SPLIT_BYTES."""
    data, lo = text.encode("latin-1", "replace").translate(table), 0
    while lo < len(data):
        hi = data.find(b" ", lo + SPLIT_BYTES)
        hi = len(data) if hi < 0 else hi
        yield data[lo:hi].split()
        lo = hi


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, counts = letter_table(), {}

    def handed():
        words = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in words], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            begin = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
            for part in runs(text or "", table):
                own: dict[bytes, int] = {}
                for w in part:
                    if len(w) >= MIN_LENGTH:
                        own[w] = own.get(w, 0) + 1
                for w, k in own.items():
                    h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), begin)
                    if h % EVERY == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1 :]
                        if len(w) < MIN_LENGTH:
                            continue
                    counts[w] = counts.get(w, 0) + k
                if len(counts) >= COUNTED:
                    yield from handed()
    if counts:
        yield from handed()


# --- steps 2 and 3: near words ---------------------------------------------------------------


class PositionIndex:
    """Bitsets of stored words by position and letter, made position by position."""

    def __init__(self, letters: np.ndarray, alphabet: int) -> None:
        """``letters``: a row of letter numbers from 1 for each stored word, 0 behind its end."""
        self.letters, self.alphabet = letters, alphabet
        self.words = -(-len(letters) // 64)

    def at(self, position: int) -> np.ndarray:
        """A bitset for each letter; none has a bit outside the words."""
        out = np.zeros((self.alphabet + 1, self.words * 8), np.uint8)
        if 0 <= position < self.letters.shape[1]:
            column = self.letters[:, position]
            for letter in np.unique(column):
                if letter:
                    bits = np.packbits(column == letter, bitorder="little")
                    out[letter, : len(bits)] = bits
        return out.view(U64)


def near_bits(queries: np.ndarray, lengths: np.ndarray, stored: np.ndarray, stored_lengths: np.ndarray, alphabet: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, stored word) places of all pairs one code point apart; ``queries`` by falling length."""
    index = PositionIndex(stored, alphabet)
    n, words = len(queries), index.words
    everything = np.zeros(words * 8, np.uint8)
    packed = np.packbits(np.ones(len(stored), bool), bitorder="little")
    everything[: len(packed)] = packed
    everything = everything.view(U64)

    def of_length(m: int) -> np.ndarray:
        out = np.zeros(words * 8, np.uint8)
        bits = np.packbits(stored_lengths == m, bitorder="little")
        out[: len(bits)] = bits
        return out.view(U64)

    equal = np.tile(everything, (n, 1))
    replaced, shorter = np.zeros((n, words), U64), np.zeros((n, words), U64)
    longer = equal.copy()
    below, here, above = index.at(-1), index.at(0), index.at(1)
    live = n
    for j in range(int(lengths[0]) if n else 0):
        letter = queries[:live, j]
        e, r, s, g = equal[:live], replaced[:live], shorter[:live], longer[:live]
        r &= here[letter]
        r |= e
        s &= below[letter]
        s |= e
        e &= here[letter]
        g &= above[letter]
        g |= e
        below, here, above = here, above, index.at(j + 2)
        ended = int(np.searchsorted(-lengths[:live], -(j + 1), "left"))
        if ended < live:
            done = slice(ended, live)
            found = (replaced[done] & ~equal[done] & of_length(j + 1)) | (shorter[done] & of_length(j)) | (longer[done] & of_length(j + 2))
            row, word = np.nonzero(found)
            if len(row):
                bits = np.unpackbits(found[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                which, bit = np.nonzero(bits)
                yield row[which] + ended, word[which] * 64 + bit
            live = ended


def coded(words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Letter numbers (a row a word), lengths and the size of the alphabet."""
    lengths = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    known, number = np.unique(points, return_inverse=True)
    out = np.zeros((len(words), int(lengths.max(initial=0))), np.uint16 if len(known) < 65_000 else np.uint32)
    row = np.repeat(np.arange(len(words)), lengths)
    out[row, np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = number + 1
    return out, lengths, len(known)


NEAR = "word string, n_near long, near_n long, near string"


def near_in_shard(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word searched: its near words in this shard, and the best of them."""
    rows = pa.Table.from_batches(list(group)).select(["bucket", "half", "word", "n", "stored", "searched"])
    bucket, half, stored, searched = (rows[c].to_numpy() for c in ("bucket", "half", "stored", "searched"))
    words, n = rows["word"].to_pylist(), rows["n"].to_numpy()
    lengths = np.array([len(w) for w in words])
    _, bucket = np.unique(bucket.astype(str), return_inverse=True)
    # blocks: whole buckets, words of like length together
    top = np.zeros(int(bucket.max(initial=-1)) + 1, np.int64)
    np.maximum.at(top, bucket, lengths)
    order = np.lexsort((bucket, top[bucket]))
    sizes = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0))
    blocks, lo, have = [], 0, 0
    for a, b in zip(sizes, np.append(sizes[1:], len(order)), strict=True):
        if have and (b - lo > BLOCK or (b - lo) * top[bucket[order[a]]] > BLOCK_LETTERS):
            blocks.append(order[lo:a])
            lo = a
        have = b - lo
    blocks.append(order[lo:])
    total: dict[str, list] = {}
    for block in blocks:
        q, s = block[searched[block]], block[stored[block]]
        q = q[np.argsort(-lengths[q], kind="stable")]
        step = max(1, min(BLOCK, BLOCK_LETTERS // max(1, int(lengths[block].max(initial=1)))))
        for x in range(0, len(q), step):
            for y in range(0, len(s), step):
                qs, ss = q[x : x + step], s[y : y + step]
                letters, size, alphabet = coded([words[i] for i in np.concatenate([qs, ss])])
                for a, b in near_bits(letters[: len(qs)], size[: len(qs)], letters[len(qs) :], size[len(qs) :], alphabet):
                    a_len, b_len = size[a], size[len(qs) + b]
                    shorter = np.minimum(a_len, b_len)
                    h = shorter // 2
                    front = half[qs[a]] > 0
                    keep = (bucket[qs[a]] == bucket[ss[b]]) & np.where(front, half[qs[a]] == h, -half[qs[a]] == shorter - h)
                    # a pair with a common beginning belongs to the beginning's bucket
                    check = np.flatnonzero(keep & ~front)
                    width = letters.shape[1]
                    same = (letters[a[check]] == letters[len(qs) + b[check]]) | (np.arange(width) >= h[check][:, None])
                    keep[check[same.all(1)]] = False
                    for i, j in zip(qs[a[keep]].tolist(), ss[b[keep]].tolist(), strict=True):
                        own = total.setdefault(words[i], [0, -1, None])
                        own[0] += 1
                        if n[j] > own[1] or (n[j] == own[1] and words[j] < own[2]):
                            own[1], own[2] = int(n[j]), words[j]
    if total:
        values = list(total.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), *[pa.array([v[k] for v in values], t) for k, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.string()))]], names=["word", "n_near", "near_n", "near"]
        )


def near_words(vocabulary: DataFrame, shard: int = SHARD) -> DataFrame:
    """word, n_near, near_n, near: for words (word, n) with near ones, how many and the best."""
    m = F.length("word")
    beginning = lambda k: F.struct(k.alias("half"), F.substring("word", F.lit(1), k).alias("part"))
    ending = lambda k: F.struct((-k).alias("half"), F.substring("word", m - k + 1, k).alias("part"))
    halves = F.array(*[f(k) for x in (m, m - 1) for f, k in ((beginning, F.floor(x / 2).cast("int")), (ending, (x - F.floor(x / 2)).cast("int")))])
    entries = vocabulary.select("word", "n", F.explode(F.array_distinct(halves)).alias("h")).select("word", "n", "h.half", F.concat_ws(":", "h.half", "h.part").alias("bucket"))
    count = entries.count()
    hot = stage(entries.groupBy("bucket").agg(F.count("*").alias("size")).where(F.col("size") > shard), "hot-buckets")
    few = hot.count() <= BROADCAST_ROWS
    n_shards = shards(count, shard // 2)
    sized = entries.join(F.broadcast(hot) if few else hot, "bucket", "left")
    blocks = F.ceil(F.col("size") / shard).cast("int")
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    # of a hot bucket, each block stores its own words and searches for all
    place = F.when(F.col("size").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), blocks - 1))
    dealt = sized.withColumn("block", F.explode(place)).select(
        F.when(F.col("size").isNull(), F.pmod(F.xxhash64("bucket"), F.lit(n_shards)).cast("string")).otherwise(F.col("bucket")).alias("shard"),
        "block", "bucket", "half", "word", "n", (F.col("size").isNull() | (own == F.col("block"))).alias("stored"), F.lit(True).alias("searched"),
    )
    found = dealt.groupBy("shard", "block").applyInArrow(near_in_shard, NEAR)
    # the largest n, ties by the smallest word: negated n orders both
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.m")).alias("near_n"), F.col("best.near").alias("near"))


# --- the operator ----------------------------------------------------------------------------


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n of all words with MIN_LENGTH code points and MIN_COUNT occurrences or more."""
    texts = renamed(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return texts.mapInArrow(count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def roots(forms: DataFrame) -> DataFrame:
    """word and root of the words (word, form) that have a form."""
    reached = forms.select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        step = reached.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        reached = stage(reached.join(step, "root", "left").select("word", F.coalesce("__next", "root").alias("root")), "roots")
    return reached


def group_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of the words of ``docs`` (doc_id, text)."""
    words = stage(vocabulary(docs), "vocabulary")
    near = near_words(words)
    is_form = F.col("near_n") >= RATIO * F.col("n")
    joined = stage(
        words.join(near, "word", "left").select("word", F.when(is_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near_n")).alias("form_n")),
        "variants",
    )
    return joined.join(roots(joined.where("form is not null")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
