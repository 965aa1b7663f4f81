"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

The encoding of every prefix of a chunk ends in exactly one token.  A token that is a
suffix of the prefix (found by a suffix-matching automaton over the vocabulary) is that
last token if and only if it is compatible with the last token of what stands before
it: the two, concatenated, must encode to just this pair.  Storing the last token of
each prefix and following the back-pointers from the end gives the ids, without
replaying merges.

Chunks repeat, so that each task encodes a distinct chunk once (its memory is bounded
by a cache that starts anew when full).  What a task met goes when it ends: only the
tables of the vocabulary stay in its Python process.

Defined results: a null or empty text has no ids and decodes to an empty text.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import lean, per_worker, pieces, ranges, renamed, replacing, with_fields, word_hashes

#: The pre-tokenizer's pattern of this file format (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Python's \s also takes the separators U+001C to U+001F; the format's doesn't.
SPACE = r"\t\n\x0b\f\r \x85\p{Z}"
#: Chunks whose ids a process keeps, some 200 bytes each (and twice as many pairs); others are encoded again.
CACHE_CHUNKS = 250_000
#: Text bytes that are split and looked up at once; their arrays take some 40 times as much.
PIECE = 1 << 19


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the file format, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merge ranks and special tokens of a byte-level BPE file, by id in flat arrays."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        alphabet = byte_alphabet()
        raw = lambda token: bytes(alphabet[c] for c in token)
        ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        merges = [[ids[raw(t)] for t in (m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        of = {i: t for t, i in ids.items()} | {i: content.encode() for content, i in self.special.items()}
        top = max(of) + 1
        #: The bytes of all tokens, one after the other, and the length of each.
        self.pool = b"".join(of.get(i, b"") for i in range(top))
        self.length = array("i", [len(of.get(i, b"")) for i in range(top)])
        #: The tokens of the model and their ids, as an automaton that finds them in a text.
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, i in ids.items():
            self.machine.add_word(token.decode("latin-1"), i)
        self.machine.make_automaton()
        #: The pair that makes a token first (-1: none).
        self.left, self.right = array("i", [-1]) * top, array("i", [-1]) * top
        for a, b in merges:
            whole = ids[of[a] + of[b]]
            if self.left[whole] < 0:
                self.left[whole], self.right[whole] = a, b
        pairs = array("q", [a << 32 | b for a, b in merges])
        del spec, ids, of, merges
        #: The rank of each merge, by left << 32 | right; the last one counts.
        self.rank = {pair: rank for rank, pair in enumerate(pairs)}
        #: The rank of the merge that makes a token (-1: none).
        self.made = array("i", [self.rank[a << 32 | b] if a >= 0 else -1 for a, b in zip(self.left, self.right, strict=True)])


class Encoder:
    """Encodes and decodes with one vocabulary; lives in a task."""

    def __init__(self, vocabulary: Vocabulary, cache_chunks: int = CACHE_CHUNKS) -> None:
        self.v, self.cache_chunks = vocabulary, cache_chunks
        self.machine, self.length = vocabulary.machine, vocabulary.length
        self.pairs: dict[int, bool] = {}
        self.single: dict[int, bool] = {}
        self.chunks: dict[bytes, bytes] = {}
        self.split = regex.compile(PATTERN.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")).findall
        special = "|".join(regex.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True))
        self.cut = regex.compile(f"({special})") if special else None
        self.classes = character_classes()

    def compatible(self, a: int, b: int, limit: int | None = None) -> bool:
        """Whether the bytes of a and b, put together, encode to the pair (a, b).

        The merges inside both tokens are undone from the last to the first.  A merge
        across the border that comes before the one undone would have been made first.
        ``limit``: only merges across that come before this rank count.
        """
        rank, made = self.v.rank, self.v.made
        left, right = a, b
        limit = len(rank) if limit is None else limit
        while True:
            across = rank.get(left << 32 | right)
            if across is not None and across < limit:
                return False
            l_rank, r_rank = made[left], made[right]
            if l_rank < 0 and r_rank < 0:
                return True
            # Undo the later merge, of equals the right one.  Equal merges are made from
            # left to right, so that one across the border comes before an equal one on
            # its right and after an equal one on its left.
            if l_rank > r_rank:
                limit, left = l_rank, self.v.right[left]
            else:
                limit, right = r_rank + 1, self.v.left[right]

    def chunk_ids(self, chunk: bytes) -> list[int]:
        """The ids of one chunk."""
        return list(self.sorted_ids([chunk]))[0]

    def sorted_ids(self, chunks: list[bytes]) -> Iterator[list[int]]:
        """The ids of sorted chunks: the last token of every prefix, then the way back.

        What a chunk has in common with the one before it has the same prefixes.
        """
        known, lengths, before, last = self.pairs, self.length, b"", [-1]
        for chunk in chunks:
            n = len(chunk)
            most = min(n, len(before))
            same = most
            if chunk[:most] != before[:most]:
                same = 0
                while chunk[same] == before[same]:
                    same += 1
            last = last[: same + 1] + [-1] * (n - same)
            # The automaton gives the suffixes of each prefix, the longest first.
            for end, token in self.machine.iter(chunk.decode("latin-1")):
                if end < same or last[end + 1] >= 0:
                    continue
                length = lengths[token]
                if end >= length:
                    left = last[end + 1 - length]
                    if left < 0:
                        continue
                    pair = left << 32 | token
                    good = known.get(pair)
                    if good is None:
                        good = known[pair] = self.compatible(left, token)
                    if good:
                        last[end + 1] = token
                elif self.is_single(token):
                    last[end + 1] = token
            before = chunk
            ids = []
            while n:
                ids.append(last[n])
                n -= self.length[last[n]]
            yield ids[::-1]

    def is_single(self, token: int) -> bool:
        """Whether a token's own bytes encode to it: its two parts, encoded on their own, are joined last."""
        good = self.single.get(token)
        if good is None:
            left, right = self.v.left[token], self.v.right[token]
            good = left < 0 or (self.is_single(left) and self.is_single(right) and self.compatible(left, right, self.v.made[token]))
            self.single[token] = good
        return good

    def encode(self, text: str) -> bytes:
        """The ids of one text, as little-endian unsigned 32-bit integers; special tokens are cut out first."""
        out = []
        for part in self.cut.split(text) if self.cut else [text]:
            special = self.v.special.get(part)
            out.append(self.lookup([c.encode() for c in self.split(part)]) if special is None else [special.to_bytes(4, "little")])
        return b"".join(x for y in out for x in y)

    def forget(self) -> None:
        """Drop what the texts so far have left: the ids of chunks and the pairs of tokens."""
        self.chunks, self.pairs = {}, {}

    def lookup(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of distinct chunks; those not met before are encoded."""
        known = self.chunks
        if len(known) > self.cache_chunks:
            known.clear()
        if len(self.pairs) > 2 * self.cache_chunks:
            self.pairs.clear()
        new = sorted({c for c in chunks if c not in known})
        found = {c: array("I", ids).tobytes() for c, ids in zip(new, self.sorted_ids(new), strict=True)}
        out = [known.get(c) or found[c] for c in chunks]
        known.update(found if not any(len(c) > 256 for c in new) else {c: i for c, i in found.items() if len(c) <= 256})
        return out

    def encode_piece(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many texts that lie one after the other, and where each text's ids begin."""
        rows = len(offsets) - 1
        starts = chunk_starts(data, offsets, self.classes)
        ends = np.append(starts[1:], len(data))
        _, some, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        ids = self.lookup([raw[i:j] for i, j in zip(starts[some].tolist(), ends[some].tolist(), strict=True)])
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool = np.frombuffer(b"".join(ids), "<u4")
        counts = n[which]
        flat = pool[ranges((np.cumsum(n) - n)[which], counts)]
        at = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, offsets)]
        if self.cut is None or not any(s.encode() in raw for s in self.v.special):
            return flat, at
        texts = [flat[at[i] : at[i + 1]] for i in range(rows)]
        for i in range(rows):
            text = raw[offsets[i] : offsets[i + 1]]
            if any(s.encode() in text for s in self.v.special):
                texts[i] = np.frombuffer(self.encode(text.decode()), "<u4")
        return np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)

    def decoder(self):
        """A function from ids to text, by the bytes of all tokens put one after the other."""
        lengths = np.array(self.v.length, np.int64)
        pool = np.frombuffer(self.v.pool, np.uint8)
        starts = np.cumsum(lengths) - lengths

        def decode(i: np.ndarray) -> bytes:
            raw = pool[ranges(starts[i], lengths[i])].tobytes()
            return raw.decode("utf-8", "replace").encode()

        return decode


LETTER, NUMBER, OTHER, WHITE = range(4)


def character_classes() -> np.ndarray:
    """The pattern's class of each code point."""
    points = np.arange(0x110000, dtype="<u4")
    points[0xD800:0xE000] = 0xFFFD
    every = points.tobytes().decode("utf-32-le")
    classes = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, f"[{SPACE}]+")):
        for m in regex.finditer(pattern, every):
            classes[m.start() : m.end()] = kind
    return classes


def chunk_starts(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte positions at which the pattern's matches begin, for all texts at once.

    A run of letters, numbers or others is one chunk and takes a blank before it along.
    A run of white space is one chunk up to its last character, if something follows.
    An apostrophe that is a run by itself, without a blank before it, takes a
    contraction's letters along.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = classes[points]
    n = len(points)
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(lead, offsets)] = True
    new = edge.copy()
    new[1:n] |= kind[1:] != kind[:-1]
    new[0] = True
    run = np.flatnonzero(new[:n])
    end = np.append(run[1:], n)
    white = kind[run] == WHITE
    last_of_text = edge[end]
    is_start = np.zeros(n + 1, bool)
    # White space: the run, and its last character unless that is a blank for what follows.
    w, stop = run[white], end[white]
    followed = ~last_of_text[white]
    is_start[w[~followed]] = True
    is_start[w[followed & (stop - w > 1)]] = True
    tail = stop[followed] - 1
    is_start[tail[points[tail] != 32]] = True
    # Other runs, with the blank before them.
    r = run[~white]
    blank = (points[np.maximum(r - 1, 0)] == 32) & (r > 0) & ~edge[r]
    is_start[r - blank] = True
    # Contractions.
    lone = (kind[run] == OTHER) & (end - run == 1) & (points[run] == 39) & ~last_of_text
    lone &= ~((points[np.maximum(run - 1, 0)] == 32) & (run > 0) & ~edge[run])
    at = np.flatnonzero(lone)
    at = at[kind[run[np.minimum(at + 1, len(run) - 1)]] == LETTER]
    for i in at.tolist():
        begin, stop_i = int(run[i + 1]), int(end[i + 1])
        two = "".join(map(chr, points[begin : min(begin + 2, stop_i)]))
        size = 2 if two in ("re", "ve", "ll") else 1 if two[:1] in ("s", "t", "m", "d") else 0
        if size:
            is_start[begin] = False
            if begin + size < stop_i:
                is_start[begin + size] = True
    return lead[np.flatnonzero(is_start[:n])]


def read_vocabulary(path: str | None = None) -> str:
    """The vocabulary file's text; it is a parameter of the run, of a few MB, read by the driver."""
    with open(path or default_vocabulary(), encoding="utf-8") as f:
        return f.read()


def _coded(docs: DataFrame, path: str | None, kept: list[str], fields: str, finish) -> DataFrame:
    vocabulary = read_vocabulary(path)
    key = "bpe", hashlib.sha256(vocabulary.encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(key, lambda: Encoder(Vocabulary(shared.value)))
        decode = encoder.decoder()
        for batch, data, offsets in pieces(batches, limit=PIECE):
            ids, at = encoder.encode_piece(data, offsets)
            columns = finish([ids[at[i] : at[i + 1]] for i in range(batch.num_rows)], decode)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *columns.values()], names=[*kept, *columns])

    return docs.mapInArrow(lean(run, key), with_fields(docs.select(*[F.col(f"`{c}`") for c in kept]).schema, fields))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (array<int>), n_tokens and the text decoded from the ids; these replace columns of the same names."""

    def finish(ids, decode):
        return {
            "ids": pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
            "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
            "decoded": pa.array([decode(i).decode() for i in ids], pa.string()),
        }

    fields = "ids array<int>, n_tokens long, decoded string"
    docs = replacing(docs, fields)
    return _coded(docs, path, docs.columns, fields, finish)


def encode_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: n_tokens and the SHA-256 of the ids and of the text decoded from them."""

    def finish(ids, decode):
        return {
            "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(decode(i)).hexdigest() for i in ids], pa.string()),
        }

    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _coded(renamed(docs, doc_id="doc_id", text="text"), path, ["doc_id"], fields, finish)
