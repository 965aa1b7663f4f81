"""Suffix-array dedup: bytes covered by long strings that also start earlier are removed.

A string is a window of ``length`` bytes; a window goes if an equal one starts earlier
(smaller document, or the same document and an earlier start).  Four steps, each a
Spark stage over whole texts:

1. *Anchors.*  Every window has an anchor, the place of the smallest hash among the
   ``GRAM``-byte strings in it (the first of equals).  Equal windows have equal anchors at
   equal places, and one anchor serves some 35 neighbouring windows, so that a document
   yields few anchors.
2. *Candidates.*  Anchors meet by hash.  One whose hash occurs once in the corpus serves
   windows that occur once; only the others go on.
3. *Suffix arrays.*  The windows of those anchors (as runs of bytes) meet by anchor.  Each
   partition takes them in document order, batch by batch.  A batch becomes an array of
   its suffixes, sorted so that suffixes with equal first ``length`` bytes are neighbours.
   It is scanned against the levels of a logarithmic family of such arrays, which hold
   the first suffix of each kind only; then it becomes a level itself, and levels of
   equal size are merged.
4. *Removal.*  The windows found cover the bytes that go.

The order of the arrays is that of a 64-bit hash of the first ``length`` bytes, which
puts equal prefixes side by side as the alphabet would.

A task sends a run of bytes that occurs in it often only once, with its first place;
the other places are settled on the spot.  A key that occurs often in a task is known to
repeat and is sent once.  So no group grows with its copies beyond one row per task.

Defined results: a null text is empty, and texts shorter than ``length`` lose nothing.
Rows with a null doc_id count as the last documents.  Rows that repeat a doc_id with
another text are different documents, in the order of a hash of the text; rows that
repeat doc_id and text are one document and get the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import BASE, U64, byte_values, lean, mix, pieces, ranges, renamed, rolling, shards, total_bytes

LENGTH = 100
GRAM = 32
#: Text bytes whose anchors (or runs) one task puts into one row per shard.
GATHER_BYTES = 16 << 20
#: Rows of a table that are gathered at most, so that two bytes number them.
GATHER_ROWS = 60_000
#: Text bytes for each shard of anchors, of runs and of documents.
ANCHOR_SHARD, RUN_SHARD, TEXT_SHARD = 48 << 20, 8 << 20, 24 << 20
#: Windows that make a batch of the family.
BATCH = 1 << 18
LAST_ID = (1 << 63) - 1


def sliding_first_min(x: np.ndarray, w: int) -> np.ndarray:
    """For each run of ``w`` values the place of its smallest, the first of equals."""
    value, place, size = x, np.arange(len(x), dtype=np.int32), 1

    def join(gap: int, n: int):
        a, b = value[:n], value[gap : gap + n]
        later = b < a
        return np.where(later, b, a), np.where(later, place[gap : gap + n], place[:n])

    while size * 2 <= w:
        value, place = join(size, len(value) - size)
        size *= 2
    if size < w:
        value, place = join(w - size, len(x) - w + 1)
    return place


def anchors(text: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of each anchor of a text, the first window it serves and how many."""
    h = mix(rolling(byte_values()[text], gram))
    place = sliding_first_min(h, length - gram + 1)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    count = np.diff(np.append(first, len(place)))
    at = place[first]
    return h[at], at, first, count


class Family:
    """A logarithmic family of sorted suffix arrays that hold the first suffix of each kind."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Takes a batch of suffixes in order; True for those whose like came before."""
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        first = np.append(True, ordered[1:] != ordered[:-1])
        kinds = ordered[first]
        old = np.zeros(len(kinds), bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, kinds), len(level) - 1)
            old |= level[at] == kinds
        seen = np.empty(len(keys), bool)
        seen[order] = ~first | old[np.cumsum(first) - 1]
        new = kinds[~old]
        if len(new):
            self.levels.append(new)
        # Levels of about equal size are merged, so that there are few.
        while len(self.levels) > 1 and 2 * len(self.levels[-1]) > len(self.levels[-2]):
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(np.sort(np.concatenate([a, b]), kind="stable"))
        return seen


def merged_runs(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of half-open intervals that touch, ascending."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.append(True, start[1:] > reach[:-1])
    return start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)]


# --- step 1 and 2: anchors that occur more than once ---------------------------------------

ANCHORS = "shard long, docs binary, keys binary, row binary, place binary, sure boolean"
FOUND = "__id long, __hash long, place long"


def pack(first: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """An anchor's first window, its place after that, and its number of windows, in one integer."""
    return first.astype(np.int64) << 16 | (at - first).astype(np.int64) << 8 | n.astype(np.int64)


def _names(batch: pa.RecordBatch) -> np.ndarray:
    """(id, hash of the text) of each row."""
    return np.stack([batch.column("__id").to_numpy(), batch.column("__hash").to_numpy()], 1)


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]]:
    """Lists of pieces with about ``limit`` text bytes."""
    held, size, rows = [], 0, 0
    for piece in pieces(batches):
        if rows + piece[0].num_rows > GATHER_ROWS and held:
            yield held
            held, size, rows = [], 0, 0
        held.append(piece)
        size, rows = size + len(piece[1]), rows + piece[0].num_rows
        if size >= limit:
            yield held
            held, size, rows = [], 0, 0
    if held:
        yield held


def _anchor_rows(n_shards: int, length: int):
    schema = pa.schema([("shard", pa.int64()), *[(c, pa.binary()) for c in ("docs", "keys", "row", "place")], ("sure", pa.bool_())])
    # Six bytes of a place hold all of it.
    short = lambda place: np.ascontiguousarray(place.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()

    def flush(names, keys, row, place):
        names, keys, row, place = (np.concatenate(a) for a in (names, keys, row, place))
        order = np.argsort(keys, kind="stable")
        keys, row, place = keys[order], row[order], place[order]
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        size = np.diff(np.append(begin, len(keys)))
        often = np.repeat(size > 1, size)
        out = []
        # Keys met more than once go on at once; one row without a place tells the other tasks.
        for part, sure in ((np.flatnonzero(~often), False), (begin[size > 1], None), (np.flatnonzero(often), True)):
            if not len(part):
                continue
            shard = (keys[part] >> U64(16)) % U64(n_shards) if not sure else mix(row[part].astype(U64)) % U64(n_shards)
            o = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.append(True, np.diff(shard[o]) != 0))
            for i, j in zip(cuts, np.append(cuts[1:], len(o)), strict=True):
                p = part[o[i:j]]
                key = b"" if sure else keys[p].tobytes()
                if sure is None:
                    out.append((int(shard[o[i]]), b"", key, b"", b"", False))
                    continue
                used, r = np.unique(row[p], return_inverse=True)
                out.append((int(shard[o[i]]), names[used].tobytes(), key, r.astype(np.uint16).tobytes(), short(place[p]), bool(sure)))
        for k in range(0, len(out), 64):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out[k : k + 64], strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gathered(batches, GATHER_BYTES):
            names, keys, row, place, base = [], [], [], [], 0
            for batch, data, offsets in held:
                names.append(_names(batch))
                for i in np.flatnonzero(np.diff(offsets) >= length):
                    k, at, first, n = anchors(data[offsets[i] : offsets[i + 1]], length)
                    keys.append(k), place.append(pack(first, at, n)), row.append(np.full(len(k), base + i))
                base += batch.num_rows
            if keys:
                yield from flush(names, keys, row, place)

    return run


def _repeated(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one shard of anchors those whose hash occurs again, a row each."""
    docs, keys, row, place, flags = [], [], [], [], []
    base = 0
    for batch in group:
        for r in batch.select(["docs", "keys", "row", "place", "sure"]).to_pylist():
            d = np.frombuffer(r["docs"], np.int64).reshape(-1, 2)
            k, w = np.frombuffer(r["keys"], U64), np.frombuffer(r["row"], np.uint16)
            size = max(len(k), len(w))
            # 0: needs a second occurrence, 1: known to have one, 2: only tells of one
            flags.append(np.full(size, 1 if r["sure"] else 0 if len(w) else 2, np.int8))
            keys.append(k if len(k) else np.zeros(size, U64))
            row.append(w + np.uint32(base) if len(w) else np.zeros(size, np.uint32))
            wide = np.zeros((size, 8), np.uint8)
            if len(w):
                wide[:, :6] = np.frombuffer(r["place"], np.uint8).reshape(-1, 6)
            place.append(wide.view("<i8").ravel())
            docs.append(d)
            base += len(d)
    if not keys:
        return
    docs, keys, row, place, flags = (np.concatenate(a) for a in (docs, keys, row, place, flags))
    good = flags == 1
    open_ = np.flatnonzero(~good)
    order = open_[np.argsort(keys[open_], kind="stable")]
    begin = np.flatnonzero(np.append(True, keys[order[1:]] != keys[order[:-1]])) if len(order) else np.zeros(0, int)
    size = np.diff(np.append(begin, len(order)))
    told = np.add.reduceat(flags[order] == 2, begin) > 0 if len(begin) else np.zeros(0, bool)
    again = order[np.repeat((size > 1) | told, size)]
    good[again[flags[again] == 0]] = True
    row, place = row[good], place[good]
    order = np.argsort(row, kind="stable")
    for k in range(0, len(order), 50_000):
        o = order[k : k + 50_000]
        who = docs[row[o]]
        yield pa.RecordBatch.from_arrays([pa.array(who[:, 0].copy()), pa.array(who[:, 1].copy()), pa.array(place[o])], names=["__id", "__hash", "place"])


# --- step 3: runs of bytes, and their suffix arrays ----------------------------------------

RUNS = "shard long, docs binary, start binary, n binary, bytes binary, settled boolean"
DUPLICATES = "__id long, __hash long, start int, stop int"


def _run_rows(n_shards: int, length: int):
    """The bytes of the windows that anchors serve, of which equal ones of a task are sent once."""
    schema = pa.schema([("shard", pa.int64()), *[(c, pa.binary()) for c in ("docs", "start", "n", "bytes")], ("settled", pa.bool_())])

    def flush(names, row, start, n, anchor, runs):
        names = np.concatenate(names)
        row, start, n, anchor = (np.concatenate(a) for a in (row, start, n, anchor))
        # The first place of each run, in the order of documents.
        order = np.lexsort((start, names[row, 1], names[row, 0]))
        seen: dict[bytes, int] = {}
        kept, settled = [], []
        for i in order.tolist():
            j = seen.setdefault(runs[i], i)
            if i == j:
                kept.append(i)
            elif (names[row[i]] != names[row[j]]).any() or start[i] != start[j]:
                settled.append(i)
        out = []
        for part, done in ((np.array(kept, np.int64), False), (np.array(settled, np.int64), True)):
            if not len(part):
                continue
            shard = (mix(anchor[part]) >> U64(20)) % U64(n_shards) if not done else mix(row[part].astype(U64)) % U64(n_shards)
            o = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.append(True, np.diff(shard[o]) != 0))
            for a, b in zip(cuts, np.append(cuts[1:], len(o)), strict=True):
                p = part[o[a:b]]
                text = b"" if done else b"".join([runs[i] for i in p.tolist()])
                out.append((int(shard[o[a]]), names[row[p]].tobytes(), start[p].astype(np.uint32).tobytes(), n[p].astype(np.uint8).tobytes(), text, done))
        for k in range(0, len(out), 32):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out[k : k + 32], strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gathered(batches, GATHER_BYTES // 2):
            names, row, start, n, anchor, runs, base = [], [], [], [], [], [], 0
            for batch, data, offsets in held:
                names.append(_names(batch))
                for i, place in enumerate(lists(batch.column("place"))):
                    text = data[offsets[i] : offsets[i + 1]]
                    # Rows repeated in the table bring their anchors repeatedly.
                    place = np.unique(place)
                    f, c = place >> 16, place & 255
                    at = f + (place >> 8 & 255)
                    raw = text.tobytes()
                    runs += [raw[a : a + b + length - 1] for a, b in zip(f.tolist(), c.tolist(), strict=True)]
                    values = byte_values()[text[ranges(at, np.full(len(at), GRAM))]].reshape(-1, GRAM)
                    h = np.zeros(len(at), U64)
                    for j in range(GRAM):
                        h = h * BASE + values[:, j]
                    anchor.append(h), start.append(f), n.append(c), row.append(np.full(len(f), base + i))
                base += batch.num_rows
            if runs:
                yield from flush(names, row, start, n, anchor, runs)

    return run


def lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The rows of a list column of numbers as arrays; null rows are empty."""
    flat, at = column.flatten().to_numpy(zero_copy_only=False), 0
    for n in column.value_lengths().fill_null(0).to_pylist():
        yield flat[at : at + n]
        at += n


def _window_hashes(text: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of runs that lie one after the other, run by run."""
    sizes = n + length - 1
    begin = np.cumsum(sizes) - sizes
    out, i = [], 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(begin, begin[i] + (1 << 20))))
        h = mix(rolling(byte_values()[text[begin[i] : begin[j - 1] + sizes[j - 1]]], length))
        out.append(h[ranges(begin[i:j] - begin[i], n[i:j])])
        i = j
    return np.concatenate(out)


def _duplicates(length: int):
    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, start, n, bytes_, settled = [], [], [], [], []
        for batch in group:
            for r in batch.select(["docs", "start", "n", "bytes", "settled"]).to_pylist():
                docs.append(np.frombuffer(r["docs"], np.int64).reshape(-1, 2))
                start.append(np.frombuffer(r["start"], np.uint32).astype(np.int64))
                n.append(np.frombuffer(r["n"], np.uint8).astype(np.int64))
                bytes_.append(r["bytes"])
                settled.append(np.full(len(docs[-1]), r["settled"]))
        if not docs:
            return
        docs, start, n, settled = (np.concatenate(a) for a in (docs, start, n, settled))
        found = [(docs[settled], start[settled], start[settled] + n[settled])]
        docs, start, n = docs[~settled], start[~settled], n[~settled]
        if len(docs):
            keys = _window_hashes(np.frombuffer(b"".join(bytes_), np.uint8), n, length)
            del bytes_
            begin = np.cumsum(n) - n
            order = np.lexsort((start, docs[:, 1], docs[:, 0]))
            # Two tasks may have sent the same run of a row that is in the table twice.
            d, s = docs[order], start[order]
            order = order[np.append(True, (d[1:] != d[:-1]).any(1) | (s[1:] != s[:-1]))]
            family, i = Family(), 0
            total = np.cumsum(n[order])
            while i < len(order):
                j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + BATCH, "right")))
                part = order[i:j]
                place = ranges(begin[part], n[part])
                hit = np.flatnonzero(family.add(keys[place]))
                run_of = np.repeat(part, n[part])[hit]
                at = start[run_of] + place[hit] - begin[run_of]
                # Neighbouring windows of a run make one interval.
                new = np.append(True, (run_of[1:] != run_of[:-1]) | (at[1:] != at[:-1] + 1)) if len(hit) else np.zeros(0, bool)
                last = np.append(np.flatnonzero(new)[1:] - 1, len(hit) - 1) if len(hit) else np.zeros(0, int)
                found.append((docs[run_of[new]], at[new], at[last] + 1))
                i = j
        who, start, stop = (np.concatenate([f[k] for f in found]) for k in range(3))
        order = np.lexsort((start, who[:, 1], who[:, 0]))
        for k in range(0, len(order), 50_000):
            o = order[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(who[o, 0]), pa.array(who[o, 1]), pa.array(start[o].astype(np.int32)), pa.array(stop[o].astype(np.int32))], names=["__id", "__hash", "start", "stop"])

    return run


# --- step 4 and the operator ---------------------------------------------------------------


def _removal(length: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            columns: list[list] = [[], [], [], []]
            for i, (starts, stops) in enumerate(zip(lists(batch.column("start")), lists(batch.column("stop")), strict=True)):
                text = data[offsets[i] : offsets[i + 1]]
                a, b = merged_runs(starts.astype(np.int64), stops.astype(np.int64) + length - 1)
                gone = int((b - a).sum())
                raw = text.tobytes()
                edges = [0, *np.stack([a, b], 1).ravel().tolist(), len(raw)]
                left = raw if not gone else b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                columns[0].append(len(raw)), columns[1].append(gone)
                if digest:
                    columns[2].append(len(a)), columns[3].append(hashlib.sha256(left).hexdigest())
                else:
                    columns[2].append([{"start": x, "stop": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
                    columns[3].append(left.decode("utf-8", "ignore"))
            kinds = [pa.int64(), pa.int64(), pa.int64() if digest else pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__extra"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=["__extra", "n_bytes", "n_removed", "n_spans" if digest else "spans", "kept_sha256" if digest else "kept_text"],
            )

    return run


def removed_spans(docs: DataFrame, length: int = LENGTH, digest: bool = False) -> DataFrame:
    """Every row of ``docs`` (doc_id, text and others) with what is removed from its text.

    Columns: ``__extra`` (the row), n_bytes, n_removed, spans (byte offsets) and kept_text
    (characters cut in two by a removal are left out); with ``digest`` n_spans and
    kept_sha256 (of the remaining bytes) in the place of the last two.
    """
    _, size = total_bytes(docs)
    wide = shards(size, TEXT_SHARD)
    named = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("__id"),
        F.xxhash64(F.col("text")).alias("__hash"),
        F.col("text"),
        F.struct(*([F.col("doc_id")] if digest else [F.col(f"`{c}`") for c in docs.columns if c != "text"])).alias("__extra"),
    )
    # One shuffle of the texts serves both joins.
    texts = named.repartition(wide, "__id", "__hash")
    sent = named.select("__id", "__hash", "text").mapInArrow(lean(_anchor_rows(shards(size, ANCHOR_SHARD), length)), ANCHORS)
    again = sent.groupBy("shard").applyInArrow(lean(_repeated), FOUND)
    by_doc = again.repartition(wide, "__id", "__hash").groupBy("__id", "__hash").agg(F.collect_list("place").alias("place"))
    # __extra isn't needed here, but keeps the shuffle of the texts the same in both joins.
    runs = texts.join(by_doc, ["__id", "__hash"]).select("__id", "__hash", "__extra", "text", "place").mapInArrow(lean(_run_rows(shards(size, RUN_SHARD), length)), RUNS)
    found = runs.groupBy("shard").applyInArrow(lean(_duplicates(length)), DUPLICATES)
    gone = found.repartition(wide, "__id", "__hash").groupBy("__id", "__hash").agg(*[F.collect_list(c).alias(c) for c in ("start", "stop")])
    extra = named.schema["__extra"].dataType.simpleString()
    out = f"__extra {extra}, n_bytes long, n_removed long, " + ("n_spans long, kept_sha256 string" if digest else "spans array<struct<start:long,stop:long>>, kept_text string")
    return texts.join(gone, ["__id", "__hash"], "left").select("__extra", "text", "start", "stop").mapInArrow(lean(_removal(length, digest)), out)


def dedup_digest(docs: DataFrame) -> DataFrame:
    """Per document: bytes, bytes and spans removed, and the digest of the bytes that stay."""
    return removed_spans(renamed(docs, doc_id="doc_id", text="text"), digest=True).select("__extra.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated passages taken out of ``text``; a null text stays null."""
    done = removed_spans(docs.withColumn("__null", F.col("text").isNull()), length)
    return done.select(*[F.when(~F.col("__extra.__null"), F.col("kept_text")).alias("text") if c == "text" else F.col(f"__extra.`{c}`").alias(c) for c in docs.columns])
