"""N-gram Jaccard join: links between documents with almost the same word shingles.

1. *Sets.*  A document's set holds the 64-bit hashes of its distinct shingles.  Equal sets
   become one node.  Shingles of many documents are counted beforehand: they are common.
2. *Candidates.*  In the global order, which puts common shingles last and else follows the
   hashes, two linked sets share a shingle of their beginnings: of n shingles, the first
   n - ceil(n * percent / 100) + 1.  Nodes meet by these.  A pair that meets becomes a candidate
   if its sizes allow a link and if its sketches (a bit each of 128 minima of hashes) agree in so
   many bits that a linked pair fails once in 10^11 cases.  Within a group only pairs that are not
   connected by others are compared.
3. *Join.*  Nodes that candidates connect form a cluster, and only these take part.
   The sets of a cluster are stored in a prefix tree.  Every set walks down the tree:
   sets with a common beginning share the overlap counted so far, and a subtree is left
   as soon as the lengths that remain can't make up the overlap required, or as all of
   it is connected with the set already.  Clusters too large for a task are cut into
   blocks that are joined with one another.
4. *Components* of the links, and the smallest doc_id of each.

Defined results: without words, or with a null text, a set is empty and linked with
nothing.  Rows with a null doc_id count as the largest id, and a component of such rows
only has a null id.  Rows that repeat a doc_id are judged one by one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.stage import stage
from demandspark.llm.common import BASE, U64, class_table, lean, lower_table, mix, pieces, renamed, shards, total_bytes, word_bounds, word_hashes
from demandspark.llm.graph import components

WORDS = 3
#: Two sets are linked if 100 * intersection >= PERCENT * union.
PERCENT = 90
#: Text bytes whose sets a task handles at once, and bytes of beginnings that meet in a task.
GATHER_BYTES = 8 << 20
SHARD_BYTES = 24 << 20
#: A shingle is common if it is in this share of the documents, and in this many.
COMMON_SHARE, COMMON_LEAST = 0.001, 50
#: Sketch bits, the odds of losing a linked pair, and group sizes up to which all pairs are compared at once.
SKETCH, LOSS, SMALL_GROUP = 128, 1e-11, 24
#: Sets of one cluster that a task joins with each other or with as many others.
BLOCK_SETS = 4096
#: Rows that may be broadcast: ids and clusters of candidates, some 40 bytes each.
BROADCAST_ROWS = 500_000
#: Tokens of a tree node; a longer path is a chain of nodes, so that it can be left early.
SEGMENT = 32
LAST_ID = (1 << 63) - 1


# --- step 1: sets --------------------------------------------------------------------------


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """The sorted hashes of the distinct shingles of each row."""
    data = lower_table()[data]
    starts, ends, first = word_bounds(class_table("space")[data], offsets)
    h = word_hashes(data, starts, ends)
    n = len(h)
    rolled = np.zeros(max(0, n - words + 1), U64)
    for j in range(words):
        rolled = rolled * BASE + h[j : j + len(rolled)]
    rolled = mix(rolled)
    out = []
    for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if j - i >= words:
            out.append(np.unique(rolled[i : j - words + 1]))
        elif j > i:
            short = np.array([j - i], U64)
            for k in range(i, j):
                short = short * BASE + h[k]
            out.append(mix(short + U64(1)))
        else:
            out.append(np.zeros(0, U64))
    return out


def set_name(tokens: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


# --- step 2: candidates --------------------------------------------------------------------


def count_locally(words: int):
    """Task: shingles that several documents of a gather have, with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, size = [], 0

        def counted():
            tokens, n = np.unique(np.concatenate(sets), return_counts=True)
            tokens, n = tokens[n > 1], n[n > 1]
            return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n)], names=["token", "n"])

        for _, data, offsets in pieces(batches):
            sets += shingle_sets(data, offsets, words)
            size += len(data)
            if size >= GATHER_BYTES:
                yield counted()
                sets, size = [], 0
        if sets:
            yield counted()

    return run


def common_shingles(docs: DataFrame, n_docs: int, words: int) -> np.ndarray:
    """The shingles of at least COMMON_SHARE of the documents, sorted.

    At most the shingles of 1 / COMMON_SHARE documents can be that common.  They only decide
    the order: with any others all links are found as well, by larger groups.
    """
    least = max(COMMON_LEAST, COMMON_SHARE * n_docs)
    found = docs.mapInArrow(lean(count_locally(words)), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return np.sort(found.select("token").toArrow()["token"].to_numpy().view(U64))


def beginning(tokens: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of the set by which it meets others; common ones are the last in order."""
    n = len(tokens) - -(-percent * len(tokens) // 100) + 1
    if not len(common):
        return tokens[:n]
    at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
    last = common[at] == tokens
    rare = tokens[~last]
    return rare[:n] if len(rare) >= n else np.concatenate([rare, tokens[last][: n - len(rare)]])


def sketch_factors() -> np.ndarray:
    """An odd multiplier for each bit of a sketch."""
    return mix((np.arange(SKETCH, dtype=U64) + U64(7)) * BASE) | U64(1)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Two words of bits for each set (none of them empty): a bit of the smallest product with each factor."""
    out = np.zeros((len(sets), SKETCH), np.uint8)
    factors, lo = sketch_factors(), 0
    while lo < len(sets):
        hi, size = lo, 0
        while hi < len(sets) and (hi == lo or size + len(sets[hi]) <= 1 << 15):  # what a cache holds
            size += len(sets[hi])
            hi += 1
        tokens = np.concatenate(sets[lo:hi])
        starts = np.cumsum([0, *[len(s) for s in sets[lo : hi - 1]]])
        product = np.empty_like(tokens)
        for j, factor in enumerate(factors):
            np.multiply(tokens, factor, out=product)
            out[lo:hi, j] = mix(np.minimum.reduceat(product, starts)) & U64(1)
        lo = hi
    return np.packbits(out, axis=1).view(U64)


def most_bits(percent: int) -> int:
    """Bits in which the sketches of linked sets may differ, but for LOSS."""
    p, tail = (100 - percent) / 200, 0.0
    for k in range(SKETCH, -1, -1):
        tail += math.comb(SKETCH, k) * p**k * (1 - p) ** (SKETCH - k)
        if tail > LOSS:
            return k
    return 0


def size_code(n: int) -> int:
    return int(32 * math.log2(n))


#: A shingle of the beginning, its node, the code of the set's size and its sketch.
ENTRY = np.dtype([("token", "u4"), ("node", "u8"), ("size", "u2"), ("sketch", "u8", 2)])
ROW = np.dtype([("id", "i8"), ("n", "i8"), ("k", "V16")])
SENT = "shard long, entries binary, rows binary"
#: Rows of documents (``a``: the half of the node's name that candidates use) and pairs of candidates.
MET = "doc_id long, n long, node binary, a long, b long"


def _send(n_shards: int, percent: int, words: int, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = common.value

        def flush(ids, sizes, names, sets):
            # Equal sets of this gather are sent once.
            record = np.zeros(len(ids), ROW)
            record["id"], record["n"], record["k"] = ids, sizes, np.frombuffer(b"".join(names), np.dtype("V16"))
            out = [(int(mix(np.array([len(ids) + int(ids[0])], U64))[0] % U64(n_shards)), b"", record.tobytes())]
            if sets:
                begins = [beginning(s, frequent, percent) for s in sets.values()]
                counts = [len(x) for x in begins]
                tokens = np.concatenate(begins)
                entry = np.zeros(len(tokens), ENTRY)
                mixed = mix(tokens)
                entry["token"] = mixed >> U64(32)
                entry["node"] = np.repeat(np.frombuffer(b"".join([k[:8] for k in sets]), U64), counts)
                entry["size"] = np.repeat([size_code(len(s)) for s in sets.values()], counts)
                entry["sketch"] = np.repeat(sketches(list(sets.values())), counts, axis=0)
                shard = (mixed & U64(0xFFFFFFFF)) % U64(n_shards)
                order = np.argsort(shard, kind="stable")
                shard, entry = shard[order], entry[order]
                cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
                out += [(int(shard[i]), entry[i:j].tobytes(), b"") for i, j in zip(cuts, np.append(cuts[1:], len(order)), strict=True)]
            for k in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out[k : k + 64], strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["shard", "entries", "rows"])

        ids, sizes, names, sets, size = [], [], [], {}, 0
        for batch, data, offsets in pieces(batches):
            for i, tokens in zip(batch.column("__id").to_pylist(), shingle_sets(data, offsets, words), strict=True):
                name = set_name(tokens)
                ids.append(i), sizes.append(len(tokens)), names.append(name)
                if len(tokens):
                    sets.setdefault(name, tokens)
            size += len(data)
            if size >= GATHER_BYTES or len(ids) >= 1 << 18:
                yield from flush(ids, sizes, names, sets)
                ids, sizes, names, sets, size = [], [], [], {}, 0
        if ids:
            yield from flush(ids, sizes, names, sets)

    return run


def alike(sketch: np.ndarray, size: np.ndarray, bits: int, spread: int) -> list[tuple[int, int]]:
    """Edges that connect what candidates connect in one group.

    The first set is compared with all others, then the sets outside the largest part found so
    far with all that they are not connected with: few, if the group consists of copies.
    """
    n = len(sketch)
    label, edges, done = np.arange(n), [], np.zeros(n, bool)
    while True:
        names, where, counts = np.unique(label, return_inverse=True, return_counts=True)
        open_ = np.flatnonzero((where != np.argmax(counts)) & ~done) if done.any() else np.zeros(1, np.int64)
        if len(names) == 1 or not len(open_):
            return edges
        for i in open_[:64].tolist():
            done[i] = True
            other = np.flatnonzero((label != label[i]) & (np.abs(size - size[i]) <= spread))
            near = other[np.bitwise_count(sketch[other] ^ sketch[i]).sum(1) <= bits]
            _, first = np.unique(label[near], return_index=True)
            for j in near[first].tolist():
                edges.append((i, j))
                label[label == label[j]] = label[i]


def candidates(entry: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of nodes, as two columns, that connect the candidates of each shingle."""
    bits, spread = most_bits(percent), math.ceil(32 * math.log2(100 / percent)) + 1
    entry = entry[np.argsort(entry["token"], kind="stable")]
    token, node, size, sketch = entry["token"], entry["node"].copy(), entry["size"].astype(np.int32), entry["sketch"].copy()
    start = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
    count = np.diff(np.append(start, len(token)))
    pairs = []
    group = np.repeat(np.arange(len(start)), count)
    small = np.flatnonzero(((count > 1) & (count <= SMALL_GROUP))[group]) if len(token) else start
    for d in range(1, SMALL_GROUP):
        a = small[small + d < len(token)]
        a = a[group[a] == group[a + d]]
        if not len(a):
            break
        b = a + d
        keep = (node[a] != node[b]) & (np.abs(size[a] - size[b]) <= spread)
        a, b = a[keep], b[keep]
        keep = np.bitwise_count(sketch[a] ^ sketch[b]).sum(1) <= bits
        pairs.append(np.stack([node[a[keep]], node[b[keep]]], 1))
    for s, c in zip(start[count > SMALL_GROUP].tolist(), count[count > SMALL_GROUP].tolist(), strict=True):
        _, at = np.unique(node[s : s + c], return_index=True)
        at += s
        edges = alike(sketch[at], size[at], bits, spread)
        if edges:
            pairs.append(node[at[np.array(edges)]])
    if not pairs:
        return np.zeros((0, 2), U64)
    pairs = np.sort(np.concatenate(pairs), axis=1)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return pairs[np.append(True, (pairs[1:] != pairs[:-1]).any(1))] if len(pairs) else pairs


def _meet(percent: int):
    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows that came along, and the candidates' pairs."""
        entries = []
        for batch in group:
            for r in batch.select(["entries", "rows"]).to_pylist():
                entries.append(np.frombuffer(r["entries"], ENTRY))
                record = np.frombuffer(r["rows"], ROW)
                for k in range(0, len(record), 20_000):
                    part = record[k : k + 20_000]
                    half = np.frombuffer(part["k"].tobytes(), np.int64)[::2]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part["id"].copy()), pa.array(part["n"].copy()), pa.array([x.tobytes() for x in part["k"]], pa.binary()), pa.array(half.copy()), pa.nulls(len(part), pa.int64())],
                        names=["doc_id", "n", "node", "a", "b"],
                    )
        pairs = candidates(np.concatenate(entries), percent).view(np.int64)
        for k in range(0, len(pairs), 20_000):
            p = pairs[k : k + 20_000]
            none = pa.nulls(len(p), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.nulls(len(p), pa.binary()), pa.array(p[:, 0]), pa.array(p[:, 1])], names=["doc_id", "n", "node", "a", "b"])

    return run


# --- step 3: prefix tree -------------------------------------------------------------------


class Links:
    """Union-find over the sets of a task."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.edges.append((i, j))


class PrefixTree:
    """Sets in the global order, as paths that share their beginnings.

    Nodes lie in arrays: the tokens of the node's segment, its children, the leaves below
    it (a range, as the sets are sorted), the smallest and largest set below it, and the
    tokens from the root to the node's end.
    """

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">i8").tobytes())
        ordered = [sets[i] for i in self.order]
        size = np.array([len(s) for s in ordered])
        common = [0] * (len(ordered) + 1)
        for i in range(1, len(ordered)):
            a, b = ordered[i - 1], ordered[i]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            common[i] = int(differ[0]) if len(differ) else n
        begin, length, low, high, depth, leaf, children = [], [], [], [], [], [], []
        pool, at = [], 0
        # (parent, depth of the parent's end, range of leaves)
        todo = [(-1, 0, 0, len(ordered))]
        while todo:
            parent, d, lo, hi = todo.pop()
            stop = len(ordered[lo]) if hi - lo == 1 else min(common[lo + 1 : hi])
            ends_here = hi - lo > 1 and len(ordered[lo]) == stop
            up = parent
            for x in range(d, max(stop, d + 1), SEGMENT) if stop > d or parent < 0 else ():
                seg = ordered[lo][x : min(x + SEGMENT, stop)]
                node = len(begin)
                begin.append(at), length.append(len(seg)), low.append(lo), high.append(hi), depth.append(x + len(seg)), leaf.append(-1), children.append([])
                pool.append(seg)
                at += len(seg)
                if up >= 0:
                    children[up].append(node)
                up = node
            if hi - lo == 1:
                if leaf[up] >= 0 or children[up] or high[up] - low[up] > 1:
                    # a set that ends where its parent ends
                    node = len(begin)
                    begin.append(at), length.append(0), low.append(lo), high.append(hi), depth.append(d), leaf.append(lo), children.append([])
                    children[up].append(node)
                else:
                    leaf[up] = lo
                continue
            i = lo
            if ends_here:
                todo.append((up, stop, lo, lo + 1))
                i = lo + 1
            while i < hi:
                j = i + 1
                while j < hi and common[j] > stop:
                    j += 1
                todo.append((up, stop, i, j))
                i = j
        self.tokens = np.concatenate(pool) if pool else np.zeros(0, np.int64)
        self.begin, self.length, self.low, self.high, self.depth, self.leaf = (np.array(x, np.int64) for x in (begin, length, low, high, depth, leaf))
        self.child_count = np.array([len(c) for c in children])
        self.child_begin = np.cumsum(self.child_count) - self.child_count
        self.children = np.array([x for c in children for x in c], np.int64)
        self.smallest = np.array([size[a:b].min() for a, b in zip(low, high, strict=True)])
        self.largest = np.array([size[a:b].max() for a, b in zip(low, high, strict=True)])
        self.size = size
        self.last = np.array([self.tokens[b + n - 1] if n else -1 for b, n in zip(begin, length, strict=True)])

    def search(self, probe: np.ndarray, member: np.ndarray, percent: int, same: np.ndarray | None) -> np.ndarray:
        """Leaves linked with ``probe``; ``same``: nodes all of whose leaves are connected with it already."""
        need = lambda other: -(-percent * (len(probe) + other) // (100 + percent))
        nodes, overlap, hits = np.zeros(1, np.int64), np.zeros(1, np.int64), []
        while len(nodes):
            if same is not None:
                keep = ~same[nodes]
                nodes, overlap = nodes[keep], overlap[keep]
            if not len(nodes):
                break
            n, b = self.length[nodes], self.begin[nodes]
            first = np.cumsum(n) - n
            flags = member[self.tokens[np.arange(int(n.sum())) + np.repeat(b - first, n)]]
            total = np.concatenate([[0], np.cumsum(flags)])
            overlap = overlap + total[first + n] - total[first]
            # What is left of the probe after this node's last token, and of the longest set below.
            left = np.where(n > 0, len(probe) - np.searchsorted(probe, self.last[nodes], "right"), len(probe))
            left = np.minimum(left, self.largest[nodes] - self.depth[nodes])
            keep = overlap + left >= need(self.smallest[nodes])
            nodes, overlap = nodes[keep], overlap[keep]
            leaf = self.leaf[nodes]
            done = leaf >= 0
            good = overlap[done] >= need(self.size[leaf[done]])
            hits.append(leaf[done][good])
            counts = self.child_count[nodes]
            first = np.cumsum(counts) - counts
            below = self.children[np.arange(int(counts.sum())) + np.repeat(self.child_begin[nodes] - first, counts)]
            overlap = np.repeat(overlap, counts)
            nodes = below
        return np.concatenate(hits) if hits else np.zeros(0, np.int64)


def join_sets(stored: list[np.ndarray], probes: list[np.ndarray] | None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect what is linked; ids are places in ``stored``, then in ``probes``.

    Without ``probes`` the stored sets are joined with each other.
    """
    everything = [*stored, *(probes or [])]
    words, dense = np.unique(np.concatenate(everything), return_inverse=True)
    cuts = np.cumsum([len(s) for s in everything])
    everything = np.split(dense.astype(np.int64), cuts[:-1])
    tree = PrefixTree(everything[: len(stored)])
    order = np.array(tree.order)
    links, member = Links(len(everything)), np.zeros(len(words), bool)
    same_root, steps, stale = None, None, 0
    for p in range(len(stored) if probes is not None else 0, len(everything)):
        if stale <= 0:
            # Which subtrees are connected as a whole; looked at again now and then.
            roots = np.array([links.root(i) for i in order.tolist()])
            steps = np.concatenate([[0], np.cumsum(roots[1:] != roots[:-1])])
            uniform = steps[tree.high - 1] == steps[tree.low]
            same_root, stale = np.where(uniform, roots[tree.low], -1), 32
        stale -= 1
        probe = everything[p]
        member[probe] = True
        root = links.root(p)
        connected = same_root == root
        for leaf in tree.search(probe, member, percent, connected).tolist():
            j = tree.order[leaf]
            if j != p:
                links.join(j, p)
        member[probe] = False
    return links.edges


SETS = "cluster long, node binary, blocks int, block int, tokens binary"


def _candidate_sets(blocks_of: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            sets = shingle_sets(data, offsets, words)
            names = [set_name(t) for t in sets]
            blocks = -(-batch.column("members").to_numpy() // blocks_of)
            block = [int.from_bytes(k[:4], "little") % b for k, b in zip(names, blocks.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("cluster"), pa.array(names, pa.binary()), pa.array(blocks, pa.int32()), pa.array(block, pa.int32()), pa.array([t.tobytes() for t in sets], pa.binary())],
                names=["cluster", "node", "blocks", "block", "tokens"],
            )

    return run


def _join_group(percent: int):
    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, dict[bytes, np.ndarray]] = {}
        i = j = 0
        for batch in group:
            for r in batch.select(["node", "block", "tokens", "i", "j"]).to_pylist():
                i, j = r["i"], r["j"]
                parts.setdefault(r["block"], {})[r["node"]] = np.frombuffer(r["tokens"], U64)
        stored, probes = parts.get(i, {}), None if i == j else parts.get(j, {})
        if not stored or (probes is None and len(stored) < 2) or (probes is not None and not probes):
            return
        names = [*stored, *(probes or {})]
        edges = join_sets(list(stored.values()), None if probes is None else list(probes.values()), percent)
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array([names[e[k]] for e in edges], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return run


# --- the operator --------------------------------------------------------------------------


def link_documents(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``docs`` (doc_id, text); shingles have ``words`` words."""
    docs = renamed(docs, doc_id="doc_id", text="text").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("__id"), "text")
    n_docs, size = total_bytes(docs)
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, n_docs, words))
    # a word of six bytes makes a shingle
    sent = docs.mapInArrow(lean(_send(shards(size * ENTRY.itemsize * (100 - percent) // 600, SHARD_BYTES), percent, words, common)), SENT)
    met = stage(sent.groupBy("shard").applyInArrow(lean(_meet(percent)), MET), "ngram-met")
    rows = met.where("doc_id is not null").select("doc_id", "n", "node", F.col("a").alias("__near"))
    near = components(met.where("b is not null").select("a", "b"))
    members = near.unionByName(near.select("root").distinct().select(F.col("root").alias("node"), "root")).withColumnRenamed("node", "__near")
    sized = members.join(near.groupBy("root").agg((F.count("*") + 1).alias("members")), "root")
    # One document stands for each set of a cluster; candidates name a set by half of its name.
    standing = rows.where("n > 0").groupBy("node", "__near").agg(F.min("doc_id").alias("__id"))
    chosen = stage(standing.join(sized, "__near").select("__id", F.col("root").alias("cluster"), "members"), "ngram-chosen")
    few = chosen.count() <= BROADCAST_ROWS
    picked = docs.join(F.broadcast(chosen) if few else chosen, "__id").select("text", "cluster", "members")
    sets = picked.mapInArrow(lean(_candidate_sets(BLOCK_SETS, words)), SETS)
    pairs = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("block")), lambda i: F.struct(i.alias("i"), F.col("block").alias("j"))),
        F.filter(F.transform(F.sequence(F.col("block"), F.col("blocks") - 1), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"))), lambda p: p["j"] > F.col("block")),
    )
    tasks = sets.withColumn("task", F.explode(pairs)).select("cluster", "task.i", "task.j", "node", "block", "tokens")
    links = tasks.groupBy("cluster", "i", "j").applyInArrow(lean(_join_group(percent)), "a binary, b binary")
    linked = components(links)
    lowest = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("low"))
    named = lowest.join(linked, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "low")
    least = named.groupBy("root").agg(F.min("low").alias("component"))
    found = named.join(least, "root").select("node", "component")
    real = lambda c: F.when(c != LAST_ID, c)
    return rows.join(found, "node", "left").select(
        real(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), real(F.coalesce("component", "doc_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The documents that are the first of their component; rows that repeat a doc_id stay together."""
    first = link_documents(docs, percent, words).where("doc_id <=> component_id").select(F.col("doc_id").alias("__first")).distinct()
    return docs.join(first, F.col("doc_id").eqNullSafe(F.col("__first")), "left_semi")
