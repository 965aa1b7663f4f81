"""Dedup, joins and the pipeline against brute force."""

import hashlib
import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from demandspark.llm import ngram_join, suffix_dedup
from demandspark.llm.graph import components
from demandspark.llm.queries import op2_suffix_dedup, op4_ngram_join

SF = "/root/testdata/sf0.001"


def _rows(sf=SF):
    return duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()


# --- op 2 ----------------------------------------------------------------------------------


def brute_repeats(rows, length=100):
    """Rows (id, text) in their order; the covered bytes of each."""
    seen, out = set(), []
    for _, text in rows:
        b = (text or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                cover[p : p + length] = b"\1" * length
            else:
                seen.add(b[p : p + length])
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        spans = sum(1 for p, c in enumerate(cover) if c and (p == 0 or not cover[p - 1]))
        out.append((len(b), sum(cover), spans, kept))
    return out


def test_op2(spark):
    rows = sorted(_rows("/root/testdata/sf0.01"))
    want = {i: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for (i, _), w in zip(rows, brute_repeats(rows), strict=True)}
    assert sum(w[1] > 0 for w in want.values()) > 50
    assert {r.doc_id: tuple(r)[1:] for r in op2_suffix_dedup(spark, "/root/testdata/sf0.01").collect()} == want


def test_family_finds_what_came_before():
    rng, family, seen = np.random.default_rng(4), suffix_dedup.Family(), set()
    for _ in range(40):
        keys = rng.integers(0, 900, 70).astype(np.uint64)
        got = family.add(keys)
        for k, g in zip(keys.tolist(), got.tolist(), strict=True):
            assert g == (k in seen)
            seen.add(k)
    sizes = [len(x) for x in family.levels]
    assert all(2 * b <= a for a, b in zip(sizes, sizes[1:], strict=False)) and sum(sizes) == len(seen)


def test_anchors_depend_on_the_window_only():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 100, 700).astype(np.uint8)
    text[300:480] = text[20:200]
    _, at, first, n = suffix_dedup.anchors(text)
    assert n.sum() == len(text) - 99 and first[0] == 0
    place = np.repeat(at, n) - np.arange(n.sum())
    assert ((place >= 0) & (place <= 68)).all()
    assert (place[20:101] == place[300:381]).all()


@pytest.mark.parametrize("sends", [1 << 30, 300])
def test_repeats_within_runs_and_batches(spark, monkeypatch, sends):
    """Periods, overlaps, repeats across tasks; sent at once or in small parts."""
    monkeypatch.setattr(suffix_dedup, "GATHER_BYTES", sends)
    monkeypatch.setattr(suffix_dedup, "BATCH", 50)
    p = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(400))
    texts = ["ab" * 150, p, "x" + p[50:260] + "y" + p[100:300], p[:99], p[:100], "ab" * 60 + p[:120], "é" * 80, "é" * 120, None, ""]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = {i: w for (i, _), w in zip(rows, brute_repeats(rows), strict=True)}
    got = {r["__extra"]["doc_id"]: r for r in suffix_dedup.removed_spans(docs).collect()}
    for i, (n, gone, spans, kept) in want.items():
        r = got[i]
        assert (r.n_bytes, r.n_removed, len(r.spans)) == (n, gone, spans)
        assert r.kept_text == kept.decode("utf-8", "ignore")


def test_dedup_edges(odd, none):
    rows = suffix_dedup.dedup_digest(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0] == by[1][1] and by[5][0].n_removed == by[5][0].n_bytes and by[2][0].n_bytes == 0
    assert by[None][0].n_removed == 160  # 180 bytes of period 20: every window from start 20 on
    assert suffix_dedup.dedup_digest(none).count() == 0
    kept = suffix_dedup.without_repeats(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 2 and text is null").count() == 1


# --- op 4 ----------------------------------------------------------------------------------


def brute_components(rows, percent=90, words=3):
    lower = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))
    sets = {}
    for i, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(lower))
        sets[i] = frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) or frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    order = sorted((i for i in sets if sets[i]), key=lambda i: len(sets[i]))
    for x, i in enumerate(order):
        for j in order[x + 1 :]:
            if 100 * len(sets[i]) < percent * len(sets[j]):
                break
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_op4(spark):
    want = brute_components(_rows("/root/testdata/sf0.01"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op4_ngram_join(spark, "/root/testdata/sf0.01").collect()} == want


def _near_copies(rng, n, words):
    base = [f"w{k}" for k in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for k in rng.integers(0, words, rng.integers(0, 1 + max(1, words // 40))):
            w[k] = f"e{rng.integers(1 << 30)}"
        if rng.random() < 0.3:
            w = w[: len(w) - rng.integers(0, 1 + words // 12)]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [4096, 7])
def test_links_of_groups_of_all_sizes(spark, monkeypatch, block):
    """Sizes around every class border, thresholds hit exactly, clusters in one task or cut into blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    rng = np.random.default_rng(8)
    texts = [t for words in (3, 11, 12, 13, 21, 22, 40, 120, 300) for t in _near_copies(rng, 30, words)]
    docs = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts, strict=True)]
    got = ngram_join.link_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(docs)


@pytest.mark.parametrize("percent", [70, 80, 90])
def test_linked_sets_meet_and_look_alike(percent):
    """Beginnings of linked sets share a shingle, whatever is common; their sketches and sizes pass."""
    rng, met = np.random.default_rng(6), 0
    for _ in range(1500):
        n = int(rng.integers(2, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        drop = int(rng.integers(0, n * (100 - percent) // percent + 1))
        b = np.delete(a, rng.permutation(len(a))[: drop // 2])
        b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, drop - drop // 2).astype(np.uint64)]))
        common = np.sort(rng.choice(a, rng.integers(0, n + 1), replace=False))
        both = len(np.intersect1d(a, b))
        if len(b) and a.tobytes() != b.tobytes() and 100 * both >= percent * (len(a) + len(b) - both):
            met += 1
            assert np.intersect1d(ngram_join.beginning(a, common, percent), ngram_join.beginning(b, common, percent)).size
            x, y = ngram_join.sketches([a, b])
            assert np.bitwise_count(x ^ y).sum() <= ngram_join.most_bits(percent)
            assert abs(ngram_join.size_code(len(a)) - ngram_join.size_code(len(b))) <= np.ceil(32 * np.log2(100 / percent)) + 1
    assert met > 500


def test_groups_are_connected_as_all_pairs_would():
    rng = np.random.default_rng(2)
    for n in (30, 200):
        centre = rng.integers(0, 1 << 63, (4, 2)).astype(np.uint64)
        sketch = centre[rng.integers(0, 4, n)].copy()
        for i in range(n):
            for bit in rng.integers(0, 128, rng.integers(0, 12)):
                sketch[i, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
        size = rng.integers(0, 30, n)
        for bits, spread in ((8, 12), (14, 100), (40, 3)):
            up = list(range(n))

            def root(x, up=up):
                while up[x] != x:
                    x = up[x]
                return x

            for i in range(n):
                for j in range(i):
                    if abs(size[i] - size[j]) <= spread and np.bitwise_count(sketch[i] ^ sketch[j]).sum() <= bits:
                        up[max(root(i), root(j))] = min(root(i), root(j))
            links = ngram_join.Links(n)
            for i, j in ngram_join.alike(sketch, size, bits, spread):
                links.join(i, j)
            assert [links.root(i) for i in range(n)] == [root(i) for i in range(n)]


@pytest.mark.parametrize("least", [2, 10**9])
def test_common_shingles_change_no_link(spark, monkeypatch, least):
    """With nearly all shingles common, or none."""
    monkeypatch.setattr(ngram_join, "COMMON_LEAST", least)
    monkeypatch.setattr(ngram_join, "COMMON_SHARE", 0.0)
    rng = np.random.default_rng(4)
    texts = [t for words in (5, 20, 60) for t in _near_copies(rng, 40, words)]
    docs = list(enumerate(texts))
    got = ngram_join.link_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(docs)


def test_prefix_tree_finds_exactly_the_links():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 30, rng.integers(1, 24)).astype(np.uint64)) for _ in range(120)]
    sets = list({s.tobytes(): s for s in sets}.values())
    for percent in (50, 80):
        edges = ngram_join.join_sets(sets, None, percent)
        up = list(range(len(sets)))

        def root(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    up[max(root(i), root(j))] = min(root(i), root(j))
        links = ngram_join.Links(len(sets))
        for i, j in edges:
            links.join(i, j)
        assert [links.root(i) for i in range(len(sets))] == [root(i) for i in range(len(sets))]
        half = len(sets) // 2
        across = ngram_join.join_sets(sets[:half], sets[half:], percent)
        assert all(i < half <= j or j < half <= i for i, j in across)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 40)}}


def test_join_edges(odd, none):
    rows = ngram_join.link_documents(odd).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == odd.count() and by[2].n_shingles == 0 and by[2].component_id == 2
    assert by[12].component_id == 6 and by[6].n_shingles == 1 and by[5].component_id == 1 and by[8].component_id == 7
    assert by[None].component_id is None and by[None].n_shingles > 0
    assert ngram_join.link_documents(none).count() == 0
    kept = ngram_join.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 2, 3, 4, 6, 7, 9, 10, 11, 13]


# --- pipeline ------------------------------------------------------------------------------


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns
        after = {r.doc_id: r.text for r in out.collect()}
        assert set(after) <= set(before)
        if name == "ngram_join":
            linked = brute_components(before.items(), 80, 5)
            assert set(after) == {i for i, (_, root) in linked.items() if root == i}
        if name == "suffix_dedup":
            rows = sorted(before.items())
            assert after == {i: w[3].decode("utf-8", "ignore") for (i, _), w in zip(rows, brute_repeats(rows), strict=True)}
        if name in ("toxicity", "decontaminate"):
            assert all(after[i] == before[i] for i in after)
        before, docs = after, out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    rows = last.collect()
    assert last.columns == ["doc_id", "n_tokens", "ids"] and {r.doc_id for r in rows} == set(before)
    assert {r.doc_id: len(r.ids) for r in corpus_pipeline.run(spark, SF).collect()} == {r.doc_id: r.n_tokens for r in rows}


def test_pipeline_edges(spark, none):
    docs = none.select("doc_id", "text", "lang", "source")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
