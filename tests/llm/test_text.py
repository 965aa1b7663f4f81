"""Tokens, benchmark, rules and classifiers against brute force, definitions and held-out rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from demandspark.llm import bpe, decontam, langid, quality_classifier, quality_rules, toxicity
from demandspark.llm.common import pieces, rolling, word_bounds
from demandspark.llm.queries import op1_bpe, op3_language_id, op5_quality_rules, op6_toxicity, op9_quality, op10_decontaminate

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"select doc_id, text, lang from '{SF}/documents.parquet'").fetchall()


def _pieces(texts, limit=1 << 21):
    return pieces([pa.record_batch({"text": pa.array(texts, pa.string())})], limit=limit)


# --- helpers -------------------------------------------------------------------------------


def test_rolling_and_word_bounds():
    v = np.arange(1, 50, dtype=np.uint64)
    for k in (1, 2, 3, 7, 32, 48, 49, 50):
        want = []
        for i in range(max(0, 50 - k)):
            h = 0
            for x in v[i : i + k]:
                h = (h * 0x9E3779B97F4A7C15 + int(x)) % (1 << 64)
            want.append(h)
        assert rolling(v, k).tolist() == want
    data = np.frombuffer(b"abc de", np.uint8)
    starts, ends, first = word_bounds(data != 32, np.array([0, 2, 2, 6]))
    assert starts.tolist() == [0, 2, 4] and ends.tolist() == [2, 3, 6] and first.tolist() == [0, 1, 1, 3]


def test_pieces_cover_everything():
    texts = ["a" * 10, None, "", "b" * 100, "ü"]
    got = [d[o[i] : o[i + 1]].tobytes().decode() for b, d, o in _pieces(texts, 12) for i in range(b.num_rows)]
    assert got == [t or "" for t in texts]


# --- op 1 ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import tokenizers

    return tokenizers.Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary()), cache_chunks=2000)


def test_bpe_pieces_match_the_library(encoder, tokenizer):
    rng = random.Random(5)
    parts = ["a", "the", " ", "  ", "\n", "\t", "\r\n", "'s", "'ll", "'re", "12", "é", "中", "🙂", "\x1c", "\x85", "\x00", "<|endoftext|>", "ing", "!!", "Z", "zzzz", "==", " ", "'", "''s", "³"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + [None, ""]
    decode, got = encoder.decoder(), []
    for batch, data, offsets in _pieces(texts, 5000):
        ids, at = encoder.encode_piece(data, offsets)
        got += [ids[at[i] : at[i + 1]] for i in range(batch.num_rows)]
    for text, ids in zip(texts, got, strict=True):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == want, text
        assert decode(ids).decode() == tokenizer.decode(want, skip_special_tokens=False)


def test_bpe_every_character_class(encoder, tokenizer):
    texts = [f"a{chr(c)}1 {chr(c)}{chr(c)}b" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    for text, want in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want.ids


def test_decoding_bytes_that_are_no_text(encoder, tokenizer):
    decode, rng = encoder.decoder(), random.Random(1)
    for _ in range(200):
        ids = [rng.randrange(256) for _ in range(9)]
        assert decode(np.array(ids)).decode() == tokenizer.decode(ids, skip_special_tokens=False)


def test_op1(spark, documents, tokenizer):
    want = {}
    for i, text, _ in documents:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert {r[0]: tuple(r)[1:] for r in op1_bpe(spark, SF).collect()} == want


def test_bpe_edges(odd, none):
    rows = bpe.encode(odd.select("doc_id", "text")).collect()
    assert len(rows) == odd.count() and all(r.decoded == (r.text or "") and r.n_tokens == len(r.ids) for r in rows)
    assert bpe.encode_digest(none).count() == 0
    over = bpe.encode(odd)  # it has a column ``ids``, which the result replaces
    assert over.columns.count("ids") == 1 and dict(over.dtypes)["ids"] == "array<int>" and over.count() == len(rows)
    assert bpe.encode_digest(odd).count() == len(rows)


# --- op 10 ---------------------------------------------------------------------------------


def _brute_hits(docs, items, window=13):
    def words(t):
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)

    grams = {}
    for name, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[k : k + window]), set()).add(str(name))
    sizes = {len(g) for g in grams}
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[g]
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_op10(spark, documents):
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    want = _brute_hits([t for _, t, _ in documents], items)
    assert any(w[1] for w in want)
    assert {r[0]: tuple(r)[1:] for r in op10_decontaminate(spark, SF).collect()} == {d[0]: w for d, w in zip(documents, want, strict=True)}


@pytest.mark.parametrize("block_bytes", [1 << 24, 40])
def test_decontamination_edges(spark, odd, none, block_bytes):
    """Short items, repeated ones, nulls; one block or many."""
    items = [(1, "quick BROWN fox"), (2, None), (3, ""), (4, "fox jumps over the lazy dog the quick brown fox jumps over the lazy dog the"), (5, "quick brown fox"), (6, "one"), (4, "w0x0 w1x1"), (None, "ünï")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumnRenamed("item_id", "item_id")
    docs = odd.select("doc_id", "text")
    found = decontam.find_contamination(docs, benchmark, block_bytes=block_bytes).collect()
    want = _brute_hits([r.text for r in found], [("null" if n is None else n, t) for n, t in items])
    assert [(r.n_words, r.n_hit, len(r["items"])) for r in found] == [w[:3] for w in want]
    assert [r.contaminated for r in found] == [w[4] for w in want]
    best = {r.doc_id: (r.longest_match, r.longest_at) for r in found}
    assert best[1] == (16, 3) and best[3] == (0, -1)
    assert decontam.contamination_digest(odd, benchmark).count() == len(found)
    assert decontam.contamination_digest(none, benchmark).count() == 0
    assert decontam.find_contamination(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.remove_contaminated(odd, benchmark).columns == odd.columns


# --- op 5 ----------------------------------------------------------------------------------


def _brute_rules(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


def test_op5(spark, documents):
    rows = {r.doc_id: r for r in op5_quality_rules(spark, SF).collect()}
    for i, text, _ in documents:
        want = _brute_rules(text)
        assert tuple(rows[i])[1:6] == want
        assert rows[i].base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (rows[i].base_failed and rows[i].kept)


def test_forest_finds_what_labels_call_poor(spark):
    rows = op5_quality_rules(spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    for i, quality in duckdb.sql("select doc_id, quality from '/root/testdata/sf0.01/labels.parquet'").fetchall():
        rows.loc[i, "quality"] = quality
    judged = rows[~rows.base_failed & rows.quality.notna()]
    assert (judged.kept == (judged.quality == 1)).mean() > 0.97


def test_rules_edges(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (7, None), (None, 0), (99, 0)], "doc_id long, quality int")
    rows = quality_rules.rules_digest(odd, labels).collect()
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert len(rows) == odd.count() and all(tuple(r)[1:6] == _brute_rules(texts[r.doc_id]) for r in rows)
    assert quality_rules.rules_digest(none, labels.limit(0)).count() == 0
    assert {r.kept for r in quality_rules.rules_digest(odd, labels.limit(0)).where("not base_failed").collect()} == {True}


# --- op 6, 9, 3 ----------------------------------------------------------------------------


def _fold(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_op6_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in op6_toxicity(spark, "/root/testdata/sf0.01").collect()}
    assert len(rows) == 1000 and all(r.held_out == _fold(i) and r.predicted == (r.score >= 0.7) for i, r in rows.items())
    known = duckdb.sql("select doc_id, toxic from '/root/testdata/sf0.01/labels.parquet' where toxic is not null").fetchall()
    held = [(rows[i].predicted, y) for i, y in known if _fold(i)]
    assert np.mean([p == y for p, y in held]) > 0.95


def test_toxicity_uses_presence_and_edges():
    texts = ["you scum you scum scum", "a fine day", "pure scum here", "another fine and long day"] * 8
    model = toxicity.fit(texts, np.array([1, 0, 1, 0] * 8))
    one, many = (model.scores(d, o)[0] for _, d, o in [next(_pieces(["the scum"])), next(_pieces(["the scum scum scum"]))])
    assert one > 0.7 and many > 0.7
    inside = next(_pieces(["ab", "cd", ""]))
    row, feature = toxicity.present(*inside[1:], None)
    alone = [toxicity.present(*next(_pieces([t]))[1:], None)[1].tolist() for t in ("ab", "cd", "")]
    assert [feature[row == i].tolist() for i in range(3)] == alone


def test_toxicity_edges(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (7, 0), (7, 0), (8, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.toxicity_digest(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity_digest(none, labels).count() == 0
    assert all(r.score < 1e-6 for r in toxicity.toxicity_digest(odd, labels.limit(0)).collect())
    assert toxicity.remove_toxic(odd, labels).columns == odd.columns


def test_op9_grades(spark):
    rows = {r.doc_id: r for r in op9_quality(spark, "/root/testdata/sf0.01").collect()}
    known = duckdb.sql("select doc_id, quality from '/root/testdata/sf0.01/labels.parquet' where quality is not null").fetchall()
    held = [(rows[i].kept, q == 1) for i, q in known if _fold(i)]
    assert len(rows) == 1000 and np.mean([k == q for k, q in held]) > 0.9
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in rows.values())


def test_ordinal_thresholds_are_ordered_and_graded():
    texts = [c * 60 for c in "abc" for _ in range(6)]
    model = quality_classifier.fit(texts, np.repeat([0, 1, 2], 6))
    assert (np.diff(model.thresholds) > 0).all()
    z = model.scores(*next(_pieces(["a" * 60, "b" * 60, "c" * 60]))[1:])
    assert z[0] < z[1] < z[2]
    assert (np.diff(model.reach(z), axis=1) <= 0).all()


def test_quality_edges(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 1), (7, 0, None), (8, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality_classifier.quality_digest(odd, labels).count() == odd.count()
    assert quality_classifier.quality_digest(none, labels.limit(0)).count() == 0
    assert {r.expected_grade for r in quality_classifier.quality_digest(odd, labels.limit(0)).collect()} == {0.0}


def test_op3_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in op3_language_id(spark, "/root/testdata/sf0.01").collect()}
    known = duckdb.sql("select doc_id, lang from '/root/testdata/sf0.01/documents.parquet' where lang is not null").fetchall()
    held = [rows[i].lang_pred == y for i, y in known if _fold(i)]
    assert len(rows) == 1000 and np.mean(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_network_gradients():
    rng = np.random.default_rng(0)
    net = langid.new_network(["a", "b", "c"], rng)
    for d in (net.ahead, net.back):
        d.byte, d.state, d.bias = (p.astype(np.float64) for p in (d.byte, d.state, d.bias))
    net.out, net.out_bias = net.out.astype(np.float64), net.out_bias.astype(np.float64)
    x, y = rng.integers(0, 256, (5, 7)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    _, grads = langid.gradients(net, x, y)
    for p, g in zip(net.parameters, grads, strict=True):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old, e = p[at], 1e-4
        p[at] = old + e
        up, _ = langid.gradients(net, x, y)
        p[at] = old - e
        down, _ = langid.gradients(net, x, y)
        p[at] = old
        assert g[at] == pytest.approx((up - down) / 2 / e, rel=1e-3)


def test_pooling_covers_all_segments():
    net = langid.new_network(["a", "b"], np.random.default_rng(2))
    texts = ["x" * 5, "", "y" * (langid.SEGMENT * 2 + 3), "z" * langid.SEGMENT]
    together = net.pooled(*next(_pieces(texts))[1:])
    assert np.allclose(together[1], 0) and np.allclose(together.sum(1)[[0, 2, 3]], 1, atol=1e-5)
    parts = [net.pooled(*next(_pieces([t]))[1:])[0] for t in texts]
    assert np.allclose(together, parts, atol=1e-6)
    long = texts[2]
    cut = [long[i : i + langid.SEGMENT] for i in range(0, len(long), langid.SEGMENT)]
    by_hand = sum(net.pooled(*next(_pieces([c]))[1:])[0] * len(c) for c in cut) / len(long)
    assert np.allclose(together[2], by_hand, atol=1e-6)


def test_language_edges(odd, none):
    rows = {r.doc_id: r for r in langid.language_digest(odd).collect()}
    assert rows[2].lang_pred == rows[3].lang_pred == rows[11].lang_pred == "und" and rows[11].score == 0
    assert rows[1].lang_pred == "en"
    assert langid.language_digest(none).count() == 0
    assert {r.lang_pred for r in langid.predict(odd.select("doc_id", "text"), None).collect()} == {"und"}
