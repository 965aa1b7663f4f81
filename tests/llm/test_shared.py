"""Bounded samples, objects that travel by value, hashes of very long words, short benchmark items."""

import os
import subprocess
import sys
import time
import zlib

import numpy as np
from pyspark.sql import functions as F

from demandspark.llm import common, decontam, quality_rules, toxicity
from demandspark.llm.common import BASE, U64, mix


def test_a_hot_doc_id_sends_one_text_for_a_label(spark):
    docs = spark.range(5000).select(F.lit(3).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    docs = docs.unionByName(spark.range(10, 60).select(F.col("id").alias("doc_id"), F.lit("other").alias("text")))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    learned = [i for i in [3, *range(10, 60)] if zlib.crc32(str(i).encode()) % 3 != 1]
    texts, known = toxicity.labelled_sample(docs, labels, "toxic", 10)
    assert len(texts) <= 20 and all((known == y).sum() == min(10, sum(i % 2 == y for i in learned)) for y in (0, 1))
    assert texts.count("text 0") == (3 in learned and "text 0" in texts)


def test_very_long_texts_are_not_learned_from(spark):
    docs = spark.createDataFrame([(2, "x" * (toxicity.LONGEST + 1)), (4, "short"), (5, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1), (4, 1), (5, 1)], "doc_id long, toxic int")
    assert toxicity.labelled_sample(docs, labels, "toxic", 5)[0] in (["short"], [])


ALONE = "import sys; from pyspark import cloudpickle; print(type(cloudpickle.loads(open(sys.argv[1], 'rb').read())).__name__, 'demandspark' in sys.modules)"


def test_models_travel_by_value(spark, tmp_path):
    """What is broadcast can be read by a Python that does not find the library."""
    models = [toxicity.Toxicity(np.zeros(4, np.float32), 0.5), quality_rules.Forests([quality_rules.grow([np.eye(3)])])]
    for k, model in enumerate(models):
        sent = common.shared(spark, model)
        assert sent.value is not model and sent.__getstate__()["kept"] is None
        (tmp_path / str(k)).write_bytes(sent.sent.value)
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        out = subprocess.run([sys.executable, "-c", ALONE, str(tmp_path / str(k))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
        assert out.stdout.split() == [type(model).__name__, "False"], out.stderr


def test_long_words_hash_as_byte_by_byte():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 123, 5000).astype(np.uint8)
    starts = np.array([0, 10, 10, 100, 900])
    ends = np.array([5, 10 + common.LONG_WORD, 10 + common.LONG_WORD + 1, 800, 5000])
    want = []
    for a, b in zip(starts, ends):
        h = 0
        for v in common.byte_values()[data[a:b]].tolist():
            h = (h * int(BASE) + v) % (1 << 64)
        want.append(h)
    assert (common.word_hashes(data, starts, ends) == mix(np.array(want, U64))).all()


def test_a_word_of_megabytes_is_fast():
    data = np.full(20_000_000, 97, np.uint8)
    began = time.time()
    common.word_hashes(data, np.array([0]), np.array([len(data)]))
    assert time.time() - began < 5


def test_short_items_beside_long_ones(spark):
    """Items of one to three words are whole windows; the others keep their key."""
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(40)]
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 120)))) for i in range(60)]
    items = [("a", "w1"), ("b", "w1"), ("c", "w2 w3"), ("d", "w4 w5 w6"), ("e", docs[0][1] or "w7"), ("f", " ".join(docs[1][1].split()[:20]) or "w8"), ("g", ""), ("h", None)]
    got = {r.doc_id: r for r in decontam.contamination_digest(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")).collect()}
    for i, text in docs:
        w, hit, found = text.split(), set(), 0
        for _, item in items:
            t = (item or "").split()
            n = min(13, len(t))
            windows = {tuple(t[k : k + n]) for k in range(len(t) - n + 1)} if t else set()
            places = [k for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows] if t else []
            found += bool(places)
            hit |= {k + j for k in places for j in range(n)}
        assert (got[i].n_words, got[i].n_hit, got[i].n_items) == (len(w), len(hit), found), i


def test_one_word_item_costs_no_pairs():
    tests = decontam.test_suffixes(["one", "long"], ["the", " ".join(f"x{k}" for k in range(30))])
    text = ("the " * 50_000).encode()
    words, first = decontam._words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert len(decontam.match_piece(words, first, tests)[0]) == 0
    assert sum(len(p) for _, p, *_ in decontam.match_short(words, first, tests)) == 50_000
