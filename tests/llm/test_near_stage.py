"""The near-duplicate stage against brute force over five-word shingles and a similarity of 0.8."""

import re

import numpy as np
import pytest

import corpus_pipeline
from demandspark.llm import ngram_join

SF = "/root/testdata/sf0.001"


def brute(rows, words, percent):
    """(shingles, smallest id of the component) of each row (id, text)."""
    lower = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))
    sets, up = {}, {}
    for i, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(lower))
        sets[i] = frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) or frozenset([tuple(w)] if w else [])
        up[i] = i

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            both = len(a & b) if i < j else 0
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_stage_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    first = {i for i, (_, c) in brute(rows, 5, 80).items() if i == c}
    assert first < {i for i, (_, c) in brute(rows, 3, 90).items() if i == c}
    assert {r.doc_id for r in corpus_pipeline.one_near_duplicate(spark, docs, SF).select("doc_id").collect()} == first


def test_copy_with_a_longer_end_goes(spark):
    text = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(text)), (2, " ".join(text + [f"e{i}" for i in range(50)])), (3, " ".join(text[:230]))]
    kept = corpus_pipeline.one_near_duplicate(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert {r.doc_id for r in kept.collect()} == {1, 3}


@pytest.mark.parametrize("words,percent", [(5, 80), (1, 70)])
def test_words_and_percent(spark, words, percent):
    rng, texts = np.random.default_rng(5), []
    for size in (2, 4, 5, 6, 12, 30, 90):
        for _ in range(20):
            w = [f"s{size}x{k}" for k in range(size)]
            for k in rng.integers(0, size, rng.integers(0, 2 + size // 20)):
                w[k] = f"e{rng.integers(1 << 30)}"
            texts.append(" ".join(w[: size - int(rng.integers(0, 1 + size // 5))]))
    rows = list(enumerate(texts))
    got = ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), percent, words)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(rows, words, percent)
