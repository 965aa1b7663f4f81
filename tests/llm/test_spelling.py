"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.llm import spelling as S

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, text in rows:
        for run in LETTERS.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def texts(seed: int, n: int):
    """Words of few letters, of very different frequency, and variants of them."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abé") for _ in range(draw.randint(5, 9))) for _ in range(40)] + ["x" * 300, "x" * 299 + "y", "x" * 301]
    for w in list(words):
        at = draw.randrange(len(w))
        words += [w[:at] + w[at + 1 :], w[:at] + "b" + w[at:], w[:at] + "ÿ" + w[at + 1 :]]
    weights = [draw.paretovariate(0.6) for _ in words]
    return [(i, " ".join(draw.choices(words, weights, k=60)).replace(" ", draw.choice([" ", ", ", "Ā", "9"])).title() if i % 3 else " ".join(draw.choices(words, weights, k=60))) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("shard", [S.SHARD, 7])
def test_against_brute_force(spark, seed, shard, monkeypatch):
    """With a small shard nearly all buckets are hot and cut into blocks."""
    monkeypatch.setattr(S.near_words, "__defaults__", (shard,))
    rows = texts(seed, 60) + [(None, "Colour colour colour colour colour color"), (500, None), (501, ""), (502, "!! 12")]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("word", "n", "bucket", "half", "form")})
    assert rows_of(S.group_variants(df.repartition(3))) == brute(rows)


def test_bitsets_find_all_pairs():
    draw = random.Random(9)
    words = sorted({"".join(draw.choice("abc") for _ in range(draw.randint(1, 6))) for _ in range(300)}, key=lambda w: -len(w))
    letters, lengths, alphabet = S.coded(words)
    got = sorted((words[i], words[j]) for a, b in S.near_bits(letters, lengths, letters, lengths, alphabet) for i, j in zip(a, b))
    assert got == sorted((a, b) for a in words for b in words if one_apart(a, b))


def test_long_runs_are_split_between_words():
    table = S.letter_table()
    text = ("Ärger über Zug " * 200_000) + "z" * 3_000_000
    assert Counter(w for part in S.runs(text, table) for w in part) == {"Ärger".encode("latin-1"): 200_000, "über".encode("latin-1"): 200_000, b"zug": 200_000, b"z" * 3_000_000: 1}


def test_chains_reach_their_end(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(27)], "word string, form string")
    assert {r.root for r in S.roots(forms).collect()} == {"w27"}


def test_empty(spark):
    assert S.group_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_positions_beyond_a_word_hold_nothing():
    index = S.PositionIndex(np.array([[1, 2], [1, 0]], np.uint16), 2)
    assert index.at(0)[1, 0] == 3 and index.at(1)[2, 0] == 1 and not index.at(-1).any() and not index.at(2).any()
