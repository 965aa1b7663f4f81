"""What the operators' tasks leave in their Python processes."""

import tracemalloc

import pyarrow as pa

from demandspark.llm import bpe, ngram_join
from demandspark.llm.common import PIECE_BYTES, lean, per_worker


def batches(n=2):
    return [pa.RecordBatch.from_arrays([pa.array([1, 2, 3])], names=["x"])] * n


def test_tasks_drop_what_another_operator_kept():
    made = []
    use = lambda key: lean(lambda b: (per_worker(key, lambda: made.append(key) or key) and x for x in b), key)
    assert list(use("a")(iter(batches()))) == batches()
    assert list(use("a")(iter(batches()))) == batches()
    assert made == ["a"]  # tasks of the same operator find it
    plain = lean(lambda b: b)
    assert list(plain(iter(batches()))) == batches()
    assert list(use("a")(iter(batches()))) == batches()
    assert made == ["a", "a"]


def test_freed_memory_goes_back_after_large_tasks_only(monkeypatch):
    trimmed = []
    pool = type("Pool", (), {"release_unused": lambda self: trimmed.append(1)})()
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    list(lean(lambda b: b)(iter(batches())))
    assert not trimmed
    large = pa.RecordBatch.from_arrays([pa.array(["x" * PIECE_BYTES])], names=["x"])
    list(lean(lambda b: b)(iter([large])))
    assert trimmed
    first = lean(lambda b: b)(iter([large, large]))
    next(first)
    first.close()  # a task that ends early
    assert len(trimmed) == 2


def test_cache_of_an_encoder_is_bounded():
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary()), cache_chunks=100)
    chunks = [b" w%d" % i for i in range(150)]
    first = encoder.lookup(chunks)
    encoder.lookup([b" other"])
    assert len(encoder.chunks) <= 100 and encoder.lookup(chunks) == first


def test_a_task_of_the_tokenizer_leaves_no_caches(spark, monkeypatch):
    made, tasks, met = [], [], []
    monkeypatch.setattr(bpe, "per_worker", lambda key, make: per_worker(key, lambda: made.append(make()) or made[0]))
    monkeypatch.setattr(bpe, "lean", lambda run, key=None: tasks.append(lean(run, key)) or run)
    bpe.encode(spark.createDataFrame([(1, "x")], "doc_id long, text string"))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some unusual words", "other words"]})
    for ends_early in (False, True):
        task = tasks[0](iter([batch, batch]))
        assert next(task).column("decoded").to_pylist() == ["some unusual words", "other words"]
        met.append(bool(made[0].chunks and made[0].pairs))
        task.close() if ends_early else list(task)
        assert not made[0].chunks and not made[0].pairs
    assert met == [True, True] and len(made) == 1  # the tables stay


def test_tables_of_a_vocabulary_are_small():
    text = bpe.read_vocabulary()
    tracemalloc.start()
    try:
        encoder = bpe.Encoder(bpe.Vocabulary(text))
        assert tracemalloc.get_traced_memory()[0] < 300 * len(encoder.length)  # bytes a token
    finally:
        tracemalloc.stop()


def test_groups_of_the_join_still_meet(spark):
    rows = [(i, "a b c d e f g h i j k l m n o p q r s t u v w x y z " + "end" * (i % 2)) for i in range(40)]
    got = ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 80, 3).collect()
    assert {r.component_id for r in got} == {0}
