"""Pieces that the tokenizer splits and looks up at once."""

import pyarrow as pa

from demandspark.llm import bpe


def test_pieces_of_the_tokenizer_are_small(spark, monkeypatch):
    sizes = []

    class Probe:
        def __init__(self, *args):
            pass

        def decoder(self):
            return lambda ids: b""

        def encode_piece(self, data, offsets):
            sizes.append(len(data))
            return data[:0], offsets * 0

    monkeypatch.setattr(bpe, "Encoder", Probe)
    monkeypatch.setattr(bpe, "Vocabulary", lambda text: None)
    monkeypatch.setattr(bpe, "per_worker", lambda key, make: make())
    tasks = []
    monkeypatch.setattr(bpe, "lean", lambda run, key=None: tasks.append(run) or run)
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    bpe.encode_digest(docs)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(100)), "text": ["word " * 10_000] * 100})
    assert sum(b.num_rows for b in tasks[0](iter([batch]))) == 100
    assert sum(sizes) == 100 * 50_000 and max(sizes) <= bpe.PIECE == 1 << 19


def test_classes_of_characters():
    classes = bpe.character_classes()
    assert len(classes) == 0x110000
    of = lambda c: int(classes[ord(c)])
    assert [of("a"), of("é"), of("7"), of(" "), of("\x1c"), of("�"), of("\U00010400")] == [
        bpe.LETTER, bpe.LETTER, bpe.NUMBER, bpe.WHITE, bpe.OTHER, bpe.OTHER, bpe.LETTER,
    ]
    assert set(classes[0xD800:0xE000].tolist()) == {bpe.OTHER}
