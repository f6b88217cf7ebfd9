import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import hashing, lm_scoring, ngram_join, packing


def test_words_of_a_long_batch_are_hashed_in_little_memory():
    texts = pa.array(["lorem ipsum dolor sit amet " * 40] * 8000, pa.string())  # 8.6 MB
    list(lm_scoring._count_words(iter([pa.RecordBatch.from_pydict({"text": texts[:1]})])))  # tables that are kept
    tracemalloc.start()
    try:
        (out,) = lm_scoring._count_words(iter([pa.RecordBatch.from_pydict({"text": texts})]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sorted(out.column("n").to_pylist()) == [320_000] * 5
    assert peak < 20 << 20


def _texts() -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"_id": pa.array([1]), "_lang": pa.array([0]), "_hash": pa.array([7]), "_row": pa.array([0]), "text": pa.array(["a b c d e f"])})


def _ids() -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"ids": pa.array([np.array([1, 2, 0], np.uint32).tobytes()], pa.binary())})


@pytest.mark.parametrize(
    "run, batch",
    [
        (lm_scoring._count_words, _texts),
        (lm_scoring._encoded(None), _texts),
        (lm_scoring._count_ids(10), _ids),
        (packing._encoded(None), _texts),
        (packing._count_terms, _ids),
        (ngram_join._count_buckets, _texts),
        (ngram_join._prefixes(np.zeros(ngram_join.SKETCH, np.int64)), _texts),
        (ngram_join._sets, _texts),
    ],
)
def test_a_pass_gives_its_memory_back(monkeypatch, run, batch):
    seen = []
    monkeypatch.setattr(hashing, "release", lambda: seen.append(1))
    assert sum(len(b) for b in run(iter([batch()]))) >= 1
    assert seen == [1]
