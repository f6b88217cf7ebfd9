import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm.packing import Bm25, pack, pack_shard, statistics
from ledgerlake.llm.tokens import Bpe, added_tokens

from .helpers import empty, hostile, stable

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_tokenizers_file(spark, tokenizer):
    rng = random.Random(5)
    odd = [chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), rng.randrange(0x1F300, 0x1F6FF), 0x20, 0x0A, 0x09, 0xA0, 0x2028])) for _ in range(6000)]
    texts = ["".join(odd[i : i + 40]) for i in range(0, 6000, 40)] + ["", " ", "\n\n  x ", "it's 'll <|endoftext|> y", "<|endoftext|><|endoftext|>", "a  <|endoftext|>  b<|endoftext", "\n<|endoftext|>'s", "a" * 5000]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    mine = [np.frombuffer(x, np.uint32).tolist() for x in Bpe(added=added_tokens()).encode(texts)]
    assert mine == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_every_id_once_and_little_padding(spark, tmp_dir, tokenizer):
    rows, df = hostile(spark)
    got = pack(stable(df, tmp_dir), window=128, shard_docs=20).collect()
    pieces, sequences = {}, {}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) >= 0
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids.tolist()))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want = {}
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        want.setdefault((r[0], len(ids)), []).append(ids)
    assert sum(len(x) for p in pieces.values() for _, x in p) == sum(len(x) for w in want.values() for x in w)
    for key, some in want.items():
        if len(some) == 1:
            assert [i for _, x in sorted(pieces[key]) for i in x] == some[0]
    short = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
        short += at < 128
    assert short <= 1 + len(rows) // 20


def test_windows_hold_neighbours():
    """Documents of one vocabulary meet in a window rather than those of another."""
    rng = np.random.default_rng(0)
    docs = [rng.integers(1000 * (i % 4), 1000 * (i % 4) + 40, 100) for i in range(80)]
    mixed = sum(len({i % 4 for i, _, _ in s}) > 1 for s in pack_shard(docs, 400))
    assert mixed <= 3
    index = Bm25(docs)
    best = np.argsort(-index.scores(5))[:19]
    assert {int(i) % 4 for i in best} == {1}


def test_empty_table(spark, tmp_dir):
    assert pack(stable(empty(spark), tmp_dir)).count() == 0


def test_weights_are_those_of_the_whole_table(spark):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 300, rng.integers(1, 90)).astype(np.uint32) for _ in range(400)]
    ids = spark.createDataFrame([(d.tobytes(),) for d in docs], "ids binary").repartition(5)
    n, mean, held = stats = statistics(ids)
    assert n == 400 and abs(mean - np.mean([len(d) for d in docs])) < 1e-9
    assert held.tolist() == [sum(t in d for d in docs) for t in range(len(held))]
    every = Bm25(docs).scores(7, 10**6)
    assert np.allclose(Bm25(docs[:40], stats).scores(7, 10**6), every[:40])
