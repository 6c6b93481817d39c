import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tutelage.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["The quick brown fox", None, "", "A<|endoftext|>b it's 12½ foo_bar \x1c ́a ΣΑΣ İ ² \xa0z\x85q don't!!", "éè ÊTRE\n\nzwei  drei", "word " * 300, "x" * 3000]


def encoded(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


def test_chunks_give_the_tokenizer_s_ids():
    texts = [t or "" for t in TEXTS]
    got = [np.frombuffer(b, "<u4").tolist() + [1] for b in packing.ChunkEncoder(PATH)(texts)]
    assert got == [encoded(t) for t in texts]


def test_chunks_met_long_ago_are_let_go(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 50)
    texts = [f"often w{i} x{i}y don't" for i in range(300)] + TEXTS[3:4]
    encode = packing.ChunkEncoder(PATH)
    got = [np.frombuffer(b, "<u4").tolist() + [1] for b in encode(texts)]
    assert got == [encoded(t) for t in texts]
    assert "often" in encode.known | encode.known_before
    assert len(encode.known) + len(encode.known_before) < 150 and len(encode.parts) + len(encode.parts_before) <= 100


def test_pieces_cover_each_text_and_fit(spark):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "again")], "doc_id long, text string, length string")
    packed = packing.pack(packing.tokenise(docs, PATH, max_len=64, crc=True), max_len=64)
    rows = packed.collect()
    whole = {}
    for r in rows:
        whole.setdefault(r["doc_id"], {}).setdefault(r["piece"], r)
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
    for i, t in enumerate(TEXTS):
        pieces = [whole[i][k] for k in sorted(whole[i])]
        assert sum((p["ids"] for p in pieces), []) == encoded(t)
        assert [p["start"] for p in pieces] == [64 * k for k in range(len(pieces))]
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= sum(r["length"] for r in rows) // 64 + 2
    full = packing.sequences(packed).collect()
    assert {r["sequence_id"]: len(r["ids"]) for r in full} == {k: sum(n for _, n in v) for k, v in by.items()}


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 100, 500)
    sequence, offset = packing.best_fit(lengths, 100, 3, 5000.0 if rule == "norm" else 10_000.0, rule)
    for s in np.unique(sequence):
        own = lengths[sequence == s]
        assert own.sum() <= 100 and len(own) <= 3 and ((own ** 2).sum() <= (5000 if rule == "norm" else 10_000) or len(own) == 1)
        assert sorted(offset[sequence == s])[0] == 0


def test_best_fit_is_tight_and_blocks_are_even(spark, monkeypatch):
    lengths = np.random.default_rng(1).integers(1, 400, 4000)
    sequence, _ = packing.best_fit(lengths, 1000, 1000, 1e6)
    assert sequence.max() + 1 <= np.ceil(lengths.sum() / 1000) + 2
    monkeypatch.setattr(packing, "BLOCK_ROWS", 500)
    frame = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id long, length long")
    out = packing.pack(frame, max_len=1000)
    assert out.count() == 4000 and out.select("sequence_id").distinct().count() <= np.ceil(lengths.sum() / 1000) + 16


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.tokenise(none, PATH)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 20)], "doc_id long, length long"), max_len=10)
