"""Best-fit packing of tokenised documents into sequences under several capacities at once.

A sequence has room for so many tokens, so many documents and so much attention cost (the sum of squared
lengths). Pieces are taken longest first; each goes to the open sequence that fits it in every dimension and
scores best, and to a new one only if none fits. Two scores: ``norm`` (least weighted norm of the residual
left) and ``dot`` (largest weighted dot product of demand and residual).

Only lengths are packed. Pieces are dealt evenly into blocks of a bounded number of tokens and rows, each
packed by one task; a block ends with a few unfilled sequences at most, so that the loss does not grow with
the input, and no task sees more than a block.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each for itself; ties go
to the earliest sequence opened; an empty table packs into no sequence; other columns of the input are left out.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.llm.frames import batched, materialise, utf8

#: A block is packed by one task: 4,096 full sequences of 4,096 tokens, or so many pieces.
BLOCK_TOKENS, BLOCK_ROWS = 1 << 24, 1 << 18
#: Chunks of text, and as many parts of chunks, that a Python worker takes up before it lets go those not met since as many before.
CACHE_ENTRIES = 1 << 17
#: Characters on which lower case and character classes are the same in every Unicode version.
PLAIN = re.compile("[!-~¡-ÿ]+")

_encoders: dict[str, "ChunkEncoder"] = {}


class ChunkEncoder:
    """Ids of whole texts, chunk by chunk between spaces, remembering chunks met lately.

    Right for tokenizers that never join characters over a space, as those are that drop white space. One that
    lower-cases, splits by a pattern and maps bytes is asked for the parts of a plain chunk only; every other
    chunk, with special tokens or rarer characters, is encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}
        self.parts_before: dict[str, bytes] = {}
        self.split = self._splitter(path)
        bytes_level = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
        self.alphabet = {b: 256 + i for i, b in enumerate(bytes_level)}

    @staticmethod
    def _splitter(path: str):
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        steps = [s["type"] for s in (parts["normalizer"] or {}).get("normalizers", [])]
        before = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
        if steps == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in before] == ["Split", "ByteLevel"] and before[0]["invert"]:
            return regex.compile(before[0]["pattern"]["Regex"]).findall
        return None

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) >= CACHE_ENTRIES:
                self.parts_before, self.parts = self.parts, {}
            ids = self.parts_before.get(part)
            if ids is None:
                mapped = part if part.isascii() else part.encode().decode("latin-1").translate(self.alphabet)
                ids = array("I", [t.id for t in self.tokenizer.model.tokenize(mapped)]).tobytes()
            self.parts[part] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        if self.split and PLAIN.fullmatch(chunk) and "<|" not in chunk:
            return b"".join([self._part(p) for p in self.split(chunk.lower())])
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for text in texts:
            if len(self.known) >= CACHE_ENTRIES:
                self.known_before, self.known = self.known, {"": b""}
            known, before = self.known, self.known_before
            words = text.replace("\n", " ").split(" ")
            got = [known.get(w) for w in words]
            if None in got:
                for i, ids in enumerate(got):
                    if ids is None:
                        w = words[i]
                        got[i] = known[w] = known.get(w) or before.get(w) or self._chunk(w)
            out.append(b"".join(got))
        return out


def encoder(path: str) -> ChunkEncoder:
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def tokenise(docs: DataFrame, tokenizer: str, max_len: int = 4096, end_id: int = 1, ids: bool = True, crc: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids?, ids_crc32?)``: ids of each text and ``end_id``, cut after ``max_len``."""
    kind = docs.schema["doc_id"].dataType
    fields = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType())]
    fields += [("ids", T.ArrayType(T.IntegerType()))] * ids + [("ids_crc32", T.LongType())] * crc
    schema = T.StructType([T.StructField("doc_id", kind)] + [T.StructField(n, t) for n, t in fields])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            row, piece, start, length, crcs, pieces = [], [], [], [], [], []
            for i, got in enumerate(encode([t.decode("utf-8", "replace") for t in part.column(1).to_pylist()])):
                got += end
                for k, a in enumerate(range(0, len(got) // 4, max_len)):
                    cut = got[a * 4:(a + max_len) * 4]
                    row.append(i), piece.append(k), start.append(a), length.append(len(cut) // 4)
                    if crc:
                        crcs.append(zlib.crc32(cut))
                    if ids:
                        pieces.append(np.frombuffer(cut, dtype="<u4").astype(np.int32))
            arrays = [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64())]
            arrays += [pa.array(pieces, pa.list_(pa.int32()))] * ids + [pa.array(crcs, pa.int64())] * crc
            yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    return batched(docs.select("doc_id", utf8("text").alias("text")), run, schema)


def best_fit(lengths: np.ndarray, max_len: int, max_docs: int, max_cost: float, rule: str = "norm",
             weights: tuple[float, float, float] = (1.0, 0.05, 0.2)) -> tuple[np.ndarray, np.ndarray]:
    """``(sequence, offset)`` of each piece; pieces must fit a sequence of their own."""
    n = len(lengths)
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    cap = np.array([max_len, max_docs, max_cost], dtype=np.float64)
    w = np.asarray(weights, dtype=np.float64)
    room = np.empty((3, 1024))  # residuals of open sequences, as shares of the capacities
    names = np.empty(1024, np.int64)
    used, made = 0, 0
    least = float(lengths.min()) if n else 0.0
    eps = 1e-12
    for i in order:
        size = float(lengths[i])
        need = np.array([size, 1.0, size * size]) / cap
        at = -1
        if used:
            left = room[:, :used] - need[:, None]
            ok = (left >= -eps).all(axis=0)
            if ok.any():
                if rule == "dot":
                    score = np.where(ok, -((w * need) @ room[:, :used]), np.inf)
                else:
                    score = np.where(ok, w @ (left * left), np.inf)
                at = int(score.argmin())
        if at < 0:
            if used == room.shape[1]:
                room, names = np.concatenate([room, np.empty_like(room)], axis=1), np.concatenate([names, np.empty_like(names)])
            at = used
            room[:, at], names[at] = 1.0, made
            used, made = used + 1, made + 1
        sequence[i] = names[at]
        offset[i] = round((1.0 - room[0, at]) * max_len)
        room[:, at] -= need
        if room[0, at] * max_len < least - 0.5 or room[1, at] * max_docs < 0.5:
            used -= 1
            room[:, at:used], names[at:used] = room[:, at + 1:used + 1].copy(), names[at + 1:used + 1].copy()
    return sequence, offset


def pack(pieces: DataFrame, max_len: int = 4096, max_docs: int = 4096, max_cost: float | None = None, rule: str = "norm",
         weights: tuple[float, float, float] = (1.0, 0.05, 0.2)) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. ``length`` must be from 1 to ``max_len``; all other columns pass.

    ``max_cost`` bounds the sum of squared lengths of a sequence; by default that of one full piece.
    """
    pieces = materialise(pieces, "pieces")
    total = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("rows"), F.max("length").alias("longest")).first()
    cost = float(max_cost or max_len * max_len)
    if total["longest"] is not None and (total["longest"] > max_len or total["longest"] ** 2 > cost):
        raise ValueError(f"a piece of {total['longest']} tokens fits no sequence")
    blocks = max(1, math.ceil(total["tokens"] / BLOCK_TOKENS), math.ceil(total["rows"] / BLOCK_ROWS))
    schema = T.StructType(pieces.schema.fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    dealt = pieces.withColumn("_block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))

    def run(block: pa.Table) -> pa.Table:
        number = block.column("_block")[0].as_py()
        sequence, offset = best_fit(block.column("length").to_numpy(), max_len, max_docs, cost, rule, weights)
        return block.drop_columns(["_block"]).append_column("sequence_id", pa.array((number << 32) + sequence)).append_column("offset", pa.array(offset))

    return dealt.groupBy("_block").applyInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, n_docs, n_tokens, doc_ids, ids?)``: the packed sequences themselves, ids in their order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", *(["ids"] if "ids" in packed.columns else []))))
    out = packed.groupBy("sequence_id").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("length").alias("n_tokens"), parts.alias("parts"))
    ids = [F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids")] if "ids" in packed.columns else []
    return out.select("sequence_id", "n_docs", "n_tokens", F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"), *ids)
