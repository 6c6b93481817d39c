"""Spelling variants of the words of a corpus: pairs at one edit found by PartEnum signatures.

A word is read as the set of its letters with their number (``banana``: a1 a2 a3 b1 n1 n2), a binary vector. One
replaced code point changes two bits of it and leaves the length, one inserted or deleted code point changes one bit, so words at one edit have a
Hamming distance of at most two. The bits are dealt into ``PARTS`` parts, evenly by how frequent letters are. Of two words of equal length
at one edit all parts but two are equal, of two whose lengths differ by one all parts but one: every such choice of parts, with the length, is a signature
(partition and enumerate), and a pair at one edit shares at least one. Words are joined on equal signatures and
verified by their edit distance in the join itself: no unverified pair is written.

Only the vocabulary is joined. It is counted with partial sums in the map tasks, so that a frequent word is one row of each.
Every join is told to merge: Spark sizes a table by its compressed file, and does not see that a word becomes 27 signatures, so it would broadcast far more than the driver holds.

Defined cases: null and empty texts, and texts without runs, have no words; a null id reads as the empty text in the
key that damages a run; repeated rows count each; ties in the choice of a form go to the smallest in code-point order; an empty
table has no words; other columns are left out; a run is as long as it is.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutelage.llm.frames import batched, materialise

#: Maximal runs of these are words.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parts the bits are dealt into.
PARTS = 6
#: One run in so many, chosen by its key, loses a code point.
DAMAGED = 199


def runs(docs: DataFrame, least: int = 1) -> DataFrame:
    """``(doc_id, run)`` for every run of at least ``least`` code points, A-Z in lower case."""
    found = docs.select("doc_id", F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    return found.filter(F.length("run") >= least).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def damaged(run: Column, key: Column, every: int = DAMAGED) -> Column:
    """``run`` without the code point at crc32(``key``:run) modulo its length where ``every`` divides that number, else as it is."""
    h = F.crc32(F.concat(key, F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(words: DataFrame, least_chars: int = 6, least_count: int = 5) -> DataFrame:
    """``(word, n)``: the words of at least so many code points that occur so often."""
    return words.filter(F.length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def parts_of(vocab: DataFrame) -> dict[str, int]:
    """A place for every code point in use, the most frequent first: few rows, as many as the alphabet has letters."""
    found = vocab.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count().orderBy(F.desc("count"), "c").collect()
    return {r["c"]: i for i, r in enumerate(found)}


def parts_held(word: str, place: Mapping[str, int], parts: int, known: dict[tuple[str, int], int]) -> list[int]:
    """For each part one number for the set of the word's bits in it; ``known`` remembers the number of a bit."""
    seen: dict[str, int] = {}
    held = [0] * parts
    for c in word:
        k = seen[c] = seen.get(c, 0) + 1
        bit = known.get((c, k))
        if bit is None:
            bit = known[c, k] = xxhash.xxh64_intdigest(f"{c}{k}")
        held[(place.get(c, 0) + 3 * k) % parts] ^= bit
    return held


def _mix(h: np.ndarray, lane: int) -> np.ndarray:
    """Another 64 bits from 64 bits: two rounds of xor-shift and multiply over a stepped state."""
    z = h + np.uint64((0x9E3779B97F4A7C15 * lane) % (1 << 64))
    for by in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F):
        z = (z ^ (z >> np.uint64(32))) * np.uint64(by)
    return z ^ (z >> np.uint64(32))


def signatures_of(held: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roles and, by row of ``held``, signatures: with role 0 of words as long, 1 of words one longer, 2 of words one shorter.

    A signature adds up the mixed numbers of the chosen parts: equal sets give equal sums, and different ones seldom, which the edit distance then settles.
    """
    parts = held.shape[1]
    mixed = np.stack([_mix(held[:, p], p + 1) for p in range(parts)], axis=1)
    total, roles, out = mixed.sum(axis=1, dtype=np.uint64), [], []
    for role, differ, short in ((0, 2, 0), (1, 1, 0), (2, 1, 1)):
        for i, left_out in enumerate(combinations(range(parts), differ)):
            own = _mix((length - short).astype(np.uint64) * np.uint64(1000) + np.uint64(100 * differ + i), parts + 1)
            roles.append(role), out.append(_mix(total - mixed[:, left_out].sum(axis=1, dtype=np.uint64) + own, parts + 2))
    return np.array(roles, np.int32), np.stack(out, axis=1).view(np.int64)


def signatures(vocab: DataFrame, parts: int = PARTS) -> DataFrame:
    """``(sig, role, word, n)`` for every signature of every word."""
    place = parts_of(vocab)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, int], int] = {}
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            words = part.column(0).to_pylist()
            roles, sigs = signatures_of(np.array([parts_held(w, place, parts, known) for w in words], np.uint64), np.array([len(w) for w in words], np.int64))
            places = pa.array(np.repeat(np.arange(len(words)), len(roles)))
            yield pa.RecordBatch.from_arrays([pa.array(sigs.reshape(-1)), pa.array(np.tile(roles, len(words))), part.column(0).take(places), part.column(1).take(places)], names=["sig", "role", "word", "n"])

    return batched(vocab.select("word", "n"), run, "sig bigint, role int, word string, n bigint")


def near(vocab: DataFrame) -> DataFrame:
    """``(word, n, other, other_n)``: all pairs of words at exactly one inserted, deleted or replaced code point, both ways round."""
    sigs = signatures(vocab)
    a, b = sigs.filter("role < 2").alias("a"), sigs.filter("role <> 1").alias("b")
    meet = F.when(F.col("a.role") == 0, (F.col("b.role") == 0) & (F.col("a.word") < F.col("b.word"))).otherwise(F.col("b.role") == 2)
    close = F.levenshtein("a.word", "b.word", 1) == 1
    found = a.join(b.hint("merge"), (F.col("a.sig") == F.col("b.sig")) & meet & close).select(*[F.col(c).alias(n) for c, n in (("a.word", "word"), ("a.n", "n"), ("b.word", "other"), ("b.n", "other_n"))])
    once = materialise(found.distinct(), "near-words")
    return once.union(once.select("other", "other_n", "word", "n"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for every row of ``forms`` (``word``, ``form``; no cycles): the last word on its way, by doubling the steps a round."""
    state = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(state.join(further.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if moved.filter("moved").isEmpty():
            return moved.drop("moved")
        state = moved.drop("moved")


def variants(vocab: DataFrame, ratio: int = 5) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of ``vocab`` (``word``, ``n``).

    A word's form is its near word of largest n if that is at least ``ratio`` (over 1) times its own; its root is where forms end.
    """
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    linked = near(vocab).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    strong = -F.col("best.less") >= ratio * F.col("n")
    linked = materialise(linked.select("word", "n_near", F.when(strong, F.col("best.other")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(linked.filter(F.col("form").isNotNull()))
    whole = vocab.join(linked.hint("merge"), "word", "left").join(ends.hint("merge"), "word", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")


def group(docs: DataFrame, least_chars: int = 6, least_count: int = 5, every: int = DAMAGED, ratio: int = 5) -> DataFrame:
    """``variants`` of the words of all texts of ``docs`` (``doc_id``, ``text``), one run in ``every`` damaged."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    words = runs(docs.select("doc_id", "text"), least_chars).select(damaged(F.col("run"), key, every).alias("word"))
    return variants(materialise(vocabulary(words, least_chars, least_count), "vocabulary"), ratio)
