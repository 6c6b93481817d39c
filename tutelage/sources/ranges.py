"""Files read by byte ranges with keys that last: one large JSON array by many tasks, and lines with their numbers.

A JSON array file has no line to split at. Spark's text source cuts it at every closing brace instead, in
splits like any text, on any file system. Whether a brace closes an element depends on all that stands before it: inside a string it does
not count, and depth decides. So the file is read twice. First each split is summed up for both cases, "starts outside a string" and "starts
inside one": where it ends, and by how much the depth changes. These sums, one row for each split, are chained in file
order; then every split is walked again from its known start. Elements that reach over splits come out as pieces and are put together by key.

Escapes are taken off before quotes are counted. A range edge never falls inside an escape, as splits begin behind a
closing brace and JSON has no escaped brace.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tutelage.operators.joins import join_lookup
from tutelage.session import materialise

_ESCAPE = re.compile(r"\\.", re.S)
_MARK = re.compile(r'\\.|["{]', re.S)


def effect(text: str, quoted: bool) -> tuple[bool, int]:
    """Is the end of ``text`` inside a string, and how many braces does it open outside of strings?"""
    parts = (_ESCAPE.sub("", text) if "\\" in text else text).split('"')
    return quoted ^ (len(parts) % 2 == 0), sum(p.count("{") for p in parts[quoted::2])


def first_brace(text: str, quoted: bool) -> int:
    """Where the first opening brace outside of strings is."""
    for m in _MARK.finditer(text):
        if m[0] == '"':
            quoted = not quoted
        elif m[0] == "{" and not quoted:
            return m.start()
    return -1


@dataclass
class Walk:
    """Elements of one split, from the state it starts in; ``since`` is the split in which the open element began, -1 for an earlier one."""

    quoted: bool
    depth: int
    block: int
    since: int = -1
    ordinal: int = 0
    parts: list[str] = field(default_factory=list)

    def step(self, text: str) -> tuple[int, int, str, bool] | None:
        """``(first split, ordinal, text, whole)`` if the brace behind ``text`` closes an element."""
        end, opened = effect(text, self.quoted)
        if self.depth == 0:
            if not opened:
                self.quoted = end
                return None
            text = text[first_brace(text, self.quoted):]
            self.since = self.block
        self.quoted = end
        self.depth += opened
        self.parts += [text, "}"]
        if end:
            return None
        self.depth -= 1
        return self._take(self.since == self.block) if self.depth == 0 else None

    def rest(self) -> tuple[int, int, str, bool] | None:
        """The piece of an element that goes on in the next split."""
        return self._take(False) if self.depth else None

    def _take(self, whole: bool) -> tuple[int, int, str, bool]:
        out = (self.since, self.ordinal if self.since == self.block else -1, "".join(self.parts), whole)
        self.ordinal += self.since == self.block
        self.parts = []
        return out


def _fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text between closing braces, with the file and the byte at which its split starts."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """The fragments of each split that a task reads, one split after the other, in file order."""
    files, blocks, values, at = [], [], [], 0

    def more() -> bool:
        nonlocal files, blocks, values, at
        for batch in batches:
            if batch.num_rows:
                files, blocks, values = (batch.column(i).to_pylist() for i in range(3))
                at = 0
                return True
        return False

    alive = more()
    while alive:
        key = (files[at], blocks[at])

        def own() -> Iterator[str]:
            nonlocal at, alive
            while alive and (files[at], blocks[at]) == key:
                yield values[at]
                at += 1
                if at == len(values):
                    alive = more()

        yield key, own()


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, block), texts in _runs(batches):
        ends, deltas = [False, True], [0, 0]
        for text in texts:
            for case in (0, 1):
                ends[case], opened = effect(text, ends[case])
                deltas[case] += opened - (not ends[case])
        yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "end0": ends[0], "delta0": deltas[0], "end1": ends[1], "delta1": deltas[1]}])


def _starts(rows: list) -> dict[tuple[str, int], tuple[bool, int]]:
    """The state in which every split starts, chained in file order; the last brace of a file is not there, so its depth ends at -1."""
    out, file, state = {}, None, (False, -1)

    def ended() -> None:
        if state != (False, -1):
            raise ValueError(f"{file} is no whole JSON array")

    for r in sorted(rows, key=lambda r: (r["file"], r["block"])):
        if r["file"] != file:
            ended()
            file, state = r["file"], (False, 0)
        out[file, r["block"]] = quoted, depth = state
        state = (r["end1"], depth + r["delta1"]) if quoted else (r["end0"], depth + r["delta0"])
    ended()
    return out


def json_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(position, value)``: the objects of JSON array files as texts, numbered from 0 over the files in name order.

    The numbers depend on the files alone, not on how they are split. Elements that are no objects are passed over; a file that is cut off raises.
    """
    fragments = _fragments(spark, path)
    sums = fragments.mapInArrow(_summary, "file string, block bigint, end0 boolean, delta0 bigint, end1 boolean, delta1 bigint").collect()  # a row a split
    starts = _starts(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), texts in _runs(batches):
            if (file, block) not in starts:
                raise ValueError("the files were split in another way the second time")
            walk = Walk(*starts[file, block], block)
            rows = []
            for text in texts:
                if (found := walk.step(text)) is not None:
                    rows.append(found)
                if len(rows) == 4096:
                    yield _rows(file, block, rows)
                    rows = []
            if (found := walk.rest()) is not None:
                rows.append(found)
            yield _rows(file, block, rows)

    walked = materialise(fragments.mapInArrow(run, "file string, block bigint, since bigint, ordinal bigint, value string, whole boolean"), "elements")
    return _numbered(walked)


def _rows(file: str, block: int, rows: list) -> pa.RecordBatch:
    since, ordinal, value, whole = zip(*rows, strict=True) if rows else ((), (), (), ())
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
    columns = ([file] * len(rows), [block] * len(rows), since, ordinal, value, whole)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "since", "ordinal", "value", "whole"])


def _numbered(walked: DataFrame) -> DataFrame:
    """Pieces put together, and elements numbered from the counts of the splits before theirs."""
    blocks = walked.groupBy("file", "block").agg((F.max("ordinal") + 1).alias("n"))
    in_order = W.orderBy("file", "block")  # a row a split
    offsets = materialise(blocks.select("file", F.col("block").alias("since"), (F.sum("n").over(in_order) - F.col("n")).alias("offset")), "offsets")
    # A piece that goes on belongs to the last element begun before it: the latest split with a beginning, in the same file.
    pieces = walked.filter(~F.col("whole"))
    begun = F.last(F.when(F.col("ordinal") >= 0, F.struct("block", "ordinal")), ignorenulls=True).over(
        W.partitionBy("file").orderBy("block", F.col("ordinal") >= 0).rowsBetween(W.unboundedPreceding, 0))  # two rows a split at most
    joined = (pieces.withColumn("begun", begun).groupBy("file", "begun")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "value"))), lambda x: x["value"]), "").alias("value"))
              .select("file", F.col("begun.block").alias("since"), F.col("begun.ordinal").alias("ordinal"), "value"))
    elements = walked.filter("whole").select("file", "since", "ordinal", "value").union(joined)
    return join_lookup(elements, offsets, ["file", "since"], "inner").select((F.col("offset") + F.col("ordinal")).alias("position"), "value")


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(position, value)``: lines numbered from 0 over the files in name order, blank ones counted but left out.

    The number is that of the line in the files, however they are split; a line's place in its split is added to the lines of the splits before.
    """
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
                                        F.monotonically_increasing_id().alias("at"))
    blocks = text.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(W.orderBy("file", "block")) - F.col("n")  # a row a split
    offsets = materialise(blocks.select("file", "block", "first", before.alias("offset")), "offsets")
    placed = join_lookup(text.filter(F.trim("value") != ""), offsets, ["file", "block"], "inner")
    return placed.select((F.col("offset") + F.col("at") - F.col("first")).alias("position"), "value")
