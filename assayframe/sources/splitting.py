"""Records that span lines, read from one file by many tasks.

A quoted CSV value may hold line breaks and a JSON array has no lines at all, so where a task's
split begins can't be told from the split alone. Two passes settle it. The first reads each
split as pieces that end at a separator and folds them into what the split does to a state, for
every state it could begin in (a few numbers). Folding these along each file gives the state
every split truly begins in. The second pass carves whole records; what a border cuts apart,
at most one piece on each of its sides, is joined by file and place.

The driver holds one row per split of a file, as it does to plan the read. Nothing is shuffled
but the pieces at borders. ``spark.sql.files.maxPartitionBytes`` sets the splits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Whether a quoted string is open, and how deep brackets are nested.
State = tuple[int, int]
_START: State = (0, 0)
_RECORDS = "file string, block long, kind int, first boolean, record string"
_WHOLE, _TAIL, _HEAD = 0, 1, 2


class Csv:
    """Lines. A value is quoted if it begins with a quote; quotes inside are doubled; a quote
    followed by anything else makes the value a plain one up to the next separator or line."""

    separator, usual = "\n", _START

    def __init__(self, delimiter: str = ","):
        d = re.escape(delimiter)
        body, rest = r'[^"]*+(?:""[^"]*+)*+', f"[^{d}]*+"
        opened = rf'(?:(?:"{body}"{rest}|(?!"){rest}){d})*+"{body}\Z'
        self.plain = re.compile(opened)
        self.quoted = re.compile(rf'{body}(?:\Z|"{rest}{d}{opened})')

    def moved(self, pieces: pa.Array) -> np.ndarray:
        """The pieces that may change a state: those with a quote."""
        return np.flatnonzero(pc.match_substring(pieces, '"').to_numpy(zero_copy_only=False))

    def moves(self, piece: str) -> tuple[State, State]:
        """From plain and from quoted text: whether a quote is open at the end, and depth."""
        return ((int(self.plain.match(piece) is not None), 0),
                (int(self.quoted.match(piece) is not None), 0))

    @staticmethod
    def between(state: State) -> bool:
        return state[0] == 0


class JsonArray:
    """Pieces that end with a closing brace; records are the objects of a file's array."""

    separator, usual = "}", (0, 1)
    _string = re.compile(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', re.S)
    _inside = re.compile(r'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.S)

    def moved(self, pieces: pa.Array) -> np.ndarray:
        return np.arange(len(pieces))

    def _plain(self, piece: str) -> State:
        bare = self._string.sub("", piece)
        still = bare.find('"')
        if still >= 0:
            bare = bare[:still]
        depth = bare.count("{") + bare.count("[") - bare.count("]")
        return (1, depth) if still >= 0 else (0, depth - 1)

    def moves(self, piece: str) -> tuple[State, State]:
        end = self._inside.match(piece)
        return self._plain(piece), (self._plain(piece[end.end():]) if end else (1, 0))

    @staticmethod
    def between(state: State) -> bool:
        return state[0] == 0 and state[1] <= 1


def _after(state: State, moves: tuple[State, State]) -> State:
    flag, depth = moves[state[0]]
    return flag, state[1] + depth


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, block, pieces) of neighbouring rows of one split."""
    block = batch.column(2).to_numpy()
    file = batch.column(1).dictionary_encode()
    code = file.indices.to_numpy()
    cut = np.flatnonzero((block[1:] != block[:-1]) | (code[1:] != code[:-1])) + 1
    for i, j in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows], strict=True):
        if j > i:
            yield file.dictionary[int(code[i])].as_py(), int(block[i]), batch.column(0).slice(
                i, j - i)


def _pieces(spark: SparkSession, path: str, machine) -> DataFrame:
    return spark.read.text(path, lineSep=machine.separator).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


def _starts(pieces: DataFrame, machine) -> tuple[dict, set, set]:
    """The state at the start of each split that doesn't begin as splits usually do, the splits
    that hold a part of a record which a border cuts, and the files whose first piece ends with
    a carriage return."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: dict[tuple[str, int], list[State]] = {}
        returns: dict[tuple[str, int], bool] = {}
        for batch in batches:
            for file, block, values in _runs(batch):
                returns.setdefault((file, block), values[0].as_py().endswith("\r"))
                ends = done.setdefault((file, block), [(0, 0), (1, 0)])
                for i in machine.moved(values).tolist():
                    moves = machine.moves(values[i].as_py())
                    ends[:] = [_after(s, moves) for s in ends]
        rows = [(f, b, *(n for s in e for n in s), int(returns[f, b]))
                for (f, b), e in done.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 7
        kinds = [pa.string(), *[pa.int64()] * 6]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["file", "block", "f0", "d0", "f1", "d1", "returns"])

    folded = pieces.mapInArrow(fold, "file string, block long, f0 long, d0 long, f1 long, "
                                     "d1 long, returns long").toArrow()
    begins, cut, returns, state, last = {}, set(), set(), _START, None
    for file, block, f0, d0, f1, d1, r in sorted(zip(*folded.to_pydict().values(), strict=True)):
        if block == 0 and r:
            returns.add(file)
        if last is None or file != last[0]:
            if not machine.between(state):  # the file before ends inside a record
                cut.add(last)
            state = _START
        elif not machine.between(state):
            cut |= {last, (file, block)}
        if state != (_START if block == 0 else machine.usual):
            begins[file, block] = state
        last, state = (file, block), _after(state, ((f0, d0), (f1, d1)))
    if not machine.between(state):
        cut.add(last)
    return begins, cut, returns


@dataclass
class _Split:
    """A split that is being carved: its state and the pieces of the record it is in. Where
    lines end with a carriage return and a line feed (``returns``), only the latter is kept."""

    file: str
    block: int
    state: State
    tail: bool
    first: bool
    returns: bool
    pending: list[str] = field(default_factory=list)


def _carve(machine, split: _Split, values: pa.Array) -> list[pa.RecordBatch]:
    n, joiner = len(values), machine.separator
    starts = np.empty(n, bool)
    at = 0
    for i in machine.moved(values).tolist():
        starts[at:i + 1] = machine.between(split.state)
        split.state = _after(split.state, machine.moves(values[i].as_py()))
        at = i + 1
    starts[at:] = machine.between(split.state)
    head = np.flatnonzero(starts)
    out = []
    if len(head) == 0:
        split.pending += values.to_pylist()
        return out
    if head[0] > 0:
        split.pending += values.slice(0, head[0]).to_pylist()
    if split.pending:
        out.append(_closed(split, joiner, _TAIL if split.tail else _WHOLE))
    split.tail = False
    # The last record may go on in the next rows.
    done = head[:-1]
    if len(done):
        ends = head[1:]
        body = values.slice(head[0], head[-1] - head[0])
        if len(body) > len(done):
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(done, ends[-1]) - head[0], pa.int32()), body)
            body = pc.binary_join(lists, joiner)
        out.append(_rows(body, split))
    split.pending = values.slice(head[-1]).to_pylist()
    return out


def _rows(records: pa.Array, split: _Split) -> pa.RecordBatch:
    n = len(records)
    if split.returns:
        records = pc.replace_substring_regex(records, "\r(\n|$)", "\\1")
    first = np.zeros(n, bool)
    if split.first and n:
        first[0], split.first = True, False
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.array(np.zeros(n, np.int32)),
         pa.array(first), records.cast(pa.string())],
        names=["file", "block", "kind", "first", "record"])


def _closed(split: _Split, joiner: str, kind: int) -> pa.RecordBatch:
    first = split.first and kind != _TAIL
    split.first = split.first and kind == _TAIL
    record = joiner.join(split.pending)
    if split.returns:
        record = record.replace("\r\n", "\n").removesuffix("\r")
    split.pending = []
    return pa.RecordBatch.from_arrays(
        [pa.array([split.file]), pa.array([split.block], pa.int64()),
         pa.array([kind], pa.int32()), pa.array([first]), pa.array([record])],
        names=["file", "block", "kind", "first", "record"])


def records(spark: SparkSession, path: str, machine) -> DataFrame:
    """(record, first): the text of each record; ``first`` marks the first one of a file."""
    pieces = _pieces(spark, path, machine)
    begins, cut, returns = _starts(pieces, machine)

    def carve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None

        def ended() -> Iterator[pa.RecordBatch]:
            if split is not None and split.pending:
                open_ = not machine.between(split.state)
                yield _closed(split, machine.separator,
                              _TAIL if split.tail else _HEAD if open_ else _WHOLE)

        for batch in batches:
            for file, block, values in _runs(batch):
                if split is None or (split.file, split.block) != (file, block):
                    yield from ended()
                    state = begins.get((file, block), _START if block == 0 else machine.usual)
                    split = _Split(file, block, state, not machine.between(state), block == 0,
                                   file in returns)
                yield from _carve(machine, split, values)
        yield from ended()

    whole = pieces.mapInArrow(carve, _RECORDS).where(F.col("kind") == _WHOLE) \
        .select("record", "first")
    if not cut:
        return whole
    # Only the splits at such borders are read again: one head and the tails that follow it.
    wanted = spark.createDataFrame(sorted(cut), "file string, block long")
    order = Window.partitionBy("file").orderBy("block", "kind")
    owner: Column = F.last(F.when(F.col("kind") == _HEAD, F.col("block")), True).over(order)
    parts = pieces.join(F.broadcast(wanted), ["file", "block"], "left_semi") \
        .select("value", "file", "block").mapInArrow(carve, _RECORDS) \
        .where(F.col("kind") != _WHOLE).withColumn("owner", owner)
    joined = parts.groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts"),
        F.max("first").alias("first")) \
        .select(F.array_join("parts.record", machine.separator).alias("record"), "first")
    return whole.unionByName(joined)


def csv_records(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """(record, first) of CSV files; empty lines between records are left out.

    Records are those of Spark's multi-line reader, also where a quote stands inside a plain
    value or follows a closing one; lines may end with a carriage return as well, if their
    quotes are sound."""
    return records(spark, path, Csv(delimiter)).where("record != ''")


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """(record) of the objects in files that hold a JSON array each."""
    found = records(spark, path, JsonArray())
    text = F.concat(F.regexp_replace("record", r"^[\s,\[﻿]+", ""), F.lit("}"))
    return found.select(text.alias("record")).where(F.col("record").startswith("{"))
