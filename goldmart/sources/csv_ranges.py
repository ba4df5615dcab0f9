"""Multi-line CSV files read by many tasks: byte ranges, their quote states, and whole records.

Spark's own reader gives a multi-line CSV file to one task, because a line end may lie inside quotes and only
the text before it tells. Here the file is read as lines in byte ranges of ``spark.sql.files.maxPartitionBytes``, in two scans:

1. each range is walked twice at once, as if it began outside and as if it began inside a quoted field (the two walks usually meet at the
   first quoted field, from where one is enough). The result is a row for each range: its state at the end for either state at its start;
2. the states are carried from range to range (the driver holds one entry per range, a few bytes for 128 MB of input), so each range knows where its first
   record begins, and puts its lines together to records.

The pieces of a record that lies across ranges are joined by (file, range where it begins): at most two pieces a range
are shuffled. Records are parsed by Spark's CSV expression, the same parser as the reader's, on the JVM.

``_pos`` is (file, range, record in the range), in file order.
"""

from __future__ import annotations

import csv
import io

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["_"]))

_RANGE_ROW = "file string, block long, from_outside boolean, from_inside boolean, ends_record boolean, header binary"
_RECORD_ROW = "file string, block long, row long, piece long, record binary"


class HeaderError(ValueError):
    """The files of one source do not begin with the same header."""


def quoted_after(line: bytes, quoted: bool) -> bool:
    """Whether the line's end lies inside a quoted field. A quote opens a field only at its begin, two quotes inside stand for one, and
    whatever follows a closing quote belongs to the field up to the comma."""
    at = 0
    while True:
        if not quoted:
            if line[at:at + 1] != b'"':
                comma = line.find(b",", at)
                if comma < 0:
                    return False
                at = comma + 1
                continue
            at += 1
        quote = line.find(b'"', at)
        if quote < 0:
            return True
        if line[quote + 1:quote + 2] == b'"':
            quoted, at = True, quote + 2
            continue
        comma = line.find(b",", quote + 1)
        if comma < 0:
            return False
        quoted, at = False, comma + 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))


def _runs(batches):
    """((file, block), lines) for consecutive lines of one range within a batch."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        codes = files.indices.to_numpy()
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
        for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            key = files.dictionary[int(codes[start])].as_py(), int(blocks[start])
            yield key, batch.column(2).slice(start, stop - start).to_pylist()


class _Walk:
    """Both walks over a range: the states now, whether the one that began inside has reached the end of a record, and the first record."""

    def __init__(self, key):
        self.key, self.outside, self.inside, self.ends_record = key, False, True, False
        self.first = [] if key[1] == 0 else None
        self.header = None

    def step(self, line: bytes) -> None:
        if b'"' in line:
            apart = self.outside != self.inside
            self.outside = quoted_after(line, self.outside)
            self.inside = quoted_after(line, self.inside) if apart else self.outside
        self.ends_record = self.ends_record or not self.inside
        if self.first is not None:
            self.first.append(line)
            if not self.outside:
                self.header, self.first = b"\n".join(self.first), None

    def row(self):
        return (*self.key, self.outside, self.inside, self.ends_record, self.header)


def _walked(lines: DataFrame) -> DataFrame:
    def run(batches):
        walk, done = None, []
        for key, part in _runs(batches):
            if walk is None or walk.key != key:
                done += [walk.row()] if walk else []
                walk = _Walk(key)
            for line in part:
                walk.step(line)
        done += [walk.row()] if walk else []
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary()]
        names = ["file", "block", "from_outside", "from_inside", "ends_record", "header"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(types)], names=names)

    return lines.mapInArrow(run, _RANGE_ROW)


def range_owners(ranges) -> dict[tuple[str, int], int]:
    """(file, range) -> the range where the record began that is open at its start; -1 if none is."""
    owners, file, quoted, owner = {}, None, False, -1
    for r in sorted(ranges, key=lambda r: (r["file"], r["block"])):
        if r["file"] != file:
            file, quoted, owner = r["file"], False, -1
        owners[file, r["block"]] = owner if quoted else -1
        began = not quoted or r["ends_record"]
        quoted = r["from_inside"] if quoted else r["from_outside"]
        if quoted and began:
            owner = r["block"]
    return owners


def _records(lines: DataFrame, owners: dict, pieces: bool) -> DataFrame:
    """The records that lie in one range (``piece`` null), or with ``pieces`` the pieces of those that do not, keyed by the range where
    the record begins. Empty records are left out, as the reader does."""

    def run(batches):
        key, state = None, None
        out: list[tuple] = []

        def begin(new):
            nonlocal key, state
            key = new
            if key not in owners:
                raise RuntimeError(f"the byte ranges changed between two scans: {key}")
            state = {"quoted": owners[key] >= 0, "head": owners[key] >= 0, "row": 0, "open": []}

        def end():
            if pieces and state["open"]:
                head = state["head"]
                out.append((key[0], owners[key] if head else key[1], -1 if head else state["row"], key[1], b"\n".join(state["open"])))

        def add(line):
            if b'"' in line:
                state["quoted"] = quoted_after(line, state["quoted"])
            state["open"].append(line)
            if state["quoted"]:
                return
            record, state["open"] = b"\n".join(state["open"]), []
            if state["head"]:
                state["head"] = False
                if pieces:
                    out.append((key[0], owners[key], -1, key[1], record))
                return
            if not pieces and record.rstrip(b"\r"):
                out.append((*key, state["row"], None, record))
            state["row"] += 1

        def batch():
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["file", "block", "row", "piece", "record"])
            out.clear()
            return made

        for found, part in _runs(batches):
            if found != key:
                if key is not None:
                    end()
                begin(found)
            for line in part:
                add(line)
            yield batch()
        if key is not None:
            end()
        yield batch()

    return lines.mapInArrow(run, _RECORD_ROW)


def _names(header: bytes) -> list[str]:
    return next(csv.reader(io.StringIO(header.decode("utf-8", "replace").lstrip("﻿").rstrip("\r"), newline="")), [])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(_pos, _record): every record of the CSV files at ``path`` but the headers, as text, in as many tasks as the files have byte ranges."""
    lines = _lines(spark, path)
    ranges = _walked(lines).collect()
    headers = {r["file"]: _names(r["header"]) for r in ranges if r["header"] is not None}
    if len({tuple(names) for names in headers.values()}) > 1:
        first = headers[min(headers)]
        odd = sorted(file for file, names in headers.items() if names != first)
        raise HeaderError(f"{path}: {len(odd)} files have another header, the first is {odd[0]}")
    owners = range_owners(ranges)
    found = _records(lines, owners, pieces=False).select("file", "block", "row", F.col("record").cast("string").alias("record"))
    if any(r["from_inside"] if owners[r["file"], r["block"]] >= 0 else r["from_outside"] for r in ranges):
        cut = _records(lines, owners, pieces=True).groupBy("file", "block").agg(
            F.max("row").alias("row"), F.array_sort(F.collect_list(F.struct("piece", F.col("record").cast("string").alias("record")))).alias("p"))
        found = found.unionByName(cut.select("file", "block", "row", F.array_join(F.transform("p", lambda p: p["record"]), "\n").alias("record")))
    body = found.where((F.col("block") > 0) | (F.col("row") > 0))
    return body.select(F.struct("file", "block", "row").alias("_pos"), F.regexp_replace("record", r"\r\z", "").alias("_record"))
