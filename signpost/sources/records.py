"""Records of delimited files, cut from byte ranges.

A quoted field may hold line breaks, so whether a line starts a record depends on all lines before
it. Files are read as lines, in as many ranges as Spark likes. A first pass says, for each range,
whether its end is inside quotes and how many records begin in it, for both ways it may start. These
are put together over the ranges of a file, one short row each. A second pass cuts the records, and
the pieces of those that cross an edge are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signpost.session import materialize


def inside_after(line: str, inside: bool) -> bool:
    """Is the place after `line` inside quotes? A quote opens a field only at its start.

    Two quotes stand for one; a quote closes where only white space is left before a comma or the end.
    """
    at, size = 0, len(line)
    while True:
        if not inside:
            if line.startswith('"', at):
                inside, at = True, at + 1
            else:
                comma = line.find(",", at)
                if comma < 0:
                    return False
                at = comma + 1
                continue
        quote = line.find('"', at)
        if quote < 0:
            return True
        if line.startswith('"', quote + 1):
            at = quote + 2
            continue
        after = quote + 1
        while after < size and line[after] <= " ":
            after += 1
        if after == size:
            return False
        if line[after] == ",":
            inside, at = False, after + 1
        else:
            at = quote + 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value, path, start (of the byte range) in the order of each range."""
    reader = spark.read.option("lineSep", "\n")
    if not path.lower().endswith(".csv"):
        reader = reader.option("pathGlobFilter", "*.[cC][sS][vV]")
    return reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )


_RANGE = "path string, start bigint, end_out boolean, end_in boolean, records_out bigint, records_in bigint"


def _ranges(lines: DataFrame) -> DataFrame:
    """For each range, if it starts outside (out) or inside (in) quotes: the end's state, records begun."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, states, begun = None, [False, True], [0, 0]

        def row() -> pa.RecordBatch:
            values = [*current, *states, *begun]
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
            names = [c.split()[0] for c in _RANGE.split(", ")]
            return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            quoted = batch.column("quoted")
            # Blank lines between records are none.
            begins = np.concatenate([[0], np.cumsum(~np.asarray(batch.column("blank")))])
            places = list(zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()))
            edges = [k for k in range(1, len(places)) if places[k] != places[k - 1]]
            marked = np.flatnonzero(np.asarray(quoted.is_valid()))
            for low, high in zip([0, *edges], [*edges, len(places)]):
                if low == high:
                    continue
                if places[low] != current:
                    if current is not None:
                        yield row()
                    current, states, begun = places[low], [False, True], [0, 0]
                at = low
                for k in marked[np.searchsorted(marked, low) : np.searchsorted(marked, high)].tolist():
                    line = quoted[k].as_py()
                    for s in (0, 1):
                        if not states[s]:
                            begun[s] += int(begins[k + 1] - begins[at])
                        states[s] = inside_after(line, states[s])
                    at = k + 1
                for s in (0, 1):
                    if not states[s]:
                        begun[s] += int(begins[high] - begins[at])
        if current is not None:
            yield row()

    quoted = F.when(F.contains("value", F.lit('"')), F.col("value")).alias("quoted")
    narrow = lines.select("path", "start", quoted, (F.col("value") == "").alias("blank"))
    return narrow.mapInArrow(summarise, _RANGE)


_STARTS = "path string, start bigint, inside boolean, ends_inside boolean, first_row bigint"


def _starts(ranges: DataFrame) -> DataFrame:
    """How each range starts, and the number of its first record in the file."""

    def follow(table: pa.Table) -> pa.Table:
        out, inside, row = [], False, 0
        for r in sorted(table.to_pylist(), key=lambda r: r["start"]):
            ends = r["end_in"] if inside else r["end_out"]
            out.append((r["path"], r["start"], inside, ends, row))
            row += r["records_in"] if inside else r["records_out"]
            inside = ends
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64()]
        names = [c.split()[0] for c in _STARTS.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return ranges.groupBy("path").applyInArrow(follow, _STARTS)


def _cut(lines: DataFrame, whole: bool) -> DataFrame:
    """path, row, start, record: whole records of each range, or the pieces at its edges."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, inside, row = None, False, 0
        held: list[str] = []
        out: list[tuple] = []

        def take(piece: bool) -> None:
            nonlocal held
            if held and piece != whole:
                out.append((current[0], row, current[1], "\n".join(held)))
            held = []

        for batch in batches:
            names = ("path", "start", "value", "inside", "first_row")
            for path, start, line, starts_inside, first in zip(*[batch.column(c).to_pylist() for c in names]):
                if (path, start) != current:
                    if current is not None:
                        take(True)
                    if starts_inside is None:
                        raise RuntimeError(f"the byte ranges of {path} changed between two reads")
                    current, inside = (path, start), starts_inside
                    # The record that is open here began before.
                    row, opened_before = (first - 1, True) if inside else (first, False)
                if not inside and line == "":
                    continue
                held.append(line)
                inside = inside_after(line, inside) if '"' in line else inside
                if not inside:
                    take(opened_before)
                    row, opened_before = row + 1, False
            if len(out) >= 1_000:
                yield _pieces(out)
                out = []
        if current is not None:
            take(True)
        yield _pieces(out)

    return lines.select("path", "start", "value", "inside", "first_row").mapInArrow(
        cut, "path string, row bigint, start bigint, record string"
    )


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows)) or [()] * 4
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "row", "start", "record"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """path, row, record: every record of the files as text, numbered in its file from 0.

    Blank lines between records are skipped. A quote that is never closed leaves one record to the
    end of the file. Each range is read by one task, whatever its file.
    """
    lines = _lines(spark, path)
    # One short row for each range, of which the driver plans a task each anyway.
    starts = materialize(_starts(_ranges(lines)), "csv-ranges")
    whole = _cut(lines.join(F.broadcast(starts), ["path", "start"], "left"), whole=True)
    open_edges = starts.where(F.col("inside") | F.col("ends_inside"))
    if open_edges.isEmpty():
        return whole.select("path", "row", "record")
    pieces = _cut(lines.join(F.broadcast(open_edges), ["path", "start"]), whole=False)
    joined = pieces.groupBy("path", "row").agg(F.sort_array(F.collect_list(F.struct("start", "record"))).alias("parts"))
    joined = joined.select("path", "row", F.array_join(F.col("parts.record"), "\n").alias("record"))
    return whole.select("path", "row", "record").union(joined)
