"""Records of CSV files that are cut into byte ranges, quoted line breaks included.

Whether a line begins a record depends on everything before it in its file: it does unless a quoted value
is still open. So every byte range first reports, for both cases, whether a value is open at its end; one
pass over these reports, one row per range, says how each range really begins. Then all ranges are read
again, each alone: records within a range are whole, and the few that cross a border are put together
from the parts that the ranges on both sides hand over.

A quote opens a value only at the beginning of a field, as in the format; elsewhere it is a character.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Possessive, so a doubled quote is never taken for a closing one and no line is scanned twice.
_FIELD = r'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|)'
_CLOSED_LINE = re.compile(rf"{_FIELD}(?:,{_FIELD})*+\Z", re.S)
_REST = re.compile(r'(?:[^"]++|"")*+"[^,]*+', re.S)


def open_after(line: str, inside: bool) -> bool:
    """Whether a quoted value is open after a line, given whether one was before."""
    if '"' not in line:
        return inside
    if not inside:
        return _CLOSED_LINE.match(line) is None
    rest = _REST.match(line)
    return rest is None or open_after_field(line[rest.end() :])


def open_after_field(rest: str) -> bool:
    return bool(rest) and _CLOSED_LINE.match(rest[1:]) is None


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, start (of the byte range): the lines as they are, a carriage return at the end included."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _by_range(batches):
    """(file, start, lines) for each run of lines of one byte range."""
    for batch in batches:
        files, starts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        values, at = batch.column(0).to_pylist(), 0
        for i in range(1, len(values) + 1):
            if i == len(values) or (files[i], starts[i]) != (files[at], starts[at]):
                yield files[at], starts[at], values[at:i]
                at = i


REPORT = "file string, start long, open_if_closed boolean, open_if_open boolean, closes boolean, spans boolean, head string"


def _report(batches):
    """One row per range: its ends for both beginnings; whether an open value closes at the end of some line;
    whether some line that begins closed leaves a value open; the first line."""
    ranges: dict = {}
    for file, start, lines in _by_range(batches):
        ends = ranges.setdefault((file, start), [False, True, False, False, lines[0]])
        for line in lines:
            if '"' in line:
                before = ends[0]
                ends[0], ends[1] = open_after(line, ends[0]), open_after(line, ends[1])
                ends[3] |= ends[0] and not before
            ends[2] |= not ends[1]
    rows = [{"file": f, "start": s, "open_if_closed": e[0], "open_if_open": e[1], "closes": e[2], "spans": e[3], "head": e[4]}
            for (f, s), e in ranges.items()]
    if rows:
        yield pa.RecordBatch.from_pylist(rows)


class Layout:
    """How the ranges of a table's files begin: one entry per range that begins within a record."""

    def __init__(self, lines: DataFrame):
        reports = lines.mapInArrow(_report, REPORT).collect()  # one row per byte range
        self.heads = {r.head for r in reports if r.start == 0}
        self.owner: dict[tuple[str, int], int] = {}  # the range in which the record began
        self.spans = False
        file, inside, owner = None, False, 0
        for r in sorted(reports, key=lambda r: (r.file, r.start)):
            if r.file != file:
                self._ended(file, inside)
                file, inside = r.file, False
            if inside:
                self.owner[r.file, r.start] = owner
            if not inside or r.closes:
                owner = r.start
            self.spans |= r.spans or inside
            inside = r.open_if_open if inside else r.open_if_closed
        self._ended(file, inside)

    @staticmethod
    def _ended(file: str | None, inside: bool) -> None:
        if inside:
            raise ValueError(f"MALFORMED: a quoted value never ends: {file}")


def _assembled(owner: dict[tuple[str, int], int]):
    """Whole records of a range, and its parts of records that cross its borders."""

    def assemble(batches):
        key, parts, inside, lead, first = None, [], False, False, False

        def row(text: str, part_of: int | None):
            return {"file": key[0], "start": key[1], "owner": part_of, "first": first, "record": text}

        def rest():
            # Open at the end: the part belongs to this range, or to the owner if no line ended the record.
            return [row("\n".join(parts), owner[key] if lead else key[1])] if key and parts else []

        for file, start, lines in _by_range(batches):
            rows = []
            if (file, start) != key:
                rows += rest()
                key, parts = (file, start), []
                lead = inside = key in owner
                first = start == 0
            for line in lines:
                parts.append(line)
                inside = open_after(line, inside)
                if not inside:
                    rows.append(row("\n".join(parts), owner[key] if lead else None))
                    parts, lead, first = [], False, False
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_PARTS)
        if last := rest():
            yield pa.RecordBatch.from_pylist(last, schema=_PARTS)

    return assemble


_PARTS = pa.schema([
    ("file", pa.string()), ("start", pa.int64()), ("owner", pa.int64()), ("first", pa.bool_()), ("record", pa.string()),
])


def records(lines: DataFrame, layout: Layout) -> DataFrame:
    """One row per record but the first of each file and blank ones: column `record`."""
    parts = lines.mapInArrow(_assembled(layout.owner), "file string, start long, owner long, first boolean, record string")
    whole = parts.where("owner IS NULL AND NOT first").select("record")
    # One record per border of two ranges at most.
    crossing = (
        parts.where("owner IS NOT NULL")
        .groupBy("file", "owner")
        .agg(F.array_sort(F.collect_list(F.struct("start", "record"))).alias("parts"), F.bool_or("first").alias("first"))
        .where("NOT first")
        .select(F.array_join("parts.record", "\n").alias("record"))
    )
    ended = F.regexp_replace(F.col("record"), r"\r$", "")
    return whole.unionAll(crossing).select(ended.alias("record")).where(F.trim("record") != "")
