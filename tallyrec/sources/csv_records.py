"""CSV records with line breaks inside quoted cells, read by many tasks.

A task that starts in the middle of a file cannot tell whether it is inside a quoted cell. So every
split is scanned for both cases: where would its last line end if its first began outside a cell, and
where if inside? Put together in the order of the splits, that gives the state at every split's
start. The few bytes per split meet on the driver, which lists the splits anyway. If no line ends
inside a cell, lines are records. Otherwise a second pass puts lines together, and the pieces of the
records that cross a split's end are joined by a small shuffle.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrec.session import materialize

_SPLITS = "file long, split long, from_outside boolean, from_inside boolean, opens boolean, closes boolean"
_PIECES = "file string, split long, row long, first boolean, origin long, record string"


class _Start(NamedTuple):
    """Whether a split starts inside a cell, and the split in which that record began."""

    inside: bool
    origin: int


def _line_reader():
    """Whether a line ends inside a quoted cell; a quote opens a cell only at its start."""
    closing = re.compile(r'(?:[^"]++|"")*+"')

    def ends_inside(line: str, inside: bool) -> bool:
        at = 0
        if not inside:
            if not line.startswith('"'):
                at = line.find(',"') + 1
                if not at:
                    return False
            at += 1
        while True:
            found = closing.match(line, at)
            if found is None:
                return True
            at = line.find(',"', found.end()) + 2
            if at < 2:
                return False

    return ends_inside


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def split_starts(spark: SparkSession, path: str) -> dict[tuple[int, int], _Start] | None:
    """By file (hashed) and split, where the split starts; None if every line is a record."""
    ends_inside = _line_reader()

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        states: dict[tuple[int, int], list[bool]] = {}
        for batch in batches:
            files, splits = (batch.column(n).to_numpy() for n in ("file", "split"))
            bounds = np.flatnonzero((np.diff(files) != 0) | (np.diff(splits) != 0)) + 1
            for first, last in zip((0, *bounds), (*bounds, batch.num_rows)):
                if first == last:
                    continue
                # the end when the split begins outside or inside a cell; whether a line ever opens
                # a cell from outside, or ends outside after a start inside
                state = states.setdefault((files[first], splits[first]), [False, True, False, False])
                lines = batch.column("quoted").slice(first, last - first).drop_null()
                for line in lines.to_pylist():
                    opens = ends_inside(line, False)
                    stays = ends_inside(line, True)
                    state[0], state[1] = (stays if x else opens for x in state[:2])
                    state[2] |= opens
                    state[3] |= not state[1]
        if states:
            keys, values = zip(*states.items())
            columns = [np.array(c) for c in (*zip(*keys), *zip(*values))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns],
                ["file", "split", "from_outside", "from_inside", "opens", "closes"],
            )

    lines = _lines(spark, path).select(
        F.xxhash64("file").alias("file"), "split", F.when(F.contains("value", F.lit('"')), F.col("value")).alias("quoted")
    )
    found = sorted(lines.mapInArrow(scan, _SPLITS).collect())
    if not any(row["opens"] for row in found):
        return None
    starts: dict[tuple[int, int], _Start] = {}
    file, inside, origin = None, False, 0
    for row in found:
        if row["file"] != file:
            file, inside, origin = row["file"], False, 0
        starts[row["file"], row["split"]] = _Start(inside, origin)
        if not inside or row["closes"]:
            origin = row["split"]  # a record that is open at the end began in this split
        inside = row["from_inside"] if inside else row["from_outside"]
    return starts


def records(spark: SparkSession, path: str, starts: dict[tuple[int, int], _Start]) -> DataFrame:
    """(file, split, row, first, record): the records of CSV files, line breaks and all.

    ``split`` and ``row`` say where a record begins; ``first`` marks the first record of a file.
    """
    ends_inside = _line_reader()
    known = spark.sparkContext.broadcast(starts)

    def assemble(batches):
        import pyarrow as pa

        at, name, held, begun, inside, first, origin = None, None, [], 0, False, False, -1

        def piece(open_):
            # pieces of records that cross a split's end name the split where the record began
            crosses = origin >= 0 or open_
            return name, at[1], begun, first, (origin if origin >= 0 else at[1]) if crosses else None, "\n".join(held)

        for batch in batches:
            out = []
            columns = (batch.column(n).to_pylist() for n in ("key", "file", "split", "row", "value"))
            for key, file, split, row, value in zip(*columns):
                if (key, split) != at:
                    if held:
                        out.append(piece(True))
                    at, name, held = (key, split), file, []
                    start = known.value[key, split]
                    inside, origin = start.inside, start.origin if start.inside else -1
                    first = split == 0
                if not held:
                    begun = row
                held.append(value)
                if '"' in value:
                    inside = ends_inside(value, inside)
                if not inside:
                    out.append(piece(False))
                    held, origin, first = [], -1, False
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names
                )
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(piece(True), kinds)], names)

    import pyarrow as pa

    names = ["file", "split", "row", "first", "origin", "record"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string()]
    lines = _lines(spark, path).withColumn("key", F.xxhash64("file"))
    pieces = materialize(lines.mapInArrow(assemble, _PIECES), "csv-records")
    part = F.struct("split", "row", "first", "record")
    crossing = pieces.where("origin is not null").groupBy("file", "origin")
    joined = crossing.agg(F.array_sort(F.collect_list(part)).alias("parts")).select(
        "file",
        F.col("parts")[0]["split"].alias("split"),
        F.col("parts")[0]["row"].alias("row"),
        F.col("parts")[0]["first"].alias("first"),
        F.array_join("parts.record", "\n").alias("record"),
    )
    return pieces.where("origin is null").drop("origin").unionByName(joined)
