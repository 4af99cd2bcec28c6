"""CSV records of files of any size, split like plain text although cells may hold line breaks.

Whether a line begins inside a quoted cell depends on all lines before it, but only as a choice of two states. A task
works out, for every split of a file, in which state it ends for either state it may begin in. Those two answers per split
are put together along each file, which tells the state every split really begins in. In a second pass each task joins lines
to records. A record belongs to the split where it begins; pieces that lie in later splits are sent there, one per split at most.

Quotes count only where they begin a cell; a doubled quote inside is a quote. An unclosed quote reaches to the end of its file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stage

BROADCAST_SPLITS = 50_000


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the end of a line lies inside a quoted cell, given that for its start."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            inside = False
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


def _states(values: pa.Array, inside: bool) -> tuple[np.ndarray, bool]:
    """For each line whether it begins inside a cell, and the state behind the last."""
    begins = np.empty(len(values), dtype=bool)
    quoted = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
    last = 0
    for at, line in zip(quoted.tolist(), values.take(pa.array(quoted)).to_pylist(), strict=True):
        begins[last : at + 1] = inside
        inside, last = ends_inside(line, inside), at + 1
    begins[last:] = inside
    return begins, inside


def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Stretches of a batch that come from one split."""
    paths, blocks = (batch.column(c).dictionary_encode() for c in ("path", "block"))
    codes = paths.indices.to_numpy().astype(np.int64) * (len(blocks.dictionary) + 1) + blocks.indices.to_numpy()
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1, [len(codes)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b > a:
            yield (batch.column("path")[a].as_py(), batch.column("block")[a].as_py()), batch.slice(a, b - a)


def split_states(lines: DataFrame) -> DataFrame:
    """``path, block, inside``: the splits that begin inside a quoted cell."""

    def run(batches):
        def row(key, ends):
            return pa.RecordBatch.from_pylist([{"path": key[0], "block": key[1], "out": ends[0], "in": ends[1]}])

        now, ends = None, [False, True]
        for batch in batches:
            for key, part in runs(batch):
                if now is not None and key != now:
                    yield row(now, ends)
                    ends = [False, True]
                now = key
                values = part.column("value")
                first = _states(values, ends[0])[1]
                ends = [first, first if ends[0] == ends[1] else _states(values, ends[1])[1]]
        if now is not None:
            yield row(now, ends)

    found = lines.select("path", "block", "value").mapInArrow(run, "path string, block long, out boolean, in boolean")
    # a row per split; a file's splits are walked in order
    along = found.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("block", "out", "in"))).alias("_all"))
    walked = F.aggregate(
        "_all", F.struct(F.lit(False).alias("now"), F.expr("cast(array() as array<bigint>)").alias("found")),
        lambda acc, s: F.struct(
            F.when(acc["now"], s["in"]).otherwise(s["out"]).alias("now"),
            F.when(acc["now"], F.array_append(acc["found"], s["block"])).otherwise(acc["found"]).alias("found"),
        ),
        lambda acc: acc["found"],
    )
    return along.select("path", F.explode(walked).alias("block"))


_RECORD = "path string, block long, row long, record string, kind int"
_SCHEMA = pa.schema([("path", pa.string()), ("block", pa.int64()), ("row", pa.int64()), ("record", pa.string()), ("kind", pa.int32())])
WHOLE, OPEN, PIECE, HEADER = range(4)
BLANK = " \t\r"


class _Joiner:
    """Puts the lines of one split together; what its last lines leave open is held until the split ends."""

    def __init__(self, key: tuple[str, int], inside: bool):
        self.path, self.block = key
        self.inside = inside
        self.held, self.held_row, self.is_piece = [], 0, inside
        self.header_due = self.block == 0

    def _emit(self, records: pa.Array, rows: np.ndarray, kind: int) -> pa.RecordBatch:
        kinds = np.full(len(records), kind, dtype=np.int32)
        if self.header_due:
            for at, record in enumerate(records.to_pylist()):
                if record.strip(BLANK):
                    kinds[at], self.header_due = HEADER, False
                    break
        same = pa.array(np.zeros(len(records), dtype=np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array([self.path]).take(same), pa.array([self.block], pa.int64()).take(same), pa.array(rows, pa.int64()), records, pa.array(kinds)],
            schema=_SCHEMA,
        )

    def _emit_held(self, kind: int) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield self._emit(pa.array(["\n".join(self.held)]), np.array([self.held_row]), PIECE if self.is_piece else kind)
        self.held, self.is_piece = [], False

    def add(self, values: pa.Array, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        begins, self.inside = _states(values, self.inside)
        starts = np.flatnonzero(~begins)
        front = int(starts[0]) if len(starts) else len(values)
        if front:
            self.held_row = self.held_row if self.held else int(rows[0])
            self.held += values.slice(0, front).to_pylist()
        if not len(starts):
            return
        yield from self._emit_held(WHOLE)
        if len(starts) > 1:
            lists = pa.ListArray.from_arrays(pa.array(starts - front, pa.int32()), values.slice(front, int(starts[-1]) - front))
            yield self._emit(pc.binary_join(lists, "\n"), rows[starts[:-1]], WHOLE)
        self.held, self.held_row = values.slice(int(starts[-1])).to_pylist(), int(rows[starts[-1]])

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self._emit_held(OPEN if self.inside else WHOLE)


def _join_lines(lines: DataFrame) -> DataFrame:
    """Records, and at the ends of splits what belongs together: an open record, and pieces of earlier ones."""

    def run(batches):
        now, joiner = None, None
        for batch in batches:
            for key, part in runs(batch):
                if key != now:
                    if joiner:
                        yield from joiner.end()
                    now, joiner = key, _Joiner(key, bool(part.column("inside")[0].as_py()))
                yield from joiner.add(part.column("value"), part.column("row").to_numpy())
        if joiner:
            yield from joiner.end()

    return lines.mapInArrow(run, _RECORD)


def csv_records(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """``path, block, row, record``: the records of all matching files, without header records and blank ones.

    ``block`` and ``row`` tell where a record begins, in file order. A carriage return at its end is no part of it.
    """
    lines = spark.read.option("pathGlobFilter", glob).option("lineSep", "\n").text(folder).select(
        F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")).alias("path"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
        F.make_valid_utf8("value").alias("value"),
    )
    entered = stage(split_states(lines), "csv-states")
    n = entered.count()  # splits that begin inside a cell
    told = entered.withColumn("inside", F.lit(True))
    if n <= BROADCAST_SPLITS:
        told = lines.join(F.broadcast(told), ["path", "block"], "left")
    else:
        told = lines.join(told, ["path", "block"], "left").sortWithinPartitions("path", "block", "row")
    joined = _join_lines(told)
    records = joined.where(F.col("kind") == WHOLE)
    if n:  # at most one open record and one piece of an earlier one per split
        edges = stage(joined.where(F.col("kind").isin(OPEN, PIECE)), "csv-edges")
        edges = edges.selectExpr("*", f"sum(int(kind = {OPEN})) over (partition by path order by block, row) as _record")
        parts = edges.groupBy("path", "_record").agg(F.sort_array(F.collect_list(F.struct("block", "row", "record"))).alias("_parts"))
        first = F.col("_parts")[0]
        whole = parts.select(
            "path", first["block"].alias("block"), first["row"].alias("row"),
            F.array_join(F.col("_parts")["record"], "\n").alias("record"), F.lit(WHOLE).alias("kind"),
        )
        records = records.unionByName(whole)
    records = records.where(F.btrim("record", F.lit(BLANK)) != "")
    return records.select("path", "block", "row", F.regexp_replace("record", r"\r$", "").alias("record"))
