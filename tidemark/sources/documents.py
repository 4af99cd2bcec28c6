"""Items of JSON documents of any size: a file that holds one array of objects, or one object, is split like plain text.

A file is cut at every closing brace, wherever Spark splits its bytes. What a brace means depends on all bytes before it, but
only by two things: whether it lies inside a string, and how many brackets are open. A task works out for every split how both
change, for either state of strings it may begin in; windows along each file tell the state every split really begins in.
In a second pass each task joins pieces to items, which end where one bracket (array) or none (object) is left open. An item belongs
to the split where it begins; pieces that lie in later splits are sent there, one per split at most.

No task and no row holds more than a split and one item. An item of more than 1 GB is called broken, since no row could carry it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import stage
from tidemark.sources.records import BROADCAST_SPLITS, OPEN, PIECE, WHOLE, runs

LONGEST = 1 << 30
_QUOTE, _BACKSLASH = ord('"'), ord("\\")
_STEPS = np.zeros(256, dtype=np.int8)
_STEPS[[ord("["), ord("{")]] = 1
_STEPS[[ord("]"), ord("}")]] = -1


class _Lexed:
    """Brackets of some pieces, each with its closing brace put back: where they are and whether quotes before them are odd."""

    def __init__(self, values: pa.Array):
        self.pieces = pc.binary_join_element_wise(values, "}", "")
        offsets = np.frombuffer(self.pieces.buffers()[1], np.int32)[self.pieces.offset : self.pieces.offset + len(values) + 1]
        data = np.frombuffer(self.pieces.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        steps = _STEPS[data]
        marks = np.flatnonzero(steps)
        quotes = np.flatnonzero(data == _QUOTE)
        behind = quotes[(quotes > 0) & (data[quotes - 1] == _BACKSLASH)]
        if len(behind):  # a quote behind an odd number of backslashes ends nothing; such runs never pass a brace
            plain = np.maximum.accumulate(np.where(data == _BACKSLASH, -1, np.arange(len(data))))
            escaped = behind[(behind - 1 - plain[behind - 1]) % 2 == 1]
            quotes = np.setdiff1d(quotes, escaped, assume_unique=True)
        self.steps = steps[marks].astype(np.int64)
        self.odd = np.searchsorted(quotes, marks) % 2 == 1
        self.swaps = len(quotes) % 2 == 1
        self.ends = np.searchsorted(marks, offsets[1:] - offsets[0] - 1)

    def change(self, inside: bool) -> int:
        """By how much the number of open brackets grows, if the first byte lies inside a string or not."""
        return int(self.steps[self.odd == inside].sum())

    def cuts(self, inside: bool, depth: int, base: int) -> np.ndarray:
        """Pieces that end an item."""
        outside = self.odd == inside
        level = depth + np.cumsum(np.where(outside, self.steps, 0))
        return np.flatnonzero(outside[self.ends] & (level[self.ends] == base))


_STATES = "path string, block long, swaps boolean, outside long, inside long, bytes long, first string, size long"


def split_states(pieces: DataFrame) -> DataFrame:
    """A row per split: ``path, block``, what lies open where it begins (``inside`` a string, ``depth`` of brackets), ``base``,
    the depth between items, ``front`` and ``back`` for the first and last of a file, ``closed`` if the file ends with a brace."""

    def run(batches):
        now, state = None, None
        for batch in batches:
            for key, part in runs(batch):
                if key != now:
                    if state:
                        yield pa.RecordBatch.from_pylist([state])
                    now = key
                    state = {"path": key[0], "block": key[1], "swaps": False, "outside": 0, "inside": 0, "bytes": 0, "first": None, "size": part.column("size")[0].as_py()}
                lexed = _Lexed(part.column("value"))
                state["outside"] += lexed.change(state["swaps"])
                state["inside"] += lexed.change(not state["swaps"])
                state["swaps"] ^= lexed.swaps
                state["bytes"] += pc.sum(part.column("bytes")).as_py()
                if state["first"] is None:
                    state["first"] = next((v.lstrip()[0] for v in _texts(lexed.pieces) if v.lstrip()), None)
        if state:
            yield pa.RecordBatch.from_pylist([state])

    found = pieces.select("path", "block", "value", "bytes", "size").mapInArrow(run, _STATES)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    within = F.coalesce(F.sum(F.col("swaps").cast("int")).over(before), F.lit(0)) % 2 == 1
    told = found.withColumn("within", within).withColumn("grown", F.when(F.col("within"), F.col("inside")).otherwise(F.col("outside")))
    return told.select(
        "path", "block", F.col("within").alias("inside"), F.coalesce(F.sum("grown").over(before), F.lit(0)).alias("depth"),
        F.when(F.first("first", ignorenulls=True).over(file) == "[", 1).otherwise(0).alias("base"),
        (F.col("block") == F.min("block").over(file)).alias("front"), (F.col("block") == F.max("block").over(file)).alias("back"),
        # every piece was counted with a brace; a byte-order mark is not among the bytes read
        (F.col("size") - F.sum("bytes").over(file)).isin(0, 3).alias("closed"),
    )


def _texts(pieces: pa.Array) -> Iterator[str]:
    return (value.as_py() for value in pieces)


_ITEMS = "path string, block long, row long, item string, base int, kind int, ends boolean"
_SCHEMA = pa.schema([
    ("path", pa.string()), ("block", pa.int64()), ("row", pa.int64()), ("item", pa.string()), ("base", pa.int32()), ("kind", pa.int32()),
    ("ends", pa.bool_()),
])


class _Cutter:
    """Joins the pieces of one split to items; what its last pieces leave open is held until the split ends."""

    def __init__(self, state: dict):
        if state["inside"] is None:
            raise RuntimeError(f"{state['path']} was split in another way in the second pass")
        self.path, self.block, self.base = state["path"], state["block"], state["base"]
        self.inside, self.depth = state["inside"], state["depth"]
        self.is_piece = not state["front"] and (self.inside or self.depth != self.base)
        self.unclosed = state["back"] and not state["closed"]
        self.last, self.held, self.row = None, [], 0

    def _emit(self, items: pa.Array, rows: np.ndarray, kind: int, ends: bool) -> pa.RecordBatch:
        n = len(items)
        same = [pa.array([value], kind_).take(pa.array(np.zeros(n, dtype=np.int64))) for value, kind_ in (
            (self.path, pa.string()), (self.block, pa.int64()), (self.base, pa.int32()), (kind, pa.int32()), (ends, pa.bool_()))]
        return pa.RecordBatch.from_arrays([same[0], same[1], pa.array(rows, pa.int64()), items, *same[2:]], schema=_SCHEMA)

    def _emit_held(self, ends: bool) -> Iterator[pa.RecordBatch]:
        if self.held:
            kind = PIECE if self.is_piece else WHOLE if ends else OPEN
            yield self._emit(pa.array(["".join(self.held)]), np.array([self.row]), kind, ends)
        self.held, self.is_piece = [], False

    def add(self, values: pa.Array, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if self.unclosed:  # no brace follows the file's last piece, so the last one seen waits
            if self.last is not None:
                values, rows = pa.concat_arrays([self.last[0], values]), np.concatenate([self.last[1], rows])
            self.last = values.slice(len(values) - 1), rows[-1:]
            values, rows = values.slice(0, len(values) - 1), rows[:-1]
        if not len(values):
            return
        lexed = _Lexed(values)
        cuts = lexed.cuts(self.inside, self.depth, self.base) + 1
        self.depth += lexed.change(self.inside)
        self.inside ^= lexed.swaps
        front = int(cuts[0]) if len(cuts) else len(values)
        self.row = self.row if self.held else int(rows[0])
        self.held += lexed.pieces.slice(0, front).to_pylist()
        if not len(cuts):
            return
        yield from self._emit_held(True)
        if len(cuts) > 1:
            lists = pa.ListArray.from_arrays(pa.array(cuts - front, pa.int32()), lexed.pieces.slice(front, int(cuts[-1]) - front))
            yield self._emit(pc.binary_join(lists, ""), rows[cuts[:-1]], WHOLE, True)
        self.held = lexed.pieces.slice(int(cuts[-1])).to_pylist()
        self.row = int(rows[cuts[-1]]) if self.held else 0

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.last is not None:
            self.row = self.row if self.held else int(self.last[1][0])
            self.held += self.last[0].to_pylist()
        yield from self._emit_held(False)


def _cut(pieces: DataFrame) -> DataFrame:
    """Items, and at the ends of splits what belongs together: an open item, and pieces of earlier ones."""

    def run(batches):
        now, cutter = None, None
        for batch in batches:
            for key, part in runs(batch):
                if key != now:
                    if cutter:
                        yield from cutter.end()
                    names = ("path", "block", "inside", "depth", "base", "front", "back", "closed")
                    now, cutter = key, _Cutter({c: part.column(c)[0].as_py() for c in names})
                yield from cutter.add(part.column("value"), part.column("row").to_numpy())
        if cutter:
            yield from cutter.end()

    return pieces.mapInArrow(run, _ITEMS)


@contextmanager
def _same_splits(spark: SparkSession):
    """Both passes must split alike, also if executors are lost or come in between: splits may not depend on their number."""
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)


def document_items(spark: SparkSession, folder: str, paths: DataFrame | None = None) -> DataFrame:
    """``path, block, row, item, sound, base, ends`` of the JSON documents right below a folder, or of those among ``paths``.

    ``block`` and ``row`` tell where an item begins, in file order. What follows the last item of a file has ``ends`` false.
    ``sound`` tells whether an item is one JSON object, or the rest of a file is what must be there. Written once as a table in
    the shared folder, items that reach over the end of a split as a second one. Blank files give no items.
    """
    path = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    pieces = spark.read.option("pathGlobFilter", "*.json").option("lineSep", "}").text(folder).select(
        path.alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
        F.make_valid_utf8("value").alias("value"), (F.octet_length("value") + 1).alias("bytes"), F.col("_metadata.file_size").alias("size"),
    )
    if paths is not None:
        pieces = pieces.join(paths.select("path"), "path", "left_semi")
    with _same_splits(spark):
        states = stage(split_states(pieces), "json-states")
        pieces = pieces.drop("bytes", "size")
        if states.count() <= BROADCAST_SPLITS:
            told = pieces.join(F.broadcast(states), ["path", "block"], "left")
        else:
            told = pieces.join(states, ["path", "block"], "left").sortWithinPartitions("path", "block", "row")
        # the only copy of the text: whole items are judged as they are written, what lies at the ends of splits after that
        whole = F.col("kind") == WHOLE
        cut = stage(_cut(told).select(
            "path", "block", "row", F.when(whole, _bare()).otherwise(F.col("item")).alias("item"), "base", "kind", "ends",
            F.when(whole, _sound()).alias("sound"),
        ), "json-items", compression="zstd")
    edges = cut.where(~whole).selectExpr(
        "*", f"sum(int(kind = {OPEN})) over (partition by path order by block, row) as _item",
    )
    # at most one open item and one piece of an earlier one per split
    edges = edges.withColumn("_length", F.sum(F.octet_length("item")).over(Window.partitionBy("path", "_item")))
    fits = F.col("_length") <= LONGEST
    parts = edges.groupBy("path", "_item").agg(
        F.sort_array(F.collect_list(F.when(fits, F.struct("block", "row", "item")))).alias("_parts"),
        F.min(F.struct("block", "row")).alias("_at"), F.first("base").alias("base"), F.bool_or("ends").alias("ends"),
    )
    joined = parts.select(
        "path", F.col("_at.block").alias("block"), F.col("_at.row").alias("row"),
        F.when(F.size("_parts") > 0, F.array_join(F.col("_parts")["item"], "")).alias("item"), "base", "ends",
    )
    joined = stage(joined.select("path", "block", "row", _bare().alias("item"), "base", "ends", _sound().alias("sound")), "json-edges")
    return cut.where(whole).drop("kind").unionByName(joined)


def _text() -> Column:
    return F.regexp_replace("item", r"^\x{feff}", "")


def _bare() -> Column:
    """An item without what stands before it in an array; what follows the last item of a file stays."""
    return F.when(F.col("ends") & (F.col("base") == 1), F.regexp_replace(_text(), r"^\s*[\[,]", "")).otherwise(_text())


def _sound() -> Column:
    """Whether ``item``, as it was cut, is one JSON object with what must stand before it, or the rest of a file is what must be there."""
    text, bare = _text(), _bare()
    led = (F.col("base") == 0) | text.rlike(r"^\s*[\[,]")
    # in brackets, so that nothing may follow the first value
    one = F.json_array_length(F.concat(F.lit("["), bare, F.lit("]"))) == 1
    rest = F.when(F.col("base") == 1, text.rlike(r"^\s*(\[\s*)?\]\s*$")).otherwise(text.rlike(r"^\s*$"))
    return F.coalesce(F.when(F.col("ends"), led & bare.rlike(r"^\s*\{") & one).otherwise(rest), F.lit(False))


def sound_documents(items: DataFrame) -> DataFrame:
    """``path, sound``: whether a file is one array of objects, or one object, as a whole."""
    rest = ~F.col("ends")
    opens = F.bool_or(rest & F.col("item").rlike(r"^\s*\["))
    files = items.groupBy("path").agg(
        F.bool_and("sound").alias("all"), F.count_if("ends").alias("items"), F.count_if(rest).alias("rests"), opens.alias("opens"),
        F.max("base").alias("base"),
    )
    array = (F.col("rests") == 1) & (F.coalesce("opens", F.lit(False)) == (F.col("items") == 0))
    one = F.col("items") == 1
    return files.select("path", (F.col("all") & F.when(F.col("base") == 1, array).otherwise(one)).alias("sound"))
