"""Reading dumps of posts: JSON in three shapes, and CSV."""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.clean import EXPECTED_COLUMNS, FILE_ORDER
from tidemark.session import stage
from tidemark.sources.documents import document_items, sound_documents
from tidemark.sources.records import csv_records

# JSON fields that are text; the others may hold numbers, text or lists.
_TEXT_FIELDS = ("username", "content", "urls")

# Cells that mean "missing" in a CSV file.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def discover_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, name, suffix, bytes`` of the JSON and CSV files right below a folder.

    The listing is Spark's own; no file is opened.
    """
    name = F.element_at(F.split("path", "/"), -1)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.{json,csv}")
        .load(folder)
        .select(
            "path",
            name.alias("name"),
            F.concat(F.lit("."), F.element_at(F.split("path", r"\."), -1)).alias("suffix"),
            F.col("length").alias("bytes"),
        )
        .orderBy("name")
    )


def _decoded(column: str) -> Column:
    """File names in row metadata are percent-encoded; a plus is a plus."""
    return F.url_decode(F.regexp_replace(column, r"\+", "%2B"))


def _csv_headers(spark: SparkSession, folder: str) -> DataFrame:
    """``path, header`` of every CSV file: its first non-blank line."""
    # A byte-order mark or trailing CR is not part of the line.
    line = F.regexp_replace("value", r"^\x{feff}|\r$", "")
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder).select(
        _decoded("_metadata.file_path").alias("path"), _place(), line.alias("line")
    ).where(F.trim("line") != "")
    return lines.groupBy("path").agg(F.min_by("line", FILE_ORDER).alias("header"))


def _place() -> Column:
    """Where a row stands in its file, whatever the split that read it."""
    return F.struct(
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(FILE_ORDER)


def _positions() -> tuple[Column, Column]:
    return _decoded("_metadata.file_name").alias("source_file"), _place()


def _ends(text: Column, *signs: str) -> Column:
    """Whether a text ends in one of some characters; compares bytes, counts none."""
    found = text.endswith(signs[0])
    for sign in signs[1:]:
        found = found | text.endswith(sign)
    return found


# Set by the readers, whatever a file says.
_OWN_COLUMNS = ("source_file", FILE_ORDER, "_corrupt_record")


def raw_schema() -> T.StructType:
    """Expected columns of a JSON post; numbers, texts and lists stay apart as variants."""
    kinds = {c: T.StringType() if c in _TEXT_FIELDS else T.VariantType() for c in EXPECTED_COLUMNS}
    return T.StructType([T.StructField(c, kind) for c, kind in kinds.items()])


def json_layouts(spark: SparkSession, folder: str) -> DataFrame:
    """``path, layout`` of every JSON file with text right below a folder, judged on all its lines.

    ``lines`` if each line is an object or array of its own; ``document`` if the file as a whole is one array of objects or
    one object; otherwise ``broken_document`` if a line can only be a part of a larger value, or ``broken``, lines of which
    some are sound. One text scan; a task sends a few numbers and characters per file. A file whose first line is a
    value by itself, with more lines behind it, is never a document, whatever else is broken in it. Files that could be
    documents are cut into their items, split like any text.
    """
    return _judged(spark, folder)[0]


def _told_by_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A row per JSON file with text: how many of its lines are what, and how it begins and ends."""
    # A byte-order mark is not part of the line. Few lines have one or end in a blank; the others cost no match.
    text = F.col("value")
    bare = ~text.startswith("\ufeff") & _ends(text, "}", "]", ",", "{", "[", '"')
    shown = F.trim(F.when(bare, text).otherwise(F.regexp_replace(text, r"^\x{feff}|[\s]+$", "")))
    lines = spark.read.option("pathGlobFilter", "*.json").text(folder).select(
        _decoded("_metadata.file_path").alias("path"), _place(), shown.alias("line")
    ).where(F.col("line") != "")
    line = F.col("line")
    object_like = line.startswith("{") & line.endswith("}")
    array_like = line.startswith("[") & line.endswith("]")
    lines = lines.withColumn("whole", F.when(object_like | array_like, F.try_parse_json("line").isNotNull()).otherwise(F.lit(False)))
    whole = F.col("whole")
    first = F.when(line.startswith("["), 1).when(line.startswith("{"), 2).otherwise(0)
    last = F.when(line.endswith("]"), 1).when(line.endswith("}"), 2).otherwise(0)
    in_larger = line.startswith('"') | line.startswith("]") | line.startswith("}") | line.startswith(",")
    only_opens = ~_ends(line, "}", "]", ",", '"') & line.rlike(r"^[\[{][\[{\s]*$")
    is_part = in_larger | only_opens | (line.endswith(",") & F.try_parse_json(F.regexp_replace("line", r",$", "")).isNotNull())
    # by split first, and as numbers (1 for square, 2 for curly brackets): texts, or places as orders, would have every line sorted
    splits = lines.groupBy("path", f"{FILE_ORDER}.block").agg(
        F.count_if(F.when(whole, F.lit(False)).otherwise(is_part)).alias("parts"),
        F.count_if(whole & object_like).alias("objects"), F.count_if(whole & array_like).alias("arrays"), F.count("*").alias("all"),
        F.min_by(first, f"{FILE_ORDER}.row").alias("first"),
        F.max_by(last, f"{FILE_ORDER}.row").alias("last"),
        F.min_by("whole", f"{FILE_ORDER}.row").alias("first_whole"),
    )
    return splits.groupBy("path").agg(
        *[F.sum(c).alias(c) for c in ("parts", "objects", "arrays", "all")],
        F.min_by("first", "block").alias("first"), F.max_by("last", "block").alias("last"),
        F.min_by("first_whole", "block").alias("first_whole"),
    )


def _judged(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame | None]:
    """Layouts, and the items of files that could be documents, if there are any."""
    judged = stage(_told_by_lines(spark, folder).select("path", F.expr("""
        case when objects + arrays = all then 'lines'
             when first_whole then 'broken'
             when first = 1 and last = 1 and arrays = 0 then 'document'
             when first = 2 and last = 2 and objects + arrays = 0 then 'document'
             when first = last and first > 0 then 'doubtful'
             else 'broken' end""").alias("layout"), F.expr("if(parts > 0 and not first_whole, 'broken_document', 'broken')").alias("if_broken")), "judged")
    likely = judged.where("layout in ('document', 'doubtful')").select("path")
    if likely.isEmpty():
        return judged.select("path", F.expr("if(layout = 'broken', if_broken, layout)").alias("layout")), None
    items = document_items(spark, folder, likely)
    return judged.join(sound_documents(items), "path", "left").select("path", F.expr("""
        case when sound then 'document' when layout = 'document' then 'broken_document'
             when layout in ('broken', 'doubtful') then if_broken else layout end""").alias("layout")), items


def _whole_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, record``: each JSON file as one text."""
    texts = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    return texts.select(_decoded("_metadata.file_path").alias("path"), F.col("value").alias("record"))


def _json_schema(inferred: T.StructType | None, extras: str | None) -> T.StructType:
    more = inferred.fields if inferred else T.StructType.fromDDL(extras).fields if extras else []
    return T.StructType([*raw_schema().fields, *[f for f in more if f.name not in (*EXPECTED_COLUMNS, *_OWN_COLUMNS)]])


_CORRUPT = T.StructField("_corrupt_record", T.StringType())


def _json_scan(spark: SparkSession, folder: str, extras: str | None) -> DataFrame:
    """All JSON files below a folder read line by line, with ``_corrupt_record`` and ``_path``."""
    reader = spark.read.option("pathGlobFilter", "*.json")
    schema = _json_schema(reader.json(folder).schema if extras is None else None, extras)
    read = reader.schema(T.StructType([*schema.fields, _CORRUPT])).json(folder)
    return read.select(*schema.names, "_corrupt_record", _decoded("_metadata.file_path").alias("_path"), *_positions())


def _document_scan(items: DataFrame, extras: str | None) -> DataFrame:
    """The items of documents as rows of ``_json_scan``. What follows a file's last item comes along only if it is broken."""
    spark = items.sparkSession
    # Spark infers columns from texts only by way of an RDD
    inferred = spark.read.json(items.where("ends").select("item").rdd.map(lambda r: r["item"])).schema if extras is None else None
    schema = _json_schema(inferred, extras)
    parsed = items.where("ends or not sound").withColumn("_r", F.from_json("item", T.StructType([*schema.fields, _CORRUPT])))
    corrupt = F.when(F.col("sound"), F.col("_r._corrupt_record")).otherwise(F.coalesce("item", F.lit("")))
    return parsed.select(
        *[F.col(f"_r.`{name}`") for name in schema.names], corrupt.alias("_corrupt_record"), F.col("path").alias("_path"),
        F.element_at(F.split("path", "/"), -1).alias("source_file"), F.struct("block", "row").alias(FILE_ORDER),
    )


def _sound(scan: DataFrame, broken: str) -> DataFrame:
    """Rows of a JSON scan without blank posts: a record that can't be parsed is an error, or left out."""
    if broken == "fail":
        # In a filter, so that no plan can leave the check out. It names the layout, which comes from the
        # choice of files where there is one, so Spark can't move it in front of that choice.
        message = F.concat(
            F.lit("broken JSON in "), F.col("_path"), F.lit(" read as "), F.col("_layout"), F.lit(": "),
            F.substring("_corrupt_record", 1, 200),
        )
        fine = F.when(F.col("_corrupt_record").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        return scan.where(fine).drop("_corrupt_record", "_path", "_layout")
    return scan.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record", "_path", "_layout")


def read_json(
    spark: SparkSession,
    folder: str,
    layout: str = "auto",
    extras: str | None = None,
    broken: str = "fail",
) -> list[DataFrame]:
    """Raw posts from the JSON files right below a folder: JSON Lines, and files that hold one array or one object.

    ``layout`` is ``auto`` (judged file by file), ``lines`` or ``document``. Fields that may be numbers, text or
    lists are read as variants, so that 12.7 and "12.7" stay different. ``extras`` names the
    further columns (DDL); without it they are inferred in one more pass. With ``broken="fail"`` a file or
    record that can't be parsed is an error that names the file; with ``"skip"`` it is left out and
    ``broken_records`` lists it; of a broken document nothing is read, as its lines are no posts. Documents are cut into
    their items by many tasks. A document of 2 GB or more in one line needs ``layout="document"``, as ``auto`` looks at lines.
    """
    if layout == "lines":
        return [_sound(_json_scan(spark, folder, extras).withColumn("_layout", F.lit(layout)), broken)]
    if layout == "document":
        items = document_items(spark, folder)
        verdicts = stage(sound_documents(items), "verdicts")
        _stop_at_broken(verdicts.where("not sound"), broken)
        return [_documents(items, verdicts.where("sound"), extras, broken)]
    layouts, items = _judged(spark, folder)
    layouts = stage(layouts, "layouts")
    _stop_at_broken(layouts.where("layout like 'broken%'"), broken)
    found = {r["layout"]: r["count"] for r in layouts.groupBy("layout").count().collect()}  # four rows at most
    frames = []
    own = ("lines", "broken")
    if any(kind in found for kind in own):
        scan = _json_scan(spark, folder, extras)
        if any(kind not in own for kind in found):
            scan = scan.join(layouts.where(F.col("layout").isin(*own)).toDF("_path", "_layout"), "_path")
        else:
            scan = scan.withColumn("_layout", F.lit("lines"))
        frames.append(_sound(scan, broken))
    if "document" in found:
        frames.append(_documents(items, layouts.where("layout = 'document'"), extras, broken))
    if found and not frames:  # broken documents only
        frames = [_json_scan(spark, folder, extras or "").where(F.lit(False)).drop("_corrupt_record", "_path")]
    return frames


def _documents(items: DataFrame, files: DataFrame, extras: str | None, broken: str) -> DataFrame:
    return _sound(_document_scan(items.join(files.select("path"), "path", "left_semi"), extras).withColumn("_layout", F.lit("document")), broken)


def _stop_at_broken(files: DataFrame, broken: str) -> None:
    if broken == "fail" and (unsound := files.count()):
        names = [r["path"] for r in files.orderBy("path").take(5)]
        raise ValueError(f"broken JSON in {unsound} files, among them {', '.join(names)}")


def broken_records(spark: SparkSession, folder: str) -> DataFrame:
    """``path, record`` of what ``read_json(..., broken="skip")`` leaves out; of a broken document, its whole text (2 GB at most)."""
    layouts, _ = _judged(spark, folder)
    layouts = stage(layouts, "layouts")
    record = F.coalesce("_corrupt_record", "content").alias("record")  # Spark wants another column of the file read too
    paths = layouts.where("layout in ('lines', 'broken')").select(F.col("path").alias("_path"))
    scan = _json_scan(spark, folder, "").join(paths, "_path", "left_semi")
    lines = scan.where(F.col("_corrupt_record").isNotNull()).select(F.col("_path").alias("path"), record)
    torn = layouts.where("layout = 'broken_document'")
    return lines.unionByName(_whole_files(spark, folder).join(torn, "path", "left_semi"))


def _header_names(header: str) -> list[str]:
    """Column names of a header line. Blank ones are called by their place, repeated ones by name and place."""
    names = next(csv.reader([header]), [])
    times = Counter(n.lower() for n in names)
    return [f"_c{i}" if not n else f"{n}{i}" if times[n.lower()] > 1 else n for i, n in enumerate(names)]


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], multiline: bool = True, names: Sequence[str] | None = None
) -> DataFrame:
    """Raw posts from CSV files that share one header; with ``names`` it is not looked up again.

    ``multiline`` allows line breaks inside quotes; such files cannot be split,
    so turn it off for large files that have none.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("pathGlobFilter", "*.csv")
    )
    if names:
        reader = reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in names]))
    raw = reader.csv(paths if isinstance(paths, str) else list(paths))
    given = [c for c in raw.columns if c not in _OWN_COLUMNS]
    return raw.select(*[_csv_cell(F.col(f"`{c}`"), c) for c in given], *_positions())


def _csv_cell(cell: Column, name: str) -> Column:
    cell = F.when(~cell.isin(*CSV_MISSING), cell)
    if name in ("replies", "retweets", "likes"):  # a count column with blanks is written with decimals, which are cut off
        cell = F.regexp_replace(cell, r"^(\s*[+-]?[0-9]+)\.[0-9]*\s*$", "$1")
    return cell.alias(name)


def read_csv_records(spark: SparkSession, folder: str, layout: str = "auto") -> DataFrame:
    """Raw posts of all CSV files right below a folder, whatever their headers, with line breaks inside quotes.

    Files are split wherever Spark splits text (``sources.records``). All headers are read in one plan: a cell is found by
    the place of its name in the header of its file. With ``layout="same"`` one file's header stands for all.
    """
    headers = _csv_headers(spark, folder)
    if layout == "same":
        headers = headers.limit(1)
    headers = stage(headers, "headers")
    named = F.udf(lambda header: _header_names(header), "array<string>")  # a row per file
    headers = stage(headers.select("path", named("header").alias("_names")), "headers")
    names = [r["_name"] for r in headers.select(F.explode("_names").alias("_name"), F.lit(0)).groupBy("_name").agg(F.count("*")).orderBy("_name").collect()]
    names = sorted((n for n in names if n not in _OWN_COLUMNS), key=lambda n: (n not in EXPECTED_COLUMNS, n))
    records = csv_records(spark, folder)
    if layout == "same":
        told = records.withColumn("_names", F.lit(headers.first()["_names"] if names else []))
    else:
        told = records.join(headers, "path")
    width = headers.agg(F.max(F.size("_names"))).first()[0] or 1
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    parsed = told.select("path", "block", "row", "_names", F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), options).alias("_r"))
    cells = parsed.select("path", "block", "row", "_names", F.array(*[F.col(f"_r.c{i}") for i in range(width)]).alias("_cells"))
    cell = {n: F.get("_cells", F.array_position("_names", F.lit(n)).cast("int") - 1) for n in names}
    return cells.select(
        *[_csv_cell(cell[n], n) for n in names], F.element_at(F.split("path", "/"), -1).alias("source_file"),
        F.struct("block", "row").alias(FILE_ORDER),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    """Append frames by column name; a column with several types becomes text."""
    kinds: dict[str, set] = {}
    for frame in frames:
        for field in frame.schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
    mixed = {name for name, seen in kinds.items() if len(seen) > 1}
    whole = None
    for frame in frames:
        common = [
            _as_common(frame, c, c in EXPECTED_COLUMNS).alias(c) if c in mixed else F.col(f"`{c}`")
            for c in frame.columns
        ]
        aligned = frame.select(*common)
        whole = aligned if whole is None else whole.unionByName(aligned, allowMissingColumns=True)
    return whole


def _as_common(frame: DataFrame, name: str, expected: bool):
    kind = frame.schema[name].dataType
    column = F.col(f"`{name}`")
    if expected:  # text beside a variant: the text becomes a variant too
        return column if isinstance(kind, T.VariantType) else column.cast("variant")
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(column)
    return column.cast("string")


def read_posts(
    spark: SparkSession,
    folder: str,
    extras: str | None = None,
    csv_multiline: bool = True,
    json_layout: str = "auto",
    csv_layout: str = "auto",
    broken: str = "fail",
) -> DataFrame:
    """Raw posts of all JSON and CSV files right below a folder, whatever their columns.

    Files of one layout (JSON Lines, JSON document, each CSV header) are read
    together; with ``auto`` one text pass over them finds it out. ``json_layout`` may be set
    to ``lines`` or ``document``, and ``csv_layout`` to ``same``, when all files
    are alike. ``broken`` says what becomes of JSON that can't be parsed (see ``read_json``).
    """
    if json_layout not in ("auto", "lines", "document") or csv_layout not in ("auto", "same"):
        raise ValueError(f"unknown layout {json_layout!r} or {csv_layout!r}")
    if broken not in ("fail", "skip"):
        raise ValueError(f"unknown way with broken JSON {broken!r}")
    kinds = [r["suffix"] for r in discover_files(spark, folder).where("bytes > 0").select("suffix").distinct().collect()]
    frames = read_json(spark, folder, json_layout, extras, broken) if ".json" in kinds else []
    if ".csv" in kinds:
        frames += _csv_frames(spark, folder, csv_multiline, csv_layout)
    if not frames:
        raise FileNotFoundError(f"no JSON or CSV posts below {folder}")
    return _union(frames)


def _csv_frames(spark: SparkSession, folder: str, multiline: bool, layout: str) -> list[DataFrame]:
    """Files without line breaks inside quotes that share one header are read by Spark itself."""
    if not multiline and layout == "same":
        return [read_csv(spark, folder, False)]
    return [read_csv_records(spark, folder, layout)]


def stream_posts(spark: SparkSession, folder: str, extras: str = "", files_per_batch: int | None = None) -> DataFrame:
    """Raw posts from JSON Lines files as they arrive in a folder."""
    schema = T.StructType([*raw_schema().fields, *(T.StructType.fromDDL(extras).fields if extras else [])])
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.json")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder).select("*", _decoded("_metadata.file_name").alias("source_file"))
