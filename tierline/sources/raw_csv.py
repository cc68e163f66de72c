"""Raw event files: scan, stream, inventory, landing writer, compressed archive."""

import hashlib
import uuid
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierline import workspace
from tierline.functions import timegrid
from tierline.functions.clean import type_raw
from tierline.schema import EMPTY_FOLDER_TIME, RAW_TEXT
from tierline.workspace import check_utc

_TEXT_COLUMNS = RAW_TEXT.fieldNames()
_LEDGER = "_archived"
_CLAIM = "path string, length bigint, modified bigint, block string, run string"
_SET_ASIDE = "path string, reason string, run string"


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def header_of(spark: SparkSession, folder: str | list[str]) -> list[str] | None:
    """The names in the header of the first file, "" where blank; None without files."""
    try:
        line = _options(spark.read).option("header", False).csv(folder).first()
    except AnalysisException as error:
        if not _missing(error):
            raise
        return None
    return None if line is None else [name or "" for name in line]


def _options(reader):
    return (
        reader.option("escape", '"')
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv*")
    )


def _by_header(reader, header: list[str]):
    """A reader of text columns that refuses files with other names or another order of them."""
    schema = StructType([StructField(name, StringType()) for name in header])
    return _options(reader.schema(schema)).option("header", True).option("enforceSchema", False)


def column_names(header: list[str]) -> list[str]:
    """The columns of a header: a blank first name is the row index. All of an event must be there."""
    names = [
        "row_idx" if n == 0 and name in ("", "_c0") else name or f"_c{n}"
        for n, name in enumerate(header)
    ]
    absent = sorted(set(_TEXT_COLUMNS) - set(names))
    if absent:
        raise ValueError(f"the header {header} lacks {absent}")
    lower = [name.lower() for name in [*names, "_path"]]
    repeated = sorted({name for name in lower if lower.count(name) > 1})
    if repeated:
        raise ValueError(f"the header {header} has {repeated} twice or as a name of the reader")
    return names


def _with_path(text: DataFrame, names: list[str]) -> DataFrame:
    return text.select("*", F.col("_metadata.file_path").alias("_path")).toDF(*names, "_path")


def _typed(text: DataFrame) -> DataFrame:
    path = F.col("_path")
    return type_raw(
        text.select(
            *_TEXT_COLUMNS,
            timegrid.file_time(path).alias("file_time"),
            timegrid.file_server(path).alias("server"),
        )
    )


def read_text(spark: SparkSession, folder: str | list[str]) -> DataFrame | None:
    """All columns of CSV files as text, by header name, and the `_path` of each row's file.

    Files with different headers end the job. None if there is no file.
    """
    header = header_of(spark, folder)
    if header is None:
        return None
    names = column_names(header)
    return _with_path(_by_header(spark.read, header).csv(folder), names)


def read_raw(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """Typed events of the CSV files below a folder, or below folders given as globs.

    Columns are found by their names in the header, in any order and beside others. A glob such as
    landing/*2019-10-01-13-* lists only the files of that hour. A missing or empty folder gives an
    empty frame.
    """
    check_utc(spark)
    text = read_text(spark, folder)
    if text is None:
        empty = StructType([*RAW_TEXT.fields, StructField("_path", StringType())])
        text = spark.createDataFrame([], empty)
    return _typed(text)


def _key(path: str) -> str:
    """A path in one spelling; Spark names files with and without an authority, encoded and not."""
    return unquote(path).replace("file:///", "file:/")


def _unreadable(error: Exception) -> tuple[str, str] | None:
    """The path and reason where one file made a scan fail."""
    if isinstance(error, AnalysisException):
        return (error.getMessageParameters()["path"], "not there") if _missing(error) else None
    cause = error.java_exception
    while cause is not None:
        if "FAILED_READ_FILE" in (cause.getMessage() or "") and hasattr(cause, "getMessageParameters"):
            path = cause.getMessageParameters().get("path")
            return (path, "cannot be read to its end") if path else None
        cause = cause.getCause()
    return None


def _first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per file with any text: a hash of its first line, NULL where that is no header.

    The scan takes lines as they are and keeps numbers only, so it sums up by hash in the tasks. A
    header has every name of an event's columns but the row index; lines that look like one but are
    not all the same leave open which one counts, so the file has none.
    """
    looks = reduce(
        Column.__and__, [F.col("value").contains(n) for n in _TEXT_COLUMNS if n != "row_idx"]
    )
    heading = F.when(looks, F.xxhash64("value"))
    lines = (
        spark.read.text(paths)
        .where("_metadata.file_block_start = 0 AND trim(value) <> ''")
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.monotonically_increasing_id().alias("line"),
            heading.alias("heading"),
        )
    )
    first_heading = F.min(F.when(F.col("heading").isNotNull(), F.col("line")))
    same = (F.min("heading") == F.max("heading")) & (first_heading == F.min("line"))
    return lines.groupBy("path").agg(F.when(same, F.min("heading")).alias("heading"))


def sort_by_header(
    spark: SparkSession, paths: list[str], reserved: tuple[str, ...] = ()
) -> tuple[dict[tuple[str, ...], list[str]], dict[str, str]]:
    """CSV files by the header they have, and the reason for each file that cannot be used.

    One distributed pass over the text of all files finds their first lines and whether they can be
    read to the end; the driver gets a number for each path. Unusable are files that are not there
    or broken, those without any text, and those whose first line lacks or repeats a column or has
    one of the `reserved` names. A broken file costs another pass.
    """
    left = {_key(path): path for path in paths}
    refused: dict[str, str] = {}
    found: dict[int, list[str]] = {}
    while left:
        try:
            for row in _first_lines(spark, sorted(left.values())).collect():
                found.setdefault(row.heading, []).append(left.pop(_key(row.path)))
            break
        except (AnalysisException, Py4JJavaError) as error:
            culprit = _unreadable(error)
            if culprit is None or _key(culprit[0]) not in left:
                raise
            refused[left.pop(_key(culprit[0]))] = culprit[1]
    refused |= dict.fromkeys(left.values(), "has no text")
    refused |= dict.fromkeys(found.pop(None, []), "has no header with the columns of an event")
    layouts: dict[tuple[str, ...], list[str]] = {}
    for alike in found.values():
        header = header_of(spark, alike[:1])
        try:
            taken = sorted({name.lower() for name in column_names(header)} & set(reserved))
            if taken:
                raise ValueError(f"the header {header} has the reserved names {taken}")
            layouts.setdefault(tuple(header), []).extend(sorted(alike))
        except ValueError as error:
            refused |= dict.fromkeys(alike, str(error))
    return dict(sorted(layouts.items())), refused


def layout_text(spark: SparkSession, header: tuple[str, ...], paths: list[str]) -> DataFrame:
    """All columns of files with this header as text, and the `_path` of each row's file."""
    return _with_path(_by_header(spark.read, list(header)).csv(paths), column_names(list(header)))


def read_layouts(spark: SparkSession, layouts: dict[tuple[str, ...], list[str]]) -> DataFrame:
    """Typed events of files sorted by their header: one scan for each header, all in one frame."""
    check_utc(spark)
    texts = [_typed(layout_text(spark, header, paths)) for header, paths in layouts.items()]
    return reduce(DataFrame.unionByName, texts)


def layout_name(header: tuple[str, ...]) -> str:
    """A short name of a header, for folders."""
    return hashlib.sha256("\n".join(header).encode()).hexdigest()[:12]


def stream_raw(
    spark: SparkSession,
    folder: str,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
    archive_to: str | None = None,
    header: list[str] | None = None,
) -> DataFrame:
    """Typed event stream of the CSV files landing in `folder`.

    `header` is that of all files, "" for a blank name; by default that of a file present, or the
    names of RAW_TEXT. A file with another header stops the stream. `archive_to` moves files there
    once their batch is done.
    """
    check_utc(spark)
    header = header or header_of(spark, folder) or _TEXT_COLUMNS
    reader = _by_header(spark.readStream, header)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    if archive_to:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
    return _typed(_with_path(reader.csv(folder), column_names(header)))


def inventory(spark: SparkSession, folder: str, pattern: str = "*.csv*") -> DataFrame:
    """One row per file: path, time, size, and the time and server in its name. Reads no content."""
    columns = "path string, modificationTime timestamp, length bigint"
    if workspace.exists(spark, folder):
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .load(folder)
            .select("path", "modificationTime", "length")
        )
    else:
        files = spark.createDataFrame([], columns)
    return files.withColumns(
        {
            "file_time": timegrid.file_time(F.col("path")),
            "server": timegrid.file_server(F.col("path")),
        }
    )


def file_time_range(files: DataFrame) -> DataFrame:
    """Oldest and newest file time; names without a time are skipped."""
    empty = F.lit(EMPTY_FOLDER_TIME).cast("timestamp")
    return files.agg(
        F.coalesce(F.min("file_time"), empty).alias("oldest"),
        F.coalesce(F.max("file_time"), empty).alias("newest"),
    )


def newest_file_time(files: DataFrame) -> Column:
    """The newest file time as a literal."""
    newest = file_time_range(files).select(F.unix_seconds("newest").alias("s")).first().s
    return F.timestamp_seconds(F.lit(newest))


def as_text(events: DataFrame, *extra: str) -> DataFrame:
    """Typed events to the text columns of a raw file."""
    return events.withColumn(
        "event_time", F.date_format("event_time", timegrid.EVENT_TIME_FORMAT)
    ).select(*[F.col(name).cast("string").alias(name) for name in _TEXT_COLUMNS], *extra)


def write_landing(
    dealt: DataFrame, folder: str, slice_seconds: int = 60, mode: str = "append"
) -> None:
    """Write dealt events (with `server`) as one folder of CSV parts per slice and server.

    The folder name carries the file key, so `file_time` works on the path. Rebalancing
    lets a large slice take several parts and several tasks.
    """
    start = timegrid.bucket_start(F.col("event_time"), slice_seconds)
    keyed = dealt.withColumn("file_key", timegrid.file_key(start, F.col("server")))
    gathered = keyed.hint("rebalance", "file_key").sortWithinPartitions("file_key", "row_idx")
    (
        as_text(gathered, "file_key")
        .write.mode(mode)
        .partitionBy("file_key")
        .option("header", True)
        .option("escape", '"')
        .csv(folder)
    )


def finished_blocks(events: DataFrame, newest: Column, block: str) -> DataFrame:
    """Events of blocks that the newest file time has passed by more than one block."""
    timegrid.check_block(block)
    start = timegrid.block_start(F.col("file_time"), block)
    ends = timegrid.shift(start, timegrid.BLOCK_SECONDS[block])
    return events.where(ends < newest).withColumn(
        "block", timegrid.block_key(F.col("file_time"), block)
    )


def write_archive(
    blocks: DataFrame, folder: str, run: str = "0", rows_per_file: int = 50_000_000
) -> None:
    """Write rows with a `block` column as gzip CSV, a folder per block and run, in row order.

    Typed events are written as their text columns; text is written as it is, whatever its columns.
    Ranges over (block, row number) give even tasks even when one block holds most rows; the part
    numbers follow the row order inside a block. A run that is repeated replaces what it wrote.
    """
    if dict(blocks.dtypes)["event_time"] == "timestamp":
        blocks = as_text(blocks, "block")
    number = F.col("row_idx").try_cast("bigint")
    ordered = (
        blocks.withColumn("run", F.lit(run))
        .repartitionByRange("block", number, "event_time")
        .sortWithinPartitions("block", number, "event_time")
    )
    (
        ordered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("block", "run")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", "gzip")
        .csv(folder)
    )


def read_archive_text(spark: SparkSession, folder: str) -> DataFrame | None:
    """All columns of an archive as text, by header name, and the `block`; None if it is empty.

    Where files of several layouts were archived, a row has NULL in the columns its file had not.
    """
    layouts: dict[str, list[str]] = {}
    for path in workspace.matching(spark, f"{folder}/block=*/run=*"):
        layouts.setdefault(path.rsplit("/run=", 1)[1].partition("-")[2], []).append(path)
    texts = [read_text(spark, paths) for _, paths in sorted(layouts.items())]
    texts = [text for text in texts if text is not None]
    if not texts:
        return None
    text = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), texts)
    block = F.regexp_extract("_path", "/block=([^/]+)/", 1)
    return text.withColumn("block", block).drop("_path")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Typed events of an archive with their `block`."""
    text = read_archive_text(spark, folder)
    if text is None:
        text = spark.createDataFrame([], StructType([*RAW_TEXT.fields, StructField("block", StringType())]))
    return type_raw(text.select(*_TEXT_COLUMNS, "block"))


def claims(spark: SparkSession, folder: str, run: str | None = None) -> DataFrame:
    """The files that runs have taken, with their block and run; those of one run if it is named."""
    ledger = f"{folder}/{_LEDGER}/files"
    wanted = f"{ledger}/run={run}" if run else ledger
    if not workspace.exists(spark, wanted):
        return spark.createDataFrame([], _CLAIM)
    return spark.read.schema(_CLAIM).option("basePath", ledger).parquet(wanted)


def claim(files: DataFrame, folder: str, run: str) -> None:
    """Note files as taken by a run, before anything else is done with them.

    The tasks that found the files write them. If that dies half-way, the files noted so far are
    those of the run and the others are still to be taken.
    """
    spark = files.sparkSession
    workspace.mark(spark, f"{folder}/{_LEDGER}/open/{run}")
    files.write.mode("overwrite").parquet(f"{folder}/{_LEDGER}/files/run={run}")


def set_aside(spark: SparkSession, folder: str, run: str, refused: dict[str, str]) -> None:
    """Note which files of a run cannot be used, before anything is done with the others."""
    rows = [(path, reason, run) for path, reason in sorted(refused.items())]
    noted = spark.createDataFrame(rows, _SET_ASIDE).coalesce(1)
    noted.write.mode("overwrite").parquet(f"{folder}/{_LEDGER}/aside/{run}")


def files_set_aside(spark: SparkSession, folder: str, run: str | None = None) -> DataFrame:
    """The files that runs could not use, and why: path, reason, run."""
    folders = workspace.matching(spark, f"{folder}/{_LEDGER}/aside/{run or '*'}/_SUCCESS")
    if not folders:
        return spark.createDataFrame([], _SET_ASIDE)
    return spark.read.schema(_SET_ASIDE).parquet(*[p.rsplit("/", 1)[0] for p in folders])


def usable_layouts(
    spark: SparkSession,
    folder: str,
    run: str,
    paths: list[str],
    reserved: tuple[str, ...] = (),
) -> tuple[dict[tuple[str, ...], list[str]], set[str]]:
    """The files of a run by header, and those set aside.

    What a run has once set aside stays so when it is repeated, since the others may be counted.
    """
    known = {r.path: r.reason for r in files_set_aside(spark, folder, run).collect()}
    layouts, refused = sort_by_header(spark, [p for p in paths if p not in known], reserved)
    set_aside(spark, folder, run, known | refused)
    return layouts, set(known | refused)


def finish_run(spark: SparkSession, folder: str, run: str) -> None:
    workspace.remove(spark, f"{folder}/{_LEDGER}/open/{run}")


def unfinished_runs(spark: SparkSession, folder: str) -> list[str]:
    """Runs that took files and did not get to their end. Lists open runs only."""
    marks = workspace.matching(spark, f"{folder}/{_LEDGER}/open/*")
    return sorted(path.rsplit("/", 1)[1] for path in marks)


def compact_claims(spark: SparkSession, folder: str, least: int = 100) -> bool:
    """Put the claims of finished runs into one folder once there are `least` of them.

    The merged claims are written before the others are removed; a file that is noted twice in
    between is taken all the same.
    """
    still_open = set(unfinished_runs(spark, folder))
    places = workspace.matching(spark, f"{folder}/{_LEDGER}/files/run=*")
    places = [place for place in places if place.rsplit("=", 1)[1] not in still_open]
    if len(places) < least:
        return False
    ledger = f"{folder}/{_LEDGER}/files"
    closed = spark.read.schema(_CLAIM).option("basePath", ledger).parquet(*places).drop("run")
    closed.distinct().write.parquet(f"{ledger}/run={uuid.uuid4().hex}")
    for place in places:
        workspace.remove(spark, place)
    return True
