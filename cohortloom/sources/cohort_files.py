"""Cohort folders: one sub-folder per entity holding its text, index and headers.

Layout: ``<root>/<entity>/*.txt`` (``Key: value`` lines), ``*.tsv`` (recording index
with a header row), ``*.hea`` (recording headers). Folders written by Spark are named
``entity_id=<entity>``; both spellings are read, and so are folders directly below the root whose
names start with ``_`` or ``.``, which Spark's readers pass over unless they are named.

Below a mounted root the tasks list, read and write the files themselves: Spark's readers hold every
file in the driver and open some 30 of them in a task.
"""

from __future__ import annotations

import os
import re
import stat
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import text as tx
from cohortloom.operators.scale import running_total, written_table

# The header names of a recording index file.
INDEX_COLUMNS = {"hour": "Hour", "time": "Time", "quality": "Quality", "record_id": "Record"}
_INDEX_TYPES = {"hour": "int", "time": "string", "quality": "float", "record_id": "string"}
# Names and bytes of files that a task which lists or reads folders holds at once.
_NAMES, _HELD_BYTES = 10_000, 4 << 20


def _decoded(text: Column) -> Column:
    """Percent escapes resolved; a plus sign stands for itself."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _entity_of(path: Column) -> Column:
    """Entity of a file by its folder's name, which Spark's writers escape after the label."""
    folder = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    label = "entity_id="
    escaped = F.substring(folder, len(label) + 1, 1 << 20)
    return F.when(folder.startswith(label), _decoded(escaped)).otherwise(folder)


def _load(reader: DataFrameReader, root: str) -> DataFrame:
    """Files below the root, at any depth; hidden folders directly below it are named one by one."""
    reader = reader.option("recursiveFileLookup", True)
    hidden = f"{root.rstrip('/')}/[_.]*/*"
    try:
        return reader.load([root, hidden])
    except AnalysisException as error:
        # A pattern without a match is an error; if the root is the one missing, so it stays.
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return reader.load(root)


def _local_root(spark: SparkSession, root: str) -> str | None:
    """The root's path if it is one folder that tasks can list; a pattern is left to Spark."""
    local = _local_path(spark, root)
    return local if local and not re.search(r"[{}\[\]*?\\]", local) and os.path.isdir(local) else None


def _is_hidden(name: str, is_folder: bool) -> bool:
    """Whether Spark's readers pass over a file or a folder of this name."""
    marked = name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")
    return marked and not (is_folder and name.startswith(("_metadata", "_common_metadata")))


def _files_at(path: str, suffix: str, named: bool) -> Iterator[tuple[str, int]]:
    """Paths and sizes of the files that Spark's readers find at a path, which is named or itself found."""
    name = os.path.basename(path)
    try:
        held = os.stat(path)
    except FileNotFoundError:
        # A link to nothing is passed over; what is gone since it was listed raises again.
        os.lstat(path)
        return
    if stat.S_ISDIR(held.st_mode):
        if named or not _is_hidden(name, True):
            for inner in os.listdir(path):
                yield from _files_at(f"{path}/{inner}", suffix, False)
    elif held.st_size and name.endswith(suffix) and not _is_hidden(name, False):
        yield path, held.st_size


def _mounted_files(spark: SparkSession, root: str, suffix: str = "", whole: bool = False) -> DataFrame:
    """path and, if asked for, value of every file that holds bytes below a mounted root, by many tasks.

    One task streams the names in the root; the others get a share of them each and list what lies below.
    """

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            with os.scandir(root) as entries:
                while some := [entry.name for entry in islice(entries, _NAMES)]:
                    yield pa.record_batch([pa.array(some, pa.string())], names=["name"])

    def found(name: str) -> Iterator[tuple[str, int]]:
        path = f"{root}/{name}"
        if name[0] in "_." and os.path.isdir(path):
            for inner in os.listdir(path):
                yield from _files_at(f"{path}/{inner}", suffix, True)
        else:
            yield from _files_at(path, suffix, False)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, values, held = [], [], 0

        def batch() -> pa.RecordBatch:
            columns = [pa.array(paths, pa.string())] + [pa.array(values, pa.binary())] * whole
            return pa.record_batch(columns, names=["path", "value"][: len(columns)])

        for given in batches:
            for name in given[0].to_pylist():
                for path, size in found(name):
                    if paths and (held + size > _HELD_BYTES or len(paths) == _NAMES):
                        yield batch()
                        paths, values, held = [], [], 0
                    paths.append(path)
                    if whole:
                        with open(path, "rb") as file:
                            values.append(file.read())
                        held += size
        yield batch()

    tasks = 4 * spark.sparkContext.defaultParallelism
    listed = spark.range(0, 1, 1, 1).mapInArrow(names, "name string").repartition(tasks, "name")
    return listed.mapInArrow(read, "path string, value binary" if whole else "path string")


def _whole_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    local = _local_root(spark, root)
    if local is None:
        path = _decoded(F.col("_metadata.file_path"))
        reader = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", f"*{suffix}")
        files = _load(reader, root)
    else:
        path = F.col("path")
        files = _mounted_files(spark, local, suffix, whole=True)
    return (
        files
        .select(
            _entity_of(path).alias("entity_id"),
            F.regexp_extract(path, rf"([^/]+)\{suffix}$", 1).alias("file_name"),
            F.regexp_replace(F.col("value").cast("string"), r"\n\z", "").alias("text"),
        )
    )


def list_entities(spark: SparkSession, root: str) -> DataFrame:
    """Sorted entity folder names. Only paths are read, never file contents."""
    local = _local_root(spark, root)
    if local is None:
        # A task lists the paths of a few files only: so many of them would each write shuffle files.
        files = _load(spark.read.format("binaryFile"), root).coalesce(4 * spark.sparkContext.defaultParallelism)
    else:
        files = _mounted_files(spark, local)
    return files.select(_entity_of(F.col("path")).alias("entity_id")).distinct().orderBy("entity_id")


def read_entity_text(spark: SparkSession, root: str) -> DataFrame:
    return _whole_files(spark, root, ".txt").select("entity_id", "text")


def read_record_headers(spark: SparkSession, root: str) -> DataFrame:
    """One row per header file: entity_id, record_id (the file name), text."""
    files = _whole_files(spark, root, ".hea")
    return files.select("entity_id", F.col("file_name").alias("record_id"), "text")


def read_recording_index(spark: SparkSession, root: str) -> DataFrame:
    """Typed index rows; ``seq`` is the position of the row in its file."""
    return recording_columns(_whole_files(spark, root, ".tsv").select("entity_id", "text"))


def recording_columns(index_text: DataFrame, sep: str = "\t") -> DataFrame:
    """Typed columns of index files given as (entity_id, text).

    Columns are found by header name, cells by position: an empty cell is NULL and does
    not shift the cells after it. Blank lines are skipped.
    """
    lines = F.filter(F.split("text", "\n"), lambda line: tx.strip(line) != "")
    header = F.transform(F.split(F.get("lines", F.lit(0)), sep), tx.strip)
    rows = (
        index_text.select("entity_id", lines.alias("lines"))
        .select(
            "entity_id",
            header.alias("header"),
            F.posexplode(F.expr("slice(lines, 2, size(lines))")).alias("seq", "line"),
        )
        .withColumn("cells", F.split("line", sep))
    )

    def cell(out: str) -> Column:
        position = F.array_position("header", F.lit(INDEX_COLUMNS[out])) - 1
        return tx.strip(F.get("cells", position.cast("int"))).alias(out)

    def typed(out: str) -> Column:
        return tx.CASTS[_INDEX_TYPES[out]](F.when(F.col(out) != "", F.col(out))).alias(out)

    # Two steps: all of it in one is a method that takes more than twice the time.
    cells = rows.select("entity_id", "seq", *[cell(out) for out in INDEX_COLUMNS])
    return cells.select("entity_id", "seq", *[typed(out) for out in INDEX_COLUMNS])


def write_entity_text(entity_text: DataFrame, root: str) -> None:
    """One text file per entity, written by every core."""
    rows = _by_entity(entity_text.select("entity_id", "text"))
    local = _local_path(rows.sparkSession, root)
    if local is None:
        rows.write.partitionBy("entity_id").text(root)
    else:
        _write_folders(rows.sortWithinPartitions("entity_id"), local, "txt")


def _by_entity(rows: DataFrame) -> DataFrame:
    """A fixed number of partitions: small files cost time, not bytes, to write."""
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(tasks, "entity_id")


# What Spark's writers escape in the name of a folder, and the folder of a missing key.
_ESCAPED = r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]"""
_NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def _local_path(spark: SparkSession, root: str) -> str | None:
    """Path of the root, if it lies in a folder that the system of every executor mounts."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _write_folders(lines: DataFrame, root: str, extension: str, header: str | None = None) -> None:
    """(entity_id, line), sorted by entity in each task, as files in mounted folders.

    The files are those of Spark's partitioned writers, which start a process for the mode of every
    file there. A file gets its name when it is whole, so that a repeated task does no harm.
    """
    if os.path.exists(root):
        raise AnalysisException(f"[PATH_ALREADY_EXISTS] Path {root} already exists.")
    os.makedirs(root)
    first = b"" if header is None else f"{header}\n".encode()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        name = f"part-{task:05d}.{extension}"
        file, at, files = None, "", 0

        def close() -> None:
            file.close()
            os.replace(file.name, f"{at}/{name}")

        for batch in batches:
            for entity, line in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                folder = re.sub(_ESCAPED, lambda c: f"%{ord(c[0]):02X}", entity) if entity else _NO_KEY
                folder = f"{root}/entity_id={folder}"
                if folder != at:
                    if file:
                        close()
                    os.makedirs(folder, exist_ok=True)
                    file, at, files = open(f"{folder}/.{name}.{attempt}", "wb"), folder, files + 1
                    file.write(first)
                file.write(f"{line or ''}\n".encode())
        if file:
            close()
        yield pa.record_batch([pa.array([files], pa.int64())], names=["files"])

    lines.mapInArrow(write, "files long").agg(F.sum("files")).head()
    open(f"{root}/_SUCCESS", "w").close()


def write_recording_index(index: DataFrame, root: str) -> None:
    """One tab-separated file per entity, rows in ``seq`` order.

    The layout itself puts an entity's rows in one file; keep large indexes in parquet.
    """
    cells = [F.col(c).cast("string").alias(name) for c, name in INDEX_COLUMNS.items()]
    rows = _by_entity(index).sortWithinPartitions("entity_id", "seq")
    form = {"sep": "\t", "nullValue": "nan"}
    local = _local_path(index.sparkSession, root)
    if local is None:
        writer = rows.select("entity_id", *cells).write.partitionBy("entity_id")
        writer.option("extension", "tsv").csv(root, header=True, **form)
    else:
        line = F.to_csv(F.struct(*cells), form).alias("line")
        _write_folders(rows.select("entity_id", line), local, "tsv", "\t".join(INDEX_COLUMNS.values()))


COHORT_TABLES = ("entity_text", "recording_index", "samples")


def write_cohort(
    entity_text: DataFrame, index: DataFrame, samples: DataFrame, root: str
) -> None:
    """The cohort as three parquet tables: the layout for large data."""
    for name, table in zip(COHORT_TABLES, (entity_text, index, samples)):
        table.write.parquet(f"{root}/{name}")


def read_cohort(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    text, index, samples = (spark.read.parquet(f"{root}/{name}") for name in COHORT_TABLES)
    return text, index, samples


def write_label_map(labels: DataFrame, path: str) -> None:
    """(entity_id, label) as one JSON object per line, so the file stays splittable."""
    labels.select("entity_id", "label").write.option("ignoreNullFields", False).json(path)


# One "key": value member of a flat JSON object; the value keeps its quotes.
_MEMBER = r'"((?:[^"\\]|\\.)*)"\s*:\s*("(?:[^"\\]|\\.)*"|[^,{}\[\]\s]+)'


def _unquoted(string: Column) -> Column:
    """A JSON string with its escapes resolved."""
    one = F.from_json(F.concat(F.lit("["), string, F.lit("]")), "array<string>")
    return F.get(one, F.lit(0))


def numeric_labels(json_text: DataFrame, key: str | None = None, value: str = "value") -> DataFrame:
    """Numeric entries of label maps held in column ``json``.

    With ``key`` every text is one ``{key: id, value: label}`` object; without it every
    text is one flat ``{id: label}`` object. Strings and nulls are dropped, booleans
    count as 1 and 0, NaN becomes NULL.
    """
    if key is None:
        members = _members(json_text)
    else:

        def member(name: str) -> Column:
            pattern = rf'"{name}"\s*:\s*("(?:[^"\\]|\\.)*"|[^,{{}}\[\]\s]+)'
            return F.regexp_extract("json", pattern, 1)

        members = json_text.select(
            F.when(member(key).startswith('"'), _unquoted(member(key)))
            .otherwise(member(key))
            .alias("entity_id"),
            member(value).alias("raw"),
        )
    return _numbers(members)


def _members(json_text: DataFrame, *kept: str) -> DataFrame:
    """entity_id and raw value of every member of flat objects, or pieces of them, in ``json``."""
    found = F.arrays_zip(
        F.regexp_extract_all("json", F.lit(_MEMBER), F.lit(1)).alias("id"),
        F.regexp_extract_all("json", F.lit(_MEMBER), F.lit(2)).alias("raw"),
    )
    members = json_text.select(*kept, F.explode(found).alias("m"))
    return members.select(*kept, _unquoted(F.concat(F.lit('"'), "m.id", F.lit('"'))).alias("entity_id"), "m.raw")


def _numbers(members: DataFrame) -> DataFrame:
    number = tx.parse_number(F.col("raw"))
    label = F.when(F.col("raw") == "true", 1.0).when(F.col("raw") == "false", 0.0).otherwise(number)
    return (
        members.withColumn("label", label)
        .where(F.col("label").isNotNull())
        .select("entity_id", tx.nan_to_null(F.col("label")).alias("label"))
    )


def write_label_object(labels: DataFrame, path: str) -> None:
    """(entity_id, label) as one ``{id: label}`` object in ordered parts, by many tasks.

    The parts, put together in the order of their names, are the object: the first starts with the
    brace, the last ends with it. Ids are sorted; rows without an id are left out, and of a repeated
    id the largest label stays. A missing label is ``null``.
    """
    known = labels.where(F.col("entity_id").isNotNull()).groupBy(F.col("entity_id").cast("string").alias("id"))
    rows = known.agg(F.max("label").alias("label"))
    first = rows.agg(F.min("id")).head()[0]
    listed = F.to_json(F.array("id"))
    name = F.substring(listed, F.lit(2), F.length(listed) - 2)
    comma = F.when(F.col("id") == first, F.lit("")).otherwise(F.lit(",")) if first is not None else F.lit("")
    member = F.concat(comma, name, F.lit(": "), F.coalesce(F.col("label").cast("string"), F.lit("null")))
    body = rows.select(F.lit(1).alias("place"), "id", member.alias("value"))
    braces = rows.sparkSession.createDataFrame([(0, "", "{"), (2, "", "}")], "place int, id string, value string")
    body.unionByName(braces).orderBy("place", "id").select("value").write.text(path)


def label_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of flat JSON objects between commas outside strings: file, place and json.

    A file is split like any text, with the comma as the end of a line, so that one large object
    is read by many tasks. A running count of quotes tells whether a piece starts inside a string;
    such pieces are put back to the one before.
    """
    quotes = F.length(F.regexp_replace(F.regexp_replace("value", r"\\.", ""), '[^"]', ""))
    pieces = (
        spark.read.option("lineSep", ",").option("recursiveFileLookup", True).text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
            "value",
            (quotes % 2).cast("long").alias("odd"),
        )
    )
    # Rows are numbered once: the counts read what was written.
    pieces = written_table(pieces, "pieces")
    order = ["block", "row"]
    inside = running_total(pieces, F.col("odd"), "before", keys=["file"], order=order)
    starts = inside.withColumn("starts", (F.col("before") % 2 == 0).cast("long"))
    numbered = running_total(starts, F.col("starts"), "place", keys=["file"], order=order)
    # The total counts what stands before a row: one that starts a member belongs to the next.
    place = F.col("place") + F.col("starts")
    together = numbered.groupBy("file", place.alias("place")).agg(
        F.array_sort(F.collect_list(F.struct("block", "row", "value"))).alias("parts")
    )
    return together.select("file", "place", F.array_join("parts.value", ",").alias("json"))


def read_label_map(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Label maps written line by line, or as a single object per file (``object``).

    Of a name that an object repeats, the last value counts.
    """
    if layout == "object":
        members = _members(label_pieces(spark, path), "file", "place")
        last = members.groupBy("file", "entity_id").agg(F.max_by("raw", "place").alias("raw"))
        return _numbers(last)
    texts = spark.read.text(path, recursiveFileLookup=True).toDF("json")
    return numeric_labels(texts, "entity_id", "label")
