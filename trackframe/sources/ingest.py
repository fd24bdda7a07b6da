"""Ingest any number of drifting wave CSVs without column misalignment.

Reading a folder of CSVs in one ``spark.read.csv`` applies *one* header
positionally to every file: a file whose columns come in another order is
silently misread. Reading one file at a time is correct but costs a job and a
plan branch per file. Instead:

1. one Spark job reads the first bytes of every file, many files to a task, and writes
   ``(file, header)`` to the shared folder (``wave_file_headers``);
2. the driver sees each *distinct* header once and works out at which position it has
   each contract column, renames included: the header dictionary;
3. one CSV scan reads all files by position, as text; a join with the dictionary by file gives every row
   the positions of its columns, which pick its fields;
4. the picked columns are harmonised and tagged by the contract.

So neither the plan nor the number of scans grows with files or headers, and the driver holds no row per
file. Parsing stays in Spark's CSV reader; no data row passes through Python.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from fnmatch import fnmatchcase

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trackframe.config import TrackerConfig
from trackframe.operators.contract import (
    CANONICAL_CONTRACT,
    REJECT_REASON,
    Contract,
    match_columns,
    split_tagged,
    tag_rows,
)
from trackframe.operators.harmonise import harmonise, resolve_renames
from trackframe.session import drop_path, scratch_path

SOURCE_FILE = "source_file"
# Header tasks aimed at, bytes read of a file at first, and lines a task asks of a file only Spark can open.
HEADER_TASKS, HEADER_BYTES, HEADER_LINES = 32, 1 << 16, 16


def _paths(input_path: str | Sequence[str]) -> list[str]:
    return [input_path] if isinstance(input_path, str) else list(input_path)


def _plain(file_path: F.Column) -> F.Column:
    """``_metadata.file_path`` (URL-encoded) as the path that listings and readers use."""
    return F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


def list_wave_files(spark: SparkSession, input_path: str | Sequence[str], *, pattern: str = "*.csv",
                    recursive: bool = False) -> DataFrame:
    """``(file_path, file_size, modified)`` of the matching files that hold anything, from the listing alone.

    The ``binaryFile`` source reads no content when ``content`` is not
    selected, so this costs a directory listing, not a scan.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(_paths(input_path)).select(
        F.col("path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified"))


def _python_reads(path: str) -> bool:
    """Whether Python workers can open files like this one: local (or mounted) ones, or a store Arrow has a client for."""
    if path.startswith(("/", "file:")):
        return True
    try:
        fs, inner = pa.fs.FileSystem.from_uri(path)
        return fs.get_file_info(inner).type == pa.fs.FileType.File
    except Exception:  # noqa: BLE001 - no client for this scheme: Spark reads the headers
        return False


def _first_line(path: str) -> str | None:
    """The first non-blank line of a file, from as few leading bytes as hold it; Spark's CSV reader skips blank ones, too."""
    from pyarrow import fs as arrow_fs

    if path.startswith(("/", "file:")):
        fs, inner = arrow_fs.LocalFileSystem(), re.sub("^file:/*", "/", path)
    else:
        fs, inner = arrow_fs.FileSystem.from_uri(path)
    with fs.open_input_stream(inner, compression="detect") as stream:
        held, size = b"", HEADER_BYTES
        while True:
            more = stream.read(size)
            held, size = held + more, 2 * size
            lines = re.split(rb"\r\n|\n|\r", held)
            # The last one may go on beyond the bytes read.
            for line in lines if not more else lines[:-1]:
                if line.strip():
                    return line.decode("utf-8", "replace")
            if not more:
                return None


def _probe_session(spark: SparkSession, **settings) -> SparkSession:
    """A session of its own for a header job: files are never split, and packed into few tasks unless ``settings`` say otherwise."""
    probe = spark.newSession()
    conf = {"spark.sql.files.maxPartitionBytes": (1 << 63) - 1, "spark.sql.files.openCostInBytes": 1 << 10,
            "spark.sql.files.minPartitionNum": HEADER_TASKS, **settings}
    for key, value in conf.items():
        probe.conf.set(key, str(value))
    return probe


def _headers_by_python(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """First lines of the listed files, many files to a task."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(p, h) for p in batch.column(0).to_pylist() if (h := _first_line(p)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], ["file_path", "header"])
    return listing.select("file_path").mapInArrow(read, "file_path string, header string")


def _headers_by_spark(spark: SparkSession, input_path: str | Sequence[str], pattern: str, recursive: bool) -> DataFrame:
    """First lines through Spark's text source, for stores only Spark reads.

    Every file is a task that takes a few lines at a time and stops at the first that is not blank.
    """
    probe = _probe_session(spark, **{"spark.sql.files.openCostInBytes": 1 << 62, "spark.sql.files.minPartitionNum": 1,
                                     "spark.sql.execution.arrow.maxRecordsPerBatch": HEADER_LINES})
    lines = _reader(probe, pattern, recursive).text(_paths(input_path)).select("value", _plain(F.col("_metadata.file_path")).alias("file_path"))

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if value.strip():
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([value])], ["file_path", "header"])
                    return
    return lines.mapInArrow(first_line, "file_path string, header string")


def _reader(spark: SparkSession, pattern: str, recursive: bool):
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def wave_file_headers(spark: SparkSession, input_path: str | Sequence[str], *, pattern: str = "*.csv",
                      recursive: bool = False) -> DataFrame:
    """``(file_path, header)``: the first non-blank line of every matching non-empty file.

    One job, written as a small table to the shared folder, which the result reads (``staged_headers`` removes it after use).
    """
    listing = list_wave_files(_probe_session(spark), input_path, pattern=pattern, recursive=recursive)
    # Plain and file: paths need no look at a file.
    direct = all(p.startswith(("/", "file:")) for p in _paths(input_path))
    if not direct:
        one = listing.select("file_path").first()
        direct = one is not None and _python_reads(one["file_path"])
    found = _headers_by_python(spark, listing) if direct else _headers_by_spark(spark, input_path, pattern, recursive)
    path = scratch_path(spark, "headers")
    found.write.parquet(path)
    return spark.read.schema("file_path string, header string").parquet(path)


@contextmanager
def staged_headers(spark: SparkSession, input_path: str | Sequence[str], *, pattern: str = "*.csv",
                   recursive: bool = False) -> Iterator[DataFrame]:
    """``wave_file_headers`` whose table is removed on exit."""
    headers = wave_file_headers(spark, input_path, pattern=pattern, recursive=recursive)
    folders = {f.rsplit("/", 1)[0] for f in headers.inputFiles()[:1]}
    try:
        yield headers
    finally:
        for folder in folders:
            drop_path(spark, folder)


def parse_header(header: str, sep: str = ",", quote: str = '"') -> tuple[str, ...]:
    """Column names of a CSV header line: BOM removed, names trimmed, blanks and repeats (in any case) made unique."""
    fields = next(csv.reader([header.lstrip("\ufeff").rstrip("\r")], delimiter=sep, quotechar=quote), [])
    names: list[str] = []
    taken = {f.strip().lower() for f in fields}
    seen: set[str] = set()
    for i, raw in enumerate(fields):
        name = base = raw.strip() or f"_c{i}"
        k = 2
        while name.lower() in seen or name != base and name.lower() in taken:
            name, k = f"{base}_{k}", k + 1
        seen.add(name.lower())
        names.append(name)
    return tuple(names)


def header_dictionary(headers: Iterable[str], config: TrackerConfig, columns: Sequence[str],
                      csv_options: Mapping[str, str] | None = None) -> dict[str, tuple[int, list[int | None]]]:
    """For each distinct header line its width, and the position at which it has each of ``columns`` (None: not at all).

    Renames apply first; names match exactly or else trimmed and without regard to case, as in the contract.
    """
    opts = dict(csv_options or {})
    sep, quote = opts.get("sep", opts.get("delimiter", ",")), opts.get("quote", '"')
    found = {}
    for header in headers:
        names = resolve_renames(parse_header(header, sep, quote), config.rename_map)
        present = match_columns(names, columns)
        found[header] = (len(names), [names.index(present[c]) if c in present else None for c in columns])
    return found


def discover_wave_files(spark: SparkSession, input_path: str | Sequence[str], *, pattern: str = "*.csv",
                        recursive: bool = False) -> list[str]:
    """Sorted paths of the wave files under ``input_path``, empty ones included (empty list if none).

    A listing by the path's own file system; Spark's sources leave empty files out of theirs.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found: set[str] = set()
    for root in _paths(input_path):
        path = jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(conf)
        for status in fs.globStatus(path) or []:
            if status.isFile():
                found.add(status.getPath().toString())
                continue
            listing = fs.listFiles(status.getPath(), recursive)
            while listing.hasNext():
                found.add(listing.next().getPath().toString())
    names = ((f, f.rsplit("/", 1)[-1]) for f in found)
    return sorted(f for f, name in names if fnmatchcase(name, pattern or "*") and not name.startswith(("_", ".")))


def read_by_header(spark: SparkSession, input_path: str | Sequence[str], headers: DataFrame, config: TrackerConfig,
                   columns: Sequence[str], *, pattern: str = "*.csv", recursive: bool = False,
                   csv_options: Mapping[str, str] | None = None) -> DataFrame | None:
    """All files' ``columns`` as text, plus ``source_file`` (the path), by one CSV scan; None if no file has a header.

    ``csv_options`` are passed to Spark's CSV reader (``sep``, ``quote``,
    ``encoding``, ``multiLine`` ...); header, schema enforcement and the
    all-text schema are fixed here. Files that came after ``headers`` were read are not part of it.
    """
    known = header_dictionary([r["header"] for r in headers.select("header").distinct().collect()], config, columns, csv_options)
    if not known:
        return None
    places = spark.createDataFrame([(h, at) for h, (_, at) in sorted(known.items())], "header string, __at array<int>")
    files = headers.join(places, "header").select(F.col("file_path").alias("__file"), "__at")
    schema = StructType([StructField(f"_c{i}", StringType(), True) for i in range(max(width for width, _ in known.values()))])
    reader = _reader(spark, pattern, recursive).options(**{"mode": "PERMISSIVE", **dict(csv_options or {})})
    raw = (reader.schema(schema).option("header", "true").option("enforceSchema", "true")
           .option("inferSchema", "false").csv(_paths(input_path)))
    rows = raw.select(F.array(*raw.columns).alias("__fields"), _plain(F.col("_metadata.file_path")).alias(SOURCE_FILE))
    placed = rows.join(files, F.col(SOURCE_FILE) == F.col("__file"))
    return placed.select(*[F.get("__fields", F.get("__at", F.lit(i))).alias(c) for i, c in enumerate(columns)], SOURCE_FILE)


def ingest_tagged(
    spark: SparkSession,
    input_path: str | Sequence[str],
    config: TrackerConfig | None = None,
    *,
    contract: Contract = CANONICAL_CONTRACT,
    only_waves: Iterable[int] | None = None,
    pattern: str = "*.csv",
    recursive: bool = False,
    keep_source: bool = False,
    keep_raw: bool = False,
    csv_options: Mapping[str, str] | None = None,
    headers: DataFrame | None = None,
) -> DataFrame:
    """Every wave file as contract-tagged rows (``reject_reason`` null = clean).

    Raises ``FileNotFoundError`` when no file matches. ``only_waves`` keeps
    those waves only (rows with a null wave never match). Files without any
    line add no rows; if all are such, the result is empty. ``headers`` are the files' (``staged_headers``);
    without them they are read here, and their small table stays in the shared folder for as long as the result may be used.
    """
    config = config or TrackerConfig()
    if headers is None:
        headers = wave_file_headers(spark, input_path, pattern=pattern, recursive=recursive)
    carry = (SOURCE_FILE,) if keep_source else ()
    raw = read_by_header(spark, input_path, headers, config, contract.columns, pattern=pattern, recursive=recursive, csv_options=csv_options)
    if raw is None:
        if not discover_wave_files(spark, input_path, pattern=pattern, recursive=recursive):
            raise FileNotFoundError(f"no wave files ({pattern}) found in {input_path!r}")
        raw = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in (*contract.columns, SOURCE_FILE)))
    tagged = tag_rows(harmonise(raw, recode_maps=config.value_maps()), contract, strict_parse=config.strict_parse, keep_raw=keep_raw, carry=carry)
    if only_waves is not None:
        tagged = tagged.where(F.col("wave").isin(list(only_waves)))
    return tagged


def ingest_waves(
    spark: SparkSession,
    input_path: str | Sequence[str],
    config: TrackerConfig | None = None,
    only_waves: Iterable[int] | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejects)`` over every wave file; see ``ingest_tagged`` for options."""
    contract = options.get("contract", CANONICAL_CONTRACT)
    tagged = ingest_tagged(spark, input_path, config, only_waves=only_waves, **options)
    clean, rejects = split_tagged(tagged, contract.columns)
    return clean, rejects


__all__ = [
    "REJECT_REASON",
    "discover_wave_files",
    "header_dictionary",
    "ingest_tagged",
    "ingest_waves",
    "list_wave_files",
    "parse_header",
    "read_by_header",
    "staged_headers",
    "wave_file_headers",
]
