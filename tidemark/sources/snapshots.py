"""Landed snapshot files: tolerant load, quarantine, load statistics, lake scans."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import COMPACT, hadoop_fs
from tidemark.sinks import commits
from tidemark.sinks.commits import CommitConflict, Entry

Schema = str | T.StructType

CORRUPT = "_corrupt_record"
JSON_FILES = "*.json*"  # also matches compressed files such as x.json.gz

# fixed values: attributes of the snapshot payload
CONTRACT_DDL = (
    "id BIGINT, name STRING, contractId BIGINT, contractName STRING, status STRING, "
    "lastTradePrice DECIMAL(10,4), bestBuyYesCost DECIMAL(10,4), bestSellYesCost DECIMAL(10,4), "
    "bestBuyNoCost DECIMAL(10,4), bestSellNoCost DECIMAL(10,4), lastClosePrice DECIMAL(10,4), displayOrder INT"
)
MARKET_DDL = (
    "id BIGINT, name STRING, shortName STRING, url STRING, status STRING, "
    f"contracts ARRAY<STRUCT<{CONTRACT_DDL}>>"
)
SNAPSHOT_SCHEMA = f"extracted_at TIMESTAMP_NTZ, source STRING, data STRUCT<markets: ARRAY<STRUCT<{MARKET_DDL}>>>"

ON_ERROR = {"CONTINUE": "PERMISSIVE", "ABORT_STATEMENT": "FAILFAST"}


@dataclass(frozen=True)
class Location:
    """A named place with files of one format. Credentials belong to the Hadoop configuration."""

    name: str
    path: str
    file_format: str = "json"

    def read(self, spark: SparkSession, schema: Schema | None = None, **options: str) -> DataFrame:
        return read_files(spark, self.path, self.file_format, schema, **options)


def read_files(
    spark: SparkSession, path: str | list[str], file_format: str, schema: Schema | None = None, **options: str
) -> DataFrame:
    """Read JSON, CSV or Parquet files."""
    fmt = file_format.lower()
    if fmt not in ("json", "csv", "parquet"):
        raise ValueError(f"Unsupported format: {file_format}")
    if fmt == "csv":
        options.setdefault("header", "true")
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def with_corrupt_text(schema: Schema) -> Schema:
    if isinstance(schema, str):
        return f"{schema}, {CORRUPT} STRING"
    return T.StructType([*schema.fields]).add(CORRUPT, "string")


def moments_as_text(schema: Schema) -> tuple[Schema, list[str]]:
    """The schema with its TIMESTAMP_NTZ columns as text, and their names."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    moments = [f.name for f in fields if isinstance(f.dataType, T.TimestampNTZType)]
    if not moments:
        return schema, moments
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in moments else f for f in fields]), moments


_ZONE = r"(?i)(Z|[+-]\d\d:?\d\d)\s*$"


def with_moments(documents: DataFrame, moments: list[str], tolerant: bool) -> DataFrame:
    """Text columns as TIMESTAMP_NTZ in UTC: with or without an offset. Other text makes a document unreadable."""
    for name in moments:
        text = F.col(f"`{name}`")
        # most texts have no offset; three characters tell, and only what may have one is matched and cast with its zone
        signs = [F.substring(text, place, 1).isin("+", "-") for place in (-6, -5)]
        may_have = signs[0] | signs[1] | F.substring(text, -1, 1).isin("Z", "z", *" \t\r\n\f\v")
        point = text.try_cast("timestamp")
        zoned = F.convert_timezone(F.current_timezone(), F.lit("UTC"), point.cast("timestamp_ntz"))
        local = text.try_cast("timestamp_ntz") if tolerant else text.cast("timestamp_ntz")
        has = may_have & F.rlike(text, F.lit(_ZONE)) & point.isNotNull()
        moment = F.when(has, zoned).otherwise(local)
        if tolerant:
            lost = text.isNotNull() & ~has & local.isNull()  # a point in time is never lost
            said = F.concat(F.lit(f"{name}: "), text)
            documents = documents.withColumn(CORRUPT, F.coalesce(F.col(CORRUPT), F.when(lost, said)))
        documents = documents.withColumn(name, moment)
    return documents


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    on_error: str = "CONTINUE",
    pattern: str = JSON_FILES,
    file_regex: str | None = None,
    one_per_file: bool = True,
    schema: Schema = SNAPSHOT_SCHEMA,
) -> DataFrame:
    """Typed documents with ``source_file``, ``loaded_at`` and the text of unreadable ones.

    ``one_per_file`` reads each file as one document or an outer array of them. Files with one
    document per line (``False``) can be split, so prefer them for large landings.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"Unsupported on_error: {on_error}")
    tolerant = on_error == "CONTINUE"
    schema, moments = moments_as_text(schema)
    if tolerant:
        schema = with_corrupt_text(schema)
    documents = (
        spark.read.schema(schema)
        .option("mode", ON_ERROR[on_error])
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", one_per_file)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .json(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
        .withColumn("loaded_at", F.localtimestamp())
    )
    documents = with_moments(documents, moments, tolerant)
    return documents if file_regex is None else documents.filter(F.col("source_file").rlike(file_regex))


def is_unreadable(documents: DataFrame) -> Column:
    """True for documents the reader could not parse.

    The reader reports errors of parsed fields only, and fields that no one asks for are not parsed.
    So the test names every payload column as a whole: the same document is unreadable whatever
    is selected, counted or summed up. The hash is computed for unreadable documents alone.
    """
    if CORRUPT not in documents.columns:
        return F.lit(False)
    added = (CORRUPT, "source_file", "loaded_at", "year", "month", "day")
    payload = [f for f in documents.schema.fields if f.name not in added]
    plain = [
        F.col(f"`{f.name}`").cast("string") if isinstance(f.dataType, (T.VariantType, T.MapType)) else F.col(f"`{f.name}`")
        for f in payload
    ]
    return F.col(CORRUPT).isNotNull() & (F.xxhash64(*plain) >= F.lit(-(2**63)))


def file_statistics(documents: DataFrame) -> DataFrame:
    """Documents loaded and errors seen per file."""
    return (
        documents.select("source_file", is_unreadable(documents).alias("_bad"))
        .groupBy("source_file")
        .agg(F.count_if(~F.col("_bad")).alias("rows_loaded"), F.count_if("_bad").alias("errors_seen"))
    )


def load_statistics(documents: DataFrame) -> DataFrame:
    """One row: files loaded, rows loaded, errors seen."""
    return file_statistics(documents).agg(
        F.count("*").alias("files_loaded"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded"),
        F.coalesce(F.sum("errors_seen"), F.lit(0)).alias("errors_seen"),
    )


@dataclass(frozen=True)
class Load:
    good: DataFrame
    quarantined: DataFrame
    stats: DataFrame


def load_snapshots(spark: SparkSession, path: str | list[str], **options) -> Load:
    """Readable documents, unreadable ones with their text, and per-file statistics."""
    documents = read_documents(spark, path, **options)
    bad = is_unreadable(documents)
    kept = [c for c in documents.columns if c != CORRUPT]
    lost = ["source_file", "loaded_at", *([CORRUPT] if CORRUPT in documents.columns else [])]
    return Load(
        good=documents.filter(~bad).select(*kept),
        quarantined=documents.filter(bad).select(*[c for c in ("extracted_at",) if c in documents.columns], *lost),
        stats=file_statistics(documents),
    )


def land_snapshots(
    spark: SparkSession, path: str | list[str], target: str, packing: Mapping[str, str] = COMPACT, **options
) -> dict[str, int]:
    """Load into Parquet in one pass over the files: ``unreadable=false`` and ``=true`` folders.

    Returns the rows loaded and errors seen, counted during the write.
    """
    documents = read_documents(spark, path, **options)
    seen = Observation("load")
    (
        documents.withColumn("unreadable", is_unreadable(documents))
        .observe(
            seen,
            F.count_if(~F.col("unreadable")).alias("rows_loaded"),
            F.count_if("unreadable").alias("errors_seen"),
        )
        .write.mode("overwrite")
        .options(**packing)
        .partitionBy("unreadable")
        .parquet(target)
    )
    return seen.get


def listed_files(spark: SparkSession, path: str, file_regex: str | None = None) -> DataFrame:
    """path, size and modified of the files a reader would take, from the listing alone: no file is opened."""
    files = spark.read.format("binaryFile").load(path)
    files = files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    return files if file_regex is None else files.filter(F.col("path").rlike(file_regex))


def loaded_files(spark: SparkSession, target: str, entry: Entry | None = None) -> DataFrame:
    """The ledger of a table filled by ``copy_into``: path, size, modified and load of every file taken."""
    entry = entry or commits.current(spark, target)
    folders = [f"{target}/{folder}" for folder in entry.content["ledger"]] if entry else []
    if not folders:
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(*folders)


_LEDGER = "path STRING, size BIGINT, modified TIMESTAMP, load STRING"
_LEDGER_FOLDERS = 32


def copy_into(
    spark: SparkSession,
    location: Location,
    target: str,
    schema: Schema,
    file_regex: str | None = None,
    on_error: str = "CONTINUE",
    force: bool = False,
    before_commit: Callable[[], None] | None = None,
) -> dict[str, int]:
    """Append files of a location to a Parquet table; returns files_loaded, rows_loaded, errors_seen.

    Files in the ledger of the table are left out before any file is opened, unless ``force`` is set; a file whose size or
    time has changed counts as new. Rows that cannot be read go to the ``unreadable=true`` part of the load. Each call writes its own
    ``load=`` folder and its ledger, and both count once the commit log names them: a call that fails leaves nothing
    behind that readers see, and of two calls at once that take the same file the second begins again without it.
    The paths of the new files pass through the driver, as they do in any file scan.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"Unsupported on_error: {on_error}")
    nothing = {"files_loaded": 0, "rows_loaded": 0, "errors_seen": 0}
    while True:
        entry = commits.current(spark, target)
        listing = listed_files(spark, location.path, file_regex)
        same_file = ["path", "size", "modified"]
        fresh = listing if force else listing.join(loaded_files(spark, target, entry), same_file, "left_anti")
        files = sorted(tuple(r) for r in fresh.collect())
        if not files:
            return nothing
        load = f"load-{uuid.uuid4().hex}"
        facts = _load_files(spark, location, [f[0] for f in files], target, load, schema, on_error)
        ledger = spark.createDataFrame([(*f, load) for f in files], _LEDGER)
        ledger.write.parquet(f"{target}/_ledger/{load}")
        if before_commit is not None:
            before_commit()
        if _commit_load(spark, target, entry, load, ledger if not force else None):
            return facts


def _load_files(
    spark: SparkSession, location: Location, paths: list[str], target: str, load: str, schema: Schema, on_error: str
) -> dict[str, int]:
    """Write the rows of some files as one load and count them."""
    options, textual = {}, location.file_format.lower() in ("json", "csv")
    if textual:
        options = {"mode": ON_ERROR[on_error], "columnNameOfCorruptRecord": CORRUPT}
        if on_error == "CONTINUE":
            schema = with_corrupt_text(schema)
    fs, root = hadoop_fs(spark, location.path)
    if not any(c in location.path for c in "*?[{") and fs.getFileStatus(root).isDirectory():
        options["basePath"] = location.path  # folders such as year=2024 stay columns
    rows = read_files(spark, paths, location.file_format, schema, **options).withColumn("source_file", F.col("_metadata.file_path"))
    seen = Observation("load")
    (
        rows.withColumns({"loaded_at": F.localtimestamp(), "unreadable": is_unreadable(rows)})
        .observe(
            seen,
            F.count_if(~F.col("unreadable")).alias("rows_loaded"),
            F.count_if("unreadable").alias("errors_seen"),
        )
        .write.partitionBy("unreadable")
        .parquet(f"{target}/load={load}")
    )
    return {"files_loaded": len(paths), **seen.get}


def _commit_load(spark: SparkSession, target: str, entry: Entry | None, load: str, ledger: DataFrame | None) -> bool:
    """Make a load visible; False, with its rows removed, if another load has taken one of its files first."""
    start = entry
    while True:
        loads = entry.content["loads"] if entry else []
        folders = entry.content["ledger"] if entry else []
        if len(folders) >= _LEDGER_FOLDERS:  # many loads: their ledgers become one
            folders = [f"_ledger/all-{uuid.uuid4().hex}"]
            loaded_files(spark, target, entry).write.parquet(f"{target}/{folders[0]}")
        try:
            commits.commit(spark, target, entry, {"loads": [*loads, load], "ledger": [*folders, f"_ledger/{load}"]})
            return True
        except CommitConflict:
            entry = commits.current(spark, target)
            theirs = entry.content["loads"][len(start.content["loads"]) if start else 0 :]
            taken = loaded_files(spark, target, entry).where(F.col("load").isin(theirs))
            if ledger is not None and not ledger.drop("load").join(taken, ["path", "size", "modified"], "left_semi").isEmpty():
                for folder in (f"load={load}", f"_ledger/{load}"):
                    fs, path = hadoop_fs(spark, f"{target}/{folder}")
                    fs.delete(path, True)
                return False


def copied(spark: SparkSession, target: str) -> DataFrame:
    """All rows of the committed loads of a table filled by ``copy_into``, with ``load`` and ``unreadable``."""
    entry = commits.current(spark, target)
    if entry is None:
        raise FileNotFoundError(target)
    folders = [f"{target}/load={load}" for load in entry.content["loads"]]
    return spark.read.option("basePath", target).option("mergeSchema", True).parquet(*folders)


def read_copied(spark: SparkSession, target: str) -> DataFrame:
    """Readable rows of a table filled by ``copy_into``."""
    rows = copied(spark, target).filter(F.col("unreadable").cast("string") == "false")
    return rows.drop("load", "unreadable", CORRUPT)


def in_days(first: date, last: date) -> Column:
    """Partition predicate over year, month and day folders, both ends included."""
    landed = F.make_date(F.col("year"), F.col("month"), F.col("day"))
    return landed.between(F.lit(first), F.lit(last))


def read_lake(
    spark: SparkSession,
    path: str,
    first: date | None = None,
    last: date | None = None,
    schema: Schema = SNAPSHOT_SCHEMA,
    on_error: str = "CONTINUE",
) -> DataFrame:
    """Documents, one a line, under ``year=/month=/day=`` folders; days outside the range are not listed as input.

    As ``read_documents`` has them: timestamps with or without offset, ``source_file`` and ``loaded_at``, and the text of an
    unreadable line in a row of its own, which ``is_unreadable`` tells from the others.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"Unsupported on_error: {on_error}")
    tolerant = on_error == "CONTINUE"
    schema, moments = moments_as_text(schema)
    lake = (
        spark.read.schema(with_corrupt_text(schema) if tolerant else schema)
        .option("mode", ON_ERROR[on_error])
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
        .withColumn("loaded_at", F.localtimestamp())
    )
    lake = with_moments(lake, moments, tolerant)
    if first is None and last is None:
        return lake
    return lake.filter(in_days(first or date.min, last or date.max))


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Zero-byte files under a path. File sources skip those silently."""
    fs, root = hadoop_fs(spark, path)
    if not fs.exists(root):
        raise FileNotFoundError(path)
    found, files = [], fs.listFiles(root, True)
    while files.hasNext():
        status = files.next()
        name = status.getPath().getName()
        if status.getLen() == 0 and not name.startswith(("_", ".")):
            found.append(status.getPath().toString())
    return found
