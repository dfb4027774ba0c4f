"""Stored stages that the registered queries start from.

The analysis hands over tables between its steps: raw records, clean photos, photos with
regions, and the rules mined from them.  Each is derived from the given tables by Spark and written once
per session to the shared folder, so that later queries scan flat, prunable columns.

A stage belongs to the files it was made from: their names, lengths and times are part of its key, so
changed input is derived anew.  One thread writes a stage, others wait for it.  Spark's file system
removes what a session stored when the session's JVM ends.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lenstrail.config import DATE_FIELDS
from lenstrail.operators import rules
from lenstrail.operators.clean import clean_photos
from lenstrail.operators.enrich import enrich_roi
from lenstrail.sources.derived_photos import derive_photos
from lenstrail.sources.tables import cut_lineage, file_listing, remove_at_exit, shared_folder

STAGES = ("raw", "clean", "enriched", "rules")
SOURCES = ("events", "documents")
RECORDS_A_FILE = 20_000


def _build(spark: SparkSession, folder: str, stage: str) -> DataFrame:
    if stage == "raw":
        return derive_photos(spark, folder)
    if stage == "clean":
        return clean_photos(stored(spark, folder, "raw"))
    if stage == "enriched":
        return enrich_roi(stored(spark, folder, "clean"))
    if stage == "rules":
        return rules.association_rules(rules.user_transactions(stored(spark, folder, "enriched")))
    raise ValueError(f"unknown stage {stage!r}")


Key = tuple[str, str, str, tuple]

# Paths and schemas by application, source folder, stage and the files of the sources.
_written: dict[Key, tuple[str, StructType]] = {}
_locks: dict[Key, threading.RLock] = {}
_guard = threading.Lock()


def _once(spark: SparkSession, folder: str, stage: str, write) -> tuple[str, StructType]:
    """What `write(path)` stored and its schema; it is called once for each state of the input."""
    files = tuple(file_listing(spark, f"{folder}/{name}.parquet") for name in SOURCES)
    key = (spark.sparkContext.applicationId, folder, stage, files)
    with _guard:
        lock = _locks.setdefault(key, threading.RLock())
    with lock:
        if key not in _written:
            path = scratch_path(spark, stage)
            _written[key] = path, write(path)
    return _written[key]


def scratch_path(spark: SparkSession, name: str = "scratch") -> str:
    """A new path in the shared folder, removed when the session's JVM ends."""
    root = f"{shared_folder(spark)}/stages-{spark.sparkContext.applicationId}"
    remove_at_exit(spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def stored_path(spark: SparkSession, folder: str, stage: str) -> str:
    """Where a stage's table lies, once it has been read."""
    return stored(spark, folder, stage).inputFiles()[0].rsplit("/", 1)[0]


def stored(spark: SparkSession, folder: str, stage: str) -> DataFrame:
    """Scan of a stage's table; writes it first if this session has not yet."""

    def write(path: str) -> StructType:
        df = _build(spark, folder, stage)
        df.write.parquet(path)
        return df.schema

    path, schema = _once(spark, folder, stage, write)
    return spark.read.schema(schema).parquet(path)


# --- the raw records as JSON --------------------------------------------------------


def _spelled(text: Column) -> Column:
    """The date field under its three spellings in turn."""
    name = F.get(F.array(*[F.lit(n) for n in DATE_FIELDS]), (F.xxhash64("id") % 3 + 3).cast("int") % 3)
    return F.replace(text, F.lit(f'"{DATE_FIELDS[0]}":'), F.concat(F.lit('"'), name, F.lit('":')))


def _write_lines(raw: DataFrame, path: str) -> None:
    raw.write.json(path, compression="gzip")


def _write_aliases(raw: DataFrame, path: str) -> None:
    raw.select(_spelled(F.to_json(F.struct(*raw.columns))).alias("value")).write.text(path, compression="gzip")


def _write_text_coordinates(raw: DataFrame, path: str) -> None:
    """Coordinates of every second record as text."""
    position = F.struct(*[F.col(f"geoData.{c}").cast("string").alias(c) for c in ("latitude", "longitude")])
    as_text = F.to_json(F.struct(*[position.alias(c) if c == "geoData" else F.col(c) for c in raw.columns]))
    chosen = F.when(F.xxhash64("id") % 2 == 0, as_text).otherwise(F.to_json(F.struct(*raw.columns)))
    raw.select(chosen.alias("value")).write.text(path, compression="gzip")


def _write_arrays(raw: DataFrame, path: str) -> None:
    """Files that each are one array on one line.

    Rows stay in the task that reads them, which closes a file after a number of records and at its end,
    so the texts are neither shuffled nor sorted.
    """
    row = F.monotonically_increasing_id()
    numbered = raw.withColumns({"task": F.shiftright(row, 33), "number": row.bitwiseAND(F.lit((1 << 33) - 1))})
    lengths = cut_lineage(numbered.groupBy("task").agg(F.max("number").alias("last")))
    place = F.col("number") % RECORDS_A_FILE
    opening = F.when(place == 0, "[").otherwise(",")
    closing = F.when((place == RECORDS_A_FILE - 1) | (F.col("number") == F.col("last")), "]").otherwise("")
    rows = numbered.join(F.broadcast(lengths), "task")  # one row a task
    values = rows.select(F.concat(opening, F.to_json(F.struct(*raw.columns)), closing).alias("value"))
    values.write.option("lineSep", " ").option("maxRecordsPerFile", RECORDS_A_FILE).text(path, compression="gzip")


_FORMS = {
    "json_lines": _write_lines,
    "json_aliases": _write_aliases,
    "json_text_coordinates": _write_text_coordinates,
    "json_array": _write_arrays,
}


def raw_json_path(spark: SparkSession, folder: str, form: str = "json_lines") -> str:
    """The raw records as JSON in one of its forms."""

    def write(path: str) -> StructType:
        raw = stored(spark, folder, "raw")
        _FORMS[form](raw, path)
        return raw.schema

    return _once(spark, folder, form, write)[0]
