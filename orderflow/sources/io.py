"""Sources and sinks.

Locations are plain Hadoop paths (``s3a://``, ``hdfs://``, ``file:``), passed
as arguments; nothing is read from the environment.

Processed zone layout: each entity's folder holds its valid rows under
``split=valid`` and its quarantine under ``split=quarantine``. Validating an
entity is a single scan of its raw input and a single write job, and either
folder reads as a plain table in processed column order (``record_status`` is
in the files, the split is not).
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderflow.specs import ENTITIES, REASON_COLUMN, STATUS_COLUMN, VALID

SPLIT_COLUMN = "split"
VALID_SPLIT, QUARANTINE_SPLIT = "valid", "quarantine"
#: Files that a task keeps open at once while it writes a table in a few
#: folders; Spark sorts the rows of a task that has more folders.
OPEN_FILES = 8
_OPEN_FILES_CONF = "spark.sql.maxConcurrentOutputFileWriters"
_OPEN_LOCK = threading.Lock()
_OPEN: dict[SparkSession, list] = {}


# --- S1: CSV -------------------------------------------------------------
#: Text of a line with too few or too many fields, on request.
MALFORMED = "_malformed_line"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None, *, mark_malformed: bool = False) -> DataFrame:
    """All-string CSV with a header row. Types are never inferred; empty and
    quoted-empty fields read as null.

    Every file's header is checked against the columns read: a folder whose
    files differ in the order or the names of their columns fails instead of
    binding by position. Folders that differ from each other are given as a
    list and are bound by name (in the first one's order; ``Customer_ID`` and
    ``customer_id`` are one name unless the session is case-sensitive); a
    folder that lacks a column of another one is an error.

    Short lines are padded with nulls and long ones cut. With
    ``mark_malformed`` the column ``_malformed_line`` holds the text of such a
    line (see :func:`malformed_lines`) and is null for the others."""
    if not isinstance(path, str):
        frames = {p: read_csv(spark, p, schema, mark_malformed=mark_malformed) for p in path}
        _check_same_columns(spark, frames)
        return reduce(DataFrame.unionByName, frames.values())
    reader = spark.read.option("header", True).option("inferSchema", False)
    known = schema or reader.csv(path).schema
    if mark_malformed:
        # All fields are parsed whatever the plan reads, or a line's length
        # could not be told.
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
        first = F.col(f"`{known.names[0]}`")
        known = StructType([*known.fields, StructField(MALFORMED, StringType())])
        marked = reader.schema(known).option("enforceSchema", False).csv(path)
        # Spark refuses to read the marks without any field.
        return marked.withColumn(MALFORMED, F.when(F.length(F.coalesce(first, F.lit(""))) >= 0, F.col(MALFORMED)))
    return reader.schema(known).option("enforceSchema", False).csv(path)


def read_csv_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """:func:`read_csv` of some files of a folder: all have the first one's
    header."""
    reader = spark.read.option("header", True).option("inferSchema", False)
    return reader.schema(reader.csv(paths[0]).schema).option("enforceSchema", False).csv(list(paths))


def _check_same_columns(spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
    sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    names = {p: {c if sensitive else c.lower() for c in df.columns} for p, df in frames.items()}
    every = set().union(*names.values())
    lacking = [f"{p}: {sorted(every - own)}" for p, own in names.items() if every - own]
    if lacking:
        raise ValueError(f"column(s) missing in {'; '.join(lacking)}")


def malformed_lines(marked: DataFrame) -> DataFrame:
    """``line, n_fields, error`` of the lines that ``mark_malformed`` marked:
    ``TOO_FEW_FIELDS`` or ``TOO_MANY_FIELDS`` against the header."""
    line = F.col(MALFORMED)
    plain = F.regexp_replace(line, r'"(?:[^"\\]|\\.)*"', "")  # separators within quotes are text
    n_fields = F.regexp_count(plain, F.lit(",")) + 1
    error = F.when(n_fields < len(marked.columns) - 1, "TOO_FEW_FIELDS").otherwise("TOO_MANY_FIELDS")
    return marked.where(line.isNotNull()).select(line.alias("line"), n_fields.alias("n_fields"), error.alias("error"))


def write_csv(df: DataFrame, path: str, **options: object) -> None:
    """CSV with a header that keeps leading and trailing blanks (the default
    writer would strip what the standardisers are meant to trim)."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .options(**options)
        .csv(path)
    )


# --- S2/S4: Parquet -------------------------------------------------------
def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Whole-directory overwrite, whatever the session's overwrite mode."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """While this lasts, tasks of the session keep up to ``OPEN_FILES`` files
    open (or what the session says, if that is more). Writes on several threads
    share it; the last one puts the session's value back."""
    with _OPEN_LOCK:
        held = _OPEN.setdefault(spark, [0, spark.conf.get(_OPEN_FILES_CONF)])
        held[0] += 1
        if int(held[1]) < OPEN_FILES:
            spark.conf.set(_OPEN_FILES_CONF, str(OPEN_FILES))
    try:
        yield
    finally:
        with _OPEN_LOCK:
            held[0] -= 1
            if not held[0]:
                spark.conf.set(_OPEN_FILES_CONF, held[1])
                del _OPEN[spark]


def write_split(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """:func:`write_parquet` by columns that have a handful of values
    (``OPEN_FILES``): without a sort of all rows by them, which holds a task's
    rows in memory or spills them."""
    with _open_files(df.sparkSession):
        write_parquet(df, path, partition_by)


def write_partitioned(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Partitioned overwrite with the rows of a partition brought together
    first, so that not every task writes a file for every value; AQE splits a
    value that is too large."""
    write_parquet(df.hint("rebalance", *partition_by), path, partition_by)


# --- zones (S5-S8) --------------------------------------------------------
@dataclass(frozen=True)
class Zones:
    """Folder layout of one run: raw CSV in, processed / curated Parquet out.

    Each zone defaults to a sub-folder of ``root``; ``raw_root``,
    ``processed_root`` and ``curated_root`` place zones elsewhere (e.g. one
    bucket per zone).
    """

    root: str = ""
    raw_root: str | None = None
    processed_root: str | None = None
    curated_root: str | None = None

    def _zone(self, explicit: str | None, name: str) -> str:
        if explicit:
            return explicit.rstrip("/")
        if not self.root:
            raise ValueError(f"no location for the {name} zone")
        return f"{self.root.rstrip('/')}/{name}"

    def raw(self, entity: str) -> str:
        return f"{self._zone(self.raw_root, 'raw')}/{entity}"

    def processed(self, entity: str) -> str:
        return f"{self._zone(self.processed_root, 'processed')}/{entity}"

    def valid(self, entity: str) -> str:
        return split_path(self.processed(entity), VALID_SPLIT)

    def quarantine(self, entity: str) -> str:
        return split_path(self.processed(entity), QUARANTINE_SPLIT)

    @property
    def validation_summary(self) -> str:
        return f"{self._zone(self.processed_root, 'processed')}/validation-summary"

    def orphans(self, parent: str) -> str:
        return f"{self._zone(self.processed_root, 'processed')}/quarantine/orphan_{parent}"

    def malformed(self, entity: str) -> str:
        return f"{self._zone(self.processed_root, 'processed')}/quarantine/malformed_{entity}"

    def curated(self, name: str) -> str:
        return f"{self._zone(self.curated_root, 'curated')}/{name}"

    def staging(self, name: str) -> str:
        return f"{self._zone(None, '_staging')}/{name}"


def split_path(path: str, split: str) -> str:
    return f"{path.rstrip('/')}/{SPLIT_COLUMN}={split}"


def with_split(validated: DataFrame) -> DataFrame:
    valid = F.col(STATUS_COLUMN) == VALID
    return validated.withColumn(SPLIT_COLUMN, F.when(valid, VALID_SPLIT).otherwise(QUARANTINE_SPLIT))


def write_processed(validated: DataFrame, path: str) -> None:
    """Valid and quarantined rows in one write job; a side without rows
    is written as an empty table."""
    write_split(with_split(validated), path, (SPLIT_COLUMN,))
    spark = validated.sparkSession
    for split in (VALID_SPLIT, QUARANTINE_SPLIT):
        if _try_read(spark, split_path(path, split), "PATH_NOT_FOUND") is None:
            write_parquet(spark.createDataFrame([], validated.schema), split_path(path, split))


def _try_read(spark: SparkSession, path: str, *absent: str) -> DataFrame | None:
    """The table at ``path``, or None for the error conditions ``absent``."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in absent:
            raise
        return None


def read_processed(spark: SparkSession, path: str, split: str | None = VALID_SPLIT, schema: StructType | None = None) -> DataFrame:
    """One split of a processed table written here (``None``: both)."""
    if split is not None:
        return read_parquet(spark, split_path(path, split), schema)
    return read_processed(spark, path, VALID_SPLIT, schema).unionByName(read_processed(spark, path, QUARANTINE_SPLIT, schema))


def read_valid(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """S2 + P13: the valid rows of a processed table, re-typed.

    ``path`` holds a table written by :func:`write_processed`, or any Parquet
    table of the entity: without a ``record_status`` all its rows are valid
    and the two verdict columns are added. A folder without data files has no
    rows; a folder that is not there, or lacks a column, is an error."""
    df = _try_read(spark, split_path(path, VALID_SPLIT), "PATH_NOT_FOUND")
    if df is None:
        df = _try_read(spark, path, "UNABLE_TO_INFER_SCHEMA")
    spec = ENTITIES[entity]
    if df is None:
        return spark.createDataFrame([], StructType.fromDDL(spec.processed_ddl()))
    needed = {spec.key, *(f.name for f in spec.fields)}
    if missing := sorted(needed - set(df.columns)):
        raise ValueError(f"{path}: no processed {entity} table, column(s) {missing} are missing")
    if STATUS_COLUMN in df.columns:
        df = df.where(F.col(STATUS_COLUMN) == VALID)
    else:
        df = df.withColumn(STATUS_COLUMN, F.lit(VALID))
    if REASON_COLUMN not in df.columns:
        df = df.withColumn(REASON_COLUMN, F.lit(None).cast("string"))
    return retype(df.drop(SPLIT_COLUMN), entity)


def retype(df: DataFrame, entity: str) -> DataFrame:
    """Re-assert processed types, for instance of a table kept as text
    (no-ops on Parquet written here: Catalyst drops casts to the same type)."""
    typed = ENTITIES[entity].typed_columns
    return df.select(*[F.col(c).cast(typed[c]).alias(c) if c in typed else F.col(c) for c in df.columns])
