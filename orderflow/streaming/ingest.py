"""Stage 1 (E1) on a stream of raw CSV files.

Standardising and validating are row-wise projections, so the same
``validate`` plan runs unchanged under Structured Streaming: each new raw
file is validated once and appended to the processed zone (partitioned by
``record_status``, like the batch writer). The file source and the Parquet
sink together give exactly-once output through the checkpoint folder, so a
restarted query neither loses nor repeats files. No state is kept, hence no
watermark is needed.

A stream needs its schema up front: the raw columns are declared as strings
in the spec's order and the CSV header of every file is checked against them
(``enforceSchema=false``), so a file whose header differs fails loudly
instead of binding columns by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from orderflow.operators.validate import validate
from orderflow.sources.io import SPLIT_COLUMN, with_split
from orderflow.specs import EntitySpec


def raw_schema(spec: EntitySpec) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in spec.raw_columns])


def read_raw_stream(spark: SparkSession, spec: EntitySpec, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (
        spark.readStream.schema(raw_schema(spec))
        .option("header", True)
        .option("enforceSchema", False)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(source_dir)


def start_processing(
    spark: SparkSession,
    spec: EntitySpec,
    source_dir: str,
    processed_path: str,
    checkpoint_path: str,
    *,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Validate new raw files and append them to the processed zone.

    ``available_now`` processes every file present at start and stops (an
    incremental batch job); otherwise the query keeps running.
    """
    validated = with_split(validate(read_raw_stream(spark, spec, source_dir, max_files_per_trigger), spec))
    writer = (
        validated.writeStream.format("parquet")
        .partitionBy(SPLIT_COLUMN)
        .option("path", processed_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
