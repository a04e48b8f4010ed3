"""Files that arrive in a folder, each taken once; rows that do not fit are kept aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tableloom.functions.columns import column, quoted
from tableloom.functions.typing import NA_TOKENS, na_normalise

#: Column that holds a row which does not fit the schema, as it stands in its file.
BAD_RECORD = "_bad_record"
_FILE, _OVERFLOW, _BATCH = "_file", "_overflow", "batch_id"

REJECTS = "file string, line bigint, reason string, record string"


def _schema(spark: SparkSession, schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def stream_csv(
    spark: SparkSession, folder: str, schema: str | T.StructType, files_per_batch: int = 1_000
) -> DataFrame:
    """Stream of the delimited files of a folder, with a stated schema.

    A row with too many or too few fields, or with a value that does not fit its
    type, is left as it is in ``_bad_record``; ``NA`` and empty cells become nulls.
    """
    fields = _schema(spark, schema).add(BAD_RECORD, "string")
    return (
        spark.readStream.schema(fields)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_RECORD)
        .option("nullValue", "NA")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
        .select("*", F.col("_metadata.file_path").alias(_FILE))
    )


def _reason(record: Column, fields: list[T.StructField]) -> Column:
    """Why a record does not fit."""
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _OVERFLOW}
    texts = [f"{quoted(f.name)} string" for f in fields]
    exact = F.from_csv(record, ", ".join([*texts, f"{_OVERFLOW} string"]), options)
    longer = F.from_csv(record, ", ".join([*texts, "_more string"]), {"escape": '"'})
    # a record with one field more fits the longer schema whole
    one_more = F.from_csv(
        record, ", ".join([*texts, "_more string", f"{_OVERFLOW} string"]), options
    )
    too_many = longer["_more"].isNotNull() | one_more[_OVERFLOW].isNull()
    unfit = F.coalesce(
        *[
            F.when(
                exact[f.name].isNotNull()
                & ~exact[f.name].isin(*NA_TOKENS)
                & exact[f.name].try_cast(f.dataType).isNull(),
                F.lit(f"{f.name}: no {f.dataType.simpleString()}"),
            )
            for f in fields
        ],
        F.lit("unreadable"),
    )
    return (
        F.when(exact[_OVERFLOW].isNull(), unfit)
        .when(too_many, "too many fields")
        .otherwise("too few fields")
    )


def _numbered_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """``file``, ``line`` (from 1) and ``value`` of all lines; the lines of a block stay together.

    One row per block, of which a file has one for every split, tells how many
    lines stand before it.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .text(files)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
            F.regexp_replace("value", "\r$", "").alias("value"),
        )
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        lines.groupBy("file", "block")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
        .select(
            "file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
        )
    )
    return lines.join(blocks, ["file", "block"]).select(
        "file", (F.col("id") - F.col("first") + F.col("before") + 1).alias("line"), "value"
    )


def rejected_rows(batch: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """File, line, reason and text of the rows of a batch that do not fit.

    The line is where the record begins. It is found by the record's first line; the
    n-th record of a file that begins alike is the n-th such line after the header.
    """
    spark = batch.sparkSession
    bad = batch.where(F.col(BAD_RECORD).isNotNull()).select(
        F.col(_FILE).alias("file"),
        F.regexp_replace(BAD_RECORD, "[\r\n]+$", "").alias("record"),
        F.monotonically_increasing_id().alias("id"),
    )
    files = [row.file for row in bad.select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], REJECTS)
    begins = F.regexp_replace(F.split("record", "\n", 2)[0], "\r$", "")
    nth = lambda order: F.row_number().over(
        Window.partitionBy("file", "value").orderBy(order)
    )
    wanted = bad.withColumn("value", begins).withColumn("nth", nth("id"))
    found = (
        _numbered_lines(spark, files)
        .where("line > 1")
        .join(wanted.select("file", "value").distinct(), ["file", "value"], "left_semi")
        .withColumn("nth", nth("line"))
    )
    return wanted.join(found, ["file", "value", "nth"], "left").select(
        "file", F.col("line").cast("bigint").alias("line"), _reason(F.col("record"), fields).alias("reason"), "record"
    )


def split_batch(batch: DataFrame, batch_id: int, table_path: str, rejects_path: str) -> None:
    """Write the rows of a batch that fit to a table and the others to a table of rejects.

    Both have a folder per batch. A batch that runs again replaces its folders, so
    it adds nothing twice, whatever was written before it broke off.
    """
    fields = [f for f in batch.schema.fields if f.name not in (BAD_RECORD, _FILE)]
    rows = batch.persist()
    try:
        good = na_normalise(rows.where(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD, _FILE))
        good.write.mode("overwrite").parquet(f"{table_path}/{_BATCH}={batch_id}")
        rejected_rows(rows, fields).write.mode("overwrite").parquet(
            f"{rejects_path}/{_BATCH}={batch_id}"
        )
    finally:
        rows.unpersist()


def ingest_new_files(
    arrivals: DataFrame, table_path: str, checkpoint: str, rejects_path: str | None = None
) -> StreamingQuery:
    """Take in everything that arrived since the last run.

    The checkpoint remembers the files taken, so a second run adds nothing. Rows
    that do not fit go to ``rejects_path`` (else ``<table_path>_rejects``) and stop
    neither their file nor the stream.
    """
    aside = rejects_path or f"{table_path.rstrip('/')}_rejects"
    return (
        arrivals.writeStream.foreachBatch(
            lambda batch, batch_id: split_batch(batch, batch_id, table_path, aside)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def arrived(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table that :func:`ingest_new_files` wrote."""
    return spark.read.parquet(path).drop(_BATCH)
