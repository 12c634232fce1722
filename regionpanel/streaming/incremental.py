"""Load only the files that have arrived since the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.contracts import Contract
from ..sources.delimited import good_rows, read_by_name, rejects

FILE_LISTING = "path string, modificationTime timestamp, length long, content binary"


def ingest_new_files(
    spark: SparkSession, path: str, contract: Contract, table: str, state: str, rejected: str | None = None, files: int = 10_000
) -> None:
    """Append the rows of files not seen before to the Parquet table, all columns as text.

    Reads what is there and stops. ``state`` keeps the list of files done; each batch of at most ``files`` files is a
    partition of the table, written over when a run has to repeat it, so a failure neither skips nor repeats a file.
    Columns are bound by each file's own header. Records that do not fit it go to the table ``rejected``, if given.
    Later batches may have columns that earlier ones have not: `read_ingested` shows the columns of all.
    """
    arrived = (
        spark.readStream.format("binaryFile").schema(FILE_LISTING).option("maxFilesPerTrigger", files).load(path).select("path")
    )

    def load(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.select("path").distinct().collect()]
        if not paths:
            return
        rows = read_by_name(batch.sparkSession, paths, contract, "source_file")
        good_rows(rows).write.mode("overwrite").parquet(f"{table}/batch={number}")
        if rejected:
            rejects(rows, contract.name, contract.columns[0]).write.mode("overwrite").parquet(f"{rejected}/batch={number}")

    query = arrived.writeStream.foreachBatch(load).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    """The table of `ingest_new_files` with the columns of all batches, NULL where a batch has none."""
    return spark.read.option("mergeSchema", True).parquet(table)
