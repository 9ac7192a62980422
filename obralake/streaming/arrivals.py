"""Months that keep arriving, as tables or as archives: a stream that is merged into the stored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import etl
from ..session import store
from ..sources import tables as io
from ..sources.tables import upsert_table, write_table


def load_arrivals(spark: SparkSession, source: str, schema: T.StructType, target: str,
                  keys: Sequence[str], checkpoint: str, order: Sequence[str] = (),
                  fmt: str = "parquet",
                  shape: Callable[[DataFrame], DataFrame] | None = None,
                  files_per_batch: int | None = None) -> None:
    """Process the files that are new since the last call, then stop.

    The stream's checkpoint remembers which files are done. A batch is an upsert by key, so a
    batch that is repeated after a failure changes nothing. Of several rows of a key in one batch the
    last by file time counts, then by file name, then by `order`.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    arrivals = reader.load(source)
    arrivals = arrivals.withColumns({
        "_arrived": F.col("_metadata.file_modification_time"), "_name": F.col("_metadata.file_path")})
    if shape is not None:
        arrivals = shape(arrivals)

    def merge(batch: DataFrame, _epoch: int) -> None:
        upsert_table(batch, target, keys, ["_arrived", "_name", *order],
                     ["_arrived", "_name"])

    query = (arrivals.writeStream.foreachBatch(merge)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def start_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty stored table to merge into."""
    write_table(spark.createDataFrame([], schema), path)


def archive_stream(spark: SparkSession, source: str, pattern: str = "*.{zip,xlsx}",
                   files_per_batch: int | None = None) -> DataFrame:
    """Files that arrive in a folder, subfolders included, with their content.

    Spark's file stream leaves out files a week older than the newest it has seen (`maxFileAge`).
    """
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary").option(
        "pathGlobFilter", pattern).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(source)


def load_archives(arrivals: DataFrame, target: str, checkpoint: str) -> None:
    """Load the archives that are new in the stream `arrivals` (`path`, `modificationTime`, `content`), then stop.

    A month is that of its latest readable archive (by file time, then path), however the archives are
    dealt to batches: a later one replaces the month in the six tables below `target`/relational, one that
    arrives late is not loaded. `target`/archives holds the archive of each month and is written last, so
    a batch that broke off or is repeated is loaded again to the same end. `target`/outcomes tells what
    became of each archive and of each sheet that could not be read, by batch.
    """
    def load(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        files = batch.select("path", "modificationTime", "content")
        cells, report = etl.cells_of(files)
        used = report.filter("outcome = 'used'").join(files.select("path", "modificationTime"), "path").select(
            "referencia", "path", "modificationTime")
        ledger = f"{target}/archives"
        if io.has_months(spark, ledger):
            order = F.struct("modificationTime", "path")
            known = spark.read.schema(used.schema).parquet(ledger).select("referencia", order.alias("known"))
            used = used.join(known, "referencia", "left").withColumn(
                "fresh", F.coalesce(order >= F.col("known"), F.lit(True)))
        else:
            used = used.withColumn("fresh", F.lit(True))
        used = store(used.select("referencia", "path", "modificationTime", "fresh"), "arrived")
        late = used.filter(~F.col("fresh")).select("path", F.lit(True).alias("late"))
        outcomes = report.join(late, "path", "left").withColumn("outcome", F.when(
            F.col("late") & (F.col("outcome") == "used"), "superseded").otherwise(F.col("outcome")))
        write_table(outcomes.select("path", "referencia", "sheet", "outcome", F.lit(epoch).alias("batch")),
                    f"{target}/outcomes", partitions=("batch",))
        fresh = used.filter("fresh").select("referencia", "path", "modificationTime")
        months = io.months_of(fresh)
        if not months:
            return
        tables = etl.process_months(cells.join(fresh.select("referencia"), "referencia", "left_semi"))
        tables = {s: store(df, "sheet") for s, df in tables.items()}
        etl.write_relational(etl.relational(tables), f"{target}/relational", months)
        write_table(fresh, ledger, months=len(months))

    query = (arrivals.writeStream.foreachBatch(load)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
