"""Drop folders as streams: each file is read once, each key is stored once.

Every run takes what is there and ends. The checkpoint remembers finished files; a batch repeated after a failure
writes the folder of its own number again, so nothing is stored twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.operators.keyed_store import open_store, upsert_store
from tripmart.operators.keys import keep_first, new_rows
from tripmart.operators.lookup import settle, stored_table
from tripmart.operators.upsert import as_of, commit_version, upsert, versions


def open_drops(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "csv", files_per_batch: int | None = None
) -> DataFrame:
    """A stream over the files of a folder or glob."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _run(stream: DataFrame, checkpoint: str, each_batch, timeout: float | None) -> None:
    """Work off what is there. Only a caller that names a limit in seconds has one."""
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(each_batch).start()
    )
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"ingest did not end within {timeout} seconds")


def ingest(stream: DataFrame, target: str, checkpoint: str, timeout: float | None = None) -> None:
    """Store every row of every new file."""
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    _run(stream, checkpoint, each_batch, timeout)


def ingest_new_keys(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order_by: Sequence[str] = (),
    timeout: float | None = None,
) -> None:
    """Store the first row of each key not stored by an earlier batch."""
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        rows = keep_first(batch, keys, order_by)
        current = stored_table(batch.sparkSession, target)
        if current is not None:
            # A micro-batch is small beside what is stored: its keys go to the table, not the table to them.
            rows = new_rows(settle(rows, "batch"), current.where(F.col("batch") < batch_id), keys, small_batch=True)
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    _run(stream, checkpoint, each_batch, timeout)


def ingest_changes(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order_by: Sequence[str] = (),
    timeout: float | None = None,
) -> None:
    """Store each batch as a set of changes, one per key. A batch costs what it holds, whatever the table's size."""
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        keep_first(batch, keys, order_by).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    _run(stream, checkpoint, each_batch, timeout)


def upserted(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A table after all stored changes: the last change of each key is upserted."""
    last_first = changes.withColumn("_age", -F.col("batch"))
    newest = keep_first(last_first, keys, ["_age"]).drop("_age", "batch")
    return upsert(base, newest.select(*base.columns), keys)


def fold_changes(spark: SparkSession, base: str, log: str, keys: Sequence[str]) -> int:
    """Apply the stored changes to the table at ``base``, a folder of versions, and return the version that holds them.

    A version remembers the last batch it holds, so each batch of the log is read and applied once; a fold repeated after a failure
    writes the same version again. Without new batches nothing is written.
    """
    table = versions(spark, base)
    newest, upto = table.agg(F.max("version")).first()[0], -1
    mark = stored_table(spark, f"{base}-folded")
    if mark is not None:
        upto = mark.where(F.col("version") <= newest).agg(F.max("batch")).first()[0]
        upto = -1 if upto is None else upto
    changes = stored_table(spark, log)
    last = None if changes is None else changes.where(F.col("batch") > upto).agg(F.max("batch")).first()[0]
    if last is None:
        return newest
    fresh = changes.where((F.col("batch") > upto) & (F.col("batch") <= last))
    # The mark comes first: without its version it does not count, and the fold is done again.
    spark.range(1).select(F.lit(last).cast("int").alias("batch")).write.mode("overwrite").parquet(f"{base}-folded/version={newest + 1}")
    commit_version(upserted(as_of(table, newest), fresh, keys), base, newest + 1)
    return newest + 1


def fold_into_store(spark: SparkSession, path: str, log: str) -> list[int]:
    """Apply the stored changes that are new to the keyed store at ``path`` and return the partitions written.

    Only partitions that hold a changed key are read and written, so a fold costs what its batches touch, not what the table holds. The
    mark of the last batch comes last: a fold that failed before it is done again, and changes applied twice change nothing.
    """
    store = open_store(spark, path)
    if store is None:
        raise ValueError(f"no keyed store at {path}")
    mark, changes = stored_table(spark, f"{path}-folded"), stored_table(spark, log)
    upto = -1 if mark is None else mark.agg(F.max("batch")).first()[0]
    last = None if changes is None else changes.where(F.col("batch") > upto).agg(F.max("batch")).first()[0]
    if last is None:
        return []
    fresh = changes.where((F.col("batch") > upto) & (F.col("batch") <= last))
    newest = keep_first(fresh.withColumn("_age", -F.col("batch")), store.keys, ["_age"])
    _, touched = upsert_store(spark, store, newest.select(*store.schema.names))
    spark.range(1).select(F.lit(last).cast("int").alias("batch")).write.mode("append").parquet(f"{path}-folded")
    return touched


def stored_rows(spark: SparkSession, target: str) -> DataFrame:
    """What the append streams stored, without the batch numbers."""
    return spark.read.parquet(target).drop("batch")
