"""Small helpers the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.lookup import settle
from tripmart.session import new_path, shared_folder

__all__ = ["ascii_lower", "let", "narrow_batches", "new_path", "read", "running_sum", "settle", "shared_folder", "size_tasks"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words that consist of ASCII letters and digits and of any character outside ASCII.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where lambdas inside ``body`` use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts of plain ASCII take the fast built-in."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def running_sum(values: Column, block: int = 256) -> Column:
    """For an array of ints, the sum of the elements before each one.

    Sums of whole blocks come first, so a row with a million elements costs some hundred million steps, not 10^12.
    """
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def offsets(arr: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(arr) - 1) / block).cast("int")),
            lambda b: total(F.slice(arr, b * block + 1, F.lit(block))))
        return let(blocks, lambda sums: let(
            F.transform(sums, lambda _, i: total(F.slice(sums, F.lit(1), i))),
            lambda starts: F.transform(arr, lambda _, i: starts[F.floor(i / block).cast("int")] + total(
                F.slice(arr, F.floor(i / block).cast("int") * block + 1, i % block)))))

    empty = F.array().cast("array<int>")
    return let(values, lambda arr: F.when(F.size(arr) > 0, offsets(arr)).otherwise(empty))


def narrow_batches(spark: SparkSession, rows: int = 1000, megabytes: int = 16) -> None:
    """Bound what one Arrow batch brings into a Python worker, in rows and in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))


def size_tasks(rows: int, rows_per_task: int) -> int:
    """How many groups keep each at about ``rows_per_task`` rows. Grows with the rows, without a ceiling."""
    return max(1, -(-rows // rows_per_task))
