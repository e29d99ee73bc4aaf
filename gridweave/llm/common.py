"""What the operators share: batch slicing, the shared folder, and tables written to cut lineage."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.sinks import shared_dir
from . import textvec as tv

#: Tables of some numbers a row may be sent to all tasks up to this size.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under this application's name."""
    return f"{shared_dir(spark)}/gridweave/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Deletes the tables that this application's operators left in the shared folder.

    Results are read from them lazily, so this is for a job's end, after its
    results have been written.
    """
    removed(spark, f"{shared_dir(spark)}/gridweave/{spark.sparkContext.applicationId}")


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df as a Parquet table in the shared folder, reread, and its path: a later loss of executors costs no recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, *paths: str) -> None:
    """Deletes tables that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def few(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """df, sent to all tasks if a count proves that it has at most ``bound`` rows; else it is joined by shuffle."""
    return F.broadcast(df) if df.count() <= bound else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = tv.BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, object, object]]:
    """(rows, offsets, bytes) of about ``limit`` bytes of text each; the offsets start at 0.

    What Arrow keeps of freed batches goes back when the rows end: workers wait for other stages' tasks.
    """
    for batch in batches:
        offsets, body = tv.utf8(batch.column(batch.schema.get_field_index(text)))
        for a, b in tv.blocks(offsets, limit):
            yield batch.slice(a, b - a), offsets[a : b + 1] - offsets[a], body[offsets[a] : offsets[b]]
        del batch, offsets, body
        pa.default_memory_pool().release_unused()


def id_bucket(column, modulus: int):
    """crc32 of the id as text, modulo; null where the id is null."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


def crc_of(value: int) -> int:
    return zlib.crc32(str(value).encode())


def labelled(labels: DataFrame, label: str, bound: int, where=None) -> DataFrame:
    """(doc_id, label int): at most ``bound`` labelled documents, chosen by hash; one row each, the greatest label of repeated ones.

    Rows without id or label are left out.  The bound is a parameter of the
    learners, so their sample may be broadcast and fitted on the driver.
    """
    kept = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if where is not None:
        kept = kept.where(where)
    one = kept.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def with_labels(documents: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, label) of the sample's documents."""
    return documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")


def replaced(df: DataFrame, text: str, *new: tuple[str, str]) -> tuple[list[int], StructType]:
    """(places of the columns kept, the schema) for a table without its text and with new columns, which stand for any of their names."""
    names = {n for n, _ in new}
    kept = [i for i, f in enumerate(df.schema.fields) if f.name != text and f.name not in names]
    more = StructType.fromDDL(", ".join(f"{n} {t}" for n, t in new)) if new else StructType([])
    return kept, StructType([*(df.schema.fields[i] for i in kept), *more.fields])
