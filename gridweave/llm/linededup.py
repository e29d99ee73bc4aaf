"""Lines that many documents share, dropped everywhere; DataFrame functions only.

A text is cut at line feeds.  A line's key is the line without ASCII white space
at both ends, ASCII letters lower-cased.  Keys of at least ``least`` code points
that are found in at least ``documents`` documents lose all their lines.

An index of line hashes is kept as levelled sorted runs (``LineIndex``):

* a run is a table (hash, n) with a row for each hash, n being the documents that
  it was found in, bucketed by hash and sorted within buckets, so that joins with
  a run do not shuffle it;
* a new batch of documents is counted by hash, merge-anti-joined with every run's
  settled hashes (n at the threshold: nothing more need be known of them), and
  added as a run of level 0;
* ``FANOUT`` runs of a level are compacted into one of the next, which adds up
  their counts, so that every hash is rewritten a logarithmic number of times and
  a batch meets few runs.

A hash is common if its counts over all runs reach the threshold.  Documents are
dealt into batches by id, so that the rows of one id are counted once.

The common hashes' places in each document then meet the documents again, as
arrays of line numbers.  Hashes are 128 bits of md5, so two keys of one hash are
not to be expected among 10^15.  A hot line is counted before it is shuffled;
common hashes and places are sent to all tasks while a count proves them small
(``BOUND`` hashes, ``BOUND`` places), and joined by shuffle beyond that, where
adaptive execution splits hot keys.

Edge cases: a null or empty text is one empty line; an empty key has no code
point and is never dropped; a text whose lines all go becomes empty; rows of one
id are one document, rows of a null id one document for each distinct text;
repeated rows are treated alike; an empty table gives an empty result; columns
that are called as the new ones are replaced, others pass through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, removed, scratch, written

DOCUMENTS, LEAST = 10, 1
BATCHES, FANOUT = 8, 4
BOUND = 1_000_000
BLANKS = "\t\n\x0b\x0c\r "
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, ASCII letters lower-cased."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


class LineIndex:
    """Levelled sorted runs of (hash, n) in the shared folder."""

    def __init__(self, spark: SparkSession, documents: int = DOCUMENTS, fanout: int = FANOUT):
        self.spark, self.documents, self.fanout = spark, documents, fanout
        self.levels: list[list[tuple[str, str]]] = []  # (table, path)

    def _written(self, counts: DataFrame, level: int) -> None:
        n = partitions(self.spark)
        name, path = f"line_run_{uuid.uuid4().hex}", scratch(self.spark, "line-run")
        counts.select("hash", "n").repartition(n, "hash").write.bucketBy(n, "hash").sortBy("hash").option("path", path).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))

    def _dropped(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"DROP TABLE {name}")
            removed(self.spark, path)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def add(self, found: DataFrame) -> None:
        """Adds a batch: (hash, doc), a row for each line or for each line and document."""
        own = found.groupBy("hash").agg(F.count_distinct("doc").alias("n"))
        for run in self.runs():
            own = own.join(run.where(F.col("n") >= self.documents).hint("merge"), "hash", "left_anti")
        self._written(own, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self.compact(level)
            level += 1

    def compact(self, level: int) -> None:
        """One run of the next level for all runs of this one."""
        runs, self.levels[level] = self.levels[level], []
        self._written(self._total(runs), level + 1)
        self._dropped(runs)

    def _total(self, runs: list[tuple[str, str]]) -> DataFrame:
        """Counts over runs, read as plain files: of a union of bucketed scans Spark 4.1.2 takes the buckets for aligned, which they are not."""
        every = self.spark.read.schema("hash binary, n long").parquet(*[path for _, path in runs])
        return every.groupBy("hash").agg(F.sum("n").alias("n"))

    def common(self) -> DataFrame:
        """The hashes that reach the threshold."""
        return self._total([run for level in self.levels for run in level]).where(F.col("n") >= self.documents).select("hash")

    def clear(self) -> None:
        for level in self.levels:
            self._dropped(level)
        self.levels = []


def cut(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """df with its lines and what names a document here: its id and the hash of its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.withColumns({"_lines": F.split(text, "\n", -1), "_text": F.xxhash64(text), "_id": F.col(id_col).cast("long")})


def lines(df: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """(doc, id, text, place, hash, batch) for every line with a key of at least ``least`` code points."""
    rows = cut(df.select(id_col, text_col), id_col, text_col).select("_id", "_text", F.posexplode("_lines").alias("place", "line"))
    keyed = rows.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= max(least, 1))
    doc = F.coalesce("_id", "_text")
    return keyed.select(doc.alias("doc"), F.col("_id").alias("id"), F.col("_text").alias("text"), "place", F.unhex(F.md5("key")).alias("hash"), F.pmod(F.xxhash64(doc), F.lit(BATCHES)).cast("int").alias("batch"))


def places(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", documents: int = DOCUMENTS, least: int = LEAST) -> tuple[DataFrame, str]:
    """(id, text, places): the numbers of the lines to drop, for documents that have any; and the table's path."""
    spark = df.sparkSession
    path = scratch(spark, "lines")
    lines(df, id_col, text_col, least).write.partitionBy("batch").parquet(path)
    every = spark.read.schema("doc long, id long, text long, place int, hash binary, batch int").parquet(path)
    index = LineIndex(spark, documents)
    for batch in range(BATCHES):
        index.add(every.where(F.col("batch") == batch).select("hash", "doc"))
    common, common_path = written(index.common(), "common-lines")
    index.clear()
    common = F.broadcast(common) if common.count() <= BOUND else common
    gone = every.join(common, "hash", "left_semi").groupBy("id", "text").agg(F.collect_set("place").alias("places"))
    out, out_path = written(gone, "places")
    removed(spark, path, common_path)
    return out, out_path


def without_common_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", documents: int = DOCUMENTS, least: int = LEAST) -> DataFrame:
    """df with its texts reduced to the lines that stay, and ``n_lines``, ``n_dropped``."""
    gone, _ = places(df, id_col, text_col, documents, least)
    small = gone.agg(F.sum(F.size("places"))).first()[0] or 0
    gone = gone.select(F.col("id").alias("_of"), F.col("text").alias("_as"), F.col("places").alias("_places"))
    kept = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    have = cut(df.select(*kept), id_col, text_col).drop(text_col)
    met = have.join(F.broadcast(gone) if small <= BOUND else gone, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_text") == F.col("_as")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_places"))
    text = F.when(F.col("_places").isNull(), F.array_join("_lines", "\n")).otherwise(F.array_join(F.transform(stay, lambda i: F.col("_lines")[i]), "\n"))
    new = {"n_lines": F.size("_lines").cast("long"), "n_dropped": F.coalesce(F.size("_places"), F.lit(0)).cast("long")}
    return met.select(*[text.alias(c) if c == text_col else F.col(c) for c in kept], *[v.alias(k) for k, v in new.items()])
