"""Line dedup over batches of documents: levelled sorted runs of line hashes, DataFrame functions only.

A line's key is the line without white space at its ends and with A-Z in lower case. A line of a
long enough key stays in the document that comes first, the one with the smallest id, and goes
in all others; short lines stay.

Documents come in batches in the order of their ids. What earlier batches hold is a set of runs: each
is a table of line hashes, bucketed by hash and sorted in its buckets. A batch counts its own hashes
in tasks, deals them out once, and merge-anti-joins them with every run: with as many buckets as shuffle
partitions a run is read bucket by bucket and not dealt out again. Hashes that no run has are the batch's
own run, on level 0, with the document that keeps the line. When a level has ``FANOUT`` runs, they are
merged into one of the next level, so n batches leave some log n runs to join. Runs never share a hash,
so merging is a union.

``LineIndex`` is that set; it may be kept and opened again, so that batches come on different days. ``deduped``
takes one table, cuts it into batches at quantiles of the ids and drops lines from whole texts.

A hash is the key's MD5, 128 bits. Lines that go are found by a join on the hash, in which Spark can split
a line that very many documents have, and are kept as places in their text, named by id and MD5 of the text.

Null texts are one empty line, as empty ones are. A null id comes after all others. Rows of one id
are one document: a line stays in all of them or goes from all of them. No rows give no rows.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import stored
from visitlens.sinks.shared import shared_folder

LEAST_CHARS = 10
BATCHES = 4
FANOUT = 2
LAST = (1 << 63) - 1

# White space at the ends of lines.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: What names a document's text: its id and the text's hash.
KEY = ["doc", "text_hash"]


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _md5(text: Column) -> Column:
    return F.unhex(F.md5(text))


def keyed(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    """``doc``, text_hash and ``text``; a null id is the last one."""
    whole = F.coalesce(F.col(text), F.lit(""))
    doc = F.coalesce(F.col(id_column).cast("long"), F.lit(LAST))
    return docs.select(doc.alias("doc"), _md5(whole).alias("text_hash"), whole.alias("text"))


def hashed_lines(rows: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``h``, ``KEY`` and ``at``, the place in its text, of each line of a long enough key."""
    lines = rows.select(*KEY, F.posexplode(lines_of(F.col("text"))).alias("at", "line"))
    keys = lines.select(*KEY, "at", key_of(F.col("line")).alias("key")).filter(F.length("key") >= least_chars)
    return keys.select(_md5(F.col("key")).alias("h"), *KEY, "at")


class LineIndex:
    """The hashes of all lines so far, in runs by level.

    ``folder`` must be one that all executors share. Each run is an external table; ``close`` drops the tables
    and leaves the files. ``LineIndex.opened`` finds the runs of a folder again.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("a level needs at least two runs to be merged")
        self.spark, self.folder, self.fanout = spark, folder.rstrip("/"), fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.version = 0

    @classmethod
    def opened(cls, spark: SparkSession, folder: str) -> LineIndex:
        """The index that ``add`` last left in a folder."""
        listed = spark.read.parquet(f"{folder.rstrip('/')}/manifest")
        rows = listed.filter(listed.version == listed.agg(F.max("version")).first()[0]).orderBy("level", "place").collect()
        index = cls(spark, folder, rows[0].buckets, rows[0].fanout)
        index.version = rows[0].version
        index.levels = [[] for _ in range(1 + max(row.level for row in rows))]
        for row in rows:
            if row.run is not None:
                index.levels[row.level].append(row.run)
                index._named(row.run)
        return index

    def _named(self, run: str) -> None:
        self.spark.sql(
            f"CREATE TABLE {run} (h BINARY, first BIGINT) USING parquet CLUSTERED BY (h) SORTED BY (h) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{run}'"
        )

    def _written(self, hashes: DataFrame) -> str:
        """A new run of (``h``, ``first``)."""
        run = f"visitlens_run_{uuid.uuid4().hex}"
        bucketed = hashes.select("h", "first").write.format("parquet").bucketBy(self.buckets, "h").sortBy("h")
        bucketed.option("path", f"{self.folder}/{run}").saveAsTable(run)
        return run

    def save(self) -> None:
        """Writes down which runs there are; ``opened`` takes the last list."""
        self.version += 1
        runs = [(level, f"'{run}'") for level, held in enumerate(self.levels) for run in held] or [(0, "string(null)")]
        rows = ", ".join(
            f"({self.version}L, {self.buckets}, {self.fanout}, {level}, {i}, {run})" for i, (level, run) in enumerate(runs)
        )
        listed = self.spark.sql(f"SELECT * FROM VALUES {rows} AS t(version, buckets, fanout, level, place, run)")
        listed.coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")

    @property
    def runs(self) -> list[str]:
        return [run for held in self.levels for run in held]

    def unseen(self, hashes: DataFrame) -> DataFrame:
        """The rows, one per hash, whose ``h`` no run has."""
        for run in self.runs:
            hashes = hashes.join(self.spark.table(run).select("h").hint("merge"), "h", "left_anti")
        return hashes

    def add(self, lines: DataFrame) -> DataFrame:
        """Takes the lines of a batch (``h``, ``KEY``, ``at``), whose documents come after all earlier ones. Gives
        ``KEY`` and ``at`` of those that an earlier document has too."""
        own = lines.groupBy("h").agg(F.min("doc").alias("first"))
        run = self._written(self.unseen(own))
        # The run has the lines that are new, and who keeps them.
        kept = F.coalesce(F.col("first") == F.col("doc"), F.lit(False))
        # Read as plain files, which are dealt out like the lines, so that Spark can split a line many documents have.
        fresh = self.spark.read.schema("h binary, first bigint").parquet(f"{self.folder}/{run}")
        gone = stored(lines.join(fresh, "h", "left").filter(~kept).select(*KEY, "at"))
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(run)
        self._compacted()
        return gone

    def _compacted(self) -> None:
        """Merges the runs of each level that has enough of them into one of the next level."""
        for level in range(len(self.levels)):
            held = self.levels[level]
            if len(held) < self.fanout:
                break
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._written(reduce(DataFrame.unionByName, map(self.spark.table, held))))
            self.levels[level] = []
            self._dropped(held)

    def _dropped(self, runs: list[str]) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run}")

    def close(self) -> None:
        self._dropped(self.runs)


def batched(lines: DataFrame, docs: DataFrame, batches: int) -> list[DataFrame]:
    """Lines in batches by ascending id, cut where about equally many rows of ``docs`` lie between."""
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx("doc", F.array(*map(F.lit, shares)), F.lit(1000))).first()[0] if shares else []
    cuts = sorted(set(cuts or []))
    bounds = [None, *cuts, None]
    parts = []
    for low, high in zip(bounds, bounds[1:]):
        part = lines if low is None else lines.filter(F.col("doc") > low)
        parts.append(part if high is None else part.filter(F.col("doc") <= high))
    return parts


def deduped(
    docs: DataFrame,
    batches: int = BATCHES,
    least_chars: int = LEAST_CHARS,
    text: str = "text",
    id_column: str = "doc_id",
    index: LineIndex | None = None,
) -> DataFrame:
    """doc_id, ``n_lines``, ``n_dropped`` and ``kept``, the lines that stay joined by line ends, for every row.

    With an ``index`` its lines count as lines of earlier documents, and those of ``docs`` are added to it."""
    rows = keyed(docs, text, id_column)
    lines = stored(hashed_lines(rows, least_chars))
    own = index or LineIndex(docs.sparkSession, shared_folder(docs.sparkSession))
    gone = reduce(DataFrame.unionByName, [own.add(part) for part in batched(lines, rows, batches)])
    if index is None:
        own.close()
    else:
        own.save()
    places = gone.groupBy(*KEY).agg(F.collect_set("at").alias("places"))
    cut = rows.join(places, KEY, "left").select("doc", lines_of(F.col("text")).alias("lines"), "places")
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.when(F.col("places").isNull(), every).otherwise(F.array_except(every, "places"))
    return cut.withColumn("left", left).select(
        F.nullif("doc", F.lit(LAST)).alias("doc_id"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("left")).cast("long").alias("n_dropped"),
        F.array_join(F.expr("transform(left, i -> lines[i])"), "\n").alias("kept"),
    )
