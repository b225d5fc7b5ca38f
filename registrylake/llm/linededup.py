"""Line dedup on levelled sorted runs of line hashes; DataFrame functions only.

A *run* is a pair of tables of ``(h1, h2, n_docs, max_doc)``, both bucketed by the 128-bit key hash and sorted by it
within each bucket: the *new* keys of one or more batches, which no earlier run holds, and the *known* ones, whose
figures add to those of earlier runs. ``LineRuns.add`` merge-anti-joins a batch's keys with every run (only the batch
moves; all runs have the same buckets), writes what is left as new keys and the others as known ones. When
``fanout`` runs stand on one level they are merged into one run of the next: sort-merge full outer joins of equal
buckets, without a shuffle. A key's figures are the sums over the runs.

A line that a document loses is taken out by its number, in time that grows with the document's lines alone.

A key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z in lower case.

Nulls, empties, ties and repeats: a null or empty text is one empty line; a null doc_id is below every
other and counts as no document; rows that share a doc_id count as one document, and the largest doc_id keeps the
line in all of its rows; a line that occurs several times in the kept document stays each time; an empty table
gives an empty run. Extra columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.llm.common import drop_path, lower_ascii, scratch, written

BLANK = " \t\n\x0b\x0c\r"
RUN = "h1 long, h2 long, n_docs long, max_doc long"
KEY = ["h1", "h2"]
BUCKET_BYTES, ROW_BYTES, MOST_BUCKETS = 128 << 20, 40, 50_000


def line_key(line):
    return lower_ascii(F.btrim(line, F.lit(BLANK)))


def hashes(key):
    """128 bits of a key: two XXH64 of different seeds."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, a 128-bit digest ``t`` of the text, and ``hs``: each line's key hash, null where the key is too short.

    The digest tells rows apart that share a doc_id; equal rows lose the same lines.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    hs = F.transform(F.transform(F.split(text, "\n"), line_key), lambda key: F.when(F.char_length(key) >= min_chars, hashes(key)))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), hashes(text).alias("t"), hs.alias("hs"))


def batch_keys(lines: DataFrame) -> DataFrame:
    """One row for each key of a batch (of ``line_hashes``).

    Documents are counted, not rows: the first exchange is by key and doc_id, so that a line that a third of
    all documents hold is spread over the tasks; what is left of it then is one row a task.
    """
    one = lines.select("doc_id", F.explode(F.filter("hs", lambda h: h.isNotNull())).alias("h")).select("doc_id", "h.h1", "h.h2")
    return one.groupBy(*KEY).agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("max_doc"))


@dataclass
class LineRuns:
    """The store of runs under one shared folder; ``close`` deletes it."""

    spark: SparkSession
    folder: str
    buckets: int = 16
    fanout: int = 2
    #: For each level its runs, oldest first: (table of new keys, table of known keys).
    levels: list = field(default_factory=list)
    made: int = 0
    name: str = field(default_factory=lambda: f"line_run_{uuid.uuid4().hex}")

    @property
    def runs(self) -> list:
        return [run for level in self.levels for run in level]

    def _write(self, rows: DataFrame) -> str:
        """``rows``, which are dealt by the buckets already, as a table of sorted buckets."""
        table = f"{self.name}_{self.made}"
        self.made += 1
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.folder}/{table}").mode("overwrite").saveAsTable(table)
        return table

    def dealt(self, keys: DataFrame) -> DataFrame:
        return keys.repartition(self.buckets, *KEY)

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The keys of ``keys`` that no run holds."""
        for new, _ in self.runs:
            keys = keys.join(self.spark.table(new).select(*KEY).hint("merge"), KEY, "left_anti")
        return keys

    def add(self, lines: DataFrame) -> None:
        """Adds a batch (of ``line_hashes``) as a run of level 0, and merges the levels that are full."""
        keys = written(self.dealt(batch_keys(lines)), "batch-keys")
        new = self._write(self.unseen(self.dealt(keys)))
        known = self._write(self.dealt(keys).join(self.spark.table(new).select(*KEY).hint("merge"), KEY, "left_anti"))
        if not self.levels:
            self.levels.append([])
        self.levels[0].append((new, known))
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(tuple(self._merge(list(tables)) for tables in zip(*runs)))
            level += 1

    def _merge(self, tables: list) -> str:
        """One table from several, two at a time, by the order of their buckets."""
        while len(tables) > 1:
            a, b = (self.spark.table(t) for t in tables[:2])
            both = a.select(*KEY, F.col("n_docs").alias("n"), F.col("max_doc").alias("m")).hint("merge").join(b, KEY, "full_outer")
            total = F.coalesce("n", F.lit(0)) + F.coalesce("n_docs", F.lit(0))
            made = self._write(both.select(*KEY, total.alias("n_docs"), F.greatest("m", "max_doc").alias("max_doc")))
            self._drop(tables[:2])
            tables = [made, *tables[2:]]
        return tables[0]

    def _drop(self, tables) -> None:
        for t in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
            drop_path(self.spark, f"{self.folder}/{t}")

    def merged(self) -> DataFrame:
        """One row for each key over all runs.

        The files are read without their buckets, on purpose: a union of bucketed columnar scans states the scans'
        partitioning without keeping it (seen in Spark 4.1.2), so that grouping it without an exchange leaves a key's rows apart.
        """
        if not self.runs:
            return self.spark.createDataFrame([], RUN)
        every = self.spark.read.schema(RUN).parquet(*[f"{self.folder}/{t}" for run in self.runs for t in run])
        return every.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"))

    def close(self) -> None:
        self._drop([t for run in self.runs for t in run])
        self.levels = []


def batch_number(docs: DataFrame, count: int):
    """A column: the batch, by ranges of doc_id, to which a document belongs, as if batches came one after another."""
    cuts = docs.select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", [i / count for i in range(1, count)], 0.02) if count > 1 else []
    d, number = F.col("doc_id").cast("long"), F.lit(0)
    for cut in sorted(set(cuts)):
        number = number + F.coalesce(d >= F.lit(cut).cast("long"), F.lit(False)).cast("int")
    return number


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` with ``text`` rid of repeated lines, and ``n_lines``, ``n_dropped`` beside it.

    Keys are made once and kept as hashes, by batch. Two shuffles beside the runs' own: the lines' hashes meet the
    repeated keys (a plain join, whose hot keys AQE may split), and the numbers of the lines that a
    document loses meet its text again.
    """
    spark = docs.sparkSession
    lines = line_hashes(docs, min_chars).withColumn("n_keys", F.size(F.filter("hs", lambda h: h.isNotNull()))).withColumn("batch", batch_number(docs, batches))
    lines = written(lines, "line-hashes", ["batch"])
    keys = lines.agg(F.sum("n_keys")).first()[0] or 0
    least = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    runs = LineRuns(spark, scratch(spark, "lines"), min(MOST_BUCKETS, max(least, -(-keys * ROW_BYTES // BUCKET_BYTES))), fanout)
    for batch in range(batches):
        runs.add(lines.filter(F.col("batch") == batch))
    # Written, so that the join below has a shuffle on either side and AQE may split a hot key's rows.
    common = written(runs.merged().filter(F.col("n_docs") >= min_docs).select(*KEY, "max_doc"), "common-lines")
    runs.close()
    held = lines.select(F.col("doc_id").alias("__rl_id"), F.col("t").alias("__rl_t"), F.posexplode("hs").alias("pos", "h")).filter(F.col("h").isNotNull())
    held = held.select("__rl_id", "__rl_t", "pos", F.col("h.h1").alias("h1"), F.col("h.h2").alias("h2"))
    lost = held.join(common, KEY).filter(~F.col("__rl_id").eqNullSafe(F.col("max_doc"))).groupBy("__rl_id", "__rl_t").agg(F.collect_set("pos").alias("__rl_lost"))
    text = F.coalesce(F.col("text"), F.lit(""))
    both = docs.withColumn("__rl_text", hashes(text))
    both = both.join(lost.hint("shuffle_hash"), F.col("doc_id").cast("long").eqNullSafe(F.col("__rl_id")) & (F.col("__rl_text") == F.col("__rl_t")), "left")
    return both.withColumns({
        "n_lines": F.size(F.split(text, "\n")).cast("long"),
        "n_dropped": F.coalesce(F.array_size("__rl_lost"), F.lit(0)).cast("long"),
        "text": F.when(F.col("__rl_lost").isNull(), text).otherwise(without_lines(text, F.col("__rl_lost"))),
    }).drop("__rl_text", "__rl_t", "__rl_lost", "__rl_id")


def without_lines(text, lost):
    """``text`` without the lines numbered in ``lost``; each line is looked at once.

    The struct binds the split text to a variable, so that the inner lambda does not split it anew for each line.
    """
    bound = F.array(F.struct(F.split(text, "\n").alias("lines"), lost.alias("lost")))

    def kept(x):
        stay = F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["lost"])
        return F.array_join(F.transform(stay, lambda at: F.get(x["lines"], at)), "\n")

    return F.get(F.transform(bound, kept), 0)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: every document of ``documents`` after line dedup, as a digest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), common AS (
  SELECT k, max(doc_id) AS max_doc FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.*, c.k IS NOT NULL AND l.doc_id <> c.max_doc AS gone FROM keyed l LEFT JOIN common c ON l.k = c.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
