"""Idempotent upsert of micro-batches into a table of key ranges (survey ids X11, X15, K1; extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.operators.rangetable import RangeTable


class VersionedTable(RangeTable):
    """A table that takes micro-batches: a batch rewrites the files that its keys touch, and a replayed batch nothing."""

    def apply(self, batch: DataFrame, epoch: int, ordinal: str) -> dict:
        """Upserts a batch; of several rows of a key the one with the largest ``ordinal`` counts."""
        rest = [c for c in batch.columns if c not in self.keys]
        best = batch.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), ordinal).alias("_r"))
        newest = best.select(*self.keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
        return self.upsert(newest, [c for c in rest if c in self.fields.names], epoch)


def upsert_stream(rows: DataFrame, table: VersionedTable, checkpoint: str, ordinal: str):
    """Starts a query that merges each micro-batch; exactly once, since a version names the last epoch that it holds."""
    return rows.writeStream.foreachBatch(lambda batch, epoch: table.apply(batch, epoch, ordinal)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
