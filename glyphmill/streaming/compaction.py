"""Running sums kept as a few sorted-out runs, merged as they grow.

Every batch of a stream adds a run with its own sums. A run that is less than ``RATIO`` times as large as all
newer ones is merged with them, so sizes at least double from each run to the next older one: there are no
more runs than the logarithm of the number of keys, all of them together have less than twice the rows of the
oldest, and a row is rewritten as often as its run doubles. A manifest that names the runs is committed last,
and a reader follows it; a batch that runs again starts from the manifest before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.schemas import RUNS
from glyphmill.session import local_table
from glyphmill.sources import state

RATIO = 2


@dataclass(frozen=True)
class RunningSums:
    """Sums of ``total`` for each ``keys`` under the folder ``out``."""

    out: str
    keys: tuple[str, ...]
    total: str

    def _runs(self, spark: SparkSession, before: int | None = None) -> list[tuple[str, int]]:
        """Paths and row counts of the runs of the last manifest, or the last one before a batch, oldest first."""
        steps = [s for s in state.committed_steps(spark, f"{self.out}/manifest") if before is None or s < before]
        if not steps:
            return []
        rows = state.load_step(spark, f"{self.out}/manifest", steps[-1])["runs"].collect()
        return [(r["path"], r["n_rows"]) for r in sorted(rows, key=lambda r: r["place"])]

    def _read(self, spark: SparkSession, paths: Sequence[str]) -> DataFrame:
        """Sums over runs; the schema is that of the first."""
        parts = [spark.read.parquet(path) for path in paths]
        return reduce(DataFrame.unionByName, parts).groupBy(*self.keys).agg(F.sum(self.total).alias(self.total))

    def add(self, sums: DataFrame, batch_id: int) -> None:
        """Take over the sums of a batch, one row per key. Batches come in the order of their numbers.

        The batch is written once; a merge reads the runs it replaces and nothing else.
        """
        spark = sums.sparkSession
        runs = self._runs(spark, before=batch_id)
        path = f"{self.out}/runs/batch={batch_id}"
        sums.select(*self.keys, self.total).write.mode("overwrite").parquet(path)
        rows = spark.read.parquet(path).count()
        merged, whole = [path], rows
        while runs and runs[-1][1] < RATIO * whole:
            old, n = runs.pop()
            merged.append(old)
            whole += n
        if len(merged) > 1:
            path = f"{self.out}/runs/merged={batch_id}"
            self._read(spark, merged).write.mode("overwrite").parquet(path)
            rows = spark.read.parquet(path).count()
        # An empty batch leaves no run, but the first one stays: it has the schema.
        if rows or not runs:
            runs.append((path, rows))
        manifest = local_table(spark, [(i, *run) for i, run in enumerate(runs)], RUNS)
        state.save_step(spark, f"{self.out}/manifest", batch_id, runs=manifest)
        self._drop_unread(spark)

    def _drop_unread(self, spark: SparkSession) -> None:
        """Remove runs that none of the kept manifests names; readers of the one before the last can end."""
        kept = set()
        for step in state.committed_steps(spark, f"{self.out}/manifest"):
            kept |= {r["path"] for r in state.load_step(spark, f"{self.out}/manifest", step)["runs"].collect()}
        for path in state.sub_folders(spark, f"{self.out}/runs"):
            if not any(path.endswith(p.removeprefix(self.out)) for p in kept):
                state.remove(spark, path)

    def current(self, spark: SparkSession) -> DataFrame:
        """The sums of all batches committed so far; none yet is an error."""
        if not state.committed_steps(spark, f"{self.out}/manifest"):
            raise ValueError(f"{self.out} holds no committed batch")
        return self._read(spark, [path for path, _ in self._runs(spark)])

    def sizes(self, spark: SparkSession) -> list[int]:
        """Rows of the runs a reader reads, oldest first."""
        return [n for _, n in self._runs(spark)]
