"""Results upserted into sorted, bucketed runs that are merged level by level.

Each batch is one table, bucketed and sorted by the id of a metric of a document, which it has once. What
holds is, of every run, the rows that no newer run has: merge joins of tables with the same buckets, so rows are
dealt out once, when their batch is written, and never again, neither by a merge nor by a read. A full
level becomes one run of the next, so a row is rewritten as many times as there are levels, and a read
looks at a few runs, not at every batch.

(An aggregate over the union of the runs would look simpler. Spark 4.1.2 plans it without a shuffle and
then reads the tables without their buckets, which gives wrong results.)
"""

import re
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.model import RESULTS
from tallyloom.operators.documents import addressed, latest

#: What tells results apart.
_KEY = ("rule_id", "table_name", "grouping_keys", "grouping_values", "index", "doc_id", "metric")


class Run(NamedTuple):
    level: int
    first: int
    last: int


class LeveledResults:
    """Runs as tables ``<name>_l<level>_<first batch>_<last batch>`` in the catalog; one writer at a time.

    Batches are numbered from 0 in the order in which they hold. A batch that is written again replaces its run, unless
    it has been merged already: then it is there. A merge that failed half way leaves its run unseen or
    the merged ones covered by it, which are dropped by the next one.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int = 64, fanout: int = 4):
        if not re.fullmatch(r"[a-z][a-z0-9_]*", name):
            raise ValueError("a name is of small letters, digits and underscores")
        self.spark, self.name, self.buckets, self.fanout = spark, name, buckets, fanout

    def _all(self) -> list[Run]:
        found = (re.fullmatch(rf"{self.name}_l(\d+)_(\d+)_(\d+)", t.name) for t in self.spark.catalog.listTables())
        return [Run(*map(int, m.groups())) for m in found if m]

    def _table(self, run: Run) -> str:
        return f"{self.name}_l{run.level}_{run.first}_{run.last}"

    def runs(self) -> list[Run]:
        """The runs that hold, those of the earliest batches first."""
        every = self._all()
        covered = lambda r: any(o.level > r.level and o.first <= r.first and r.last <= o.last for o in every)
        return sorted((r for r in every if not covered(r)), key=lambda r: r.first)

    def _write(self, rows: DataFrame, run: Run) -> None:
        rows.write.mode("overwrite").format("parquet").bucketBy(self.buckets, "id").sortBy("id").saveAsTable(self._table(run))

    def _newest(self, runs: list[Run]) -> DataFrame:
        """Rows of each run that no newer one has."""
        frames = [self.spark.table(self._table(r)) for r in runs]
        parts = []
        for k, rows in enumerate(frames):
            for newer in frames[k + 1 :]:
                rows = rows.join(newer.select("id"), "id", "left_anti")
            parts.append(rows)
        return reduce(DataFrame.unionByName, parts)

    def add(self, results: DataFrame, batch: int) -> None:
        """Upsert the results of one batch; merges the levels that are full then."""
        if any(r.level > 0 and r.first <= batch <= r.last for r in self.runs()):
            return
        rows = latest(addressed(results).withColumn("version", F.lit(batch).cast("bigint")))
        rows = rows.withColumn("id", F.to_json(F.struct(*_KEY)))
        self._write(rows.repartition(self.buckets, "id"), Run(0, batch, batch))
        level = 0
        while len(full := [r for r in self.runs() if r.level == level]) >= self.fanout:
            self._write(self._newest(full), Run(level + 1, full[0].first, full[-1].last))
            level += 1
        self._drop([r for r in self._all() if r not in self.runs()])

    def read(self) -> DataFrame:
        """The latest version of every metric of every document, as long results."""
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], RESULTS)
        return self._newest(runs).select(*RESULTS.names)

    def _drop(self, runs: list[Run]) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(run)}")

    def drop(self) -> None:
        self._drop(self._all())
