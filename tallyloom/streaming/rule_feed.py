"""A rules folder that a running stream reads again in every micro-batch.

Spark lists the files of an ordinary file source once, when the query starts, so an
edit would not be seen. A Python data source is read anew each time its plan runs.
Only the small rules side goes through it; events stay with Spark's own sources.
"""

import sys
import time
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallyloom.operators.bounded import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS
from tallyloom.operators.rules import current_rules, with_epoch
from tallyloom.sources.rules import parse_rules, usable

FORMAT = "rule_lines"

# sent to the workers as it is, so that they need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _FolderReader(DataSourceReader):
    def __init__(self, path: str, max_rows: int | None, max_bytes: int | None, patience: float):
        self.path, self.max_rows, self.max_bytes, self.patience = path, max_rows, max_bytes, patience

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def _files(self, system, root: str) -> list | None:
        """The files of a complete set in their order, or None while it is being rewritten."""
        from pyarrow import fs

        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        name = lambda info: info.path.rsplit("/", 1)[-1]
        if any(name(f) == "_temporary" for f in found):
            return None
        versions = sorted(
            (int(name(f)[8:]), f.path) for f in found if not f.is_file and name(f)[:8] == "version=" and name(f)[8:].isdigit()
        )
        for _, folder in reversed(versions):
            inside = system.get_file_info(fs.FileSelector(folder))
            if any(name(f) == "_SUCCESS" for f in inside):
                found = inside
                break
        else:
            if versions:
                return None
        if system.get_file_info(root).type == fs.FileType.NotFound:
            return None
        kept = [f for f in found if f.is_file and not name(f).startswith((".", "_"))]
        return sorted(kept, key=lambda f: f.path)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.path)
        give_up = time.monotonic() + self.patience
        while True:
            lines = self._lines(system, root)
            if lines is not None:
                yield from enumerate(lines)
                return
            if time.monotonic() > give_up:
                raise FileNotFoundError(f"no complete set of rules in {self.path}")
            time.sleep(0.05)

    def _lines(self, system, root: str) -> list[str] | None:
        files = self._files(system, root)
        if files is None:
            return None
        if self.max_bytes is not None and sum(f.size for f in files) > self.max_bytes:
            raise ValueError(f"rules in {self.path} exceed {self.max_bytes} bytes")
        lines = []
        try:
            for info in files:
                with system.open_input_stream(info.path) as stream:
                    lines += [line for line in stream.read().decode("utf-8").split("\n") if line]
        except FileNotFoundError:
            return None  # rewritten meanwhile
        again = self._files(system, root)
        if again is None or [(f.path, f.size, f.mtime) for f in again] != [(f.path, f.size, f.mtime) for f in files]:
            return None
        if self.max_rows is not None and len(lines) > self.max_rows:
            raise ValueError(f"rules in {self.path} exceed {self.max_rows} rows")
        return lines


class RuleFolder(DataSource):
    """Text files of rule lines in one folder that every executor can reach."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "seq bigint, line string"

    def reader(self, schema) -> DataSourceReader:
        limit = lambda name: int(self.options[name]) if name in self.options else None
        return _FolderReader(
            self.options["path"], limit("maxRows"), limit("maxBytes"), float(self.options.get("patience", 30))
        )


def live_rules(
    spark: SparkSession,
    path: str,
    max_rows: int | None = MAX_BROADCAST_ROWS,
    max_bytes: int | None = MAX_BROADCAST_BYTES,
    patience: float = 30,
) -> DataFrame:
    """The current rules of the folder ``path`` (a URI or an absolute path).

    The lines of its files, in the order of file names, are changes: the last one of an id
    holds, a delete takes the rule away, and a ``DELETE_RULES_ALL`` command voids what comes before
    it. So rules are changed by adding a file. To replace the whole set, write it to a subfolder
    ``version=<n>`` with Spark: the highest one with a ``_SUCCESS`` marker is read, and nothing else then. A
    folder that is missing, or in the middle of being rewritten, is waited for, ``patience`` seconds at
    most; then it is an error, since a batch that saw no rules would lose its events for good.

    The reader holds to its bounds at every read, so the rules may safely be broadcast
    while a stream runs. A set beyond them stops the stream; with ``None`` there is no
    bound, and the stream has to join with ``small_rules=False``.

    A ``CLEAR_STATE_ALL`` command clears the state of a running stream: rules carry the number of such commands
    as their ``epoch``, which is part of every group's key, and readers of the results take the latest epoch. Whoever
    replaces the whole set keeps the commands in it.
    """
    spark.dataSource.register(RuleFolder)
    reader = spark.read.format(FORMAT).option("path", path).option("patience", patience)
    for name, limit in (("maxRows", max_rows), ("maxBytes", max_bytes)):
        if limit is not None:
            reader = reader.option(name, limit)
    return current_rules(with_epoch(usable(parse_rules(reader.load())).drop("line")))


def current_epoch(spark: SparkSession, path: str) -> int:
    """How many times the state has been cleared by commands in the folder of rules, so far."""
    spark.dataSource.register(RuleFolder)
    lines = spark.read.format(FORMAT).option("path", path).load()
    return with_epoch(usable(parse_rules(lines)).drop("line")).agg(F.coalesce(F.max("epoch"), F.lit(0))).first()[0]
