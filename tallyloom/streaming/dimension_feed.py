"""A dimension that a running stream reads again in every micro-batch, never older than a bound.

A dimension is a folder of versions, ``version=<n>``, each a set of Parquet files with a ``_SUCCESS``
marker, as Spark writes them. Spark plans the parts of a source once for a whole stream, but reads them
anew in every micro-batch; so there is one part, whose reader picks the newest complete version at that
moment and passes on its files batch by batch, only the columns that the look-up needs. A
micro-batch therefore sees one version whole. One that was published longer ago than the bound
allows is an error, not an answer.
"""

import sys
import time
from collections.abc import Iterator, Mapping, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tallyloom.operators.bounded import MAX_BROADCAST_BYTES

FORMAT = "dimension_versions"

# sent to the workers as it is, so that they need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _newest(path: str) -> tuple[int, float, list] | None:
    """(version, when it was complete, its data files) of the newest complete version."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path)
    name = lambda info: info.path.rsplit("/", 1)[-1]
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    versions = sorted((int(name(f)[8:]), f.path) for f in found if name(f)[:8] == "version=" and name(f)[8:].isdigit())
    for version, folder in reversed(versions):
        inside = system.get_file_info(fs.FileSelector(folder, recursive=True))
        done = [f.mtime.timestamp() for f in inside if name(f) == "_SUCCESS"]
        if done:
            files = [f for f in inside if f.is_file and not name(f).startswith((".", "_"))]
            return version, done[0], sorted(files, key=lambda f: f.path)
    return None


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.path = schema, options["path"]
        bound = lambda key: float(options[key]) if key in options else None
        self.max_age, self.max_bytes, self.patience = bound("maxage"), bound("maxbytes"), float(options.get("patience", 30))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def _version(self) -> tuple[int, float, list]:
        give_up = time.monotonic() + self.patience
        while (found := _newest(self.path)) is None:
            if time.monotonic() > give_up:
                raise FileNotFoundError(f"no complete version in {self.path}")
            time.sleep(0.05)
        version, published, files = found
        age = time.time() - published
        if self.max_age is not None and age > self.max_age:
            raise ValueError(f"version {version} of {self.path} is too old: {age:.1f} s of {self.max_age:g} s allowed")
        if self.max_bytes is not None and sum(f.size for f in files) > self.max_bytes:
            raise ValueError(f"version {version} of {self.path} exceeds {self.max_bytes:.0f} bytes")
        return found

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs, parquet
        from pyspark.sql.pandas.types import to_arrow_schema

        version, published, files = self._version()
        system, _ = fs.FileSystem.from_uri(self.path)
        want = to_arrow_schema(self.schema)
        own = {"version": version, "published": int(published * 1000)}
        for info in files:
            with system.open_input_file(info.path) as file:
                for batch in parquet.ParquetFile(file).iter_batches(columns=[f.name for f in want if f.name not in own]):
                    arrays = [
                        pa.array([own[f.name]] * batch.num_rows, pa.int64()) if f.name in own
                        else batch.column(f.name).cast(f.type)
                        for f in want
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, schema=want)


class DimensionVersions(DataSource):
    """The newest complete version of a folder; columns are those of the schema that is asked for."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, {k.lower(): v for k, v in self.options.items()})


def publish_dimension(dimension: DataFrame, path: str) -> int:
    """Write ``dimension`` as the next version of the folder ``path``; returns its number.

    Streams take it up with their next micro-batch. Old versions may be removed once no batch
    that began with them is running. One writer at a time.
    """
    found = _newest(path)
    version = found[0] + 1 if found else 1
    dimension.write.mode("overwrite").parquet(f"{path}/version={version}")
    return version


def live_dimension(
    spark: SparkSession, path: str, on: Mapping[str, str], extend: Sequence[str], order: str | None = None,
    max_age: float | None = None, max_bytes: int | None = MAX_BROADCAST_BYTES, patience: float = 30,
) -> DataFrame:
    """The key, extend and order columns of the newest version of the folder ``path`` (a URI or an absolute path).

    For :func:`tallyloom.operators.lookup.widen` on a stream. No event meets a dimension that is older
    than ``max_age`` seconds plus one micro-batch: with nothing newer published, the batch fails, the
    stream stops, and its events wait for a restart. Columns ``version`` and ``published`` (epoch milliseconds)
    say which one it was. The reader holds to ``max_bytes`` of Parquet at every read, so that the look-up may be
    broadcast while the stream runs (``widen(..., small=True)``); with ``None`` there is no bound.
    """
    found = _newest(path)
    if found is None:
        raise FileNotFoundError(f"no complete version in {path}")
    kinds = {f.name: f.dataType for f in spark.read.parquet(f"{path}/version={found[0]}").schema.fields}
    schema = StructType()
    for column in dict.fromkeys([*on.values(), *extend, *([order] if order else [])]):
        schema.add(column, kinds[column])
    schema.add("version", "long").add("published", "long")
    spark.dataSource.register(DimensionVersions)
    reader = spark.read.format(FORMAT).schema(schema).option("path", path).option("patience", patience)
    for name, limit in (("maxAge", max_age), ("maxBytes", max_bytes)):
        if limit is not None:
            reader = reader.option(name, limit)
    return reader.load()


def seen_versions(dimension: DataFrame) -> DataFrame:
    """Version and age in milliseconds of what a read of the dimension finds now."""
    return dimension.select("version", (F.unix_millis(F.current_timestamp()) - F.col("published")).alias("age_ms")).distinct()
