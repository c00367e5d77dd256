"""Session defaults and the shared folder used to cut lineage."""

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ON_DISK = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # one bound for buffers and caches of all parts of the state in an executor
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # files as large as what is in them: a part of the state sets aside some 4 MB else, however small it is
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
_starting = threading.Lock()


def build_session(master: str | None = None, app: str = "tallyloom", **conf) -> SparkSession:
    """A session with the settings the plans expect; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # state that outgrows the heap lives on disk; only its changes are checkpointed
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state on the executors' disks, if the session does not say where.

    Spark's own choice is a map in the heap of the executors, two versions of it and that of a run which has just
    ended: a state that does not fit there ends the stream. A stream that has a checkpoint goes on with the
    store that it began with. The settings are those of the stream; the session is left as it was.
    """
    with _starting:
        own = spark.conf.get(_PROVIDER, None) is not None
        ours = {} if own else {key: value for key, value in _ON_DISK.items() if spark.conf.get(key, None) is None}
        for key, value in ours.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key in ours:
                spark.conf.unset(key)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from the written copy.

    Used where a later step must see the very same rows twice (positions given out
    by a range shuffle, say) even after an executor is lost. The folder is the one
    the cluster names in ``spark.checkpoint.dir``; only a local session without
    that setting gets a folder of its own.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="tallyloom-checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder next to the checkpoints, reachable by every executor."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        return tempfile.mkdtemp(prefix="tallyloom-")
    return f"{base.rstrip('/')}/tallyloom-{uuid.uuid4().hex}"
