"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tabulore", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine expects; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Plans here hold many expressions; recording the call site of each one doubles planning time.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Folders stored inside the blocks of ``stored_frames`` that are open, the innermost last.
_stored: list[list[str]] = []


@contextmanager
def stored_frames(spark: SparkSession) -> Iterator[None]:
    """Delete what ``cut_lineage`` stored inside the block when it ends; frames from inside must have been used by then."""
    _stored.append([])
    try:
        yield
    finally:
        configuration = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _stored.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(configuration).delete(folder, True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the folder named in ``spark.checkpoint.dir``, or one beside the warehouse, which executors share too."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if not context.master.startswith("local") and (warehouse.startswith("file:") or ":" not in warehouse):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{warehouse.rstrip('/')}/_checkpoints"
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Like a checkpoint it survives the loss of executors, and being a Parquet
    table later passes read only the columns they need.
    """
    return cut_lineage_of_blocks([df])


def cut_lineage_of_blocks(blocks: Iterable[DataFrame]) -> DataFrame:
    """The same for the union of frames with equal columns: each is planned, written and forgotten before the next is built."""
    path, first, mode = None, None, "error"
    for df in blocks:
        if first is None:
            first = df
            path = f"{ensure_checkpoint_dir(df.sparkSession)}/tabulore/{uuid.uuid4().hex}"
            if _stored:
                _stored[-1].append(path)
        df.write.mode(mode).parquet(path)
        mode = "append"
    if first is None:
        raise ValueError("no frame to store")
    return first.sparkSession.read.schema(first.schema).parquet(path)
