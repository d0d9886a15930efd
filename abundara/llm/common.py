"""Shared helpers: written tables in the cluster's shared folder, and table readers."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run without the six ASCII white-space characters (also what bytes.split() cuts at).
WORD = r"[^\x20\x09-\x0D]+"
#: Shuffle files of a finished write go at its end, not when the driver next collects garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local master, whose executor is this process, may leave it unset and gets a folder
    of its own that goes at exit; on a cluster a missing setting is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="scratch-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def cut(df: DataFrame, *, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends at files any executor can reread.

    An aggregate written before a join also lets adaptive execution split the join's hot keys:
    both sides are then plain exchanges.  ``batch_rows`` bounds the rows of an Arrow batch during the write:
    the executor and its Python worker each hold batches of whole texts outside the heap.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/cut-{uuid.uuid4().hex}"
    schema, wanted = df.schema, {CLEAN_UP: "true"} | ({BATCH_ROWS: str(batch_rows)} if batch_rows else {})
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    table_ = spark.read.schema(schema).parquet(path)
    table_.written_to = path
    return table_


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``cut`` that no later step reads: only for those whose every reader has been written itself."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text"):
    """Raw UTF-8 of a text column, null as empty: no decoding between the JVM and Python."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def text_digest(column: str = "text"):
    """64 bits that tell texts apart, null as empty."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("")))


def give_back() -> None:
    """Unused memory of this process goes back to the system: Arrow's pool and the C library keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def lean(run):
    """A function on Arrow batches, for mapInArrow, whose worker waits for its next task without the memory of this one."""

    def held(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return held


def slices(batches, rows: int = 1000):
    """Batches in parts of a few rows, so that a step's lists hold those of a part only."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def fresh(name: str, taken) -> str:
    """A column name that clashes with none of ``taken``, compared as Spark does (without case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name
