"""Where intermediate results live.

Lineage is cut with reliable checkpoints or written tables only, so that a lost
executor never costs more than the tasks it was running. Both go to the shared folder
the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


JIT_BYTECODE_LIMIT = 8_000


def tune(spark: SparkSession) -> SparkSession:
    """Keep generated code within what the JVM compiles.

    Wide chains of labels generate methods beyond 8000 bytes of bytecode, which HotSpot
    only interprets. With the limit lowered, such a stage is generated operator by
    operator in smaller methods, which measured more than twice as fast here.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_BYTECODE_LIMIT)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a temporary one only in local mode."""
    context = spark.sparkContext
    active = context.getCheckpointDir()
    if active:
        return active
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="ledgerlens-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared folder and go on from the stored columns.

    A written table is computed once (a checkpoint recomputes its last stage), is read
    column by column, and has a known size, so joins with small ones broadcast by
    themselves.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin_layout(df: DataFrame) -> DataFrame:
    """Store ``df`` with its partitions and row order as they are."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a written intermediate table."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Probe a path through Hadoop, so that any configured file system works."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def spread(df: DataFrame, per_core: int = 128 << 20) -> DataFrame:
    """Hand a small input to all cores before per-row Python work; large inputs have enough partitions."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < per_core * cores else df
