"""Table access and lineage cuts that work on a cluster.

Intermediate tables go to the folder named by ``spark.checkpoint.dir``; only where
that is unset and driver and executors are one machine (tests, a laptop) a temporary
folder is used. On a cluster without the setting nothing is written.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors can see."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that driver and executors share (the master is {master!r})")
        named = f"file://{tempfile.mkdtemp(prefix='sievemark-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


#: Bytes read for each file that is written, and files for each core at least.
FILE_BYTES, CORE_FILES = 1_000_000, 2


def _files(df: DataFrame) -> int:
    """The number of files to deal out ``df`` to before it is written, or 0: each task writes its own.

    Where Spark does not merge small partitions, a small table would become a file for each shuffle
    partition. On a local file system Hadoop launches chmod three times for each file. The tasks that make
    the rows stay as they are. Rows that a second run of a task could make otherwise (numbers,
    the first of a group) are not dealt out: a lost executor would mix two runs.
    """
    conf = df.sparkSession.conf
    if all(conf.get(f"spark.sql.adaptive.{k}") == "true" for k in ("enabled", "coalescePartitions.enabled")):
        return 0
    query = df._jdf.queryExecution()
    plan = query.optimizedPlan()
    if not plan.deterministic() or "Exchange hashpartitioning" not in query.executedPlan().toString():
        return 0
    leaves = plan.collectLeaves()
    read = sum(leaves.apply(i).stats().sizeInBytes() for i in range(leaves.length()))
    files = max(CORE_FILES * df.sparkSession.sparkContext.defaultParallelism, -(-read // FILE_BYTES))
    return files if 2 * files <= int(conf.get("spark.sql.shuffle.partitions")) else 0


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    The result no longer depends on the tasks that made it, so a lost executor
    costs one read, not a recomputation; it is compressed, unlike RDD checkpoints.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    files = _files(df)
    (df.repartition(files) if files else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def apart(*columns: str) -> Column:
    """One more grouping column that changes no group, named ``__apart``.

    An aggregation by ``columns`` and this one is dealt out otherwise than a join by
    ``columns`` alone. The join then shuffles its two sides itself, and Spark may split
    a key that holds many rows; it never does so where an aggregation uses the same shuffle.
    """
    return F.xxhash64(*columns).alias("__apart")


#: What may be broadcast, by a count of its rows.
BROADCAST_BYTES = 16_000_000


def fitted(df: DataFrame, row_bytes: int = 64) -> DataFrame:
    """``df``, a written table, marked for broadcasting if its counted rows of so many bytes are few enough.

    A join with it then leaves the other side where it is; beyond the size both sides are shuffled.
    """
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df
