"""Tables between the steps of an operator, in the folder that driver and executors share."""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: rows that go to a Python worker at a time, where the session does not say: texts are large rows, and each side
#: holds whole batches
BATCH_ROWS = 1000


def prepared(spark: SparkSession) -> None:
    """What the queries and the pipeline ask of their session. The Python workers can import this package also where it
    is not installed: the folder that the driver has it in joins their search path. And batches are small, unless the
    session's owner has set their size."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(batch, None) is None:
        spark.conf.set(batch, str(BATCH_ROWS))
    folder = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if folder not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [folder, known]))


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``, else the folder set on the
    context, else one inside the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/llm-tables"
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, and survives
    the loss of executors. The folder's owner clears it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def joined_by_weight(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """``rows`` joined with ``table``, which has one row a key and says in ``weight`` how many of the ``total`` rows
    have it. No more than 1,000 keys can have above a thousandth of all rows: those are broadcast, so that no task gets a
    very common key's rows. The others are shuffled."""
    heavy = F.broadcast(table.where(F.col(weight) * 1000 > total))
    light = table.where(F.col(weight) * 1000 <= total)
    return rows.join(heavy, keys).unionByName(
        rows.join(heavy.select(*keys), keys, "left_anti").join(light, keys))
