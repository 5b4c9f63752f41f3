"""Shared scratch storage: tables written once and read by several later steps."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session without that setting falls back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="recfold-")
    return f"{shared.rstrip('/')}/recfold-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    Cuts the lineage like a checkpoint, but stays columnar, so that each later reader scans
    only the columns and row groups it needs.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(*works: Callable[[], object]) -> list:
    """The results of jobs that do not need each other, run at the same time.

    Short jobs and the last tasks of long ones leave a cluster half idle; another job fills it.
    """
    with ThreadPoolExecutor(len(works)) as pool:
        return [done.result() for done in [pool.submit(work) for work in works]]
