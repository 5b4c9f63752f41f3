"""Fingerprints: of the bytes of files, one row per file, and of the rows of a table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import ceil

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField

from recfold.sources.storage import materialise, scratch_dir

_PIECE = 8 * 1024 * 1024
_TASK_BYTES = 128 * 1024 * 1024


def _located(spark: SparkSession, path: str) -> str:
    """The address of a path behind mounts and defaults, as the session's file system resolves it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        return where.getFileSystem(spark._jsc.hadoopConfiguration()).resolvePath(where).toString()
    except Py4JJavaError as error:
        if "FileNotFoundException" not in str(error.java_exception):
            raise
        raise FileNotFoundError(path) from error


def list_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``arquivo`` and ``tamanho_bytes`` of every file below ``paths``, empty and hidden ones included.

    Tasks list the folders: one the given paths, others the folders found there with all below.
    """
    def entries(uri: str, deep: bool):
        # Defined here, so that workers need nothing of this library.
        scheme, _, rest = uri.partition(":")
        if scheme == "file":
            storage, path = fs.LocalFileSystem(), "/" + rest.lstrip("/")
        else:
            storage, path = fs.FileSystem.from_uri(uri)
        before = uri[: len(uri) - len(path)] if uri.endswith(path) else f"{scheme}:"
        own = storage.get_file_info(path)
        if own.type == fs.FileType.File:
            return [(uri, own.size, False)]
        return [
            (before + info.path, info.size or 0, info.type == fs.FileType.Directory)
            for info in storage.get_file_info(fs.FileSelector(path, recursive=deep))
        ]

    def listing(deep: bool):
        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for uri in batch["arquivo"]:
                    yield pd.DataFrame(entries(uri, deep), columns=["arquivo", "tamanho_bytes", "pasta"])
        return work

    schema = "arquivo string, tamanho_bytes long, pasta boolean"
    roots = [_located(spark, path) for path in ([paths] if isinstance(paths, str) else paths)]
    top = spark.createDataFrame([(root,) for root in roots], "arquivo string").mapInPandas(listing(False), schema)
    top = materialise(top, f"{scratch_dir(spark)}/listing")
    folders = top.filter("pasta")
    number = folders.count()
    found = top.filter("NOT pasta")
    if number:
        deeper = folders.select("arquivo").repartition(number).mapInPandas(listing(True), schema)
        found = found.unionByName(deeper.filter("NOT pasta"))
    return found.select("arquivo", "tamanho_bytes")


def fingerprint(spark: SparkSession, paths: str | list[str], task_bytes: int = _TASK_BYTES) -> DataFrame:
    """Path, length and SHA-256 of every file below ``paths``, empty and hidden ones included.

    Files are dealt out to as many tasks as their bytes ask for and read there piece by piece,
    whatever their size. Paths are those that Arrow's file systems open, mounts resolved; one that
    does not exist raises ``FileNotFoundError``.
    """
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests = []
            for uri in batch["arquivo"]:
                scheme, _, rest = uri.partition(":")
                if scheme == "file":
                    storage, path = fs.LocalFileSystem(), "/" + rest.lstrip("/")
                else:
                    storage, path = fs.FileSystem.from_uri(uri)
                digest = hashlib.sha256()
                with storage.open_input_stream(path) as stream:
                    while piece := stream.read(_PIECE):
                        digest.update(piece)
                digests.append(digest.hexdigest())
            yield batch.assign(sha256=digests)

    files = materialise(list_files(spark, paths), f"{scratch_dir(spark)}/files")
    number, size = files.agg(F.count("*"), F.sum("tamanho_bytes")).first()
    tasks = min(number, max(spark.sparkContext.defaultParallelism, ceil((size or 0) / task_bytes)))
    return files.repartition(max(tasks, 1)).mapInPandas(work, "arquivo string, tamanho_bytes long, sha256 string")


def _six_decimals(value: Column) -> Column:
    """A double as decimal(38,6) writes it, by whole numbers where it is one of up to eight digits and six decimals.

    Such a number has 14 digits at most, so no other of that many digits is the same double.
    """
    scaled = F.rint(value * 1e6)
    whole = F.abs(scaled).cast("long")
    made = F.concat(
        F.when(scaled < 0, "-").otherwise(""), F.floor(whole / 1e6).cast("string"), F.lit("."),
        F.substring((whole % 1_000_000 + 1_000_000).cast("string"), 2, 6),
    )
    return F.when((F.abs(value) < 1e8) & (scaled / 1e6 == value), made).otherwise(
        value.try_cast("decimal(38,6)").cast("string")
    )


def _as_text(field: StructField) -> Column:
    """A value with its length, so that neighbours cannot run together; NULL is a mark of its own."""
    value = F.col(f"`{field.name}`")
    text = value.cast("string")
    if isinstance(field.dataType, DoubleType):
        text = F.coalesce(_six_decimals(value), text)
    elif isinstance(field.dataType, FloatType):
        text = F.coalesce(value.try_cast("decimal(38,6)").cast("string"), text)
    return F.coalesce(F.concat(F.lit("+"), F.length(text), F.lit(":"), text), F.lit("-"))


def content_fingerprint(df: DataFrame) -> DataFrame:
    """``linhas`` and ``sha256`` of a table, the same for any order, partitions or files of its rows.

    The values of a row, by column name, give a SHA-256 whose parts are summed over all rows: tasks
    reduce what they read to one row, and repeated rows count. Numbers with a fraction count to
    six decimals. An empty table has 0 rows.
    """
    fields = sorted(df.schema.fields, key=lambda field: field.name)
    digests = df.select(F.sha2(F.concat(*map(_as_text, fields)), 256).alias("digest"))
    parts = [F.conv(F.substring("digest", at, 15), 16, 10).cast("long").alias(f"parte_{n}") for n, at in enumerate((1, 17, 33, 49))]

    def total(name: str) -> Column:
        # By 20 bits at a time: sums of long numbers, which decimals of this size would slow down.
        return reduce(Column.__add__, [
            F.sum(F.shiftright(name, shift).bitwiseAND(0xFFFFF)).cast("decimal(20,0)") * F.lit(1 << shift) for shift in (0, 20, 40)
        ])

    sums = digests.select(*parts).agg(F.count("*").alias("linhas"), *[
        F.coalesce(total(f"parte_{n}"), F.lit(0)).cast("string").alias(f"soma_{n}") for n in range(len(parts))
    ])
    whole = F.concat_ws(":", F.col("linhas").cast("string"), *[f"soma_{n}" for n in range(len(parts))])
    return sums.select("linhas", F.sha2(whole, 256).alias("sha256"))


def compare_fingerprints(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row per file seen at either time; a file that came or went is not equal."""
    left = before.select("arquivo", F.col("sha256").alias("hash_pre"))
    right = after.select("arquivo", F.col("sha256").alias("hash_pos"))
    return left.join(right, "arquivo", "full").withColumn("iguais", F.col("hash_pre").eqNullSafe(F.col("hash_pos")))
