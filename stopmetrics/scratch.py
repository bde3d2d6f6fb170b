"""Folders for written intermediates, in storage every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_FOLDER_SETTING = "spark.checkpoint.dir"
_FREES_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from the session's setting; fails, in every mode, where none is set."""
    folder = spark.conf.get(_FOLDER_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"Set {_FOLDER_SETTING} to a folder all executors can reach.")
    return folder.rstrip("/")


def set_folder_for_tests(spark: SparkSession) -> None:
    """Give a single-process session without a shared folder a temporary one; registered queries call this."""
    unset = not spark.conf.get(_FOLDER_SETTING, None) and not spark.sparkContext.getCheckpointDir()
    if unset and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stopmetrics-"))


def new_folder(spark: SparkSession, label: str) -> str:
    """Path, not yet created, that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back, so that several results share one computation.

    The files outlive lost executors, and each reader still prunes its own columns.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes of a DataFrame within this block drop their shuffle files when they end.

    Without it these files stay until the driver happens to collect its garbage, so a job of several writes holds the
    shuffles of all of them at once. The setting is the caller's again afterwards.
    """
    before = spark.conf.get(_FREES_SETTING, None)
    spark.conf.set(_FREES_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREES_SETTING)
        else:
            spark.conf.set(_FREES_SETTING, before)
