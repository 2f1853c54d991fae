"""Helpers shared by the operators: tables, shared work tables, clashing names."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veil.runtime import remove_folder, work_dir

#: A word is a run of anything but these six characters.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
WORD_CLASS = "[^\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Folders of work tables: those of the operators that are running, and below them what results are read from.
_scopes: list[list[str]] = [[]]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder path below the shared work folder, removed at the end of the scope it is made in."""
    _scopes[-1].append(work_dir(spark, label))
    return _scopes[-1][-1]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A scope of work tables: what is made in it is removed when it ends, also by a failure."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove_folder(spark, path)


def release(spark: SparkSession) -> None:
    """Remove what results of earlier calls are read from; call it when these have been used."""
    while _scopes[0]:
        remove_folder(spark, _scopes[0].pop())


def tidy(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator whose result is stored, and whose work tables are removed as soon as it is.

    The result's own folder belongs to the scope around the call: an outer operator's, or the caller's (``release``).
    """
    @wraps(operator)
    def run(df: DataFrame, *args, **kwargs) -> DataFrame:
        spark = df.sparkSession
        path = scratch_dir(spark, operator.__name__)
        with scratch(spark):
            result = operator(df, *args, **kwargs)
            result.write.parquet(path)
        return spark.read.schema(result.schema).parquet(path)

    return run


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared work folder and read again.

    The lineage ends at the files, so a lost executor costs at most the tasks
    that read from it.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text column as an array; null and blank text: no words."""
    return F.array_remove(F.split(F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES)), f"{SPACE_CLASS}+"), "")
