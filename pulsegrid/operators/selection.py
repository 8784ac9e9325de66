"""Which files and participants a run takes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import SENSITIVE, SOURCE
from ..functions.scalars import normal_source


def anonymise(df: DataFrame, columns: tuple[str, ...] = SENSITIVE) -> DataFrame:
    """Without the columns that name a person or device; missing ones do not matter."""
    return df.drop(*columns)


def from_source(df: DataFrame, source: str = SOURCE, column: str = "data_source") -> DataFrame:
    """Rows of one source whatever its case and surrounding white space; null is no source."""
    return df.where(normal_source(F.col(column)) == source)


def unprocessed(files: DataFrame, log: DataFrame, key: str = "filename") -> DataFrame:
    """Files that the log does not name."""
    return files.join(log.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def processed(files: DataFrame, log: DataFrame, key: str = "filename") -> DataFrame:
    return files.join(log.select(key).distinct(), key, "left_semi")


def select_ids(ids: DataFrame, wanted: DataFrame, key: str = "participant_id") -> DataFrame:
    return ids.join(wanted.select(key).distinct(), key, "left_semi")


def skip_ids(ids: DataFrame, present: DataFrame, *, skip: bool, resume: bool, key: str = "participant_id") -> DataFrame:
    """Without IDs already in the output, if asked; resuming by the log turns skipping off."""
    return ids.join(present.select(key).distinct(), key, "left_anti") if skip and not resume else ids
