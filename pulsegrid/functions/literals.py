"""Python literals in string columns, parsed in Arrow batches and handed on as JSON."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def records_of(text: str | None) -> str | None:
    """JSON array of the records in a wrapped literal; null if it is no dict or list of dicts.

    One character is cut off at each end before the rest is read as a Python literal.
    """
    if text is None or len(text) < 2:
        return None
    try:
        found = ast.literal_eval(text[1:-1])
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None
    if isinstance(found, dict):
        found = [found]
    if not isinstance(found, list) or not all(isinstance(x, dict) for x in found):
        return None
    return json.dumps(found, default=str, ensure_ascii=False)


@F.pandas_udf(StringType())
def _records(texts: pd.Series) -> pd.Series:
    return texts.map(records_of, na_action="ignore")


def literal_records(text: Column) -> Column:
    """Array of records, each a map of JSON texts by key; null where the literal is rejected."""
    return F.from_json(_records(text), "array<map<string,string>>")
