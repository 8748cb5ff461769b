"""Run a user's Python function on a column without failing the job."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe(fn: Callable[[Any], Any], return_type: T.DataType | str):
    """A column function giving ``struct<ok, error>``: the result, or the text of the exception.

    For user code only; values travel in Arrow batches. Built-in parsing uses ``operators.parse``.
    """
    ok = T._parse_datatype_string(return_type) if isinstance(return_type, str) else return_type
    schema = T.StructType([T.StructField("ok", ok), T.StructField("error", T.StringType())])

    def one(value: Any) -> tuple[Any, str | None]:
        try:
            return fn(value), None
        except Exception as e:  # the point is to turn any error into data
            return None, f"{type(e).__name__}: {e}"

    def batch(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(v) for v in values], columns=["ok", "error"])

    batch.__annotations__ = {"values": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(batch, schema)
