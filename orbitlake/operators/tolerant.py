"""Kernels that may fail on some groups: the job goes on, and each failed group leaves a row with the reason."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASON = "error"


def apply_groups(df: DataFrame, keys: Sequence[str], kernel: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType, attempts: int = 1, reason: str = REASON) -> DataFrame:
    """kernel on each group of keys, as applyInPandas does it, and a column `reason`: NULL on the kernel's rows; a group on which the kernel raises `attempts` times has one row instead, with its keys (as far as the
    schema has them), the last exception's type and text as reason, and NULL elsewhere. A result that lacks columns of the schema counts as a failure. Failures of the machine (a lost executor, no memory) are Spark's to repeat."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name for f in kind.fields]
    whole = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in kind.fields], T.StructField(reason, T.StringType(), True)])

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        why = None
        for _ in range(attempts):
            try:
                out = kernel(pdf.copy() if attempts > 1 else pdf)
                if missing := [n for n in names if n not in out.columns]:
                    raise KeyError(f"no column {', '.join(missing)} in the result")
                return out[names].assign(**{reason: None})
            except Exception as e:  # whatever the kernel raises is the reason
                why = f"{type(e).__name__}: {e}"
        row = dict.fromkeys(names) | {k: v for k, v in zip(keys, key) if k in names}
        return pd.DataFrame([row | {reason: why}], columns=[*names, reason], dtype=object)

    return df.groupBy(*keys).applyInPandas(run, whole)


def parted(result: DataFrame, reason: str = REASON) -> tuple[DataFrame, DataFrame]:
    """The rows of groups that went well, and those of failed ones."""
    return result.where(F.col(reason).isNull()).drop(reason), result.where(F.col(reason).isNotNull())
