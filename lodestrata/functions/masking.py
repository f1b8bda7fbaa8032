"""Column masks. A reader is privileged for a whole query, so the choice is made at plan time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.keys import as_col

NAME_TAIL = "***"
KINDS = ("money", "money_double", "personal_name", "tax_reference", "tokenised_account")


def masked(c: str | Column, kind: str) -> Column:
    """What an unprivileged reader sees; the type of the column stays as declared."""
    c = as_col(c)
    if kind == "personal_name":
        return F.concat(F.left(c, F.lit(1)), F.lit(NAME_TAIL))
    if kind == "money":
        return F.lit(None).cast("decimal(18,2)")
    if kind == "money_double":
        return F.lit(None).cast("double")
    if kind in ("tax_reference", "tokenised_account"):
        return F.lit(None).cast("string")
    raise ValueError(f"unknown mask {kind!r}")


def mask(df: DataFrame, masks: dict[str, str], privileged: bool = False) -> DataFrame:
    """Projection with every declared column masked unless the reader is privileged."""
    unknown = set(masks) - set(df.columns)
    if unknown:
        raise ValueError(f"masks name columns that do not exist: {sorted(unknown)}")
    if privileged:
        return df
    return df.select(*[masked(c, masks[c]).alias(c) if c in masks else F.col(c)
                       for c in df.columns])
