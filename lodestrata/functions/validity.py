"""Field validity checks. A blank passes all of them but ``present``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions.rules import bare

# Accepted booleans and the number texts that are no amount.
BOOLEAN_TEXTS = ("0", "1", "FALSE", "N", "TRUE", "Y")
NUMBER_SHAPE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"


def blank(c: str | Column) -> Column:
    return bare(c) == ""


def present(c: str | Column) -> Column:
    return ~blank(c)


def numeric(c: str | Column) -> Column:
    """Finite decimal numbers of any length; a shape test, so no digit count is too long."""
    return blank(c) | F.translate(bare(c), "_", "").rlike(NUMBER_SHAPE)


def iso_date(c: str | Column) -> Column:
    """``YYYY-MM-DD`` in shape and a day of the calendar."""
    text = bare(c)
    real = text.rlike(DATE_SHAPE) & text.try_cast("date").isNotNull() & (F.left(text, F.lit(4)) != "0000")
    return blank(c) | F.coalesce(real, F.lit(False))


def boolean(c: str | Column) -> Column:
    return blank(c) | F.upper(bare(c)).isin(*BOOLEAN_TEXTS)
