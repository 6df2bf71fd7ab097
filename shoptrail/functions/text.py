"""Text expressions: trimming, id order, number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to the space counts as blank, not the space alone.
_BLANKS = "".join(chr(c) for c in range(0x21))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


def as_long(c: Column) -> Column:
    """The whole number in ``c``; null for anything else."""
    return c.try_cast("bigint")


def is_plain_number(c: Column) -> Column:
    """Whether ``c`` is a whole number written the way Spark writes it."""
    return F.coalesce(as_long(c).cast("string") == c, F.lit(False))


def as_double(c: Column) -> Column:
    """The finite number in ``c``; null for anything else."""
    d = c.try_cast("double")
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def id_order(c: Column) -> Column:
    """Sort key of an id: whole numbers first and by value, then text.

    Ids are strings. The text itself comes last in the key, so ``7`` and
    ``07`` differ and the order is total.
    """
    n = as_long(c)
    return F.struct(
        n.isNull().alias("is_text"),
        F.coalesce(n, F.lit(0).cast("bigint")).alias("number"),
        c.alias("id"),
    )


def fixed(c: Column, places: int) -> Column:
    """Decimal text with ``places`` digits after a point."""
    return F.format_string(f"%.{places}f", c)
