"""Column expressions for typed record fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_number(col: Column, target: str) -> Column:
    """Text to a whole-number type: ``'20'`` and ``'20.7'`` give 20, anything else null.

    Plain whole numbers take the direct cast. For the rest the fraction is cut from the text, not
    through a double, so a BIGINT keeps all its digits; a zero is put before the digits so that
    ``'.5'`` has some. Values out of the target's range are null.
    """
    cut = F.regexp_replace(F.trim(col), r"^([+-]?)([0-9]*)\.[0-9]*$", "$10$2")
    return F.coalesce(col.try_cast(target), cut.try_cast(target))


def repair_shifted(col: Column, donor: Column, sentinel: str = "False", length: int | None = None) -> Column:
    """``donor`` where ``col`` holds the sentinel, else ``col``.

    With ``length``, a code of any other length becomes null. Null stays null.
    """
    repaired = F.when(col == sentinel, donor)
    if length is not None:
        repaired = repaired.when(F.length(col) != length, F.lit(None))
    return repaired.otherwise(col)


def valid_code(col: Column, length: int, guard: Column | None = None) -> Column:
    """``col`` where it has the wanted length, else null.

    ``guard`` limits the check to rows where that column is present; other rows pass unchecked.
    """
    wrong = F.length(col) != length
    if guard is not None:
        wrong = guard.isNotNull() & wrong
    return F.when(wrong, F.lit(None)).otherwise(col)


def epoch_span(end: Column, start: Column, unit_seconds: int, digits: int = 3) -> Column:
    """Time from ``start`` to ``end``, both epoch seconds, in units of ``unit_seconds``, rounded."""
    scale = 10**digits
    return F.round((end.cast("bigint") - start.cast("bigint")) / unit_seconds * scale) / scale
