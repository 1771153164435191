"""Columns over prices."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def currency(text: Column) -> Column:
    """Number in a currency string such as ``$1,200.00``; NULL where there is none.

    Every ``$`` and ``,`` is removed wherever it stands, so ``10,00`` is 1000.
    """
    return F.translate(text, "$,", "").try_cast("double")


def band(value: Column, ceilings: Sequence[tuple[str, float]], top: str) -> Column:
    """Label of the first band whose ceiling lies above ``value``, else ``top``.

    ``ceilings`` holds ``(label, exclusive ceiling)`` in ascending order. NULL and
    NaN compare with no ceiling and get ``top``: filter them out first.
    """
    label = F.lit(top)
    for name, ceiling in reversed(ceilings):
        label = F.when(value < ceiling, F.lit(name)).otherwise(label)
    return label
