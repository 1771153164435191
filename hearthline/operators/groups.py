"""Range filter and statistics per group.

Formulas are SQL text: one call to Spark each, however many operations they have.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, IntegralType

LIMB = 1 << 30  # sums of 2**33 limbs below it don't overflow
LARGEST = 2.0**90  # below it numbers are three limbs; steps of doubles there are over 10**11
GUARD = 4  # decimals of a value beyond those of its average
PLACES = 6  # decimals of a value at least, and of its first limb
DECIMALS = 15  # of a value at most
WIDE = "decimal(38,0)"


def within(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows with ``low <= column <= high``; NULL and NaN go."""
    return df.filter(F.col(column).between(low, high))


class ExactAverage:
    """The average of a column of type ``kind``, rounded half away from zero to ``digits``.

    ``sums`` are what a group adds up, ``steps`` what makes the average of their names. The
    sums are exact, so the result depends neither on the order of addition nor on the
    size of the values: whole numbers and fractions are added up apart, as whole-number
    limbs, and decimals as decimals. Of floating values as many decimals count as the average
    has and four more, at least six and at most fifteen. Only a group with a value that is
    not finite or beyond 10**27 has a floating average.
    """

    def __init__(self, name: str, column: str, digits: int, kind: DataType = DoubleType()):
        self.name, self.digits = name, digits
        self.sums: list[Column] = []
        self.names: list[str] = []
        self._add("n", f"count({column})")
        if isinstance(kind, DecimalType):
            self.scale, self.limbs, self.parts = min(kind.scale, DECIMALS), [], []
            self._add("total", f"sum(CAST({column} AS decimal({kind.precision},{self.scale})))")
        elif isinstance(kind, IntegralType):
            self.scale, self.limbs, self.parts = 0, ["high", "low"], []
            number = f"CAST({column} AS bigint)"
            self._add("high", f"sum(shiftright({number}, 30))")
            self._add("low", f"sum({number} & {LIMB - 1})")
        else:
            self.scale = max(PLACES, min(DECIMALS, digits + GUARD))
            self._floating(f"CAST({column} AS double)")

    def _label(self, part: str) -> str:
        return f"`_{self.name}_{part}`"

    def _add(self, part: str, total: str) -> None:
        self.names.append(part)
        self.sums.append(F.expr(f"{total} AS {self._label(part)}"))

    def _floating(self, number: str) -> None:
        self.limbs, self.parts = ["top", "high", "low"], ["part"]
        self._add("fits", f"count_if(abs({number}) < {LARGEST!r}D)")
        self._add("floating", f"avg({number})")
        number = f"if(abs({number}) < {LARGEST!r}D, {number}, NULL)"
        for limb, unit in zip(self.limbs, (2.0**60, 2.0**30, 1.0)):
            # Casts cut towards zero; quotients and differences of doubles are exact here.
            whole = f"CAST({number} / {unit!r}D AS bigint)"
            self._add(limb, f"sum({whole})")
            number = f"({number} - {whole} * {unit!r}D)"
        number = f"({number} * {10.0**PLACES!r}D)"
        if self.scale == PLACES:
            self._add("part", f"sum(CAST(rint({number}) AS bigint))")
            return
        self.parts.append("rest")
        first = f"CAST({number} AS bigint)"
        self._add("part", f"sum({first})")
        self._add("rest", f"sum(CAST(rint(({number} - {first}) * {10.0 ** (self.scale - PLACES)!r}D) AS bigint))")

    def steps(self) -> list[dict[str, str]]:
        """Columns to compute one after the other from the sums; the last is the average.

        ``(whole + part / 10**scale) / n`` is ``floor + rest / unit`` with a rest that is not
        negative, in whole numbers of at most 38 digits. All quotients are exact.
        """
        scale, digits = self.scale, self.digits
        c = {x: self._label(x) for x in (
            "n", "total", "whole", "fraction", "rows", "unit", "over", "base", "all", "left", "floor", "near", "less", *self.limbs, *self.parts
        )}

        def wide(x) -> str:
            return f"CAST({x} AS {WIDE})"

        if self.limbs:
            whole = wide(c[self.limbs[0]])
            for limb in self.limbs[1:]:
                whole = wide(f"{whole} * {LIMB} + {c[limb]}")
            part = wide(c[self.parts[0]] if self.parts else 0)
            for more in self.parts[1:]:
                part = wide(f"{part} * {wide(10 ** (scale - PLACES))} + {c[more]}")
        else:
            whole = wide(f"floor({c['total']})")
            part = wide(f"({c['total']} - floor({c['total']})) * CAST({10**scale} AS decimal(16,0))")
        rows = wide(f"nullif({c['n']}, 0)")
        twice = wide(f"{c['unit']} * 2")
        units = wide(f"{c['floor']} * {wide(10**digits)} + {wide(f'({c["near"]} - {c["less"]}) / {twice}')}")
        average = f"CAST({units} AS double) / {10.0**digits!r}D"
        if "floating" in self.names:
            floating = f"round({self._label('floating')}, {digits})"
            average = f"if({c['n']} > 0 AND {c['n']} = {self._label('fits')}, {average}, {floating})"
        return [
            {c["whole"]: whole, c["fraction"]: part, c["rows"]: rows, c["unit"]: wide(f"{rows} * {wide(10**scale)}")},
            {c["over"]: wide(f"pmod({c['whole']}, {c['rows']})")},
            {
                c["base"]: wide(f"({c['whole']} - {c['over']}) / {c['rows']}"),
                c["all"]: wide(f"{c['over']} * {wide(10**scale)} + {c['fraction']}"),
            },
            {c["left"]: wide(f"pmod({c['all']}, {c['unit']})")},
            {c["floor"]: wide(f"{c['base']} + {wide(f'({c["all"]} - {c["left"]}) / {c["unit"]}')}")},
            {c["near"]: wide(f"{c['left']} * {wide(2 * 10**digits)} + {c['unit']} - if({c['floor']} < 0, 1, 0)")},
            {c["less"]: wide(f"pmod({c['near']}, {twice})")},
            {f"`{self.name}`": average},
        ]


def group_stats(
    df: DataFrame, key: str, count: str, digits: int = 2, **statistics: tuple[str, str]
) -> DataFrame:
    """Rows per ``key`` and rounded statistics, as ``name=("avg" | "min" | "max", column)``.

    A NULL key is a group of its own. Partial aggregation leaves one row per task and
    group before the shuffle, so the size of a group does not matter. Averages are doubles,
    whatever the column's type.
    """
    sums, shown, averages = [F.count(F.lit(1)).alias(count)], [key, f"`{count}`"], []
    for name, (kind, column) in statistics.items():
        shown.append(f"`{name}`")
        if kind == "avg":
            averages.append(ExactAverage(name, column, digits, df.select(column).schema[0].dataType))
            sums += averages[-1].sums
        else:
            extreme = {"min": F.min, "max": F.max}[kind]
            sums.append(F.round(extreme(column), digits).alias(name))
    stats = df.groupBy(key).agg(*sums)
    for level in zip(*(average.steps() for average in averages)):
        columns = [f"{value} AS {name}" for step in level for name, value in step.items()]
        stats = stats.selectExpr("*", *columns)
    return stats.select(*shown)
