"""Wide, dirty, compressed CSV exports."""

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType, StructField, StructType

from hearthline import schemas


def lenient(text: Column, kind: DataType) -> Column:
    """``text`` as ``kind``, NULL where it does not parse.

    A whole-number column also accepts ``3.0`` or ``3.7`` and drops the fraction;
    the pattern is only evaluated for values that did not parse as they are.
    """
    if isinstance(kind, StringType):
        return text
    parsed = text.try_cast(kind)
    if not isinstance(kind, IntegralType):
        return parsed
    fraction = r"^\s*(?<sign>[+-]?)(?<whole>\d*)\.\d*\s*$"
    whole = F.regexp_replace(text, fraction, "${sign}0${whole}")
    return F.coalesce(parsed, whole.try_cast(kind))


def project_cast(raw: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, by name and in its order, parsed from text."""
    return raw.select(
        [lenient(F.col(f"`{field.name}`"), field.dataType).alias(field.name) for field in schema]
    )


FORMAT = {"multiLine": True, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
HEADERS_AT_ONCE = 16


def read_wide_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    *,
    check_headers: bool = True,
) -> DataFrame:
    """Columns of ``schema`` from CSV files with a header, plain or compressed.

    Quoted fields may hold commas, line breaks and doubled quotes; short rows are
    filled with NULL, surplus fields dropped, other columns ignored, and nothing is
    inferred. Neither gzip nor line breaks inside fields can be split, so each file
    is read by one task: pass a folder or a list of many files.

    Columns are found by the header of their own file, so files may have them in another
    order, and more of them, with empty or repeated names. Only a wanted column that is
    missing or repeated is an error. Names are equal if only their case differs, unless
    one is written exactly alike. A file without a header has no rows. ``check_headers=False``
    takes the first file's header for all and reads no other one.
    """
    files = [_literal(f) for f in spark.read.schema("line string").csv(path).inputFiles()]
    asked = files if check_headers else files[:1]
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        headers = list(pool.map(inheritable_thread_target(spark)(lambda f: _header(spark, f)), asked))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for number, file in enumerate(files):
        header = headers[number if check_headers else 0]
        if header:
            layouts.setdefault(_layout(header, schema, file), []).append(file)
    if not layouts:
        raise AnalysisException(f"no header in {path}")
    tables = [
        project_cast(
            spark.read.schema(StructType([StructField(name, StringType()) for name in names])).csv(
                found, header=True, enforceSchema=True, **FORMAT
            ),
            schema,
        )
        for names, found in layouts.items()
    ]
    return reduce(DataFrame.unionByName, tables)


def _literal(file: str) -> str:
    """A listed file as a path that is read as it stands."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file))


def _header(spark: SparkSession, file: str, width: int = 256) -> tuple[str, ...]:
    """The first record of a file, without empty names at its end; the reader stops behind it."""
    columns = StructType([StructField(f"_{place}", StringType()) for place in range(width)])
    first = spark.read.schema(columns).csv(file, header=False, **FORMAT).head(1)
    names = [name or "" for name in first[0]] if first else []
    if names and names[-1]:
        return _header(spark, file, 2 * width)
    return tuple(names[: max((i + 1 for i, name in enumerate(names) if name), default=0)])


def _layout(header: tuple[str, ...], schema: StructType, file: str) -> tuple[str, ...]:
    """A name for each place of a file: the wanted column's, or one that nobody asks for."""
    names = [f"_{place}" for place in range(len(header))]
    taken = {field.name.lower() for field in schema}
    names = [name if name not in taken else f"_{name}_" for name in names]
    for field in schema:
        places = [i for i, name in enumerate(header) if name == field.name] or [
            i for i, name in enumerate(header) if name.lower() == field.name.lower()
        ]
        if len(places) != 1:
            fault = "is repeated" if places else "is missing"
            raise AnalysisException(f"column {field.name} {fault} in the header of {file}")
        names[places[0]] = field.name
    return tuple(names)


def spread_rows(source: DataFrame, width: int) -> DataFrame:
    """The rows of a scan, dealt out evenly to ``width`` tasks.

    For few files that can't be split, so that costly expressions run everywhere instead
    of in the tasks that read the files; a scan of about ``width`` tasks or more needs it
    not. The shuffle goes by row number, not by content, so neither hot keys nor copies
    gather; a repeated scan numbers its rows alike.
    """
    numbered = source.withColumn("_row", F.monotonically_increasing_id())
    return numbered.repartition(width, "_row").drop("_row")


def read_listings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_wide_csv(spark, path, schemas.LISTINGS)


def read_reviews(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_wide_csv(spark, path, schemas.REVIEWS)
