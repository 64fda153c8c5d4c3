"""Types of text columns: a lattice of types that merges as counts.

Per column, one aggregate counts the values and those that each type can hold. A type holds a column when it
holds all its values, and the first such type in the order of ``TYPES`` is the narrowest, as int
fits into bigint and bigint into double. Counts of parts of a file add up to those of the whole, so no
part has to know the others, and the values a type cannot hold are counted along the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: From narrow to wide; every value fits the last one.
TYPES = ["int", "bigint", "double", "timestamp", "string"]

WHOLE_NUMBER = r"^[+-]?[0-9]{1,38}$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"


def fits(value: Column, kind: str) -> Column:
    """Whether a text, apart from spaces around it, can be read as a type; null for null."""
    text = F.trim(value)
    if kind in ("int", "bigint"):
        number = F.when(text.rlike(WHOLE_NUMBER), text).try_cast("decimal(38, 0)")
        reach = 1 << (31 if kind == "int" else 63)
        inside = (number >= F.lit(str(-reach)).cast("decimal(38, 0)")) & (number < F.lit(str(reach)).cast("decimal(38, 0)"))
        return F.when(text.isNotNull(), F.coalesce(inside, F.lit(False)))
    if kind == "double":
        return text.rlike(NUMBER)
    if kind == "timestamp":
        return F.when(text.isNotNull(), text.rlike(MOMENT) & text.try_cast("timestamp_ntz").isNotNull())
    if kind == "string":
        return F.when(text.isNotNull(), F.lit(True))
    raise ValueError(f"no type {kind}")


def type_counts(df: DataFrame) -> DataFrame:
    """``(column, n, n_null, n_int, n_bigint, n_double, n_timestamp)`` for the text columns of ``df``.

    Blank texts count as missing, as nulls do.
    """
    names = df.columns
    texts = df.select(*[F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")).alias(c) for c in names])
    # Column names as values; the values of a row follow one another, so nothing is held for the columns together.
    long = texts.unpivot([], names, "column", "value")
    counted = long.groupBy("column").agg(
        F.count("value").alias("n"),
        F.count_if(F.col("value").isNull()).alias("n_null"),
        *[F.count_if(fits(F.col("value"), kind)).alias(f"n_{kind}") for kind in TYPES[:-1]],
    )
    return counted


def inferred_types(df: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """:func:`type_counts` with ``type``, the narrowest that holds all but a share of the values, and ``misfits``.

    ``misfits`` is the number of values that ``type`` cannot hold; they become null when the column is
    read with it. A column without values is ``string``.
    """
    enough = F.col("n") * (1 - tolerance)
    kind, misfits = F.lit("string"), F.lit(0)
    for name in reversed(TYPES[:-1]):
        holds = (F.col("n") > 0) & (F.col(f"n_{name}") >= enough)
        kind = F.when(holds, name).otherwise(kind)
        misfits = F.when(holds, F.col("n") - F.col(f"n_{name}")).otherwise(misfits)
    return type_counts(df).withColumns({"type": kind, "misfits": misfits.cast("long")})


def misfits(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``(column, type, n, misfits)``: the values of text columns that their declared types cannot hold."""
    rows = type_counts(df.select(*[F.col(f"`{c}`") for c in columns]))
    kind = F.create_map(*[F.lit(x) for pair in columns.items() for x in pair])[F.col("column")]
    held = F.col("n")
    for name in TYPES[:-1]:
        held = F.when(F.col("type") == name, F.col(f"n_{name}")).otherwise(held)
    return rows.withColumn("type", kind).select("column", "type", "n", (F.col("n") - held).alias("misfits"))
