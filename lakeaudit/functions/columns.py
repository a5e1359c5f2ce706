"""Column-level helpers: naming, tolerant casts, percentages, canonical text of nested values."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
)
NESTED_TYPES = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def quoted(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def snake_name(name: str) -> str:
    """``Lap Number`` / ``lapNumber`` / ``lap-number`` all become ``lap_number``."""
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    return re.sub(r"[\s\-]+", "_", spaced).lower()


def snake_case(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in names if n in have]


def cast_columns(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Cast the listed columns that exist; text that does not parse becomes null."""
    types = dict(df.dtypes)
    exprs = {}
    for name, target in casts.items():
        if name not in types or types[name] == target:
            continue
        if target == "timestamp":
            exprs[name] = parse_timestamp(quoted(name), types[name])
        elif target in ("bigint", "long") and types[name] == "string":
            # '7.0' is a valid whole number in feeds that mix integers and floats
            exprs[name] = F.coalesce(
                quoted(name).try_cast("bigint"),
                quoted(name).try_cast("decimal(38,6)").try_cast("bigint"),
            )
        else:
            exprs[name] = quoted(name).try_cast(target)
    return df.withColumns(exprs) if exprs else df


def parse_timestamp(value: Column, source_type: str) -> Column:
    if source_type == "string":
        return F.try_to_timestamp(value)
    return value.try_cast("timestamp")


def pct(part: Column, whole: Column, digits: int = 4) -> Column:
    """``part`` as a percentage of ``whole``; 0 when the whole is empty."""
    share = F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))
    return F.round(F.coalesce(share, F.lit(0.0)), digits)


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def groupable(value: Column, dtype: T.DataType) -> Column:
    """A form of the value that can be a grouping key (maps and variants cannot)."""
    if isinstance(dtype, T.MapType):
        return F.to_json(_by_key(value))
    if isinstance(dtype, T.VariantType):
        return F.to_json(value)
    return value


def _by_key(value: Column) -> Column:
    """A map's entries in the order of their keys alone, as values may have no order."""
    return F.transform(F.array_sort(F.map_keys(value)), lambda k: F.struct(k.alias("key"), value[k].alias("value")))


def not_nan(value: Column, dtype: T.DataType) -> Column:
    """The value with NaN as missing."""
    return F.nanvl(value, F.lit(None).cast(dtype)) if isinstance(dtype, (T.FloatType, T.DoubleType)) else value


def content_key(value: Column, dtype: T.DataType) -> Column:
    """A short stand-in for counting equal values: long text becomes its SHA-256 digest.

    Grouping then ships at most 65 characters per text cell instead of the whole text.
    """
    if isinstance(dtype, (T.StringType, T.MapType, T.VariantType, T.ArrayType, T.StructType)):
        return _digest(as_text(value, dtype))
    return value


def row_digest(df: DataFrame, names: Sequence[str]) -> Column:
    """128 bits that stand for the content of a row, so that grouping ships 16 bytes for it.

    Hashes pass over nulls, so which cells are null is hashed as well, and nested values as their text.
    """
    kinds = [(quoted(n), dtype_of(df, n)) for n in names]
    cells = [as_text(value, kind) if isinstance(kind, NESTED_TYPES) else value for value, kind in kinds]
    masks = []
    for i in range(0, len(cells), 60):
        bits = [F.when(c.isNull(), F.lit(1 << j)).otherwise(F.lit(0)).cast("bigint") for j, c in enumerate(cells[i:i + 60])]
        masks.append(reduce(lambda a, b: a.bitwiseOR(b), bits))
    return F.struct(F.xxhash64(*masks, *cells).alias("a"), F.xxhash64(F.lit("second"), *masks, *cells).alias("b"))


def _digest(text: Column) -> Column:
    return F.when(F.length(text) > 64, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(text)


def as_text(value: Column, dtype: T.DataType) -> Column:
    """Text that is equal exactly when the values are equal; null stays null."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (value + F.lit(0.0)).cast("string")  # -0.0 and 0.0 are one value
    if isinstance(dtype, T.MapType):
        return F.to_json(_by_key(value))
    if isinstance(dtype, NESTED_TYPES):
        return F.to_json(value)
    return value.cast("string")


def stacked(df: DataFrame, sets: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """One row per (row, set of columns): the set's number ``place`` and its columns as ``names``.

    UNPIVOT expands rows inside generated code, which an array with INLINE does not.
    """
    cells = [c.alias(f"c{i}_{j}") for i, s in enumerate(sets) for j, c in enumerate(s)]
    places = ", ".join(
        "(" + ", ".join(f"c{i}_{j}" for j in range(len(names))) + f") as `{i}`" for i in range(len(sets)))
    listed = ", ".join(names)
    return df.sparkSession.sql(
        f"select cast(place as int) as place, {listed} from {{wide}} "
        f"unpivot include nulls (({listed}) for place in ({places}))", wide=df.select(*cells))


def double_cell(df: DataFrame, name: str) -> Column:
    """A number column as double, with NaN as missing."""
    return F.nanvl(quoted(name).try_cast("double"), F.lit(None).cast("double"))


def number_cells(df: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    """One row per (row, listed column): the column's place in ``names`` and its value as double.
    NaN counts as missing.

    The place is an int because it is part of every shuffled key; ``name_at`` gives the name.
    """
    cells = stacked(df, [[double_cell(df, n)] for n in names], [value])
    return cells.withColumnRenamed("place", "column_no")


CELL_PARTS = ("cell_whole", "cell_real", "cell_text")


def value_cells(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per (row, listed column): its place and its value in the part that fits the type.

    Whole numbers and reals keep their type, so grouping needs no text; other values are canonical
    text, shortened to a digest when long. All three parts are null for a missing value.
    """
    no_whole, no_real, no_text = (F.lit(None).cast(t) for t in ("bigint", "double", "string"))
    sets = []
    for name in names:
        dtype = dtype_of(df, name)
        if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
            sets.append([quoted(name).cast("bigint"), no_real, no_text])
        elif isinstance(dtype, (T.FloatType, T.DoubleType)):
            sets.append([no_whole, F.nanvl(quoted(name).cast("double"), F.lit(None).cast("double")), no_text])
        else:
            sets.append([no_whole, no_real, _digest(as_text(quoted(name), dtype))])
    return stacked(df, sets, CELL_PARTS).withColumnRenamed("place", "column_no")


def name_at(names: Sequence[str], place: str = "column_no") -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.col(place) + 1)


def _literal(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}D" if math.isfinite(value) else f"double('{value!r}')"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def rows_frame(df_or_spark, rows: list[tuple], ddl: str) -> DataFrame:
    """A small literal frame. Inline values plan as a local relation, without Python workers."""
    spark = df_or_spark.sparkSession if isinstance(df_or_spark, DataFrame) else df_or_spark
    if not rows:
        return spark.createDataFrame([], ddl)
    fields = [part.strip().split(" ", 1) for part in ddl.split(",")]
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"c{i}" for i in range(len(fields)))
    cast = ", ".join(f"cast(c{i} as {t}) as `{n}`" for i, (n, t) in enumerate(fields))
    return spark.sql(f"select {cast} from values {values} as t({names})")
