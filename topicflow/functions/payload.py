"""Row to payload text, and payload back to typed columns. Everything stays in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.functions.avro_schema import from_avro_text, is_avro_text

# How a JVM row prints its parts.
NULL_TEXT = "null"
ARRAY_OPEN, ARRAY_CLOSE = "WrappedArray(", ")"
MAP_OPEN, MAP_CLOSE, MAP_ARROW = "Map(", ")", " -> "


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _timestamp_text(column: Column) -> Column:
    """``2024-01-02 03:04:05.0``: there is always at least one digit after the point."""
    text = column.cast("string")
    return F.when(F.instr(text, ".") == 0, F.concat(text, F.lit(".0"))).otherwise(text)


def _local_timestamp_text(column: Column) -> Column:
    """ISO form: ``T`` between the parts, no zero seconds, a fraction of 3 or 6 digits."""
    text = F.replace(column.cast("string"), F.lit(" "), F.lit("T"))
    # Zones differ by whole seconds, so the part below a second is the same in any of them.
    micros = F.pmod(F.unix_micros(column.cast("timestamp")), F.lit(1_000_000))
    fraction = F.when(
        micros % 1000 == 0, F.lpad((micros / 1000).cast("int").cast("string"), 3, "0")
    ).otherwise(F.lpad(micros.cast("string"), 6, "0"))
    return (
        F.when((F.second(column) == 0) & (micros == 0), F.substring_index(text, ":", 2))
        .when(micros == 0, text)
        .otherwise(F.concat(F.substring_index(text, ".", 1), F.lit("."), fraction))
    )


def _decimal_text(column: Column, scale: int) -> Column:
    """Plain digits, or scientific notation where the exponent is below -6."""
    plain = column.cast("string")
    if scale < 7:
        return plain
    digits = F.regexp_replace(F.regexp_replace(plain, "[-.]", ""), "^0+(?=.)", "")
    exponent = F.length(digits) - (1 + scale)
    scientific = F.concat(
        F.when(column < 0, "-").otherwise(""),
        F.left(digits, F.lit(1)),
        F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(""),
        F.lit("E"),
        exponent.cast("string"),
    )
    return F.when(exponent >= -6, plain).otherwise(scientific)


def _period_text(column: Column) -> Column:
    """ISO-8601 of years and months, ``P1Y2M``; none of them is ``P0D``."""
    column = column.cast(T.YearMonthIntervalType(0, 1))
    years, months = F.extract(F.lit("YEAR"), column), F.extract(F.lit("MONTH"), column)
    part = lambda n, unit: F.when(n != 0, F.concat(n.cast("string"), F.lit(unit))).otherwise("")
    text = F.concat(F.lit("P"), part(years, "Y"), part(months, "M"))
    return F.when(column.isNotNull(), F.when(text == "P", "P0D").otherwise(text))


def _duration_text(column: Column) -> Column:
    """ISO-8601 of hours, minutes and seconds, ``PT26H1.5S``: days are hours, every part has the sign of
    the whole, and a fraction ends with its last digit."""
    micros = F.unix_micros(F.timestamp_micros(F.lit(0)) + column)
    sign = F.when(micros < 0, "-").otherwise("")
    size = F.abs(micros)
    hours, minutes = F.floor(size / 3_600_000_000), F.floor(size / 60_000_000) % 60
    seconds, fraction = F.floor(size / 1_000_000) % 60, size % 1_000_000
    part = lambda n, unit: F.when(n != 0, F.concat(sign, n.cast("string"), F.lit(unit))).otherwise("")
    digits = F.regexp_replace(F.lpad(fraction.cast("string"), 6, "0"), "0+$", "")
    point = F.when(fraction != 0, F.concat(F.lit("."), digits)).otherwise("")
    last = F.when(
        (seconds != 0) | (fraction != 0), F.concat(sign, seconds.cast("string"), point, F.lit("S"))
    ).otherwise("")
    text = F.concat(F.lit("PT"), part(hours, "H"), part(minutes, "M"), last)
    return F.when(column.isNotNull(), F.when(text == "PT", "PT0S").otherwise(text))


def value_text(column: Column, data_type: T.DataType) -> Column:
    """The text of one value; NULL is ``null``."""
    if isinstance(data_type, T.StructType):
        inner = [value_text(column.getField(f.name), f.dataType) for f in data_type.fields]
        text = F.when(column.isNotNull(), _bracketed(inner))
    elif isinstance(data_type, T.ArrayType):
        parts = F.transform(column, lambda x: value_text(x, data_type.elementType))
        text = F.concat(F.lit(ARRAY_OPEN), F.array_join(parts, ", "), F.lit(ARRAY_CLOSE))
    elif isinstance(data_type, T.MapType):
        parts = F.transform(
            F.map_entries(column),
            lambda e: F.concat(
                value_text(e["key"], data_type.keyType),
                F.lit(MAP_ARROW),
                value_text(e["value"], data_type.valueType),
            ),
        )
        text = F.concat(F.lit(MAP_OPEN), F.array_join(parts, ", "), F.lit(MAP_CLOSE))
    elif isinstance(data_type, T.TimestampType):
        text = _timestamp_text(column)
    elif isinstance(data_type, T.TimestampNTZType):
        text = _local_timestamp_text(column)
    elif isinstance(data_type, T.DecimalType):
        text = _decimal_text(column, data_type.scale)
    elif isinstance(data_type, T.YearMonthIntervalType):
        text = _period_text(column)
    elif isinstance(data_type, T.DayTimeIntervalType):
        text = _duration_text(column)
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(NULL_TEXT))


def _bracketed(parts: Sequence[Column]) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """``[v1,v2,...]`` over the named columns (default all): no quoting, no escaping."""
    fields = [df.schema[c] for c in columns] if columns is not None else df.schema.fields
    return _bracketed([value_text(quoted(f.name), f.dataType) for f in fields])


def row_payload(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The row text as UTF-8 bytes."""
    return row_text(df, columns).cast("binary")


def decode_payload(
    df: DataFrame,
    schema: T.StructType | str,
    fmt: str = "json",
    *,
    column: str = "data",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Replace ``column`` by the struct its bytes hold.

    ``schema`` is a ``StructType``, DDL text or a record declared as Avro JSON text; ``avro`` takes the
    last one (and needs the Avro module of Spark on the class path).
    Malformed JSON or CSV gives a struct of NULLs.
    """
    source = quoted(column)
    options = options or {}
    if fmt in ("json", "csv") and is_avro_text(schema):
        schema = from_avro_text(schema)
    if fmt == "json":
        decoded = F.from_json(source.cast("string"), schema, options)
    elif fmt == "csv":
        ddl = schema if isinstance(schema, str) else schema.toDDL()
        decoded = F.from_csv(source.cast("string"), ddl, options)
    elif fmt == "avro":
        decoded = _from_avro(df, source, schema, options)
    else:
        raise ValueError(f"Unknown payload format {fmt!r}; use json, csv or avro")
    return df.withColumn(column, decoded)


def _from_avro(df: DataFrame, source: Column, schema: str, options: dict[str, str]) -> Column:
    from pyspark.sql.avro.functions import from_avro

    if not isinstance(schema, str):
        raise ValueError("The avro format takes the Avro schema as JSON text")
    try:
        decoded = from_avro(source, schema, options)
        df.select(decoded)
    except (AnalysisException, TypeError) as error:
        raise ValueError(
            "Cannot decode avro: add the spark-avro module to the session "
            f"(spark.jars.packages). Spark said: {error}"
        ) from error
    return decoded


def expand_payload(df: DataFrame, column: str = "data") -> DataFrame:
    """The fields of a decoded payload as the columns of the result."""
    return df.select(f"`{column}`.*")
