"""Records read without loss: every field as text first, and what does not fit its type kept beside it.

A stated schema turns text in a number field into null, which then looks like a
field that was never sent. Here a field that has text but no value of its type
stays null and its text goes into ``rescued``, a map from field to text. A record that cannot be
read at all has nothing but its own text there, under ``RECORD``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

RESCUED, RECORD = "rescued", "_record"
_BROKEN = "_unreadable"


def _texts(schema: T.StructType) -> T.StructType:
    """The same fields as text, and one for a record that cannot be read."""
    return T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema], T.StructField(_BROKEN, T.StringType())])


def _once(rows: DataFrame) -> DataFrame:
    """The rows with every column worked out once. Otherwise a filter on what derives from them repeats them at each use."""
    return rows.select(F.explode(F.array(F.struct(*rows.columns))).alias("_row")).select("_row.*")


def _typed(rows: DataFrame, schema: T.StructType, broken: Column, raw: Column) -> DataFrame:
    """Text columns as their types, and the map of what does not fit. Blank text in a field that is not text counts as missing."""
    def text(f: T.StructField) -> Column:
        return F.col(f.name) if f.dataType == T.StringType() else F.when(F.trim(f.name) != "", F.trim(f.name))

    def value(f: T.StructField) -> Column:
        return text(f) if f.dataType == T.StringType() else text(f).try_cast(f.dataType)

    odd = [F.when(text(f).isNotNull() & value(f).isNull(), F.struct(F.lit(f.name).alias("k"), F.col(f.name).alias("v"))) for f in schema if f.dataType != T.StringType()]
    kind = "array<struct<k:string,v:string>>"
    found = F.array_compact(F.array(*odd)).cast(kind) if odd else F.array().cast(kind)
    whole = F.array(F.struct(F.lit(RECORD).alias("k"), raw.alias("v"))).cast(kind)
    rescued = F.map_from_entries(F.when(broken, whole).otherwise(found))
    return _once(rows.select(*[F.when(~broken, value(f)).alias(f.name) for f in schema], rescued.alias(RESCUED), raw.alias("raw")))


def parse_json(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """One JSON object per text: typed fields, ``rescued``, and the text itself as ``raw``. No shuffle; batch or stream."""
    read = F.from_json(F.col(column), _texts(schema), {"columnNameOfCorruptRecord": _BROKEN})
    rows = _once(lines.select(F.col(column).alias("_line"), read.alias("_p"))).select("_line", "_p.*", F.col("_p").isNull().alias("_none"))
    return _typed(rows, schema, F.col("_none") | F.col(_BROKEN).isNotNull(), F.coalesce("_line", F.lit("")))


def read_csv(reader: SparkSession | DataStreamReader, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, fields in the schema's order: typed fields, ``rescued``, and the fields as JSON for ``raw``."""
    if isinstance(reader, SparkSession):
        reader = reader.read
    options = {
        "header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN,
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }
    rows = reader.schema(_texts(schema)).options(**options).csv(path)
    broken = F.col(_BROKEN).isNotNull()
    raw = F.coalesce(F.col(_BROKEN), F.to_json(F.struct(*schema.fieldNames())))
    return _typed(rows, schema, broken, raw)
