"""Fixed schemas of the inputs and the ``mentions`` contract."""

from __future__ import annotations

from pyspark.sql import types as T

# The 27 column names of a news knowledge-graph record, in file order.
GKG_COLUMNS = [
    "gkgrecordid", "date", "sourceCollectionIdentifier", "sourceCommonName",
    "documentIdentifier", "counts", "v2Counts", "themes", "v2Themes", "locations",
    "v2Locations", "persons", "v2Persons", "organizations", "v2Organizations", "v2Tone",
    "dates", "gcam", "sharingImage", "relatedImages", "socialImageEmbeds",
    "socialVideoEmbeds", "quotations", "allNames", "amounts", "translationInfo", "extras",
]
GKG_DATE_FORMAT = "yyyyMMddHHmmss"
NAMES_INDEX = GKG_COLUMNS.index("allNames")  # 23
DATE_INDEX = GKG_COLUMNS.index("date")  # 1


def _gkg_type(name: str) -> T.DataType:
    if name == "date":
        return T.TimestampType()
    if name == "sourceCollectionIdentifier":
        return T.IntegerType()
    return T.StringType()


GKG_SCHEMA = T.StructType([T.StructField(c, _gkg_type(c), True) for c in GKG_COLUMNS])

# The sensor example's columns and types.
SENSOR_SCHEMA = T.StructType([
    T.StructField("sensorname", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("numA", T.DoubleType(), True),
    T.StructField("numB", T.DoubleType(), True),
    T.StructField("numC", T.LongType(), True),
    T.StructField("numD", T.DoubleType(), True),
    T.StructField("numE", T.LongType(), True),
    T.StructField("numF", T.DoubleType(), True),
])
SENSOR_TIME_FORMAT = "M/d/yy:H:mm"

# The one contract every source is turned into.
MENTION_SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType(), True),
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("topic", T.StringType(), True),
])

# Daily document as shown by the display: {"data": "yyyy-MM-dd", "result": [{topic, count}]}.
DAILY_DOCUMENT_SCHEMA = T.StructType([
    T.StructField("data", T.StringType(), True),
    T.StructField("result", T.ArrayType(T.StructType([
        T.StructField("topic", T.StringType(), True),
        T.StructField("count", T.LongType(), True),
    ])), True),
])

# Headers file: name TAB type TAB mode TAB
_TYPE_NAMES = {
    "STRING": T.StringType(), "TIMESTAMP": T.TimestampType(), "DATE": T.DateType(),
    "INTEGER": T.IntegerType(), "INT": T.IntegerType(), "LONG": T.LongType(),
    "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "FLOAT": T.FloatType(),
    "BOOLEAN": T.BooleanType(),
}


def type_from_name(name: str) -> T.DataType:
    try:
        return _TYPE_NAMES[name.strip().upper()]
    except KeyError as exc:
        raise ValueError(f"unknown column type {name!r}") from exc


def require_columns(df, schema: T.StructType, strict_types: bool = True):
    """Typed view over an untyped frame: fail early when a column is missing or mistyped."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if strict_types:
        wrong = [f.name for f in schema.fields if have[f.name] != f.dataType]
        if wrong:
            raise TypeError(f"columns with other types: {wrong}")
    return df.select(*[f.name for f in schema.fields])
