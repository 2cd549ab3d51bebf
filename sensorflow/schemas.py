"""Message schemas and target-table specifications.

Message schemas are fixed and never inferred; every field is nullable and
``from_json`` runs in its default PERMISSIVE mode, so a bad field becomes NULL
without failing the job.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Kafka source columns; file fixtures use the same envelope.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

@dataclass(frozen=True)
class MessageSchemas:
    parameter: T.StructType
    country: T.StructType
    location: T.StructType
    measurement: T.StructType

    @property
    def parameter_array(self) -> T.ArrayType:
        return T.ArrayType(self.parameter)

    @property
    def location_array(self) -> T.ArrayType:
        return T.ArrayType(self.location)


def message_schemas(id_type: str = "int") -> MessageSchemas:
    """The four message schemas.  Ids are ``int`` as in the original
    messages; ``id_type="bigint"`` widens every id (keys of large tables pass
    2^31, and an id that overflows its JSON field type parses as NULL)."""
    ID = T.LongType() if id_type == "bigint" else T.IntegerType()
    utc_local = T.StructType([
        T.StructField("utc", T.StringType()),
        T.StructField("local", T.StringType()),
    ])
    parameter = T.StructType([
        T.StructField("id", ID),
        T.StructField("name", T.StringType()),
        T.StructField("units", T.StringType()),
        T.StructField("displayName", T.StringType()),
        T.StructField("description", T.StringType()),
    ])
    country = T.StructType([
        T.StructField("id", ID),
        T.StructField("code", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("datetimeFirst", T.TimestampType()),
        T.StructField("datetimeLast", T.TimestampType()),
        T.StructField("parameters", T.ArrayType(parameter)),
    ])
    location = T.StructType([
        T.StructField("id", ID),
        T.StructField("name", T.StringType()),
        T.StructField("locality", T.StringType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("country", T.StructType([
            T.StructField("id", ID),
            T.StructField("code", T.StringType()),
        ])),
        T.StructField("coordinates", T.MapType(T.StringType(), T.StringType())),
        T.StructField("datetimeFirst", utc_local),
        T.StructField("datetimeLast", utc_local),
        T.StructField("sensors", T.ArrayType(T.StructType([
            T.StructField("id", ID),
            T.StructField("name", T.StringType()),
            T.StructField("parameter", T.StructType([T.StructField("id", ID)])),
        ]))),
    ])
    measurement = T.StructType([
        T.StructField("datetime", utc_local),
        T.StructField("value", T.DoubleType()),
        T.StructField("coordinates", T.StructType([
            T.StructField("latitude", T.DoubleType()),
            T.StructField("longitude", T.DoubleType()),
        ])),
        T.StructField("sensorsId", ID),
        T.StructField("locationsId", ID),
        # {"end": true} arrives through a string field as 'true'
        T.StructField("end", T.StringType()),
    ])
    return MessageSchemas(parameter, country, location, measurement)


MESSAGES = message_schemas("int")
WIDE_MESSAGES = message_schemas("bigint")
PARAMETER = MESSAGES.parameter
COUNTRY = MESSAGES.country
PARAMETER_ARRAY = MESSAGES.parameter_array
LOCATION = MESSAGES.location
LOCATION_ARRAY = MESSAGES.location_array
MEASUREMENT = MESSAGES.measurement


def page_schema(result_type: T.DataType) -> T.StructType:
    """API page envelope ``{meta: {found, limit}, results: [...]}``."""
    return T.StructType([
        T.StructField("meta", T.StructType([
            T.StructField("found", T.LongType()),
            T.StructField("limit", T.LongType()),
        ])),
        T.StructField("results", T.ArrayType(result_type)),
    ])


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str          # parent table name
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    """Declarative table: columns, primary key, NOT NULL, VARCHAR(n), FKs."""

    name: str
    columns: tuple[tuple[str, str], ...]          # (name, spark DDL type)
    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    max_length: dict = field(default_factory=dict)  # column -> n
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    def struct_type(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in self.columns))

    def empty(self, spark):
        """Empty table of this shape (the CREATE TABLE IF NOT EXISTS case)."""
        return spark.createDataFrame([], self.struct_type())


# The five target tables of the star schema, their keys,
# NOT NULL columns, VARCHAR lengths and foreign keys.
COUNTRY_TABLE = TableSpec(
    name="country",
    columns=(("id", "bigint"), ("code", "string"), ("name", "string"),
             ("datetimeFirst", "timestamp"), ("datetimeLast", "timestamp")),
    key=("id",),
    not_null=("code", "name"),
    max_length={"code": 10, "name": 255},
)
PARAMETER_TABLE = TableSpec(
    name="parameter",
    columns=(("parameter_id", "bigint"), ("name", "string"), ("unit", "string"),
             ("display_name", "string"), ("description", "string")),
    key=("parameter_id",),
    not_null=("name",),
    max_length={"name": 255, "unit": 50, "display_name": 255},
)
LOCATION_TABLE = TableSpec(
    name="location_table",
    columns=(("location_id", "bigint"), ("name", "string"), ("locality", "string"),
             ("country_id", "bigint"), ("latitude", "double"), ("longitude", "double"),
             ("timezone", "string"), ("datetime_first_utc", "timestamp"),
             ("datetime_first_local", "timestamp_ntz"), ("datetime_last_utc", "timestamp"),
             ("datetime_last_local", "timestamp_ntz")),
    key=("location_id",),
    not_null=("name",),
    max_length={"name": 255, "locality": 255, "timezone": 50},
    foreign_keys=(ForeignKey("country_id", "country", "id"),),
)
SENSOR_TABLE = TableSpec(
    name="sensor",
    columns=(("sensor_id", "bigint"), ("name", "string"), ("parameter_id", "bigint"),
             ("location_id", "bigint")),
    key=("sensor_id",),
    max_length={"name": 255},
    foreign_keys=(ForeignKey("parameter_id", "parameter", "parameter_id"),
                  ForeignKey("location_id", "location_table", "location_id")),
)
MEASUREMENT_TABLE = TableSpec(
    name="latest_measurements",
    columns=(("latest_id", "string"), ("location_id", "bigint"), ("sensor_id", "bigint"),
             ("value", "double"), ("timestamp_utc", "timestamp"),
             ("timestamp_local", "timestamp_ntz"), ("latitude", "double"),
             ("longitude", "double")),
    key=("latest_id",),
    max_length={"latest_id": 255},
    foreign_keys=(ForeignKey("location_id", "location_table", "location_id"),
                  ForeignKey("sensor_id", "sensor", "sensor_id")),
)

TABLES = {t.name: t for t in (COUNTRY_TABLE, PARAMETER_TABLE, LOCATION_TABLE,
                              SENSOR_TABLE, MEASUREMENT_TABLE)}
