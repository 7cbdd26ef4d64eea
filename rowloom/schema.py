"""Source column types of the vendors and their Spark types."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names by Spark type, as most vendors mean them.
_COMMON = {
    "string": (
        "CHAR", "VARCHAR", "NCHAR", "NVARCHAR", "VARCHAR2", "NVARCHAR2", "TEXT", "NTEXT", "UNITEXT", "MEDIUMTEXT",
        "LONGTEXT", "STRING", "CLOB", "NCLOB", "DBCLOB", "GRAPHIC", "VARGRAPHIC", "LONG", "LONG VARCHAR",
        "LONG VARGRAPHIC", "JSON", "JSONB", "XML", "XMLTYPE", "UUID", "UNIQUEIDENTIFIER", "ROWID", "UROWID", "TIME",
        "INTERVAL", "VARIANT", "OBJECT", "ENUM", "SQL_VARIANT", "GEOGRAPHY", "GEOMETRY", "HIERARCHYID", "POINT",
    ),
    "smallint": ("SMALLINT", "TINYINT", "BYTEINT"),
    "int": ("INT", "INTEGER", "MEDIUMINT", "YEAR"),
    "bigint": ("BIGINT",),
    "float": ("REAL", "BINARY_FLOAT", "FLOAT4"),
    "double": ("FLOAT", "DOUBLE", "DOUBLE PRECISION", "BINARY_DOUBLE", "FLOAT8"),
    "decimal": ("NUMBER", "NUMERIC", "DECIMAL", "DECFLOAT", "MONEY", "SMALLMONEY"),
    "boolean": ("BIT", "BOOLEAN"),
    "date": ("DATE",),
    "timestamp": (
        "TIMESTAMP", "TIMESTAMP WITH TIME ZONE", "TIMESTAMP WITH LOCAL TIME ZONE", "TIMESTAMP_LTZ", "TIMESTAMP_TZ",
        "DATETIME", "DATETIME2", "SMALLDATETIME", "DATETIMEOFFSET", "BIGDATETIME", "BIGSMALLDATETIME",
    ),
    "timestamp_ntz": ("TIMESTAMP_NTZ",),
    "binary": (
        "RAW", "LONG RAW", "BLOB", "TINYBLOB", "MEDIUMBLOB", "LONGBLOB", "BYTEA", "IMAGE", "BINARY", "VARBINARY",
        "BYTE", "VARBYTE", "BFILE",
    ),
    "array<string>": ("ARRAY", "SET"),
}
# Where a vendor means something else by a name.
_BY_VENDOR = {
    "oracle": {"DATE": "timestamp"},
    "mysql": {"FLOAT": "float", "TINYINT(1)": "boolean", "INT UNSIGNED": "bigint", "BIGINT UNSIGNED": "decimal(20,0)"},
}
# Precision and scale of types that carry none in their name.
_PRECISION = {"MONEY": (19, 4), "SMALLMONEY": (10, 4)}
DEFAULT_DECIMAL = (38, 10)
VENDORS = ("oracle", "postgresql", "sqlserver", "mysql", "db2", "teradata", "snowflake", "sybase")

_SPARK_TYPE = {name: spark for spark, names in _COMMON.items() for name in names}
_NAME = re.compile(r"^\s*([A-Z_0-9 ]+?)\s*(?:\(([^)]*)\))?\s*(WITH.*|UNSIGNED)?\s*$", re.I)


def spark_type(declared: str, vendor: str = "postgresql") -> str:
    """Spark type (as DDL text) of a vendor's column type, with or without its length."""
    if vendor not in VENDORS:
        raise ValueError(f"unknown vendor {vendor!r}, use one of {VENDORS}")
    special = _BY_VENDOR.get(vendor, {})
    full = re.sub(r"\s+", " ", declared.strip().upper())
    if full in special:
        return special[full]
    period = re.fullmatch(r"PERIOD\s*\((DATE|TIMESTAMP)\)", full)
    if period:
        item = spark_type(period.group(1), vendor)
        return f"struct<start:{item},end:{item}>"
    parsed = _NAME.match(full)
    if not parsed:
        raise ValueError(f"cannot read type {declared!r}")
    base, arguments, tail = parsed.groups()
    name = f"{base} {tail}".strip() if tail else base
    name = name if name in _SPARK_TYPE or name in special else base
    spark = special.get(name) or _SPARK_TYPE.get(name)
    if spark is None:
        raise ValueError(f"unknown {vendor} type {declared!r}")
    if spark != "decimal":
        return spark
    numbers = [int(n) for n in re.findall(r"-?\d+", arguments or "")]
    if name == "NUMBER" and len(numbers) == 2 and numbers[1] == 0 and numbers[0] <= 18:
        return "bigint"
    if not numbers:
        precision, scale = _PRECISION.get(name, DEFAULT_DECIMAL)
    else:
        precision, scale = numbers[0], numbers[1] if len(numbers) > 1 else 0
    if scale < 0:  # rounded to tens or hundreds: so many more digits before the point
        precision, scale = precision - scale, 0
    # no decimal of Spark's holds more digits; text loses none
    return f"decimal({precision},{scale})" if precision <= 38 else "string"


def struct_type(columns: Sequence[Mapping[str, object]], vendor: str) -> T.StructType:
    """Column specs as a schema; what Spark types cannot say goes to the field's metadata."""
    fields = []
    for column in columns:
        extra = {k: v for k, v in column.items() if k not in ("name", "type", "nullable") and v is not None}
        parsed = T.StructType.fromDDL(f"c {spark_type(str(column['type']), vendor)}")[0].dataType
        fields.append(T.StructField(str(column["name"]), parsed, column.get("nullable", True) is not False, extra))
    return T.StructType(fields)


def conform(df: DataFrame, columns: Sequence[Mapping[str, object]], vendor: str, strict: bool = False) -> DataFrame:
    """Select the columns of a spec with its types, defaults and metadata, in its order.

    Columns the input lacks are null or take their default. Bad values raise when
    ``strict``, else become null.
    """
    present = {c.lower(): c for c in df.columns}
    selected = []
    for column, field in zip(columns, struct_type(columns, vendor)):
        kind = field.dataType
        source = present.get(str(column["name"]).lower())
        value = F.lit(None) if source is None else F.col(f"`{source}`")
        value = value.cast(kind) if strict or source is None else value.try_cast(kind)
        if column.get("default") is not None:
            value = F.coalesce(value, F.lit(column["default"]).cast(kind))
        selected.append(value.alias(field.name, metadata=field.metadata))
    return df.select(*selected)


def table_ddl(schema: T.StructType) -> str:
    """Columns of a schema in the type names of managed tables."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema)
