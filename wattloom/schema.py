"""Schemas of the compact meter record, the flat reading and the source dimensions."""

from __future__ import annotations

from pyspark.sql import types as T

READING_STRUCT = "struct<meterId:string,power:string,label:string>"

# One JSON object per house and time step. Every member of a reading is text on the wire.
COMPACT = f"timestamp string, houseId bigint, zip string, readings array<{READING_STRUCT}>"
CORRUPT_COLUMN = "_corrupt_record"
COMPACT_WITH_CORRUPT = f"{COMPACT}, {CORRUPT_COLUMN} string"
# A record that several houses share has no house and zip of its own but a list of theirs.
HOUSES_COLUMN = "_houses"

READING_COLUMNS = ["house_id", "date", "ts", "zip", "label", "meter_id", "power"]

ZIP_COLUMNS = [
    ("_idx", "int"),
    ("zip", "string"),
    ("type", "string"),
    ("primary_city", "string"),
    ("acceptable_cities", "string"),
    ("unacceptable_cities", "string"),
    ("state", "string"),
    ("county", "string"),
    ("timezone", "string"),
    ("area_codes", "string"),
    ("latitude", "double"),
    ("longitude", "double"),
    ("world_region", "string"),
    ("country", "string"),
    ("decommissioned", "int"),
    ("estimated_population", "bigint"),
    ("notes", "string"),
]
ZIPS_INDEXED = ", ".join(f"{name} {kind}" for name, kind in ZIP_COLUMNS)
ZIPS = ", ".join(f"{name} {kind}" for name, kind in ZIP_COLUMNS[1:])


def struct_of(ddl: str) -> T.StructType:
    """DDL text to a StructType, without a running session."""
    return T.StructType.fromDDL(ddl)
