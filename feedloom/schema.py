"""Canonical output model.

Fixed values: the canonical product tables, column order and types
(T = string, F = double, I = bigint, B = boolean). They must equal the
tables the mapped ingest writes, so they are listed plainly here.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"T": T.StringType(), "F": T.DoubleType(), "I": T.LongType(), "B": T.BooleanType()}
SQL_TYPES = {"T": "string", "F": "double", "I": "bigint", "B": "boolean"}

# Core product table (27 columns + product_id).
CORE_COLUMNS = [
    ("vendor_code", "T"), ("inventory_partno", "T"), ("category_type", "T"), ("upc", "T"),
    ("wholesale_price", "F"), ("imap_price", "F"), ("is_imap", "B"),
    ("width_in", "F"), ("height_in", "F"), ("length_in", "F"), ("weight_lb", "F"),
    ("shipping_weight_lb", "F"), ("carton_height_in", "F"), ("carton_length_in", "F"), ("carton_width_in", "F"),
    ("bulb_quantity", "I"), ("marketing_description", "T"), ("finish", "T"), ("subcategory", "T"),
    ("shipping_type", "T"), ("collection", "T"), ("location", "T"),
    ("currency_code", "T"), ("source_file_name", "T"), ("source_sheet_name", "T"),
    ("source_row_number", "I"), ("run_id", "I"),
]

# Lighting attributes (product_id + 25).
LIGHTING_COLUMNS = [
    ("type1", "T"), ("type2", "T"), ("subtype1", "T"), ("room_used", "T"),
    ("certification_type", "T"), ("ada", "B"), ("energy_star", "B"),
    ("material", "T"), ("style", "T"), ("shade", "T"),
    ("voltage", "T"), ("bulb_socket", "T"), ("bulb_included", "B"), ("bulb_watts", "F"), ("bulb_shape", "T"),
    ("kelvin", "I"), ("cri", "I"), ("bulb_dimmable", "B"), ("lumens", "I"),
    ("canopy_height_in", "F"), ("canopy_length_in", "F"), ("canopy_width_in", "F"), ("canopy_depth_in", "F"),
    ("minimum_height_in", "F"), ("maximum_height_in", "F"),
]

# Fan attributes (product_id + 28).
FANS_COLUMNS = [
    ("type1", "T"), ("type2", "T"), ("subtype1", "T"), ("room_used", "T"), ("certification_type", "T"),
    ("blade_span_in", "F"), ("blade_count", "I"), ("blade_color", "T"), ("blade_pitch", "F"),
    ("cfm_average", "I"), ("cfm_high", "I"), ("cfm_average_watts", "F"), ("cfm_high_watts", "F"),
    ("max_angle", "F"), ("low_rpm", "I"), ("high_rpm", "I"), ("motor_watts", "F"), ("motor_type", "T"),
    ("is_flush_mount", "B"), ("warranty", "T"), ("downrod", "T"), ("control_type", "T"),
    ("light_kit_included", "B"), ("light_kit_watts", "F"), ("light_kit_kelvin", "I"), ("light_kit_lumens", "I"),
    ("diffuser_type", "T"), ("style", "T"),
]

# Light bulb attributes (product_id + 1).
BULBS_COLUMNS = [("diameter_in", "F")]

# Categories with an attribute table, and presence-only categories.
ATTRIBUTE_TABLES = {"lighting": LIGHTING_COLUMNS, "fans": FANS_COLUMNS, "light_bulbs": BULBS_COLUMNS}
PRESENCE_TABLES = ("accessories", "home_decor")

# Columns that the pipeline adds to a wide feed. A normalised header never
# starts with "_", so no sheet column can have one of these names.
RESERVED = "_src_"
ROW, FILE, PATH, SHEET = "_src_row", "_src_file", "_src_path", "_src_sheet"
FILE_SEQ, SHEET_SEQ, VENDOR = "_src_file_seq", "_src_sheet_seq", "_src_vendor"
SHEET_COLUMNS = "_src_columns"   # the sheet's first column names, in sheet order
KIND = "_src_kind_"              # + column: cell kind of that column's value
HAS = "_src_has_"                # + token: some column named like the token has text

KEY_COLUMNS = ("vendor_code", "inventory_partno")
LINEAGE_COLUMNS = ("source_file_name", "source_sheet_name", "source_row_number", "run_id")
DEFAULT_CURRENCY = "USD"
DEFAULT_CATEGORY = "lighting"


def struct_type(columns) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[k], True) for n, k in columns])


def core_struct() -> T.StructType:
    return struct_type([("product_id", "I")] + CORE_COLUMNS)
