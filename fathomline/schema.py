"""Schemas, thresholds and sentinels of the moving-object model."""

from __future__ import annotations

from pyspark.sql import types as T

UNKNOWN_INT, UNKNOWN_FLOAT, UNKNOWN_TEXT = -1, -1.0, "Unknown"

# Thresholds of trajectory construction and of cell facts.
GAP_SECONDS = 900
STOP_SECONDS = 300
STOP_KNOTS = 0.5
MIN_POINTS = 3
MAX_KNOTS = 100.0
SOG_TOLERANCE = 2.0
KNOTS = 1.943844
CELL_KNOTS = 1.94
EDGE_METRES = 0.2
SIMPLIFY_METRES = 10.0
TEMPORAL_RESOLUTION = 84600
CELL_SIZES = (5000, 1000, 200, 50)
TILE = 5000
DOMAIN = (3480000, 2930000, 4495000, 3645000)

TIMESTAMP_FORMAT = "dd/MM/yyyy HH:mm:ss"

_D, _S = T.DoubleType(), T.StringType()

#: The raw CSV's columns, in file order. Timestamps and IMO are text until they are parsed.
AIS_CSV = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("timestamp_text", _S), ("mobile_type", _S), ("mmsi", T.LongType()), ("lat", _D), ("lon", _D), ("nav_status", _S), ("rot", _D), ("sog", _D), ("cog", _D), ("heading", _D), ("imo_text", _S),
            ("callsign", _S), ("name", _S), ("ship_type", _S), ("cargo_type", _S), ("width", _D), ("length", _D), ("position_fixing_device", _S), ("draught", _D), ("destination", _S), ("eta_text", _S),
            ("data_source_type", _S), ("a", _D), ("b", _D), ("c", _D), ("d", _D),
        )
    ]
)

POINT = T.StructType([T.StructField("t", T.TimestampType()), T.StructField("x", _D), T.StructField("y", _D)])
SEQUENCE = T.ArrayType(POINT, containsNull=False)
STEP = T.StructType([T.StructField("t", T.TimestampType()), T.StructField("v", _D)])
