"""Column-level helpers: JSON parse/render, tolerant casts, composite keys."""

from sensorflow.functions.casts import (  # noqa: F401
    cast_double, cast_timestamps, conform_casts, instant_to_utc_ntz, iso_utc, iso_with_offset,
)
from sensorflow.functions.json import (  # noqa: F401
    map_lookup, parse_array, parse_struct,
)
from sensorflow.functions.keys import composite_key  # noqa: F401
