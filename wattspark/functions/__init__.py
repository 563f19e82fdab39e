"""Column-expression helpers (all JVM-side, codegen friendly)."""

from wattspark.functions.missing import (  # noqa: F401
    clean_tag, clean_value, ieee_div, to_numeric, NULL_TOKENS,
)
from wattspark.functions.timeops import (  # noqa: F401
    floor_time, interval_micros, parse_range, parse_time, in_range,
)
from wattspark.functions import units  # noqa: F401
