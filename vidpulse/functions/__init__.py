from vidpulse.functions.columns import clamp, finite_or_null, flag, lenient, millis_text, parse_time, ratio, time_text
from vidpulse.functions.draws import draw32, draw60, int_between, md5_key, uniform

__all__ = [
    "clamp",
    "draw32",
    "draw60",
    "finite_or_null",
    "flag",
    "int_between",
    "lenient",
    "millis_text",
    "md5_key",
    "parse_time",
    "ratio",
    "time_text",
    "uniform",
]
