from .columns import (bucketize, code_map, flag, flag_in, pct_change,
                      postcode_area, postcode_district, regex_first, surrogate_key,
                      tri_state, try_date, upper_trim)
from . import dates

__all__ = [
    "bucketize", "code_map", "flag", "flag_in", "pct_change",
    "postcode_area", "postcode_district", "regex_first", "surrogate_key",
    "tri_state", "try_date", "upper_trim", "dates",
]
