"""Column expressions: codes, coercion, reference look-ups and distances."""

from skytally.functions.codes import (
    as_utc, count_when, instant, is_blank, json_to_int, normalize_code, partition_label_path,
    partition_labels, percent, to_double, to_int, utc_iso,
)
from skytally.functions.geo import great_circle_km
from skytally.functions.reference import (
    continent_code, continent_name, country_code_of_name, manufacturer,
)

__all__ = [
    "as_utc", "continent_code", "continent_name", "count_when", "country_code_of_name",
    "great_circle_km", "instant", "is_blank", "json_to_int", "manufacturer", "normalize_code",
    "partition_label_path", "partition_labels", "percent", "to_double", "to_int", "utc_iso",
]
