"""Column expressions (no Python UDFs): lenient casts, address keys, money."""

from .lenient import is_number, lenient_decimal, lenient_long, lenient_round, lenient_timestamp
from .keys import address_key, hex_prefix_to_unsigned
from .money import money, per_unit
from .text import collated, empty_to_null, null_if_empty, value_or_default

__all__ = [
    "is_number", "lenient_decimal", "lenient_long", "lenient_round", "lenient_timestamp",
    "address_key", "hex_prefix_to_unsigned", "money", "per_unit",
    "collated", "empty_to_null", "null_if_empty", "value_or_default",
]
