from tidegauge.functions.text import blank_fields, comma_fields, has_keyword
from tidegauge.functions.numbers import read_number, valid_number
from tidegauge.functions.doublebytes import double_from_bytes, double_to_bytes

__all__ = ["blank_fields", "comma_fields", "has_keyword", "read_number", "valid_number",
           "double_from_bytes", "double_to_bytes"]
