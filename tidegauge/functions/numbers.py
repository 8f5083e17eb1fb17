"""Numbers in text fields, with the strictness of the JVM parsers.

``try_cast`` is a little more generous: it takes ``inf`` and ``nan`` in any spelling for
floating types and blanks around whole numbers. ``valid_number`` refuses those.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings the cast accepts and the JVM does not; a plain whole number.
_LOOSE_SPECIAL = r"^\s*[+-]?(?!(?:Infinity|NaN)\s*$)(?i:inf|infinity|nan)\s*$"
_WHOLE = r"^[+-]?[0-9]+$"


# The greatest finite double.
_FINITE = 1.7976931348623157e308


def read_number(field, dtype):
    return field.try_cast(dtype)


def valid_number(field, number, dtype):
    """Whether ``number``, read from ``field``, is one the JVM would have read as well."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        # The spelling matters only for the rare special values.
        return F.when(F.abs(number) <= F.lit(_FINITE), True).otherwise(
            number.isNotNull() & ~field.rlike(_LOOSE_SPECIAL))
    return number.isNotNull() & field.rlike(_WHOLE)
