"""Row filters."""

from pyspark.sql import functions as F

from tidegauge.functions.text import has_keyword

# Fixed value: pressure below this is an alert.
LOW_PRESSURE = 5.0


def is_alert(column="psi", threshold=LOW_PRESSURE):
    return F.col(column) < F.lit(float(threshold))


def alerts(df, column="psi", threshold=LOW_PRESSURE):
    """Rows strictly below the threshold; NaN is no alert."""
    return df.filter(is_alert(column, threshold))


def drop_lines_containing(lines, terms, column="value"):
    for term in terms:
        lines = lines.filter(~F.col(column).contains(term))
    return lines


def keyword_filter(df, terms, column="text"):
    """Rows whose text holds any of the terms as a whole token, in any case."""
    return df.filter(has_keyword(F.col(column), terms))
