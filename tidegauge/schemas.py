"""Row layouts shared by the sources, the parsers and the tables."""

from pyspark.sql import types as T


def _struct(types, names):
    return T.StructType([T.StructField(n, t) for n, t in zip(names, types)])


_S, _D, _F, _L = T.StringType(), T.DoubleType(), T.FloatType(), T.LongType()

# Field names and their order are part of the input formats.
METRICS = ["hz", "disp", "flo", "sedPPM", "psi", "chlPPM"]
SENSOR = _struct([_S] * 3 + [_D] * 6, ["resid", "date", "time"] + METRICS)
SENSOR_ROW = _struct([_S] * 3 + [_D] * 6, ["key", "resID", "date"] + METRICS)
PUMP = _struct(
    [_S] * 5 + [_F] * 2,
    ["resid", "pumpType", "purchaseDate", "serviceDate", "vendor", "longitude", "lattitude"],
)
MAINT = _struct([_S] * 4, ["resid", "eventDate", "technician", "description"])
EMPLOYEE = _struct(
    [_L] + [_S] * 5,
    ["emp_no", "birth_date", "first_name", "last_name", "gender", "hire_date"],
)
EMPLOYEE_AVRO = EMPLOYEE  # int numbers of older files are read as bigint
VMSTAT_COUNTERS = ["R", "B", "SWPD", "FREE", "BUFF", "CACH", "SI", "SO", "BI", "BO",
                   "INS", "CS", "US", "SY", "ID", "WA"]
VMSTAT = _struct([_S] * 17, VMSTAT_COUNTERS + ["ST"])
VMSTAT_STAMPED = _struct([_S] * 18, VMSTAT_COUNTERS + ["DATE", "TIME"])
POST = _struct([_L, _S, _S], ["id", "text", "created_at"])
CELL = _struct([_S] * 4, ["row_key", "family", "qualifier", "value"])
BINARY_CELL = _struct([_S] * 3 + [T.BinaryType()], CELL.fieldNames())
CELL_KEYS = ["row_key", "family", "qualifier"]
