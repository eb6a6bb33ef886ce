"""Schemas, codes and parameters shared by every job."""

from pyspark.sql import types as T

# Country code and display name.
COUNTRIES = {
    "CH": "China",
    "GM": "Germany",
    "GR": "Greece",
    "BR": "Brazil",
    "IS": "Israel",
}

# The observed variables that end up in the monthly averages.
VARIABLES = ("TMAX", "TMIN", "PRCP")

# Season number of January ... December for each country.
SEASON_BY_MONTH = {
    "CH": (4, 4, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4),
    "GM": (4, 4, 1, 1, 1, 2, 2, 2, 3, 3, 3, 4),
    "GR": (4, 4, 1, 1, 1, 2, 2, 2, 3, 3, 3, 4),
    "BR": (2, 2, 2, 3, 3, 3, 4, 4, 4, 1, 1, 1),
    "IS": (4, 4, 1, 1, 1, 2, 2, 2, 3, 3, 3, 4),
}
SEASON_NAMES = {1: "spring", 2: "summer", 3: "autumn", 4: "winter"}
MONTH_NAMES = dict(
    enumerate(
        "January February March April May June July August September October November December".split(),
        start=1,
    )
)

# Fixed value: observations before this day are not used.
DATE_FLOOR = 19700101

OBSERVATION = T.StructType(
    [
        T.StructField("StationId", T.StringType()),
        T.StructField("Date", T.IntegerType()),
        T.StructField("Variable", T.StringType()),
        T.StructField("Value", T.IntegerType()),
        T.StructField("M_Flag", T.StringType()),
        T.StructField("Q_Flag", T.StringType()),
        T.StructField("S_Flag", T.StringType()),
        T.StructField("ObsTime", T.StringType()),
    ]
)

# The columns of a message-queue record that the jobs use.
RAW_RECORD = T.StructType(
    [
        T.StructField("value", T.BinaryType()),
        T.StructField("offset", T.LongType()),
        T.StructField("partition", T.IntegerType()),
    ]
)

COORDINATES = ("LATITUDE", "LONGITUDE", "ELEVATION")

# Stations over time: a line holds from a day on, a missing day is the beginning.
STATION_HISTORY = T.StructType(
    [
        T.StructField("StationIdA", T.StringType()),
        *(T.StructField(c, T.DoubleType()) for c in COORDINATES),
        T.StructField("ValidFrom", T.IntegerType()),
    ]
)

PARTIALS = T.StructType(
    [
        T.StructField("StationId", T.StringType()),
        T.StructField("Month", T.IntegerType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("SumTmax", T.LongType()),
        T.StructField("SumTmin", T.LongType()),
        T.StructField("SumPrcp", T.LongType()),
        T.StructField("countTmax", T.LongType()),
        T.StructField("countTmin", T.LongType()),
        T.StructField("countPrcp", T.LongType()),
        T.StructField("FIPS_code", T.StringType()),
        T.StructField("LATITUDE", T.DoubleType()),
        T.StructField("LONGITUDE", T.DoubleType()),
        T.StructField("ELEVATION", T.DoubleType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# The partials with a divisor by distinct values: a sketch for each variable, or the bits of 64 neighbouring values.
SKETCH_PARTIALS = T.StructType(
    [
        T.StructField("StationId", T.StringType()),
        T.StructField("Month", T.IntegerType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("SumTmax", T.LongType()),
        T.StructField("SumTmin", T.LongType()),
        T.StructField("SumPrcp", T.LongType()),
        T.StructField("SketchTmax", T.BinaryType()),
        T.StructField("SketchTmin", T.BinaryType()),
        T.StructField("SketchPrcp", T.BinaryType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

BIT_PARTIALS = T.StructType(
    [
        T.StructField("StationId", T.StringType()),
        T.StructField("Month", T.IntegerType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("Variable", T.StringType()),
        T.StructField("Word", T.IntegerType()),
        T.StructField("Bits", T.LongType()),
        T.StructField("Total", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# First values of each day, the finer alternative to the partials.
DAILY = T.StructType(
    [
        T.StructField("StationId", T.StringType()),
        T.StructField("Date", T.IntegerType()),
        T.StructField("Variable", T.StringType()),
        T.StructField("Value", T.IntegerType()),
        T.StructField("seq", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# Sums of the months that a batch of a stateful stream has changed.
MONTHLY = T.StructType([f for f in PARTIALS if f.name not in ("FIPS_code", *COORDINATES)])

# What came in with each micro-batch, before cleaning.
PROGRESS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)

WEATHER = T.StructType(
    [
        T.StructField("StationId", T.StringType()),
        T.StructField("Month", T.IntegerType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("AvgTmax", T.DoubleType()),
        T.StructField("AvgTmin", T.DoubleType()),
        T.StructField("AvgPrcp", T.DoubleType()),
        T.StructField("FIPS_code", T.StringType()),
        T.StructField("LATITUDE", T.DoubleType()),
        T.StructField("LONGITUDE", T.DoubleType()),
        T.StructField("ELEVATION", T.DoubleType()),
    ]
)
