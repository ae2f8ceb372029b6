"""Schemas, fixed labels and default parameters.

The flight files are the public on-time performance CSVs: 29 positional
columns, no header after ingest.  Everything is read as STRING first (the raw
layer) and typed once by :func:`ontime_analytics.sources.flights.type_flights`.
"""

from __future__ import annotations

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# --- fixed values: the 29 input columns of the flight files, in file order ---
RAW_COLUMNS = (
    "Year", "Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime",
    "ArrTime", "CRSArrTime", "UniqueCarrier", "FlightNum", "TailNum",
    "ActualElapsedTime", "CRSElapsedTime", "AirTime", "ArrDelay", "DepDelay",
    "Origin", "Dest", "Distance", "TaxiIn", "TaxiOut", "Cancelled",
    "CancellationCode", "Diverted", "CarrierDelay", "WeatherDelay", "NASDelay",
    "SecurityDelay", "LateAircraftDelay",
)

# --- fixed values: English names, 1 = Monday / 1 = January ---
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                 "Saturday", "Sunday")
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December")

# --- fixed values: cancellation code -> reason (looked up after upper-casing) ---
CANCELLATION_REASONS = (
    ("A", "Carrier"),
    ("B", "Weather"),
    ("C", "NAS"),
    ("D", "Security"),
    ("NA", "Not Available"),
)
ALL_FLIGHTS_LABEL = "All Flights"

# --- fixed values: delay reason label -> typed column ---
DELAY_REASONS = (
    ("Carrier Delay", "carrier_delay"),
    ("Weather Delay", "weather_delay"),
    ("NAS Delay", "nas_delay"),
    ("Security Delay", "security_delay"),
    ("Late Aircraft Delay", "late_aircraft_delay"),
)

UNAVAILABLE_MODEL = "Unavailable"

# A departure delay strictly above this many minutes counts as "delayed".
DELAY_THRESHOLD_MINUTES = 15

# Distance bands are 500 miles wide, upper bound inclusive, open above 5000.
DISTANCE_BAND_WIDTH = 500
DISTANCE_BAND_MAX = 5000

# --- fixed values: cut-offs found on the full 1987-2008 data; they are the
# defaults of the threshold queries (each is a parameter) ---
AIRPORT_COUNT_UPPER = 92625
AIRPORT_COUNT_LOWER = 290
AIRPORT_PERCENT_UPPER = 18.06
AIRPORT_PERCENT_LOWER = 8.41
MODEL_PERCENT_UPPER = 51.72
MODEL_AVERAGE_UPPER = 105.0
MODEL_COUNT_UPPER = 5719
TOP_K = 50

# --- fixed value: first year of the published data; the daylight-saving rule
# has no last year unless a query is given one ---
DST_FIRST_YEAR = 1987

# Metadata of a typed column that its plan parses from text (a lake's columns have none).
PARSED_HERE = "parsed_here"

# Raw column -> typed column.  INT columns go through the strict parser.
INT_FIELDS = (
    ("Year", "year"),
    ("Month", "month"),
    ("DayofMonth", "day_of_month"),
    ("DayOfWeek", "day_of_week"),
    ("ArrDelay", "arr_delay"),
    ("DepDelay", "dep_delay"),
    ("Distance", "distance"),
    ("CarrierDelay", "carrier_delay"),
    ("WeatherDelay", "weather_delay"),
    ("NASDelay", "nas_delay"),
    ("SecurityDelay", "security_delay"),
    ("LateAircraftDelay", "late_aircraft_delay"),
)
STRING_FIELDS = (
    ("UniqueCarrier", "carrier"),
    ("Origin", "origin"),
    ("Dest", "dest"),
)

FLIGHTS_SCHEMA = StructType(
    [StructField("year", IntegerType()), StructField("month", IntegerType()),
     StructField("day_of_month", IntegerType()), StructField("day_of_week", IntegerType()),
     StructField("carrier", StringType()), StructField("tail_num", StringType()),
     StructField("arr_delay", IntegerType()), StructField("dep_delay", IntegerType()),
     StructField("origin", StringType()), StructField("distance", IntegerType()),
     StructField("cancelled", IntegerType()), StructField("cancel_code_raw", StringType()),
     StructField("cancel_code", StringType()),
     StructField("carrier_delay", IntegerType()), StructField("weather_delay", IntegerType()),
     StructField("nas_delay", IntegerType()), StructField("security_delay", IntegerType()),
     StructField("late_aircraft_delay", IntegerType()),
     StructField("dest", StringType())]
)
FLIGHT_COLUMNS = tuple(f.name for f in FLIGHTS_SCHEMA.fields)

# --- fixed values: aircraft registry, fixed width (0-based, half-open character slices) ---
MASTER_TAIL_SLICE = (0, 5)
MASTER_MODEL_CODE_SLICE = (37, 43)
ACFTREF_MODEL_CODE_SLICE = (0, 6)
ACFTREF_MODEL_NAME_SLICE = (39, 58)
