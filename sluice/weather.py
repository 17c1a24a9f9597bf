"""The hourly weather observation model, ready to use with the library.

Everything the source pipeline needs for its own data: the 15-column
observation contract, the API's columnar payload and its mapping to table
columns, the city dimension, and its questions expressed with the
library's operators.  Only the values below are specific to that data;
the logic is the generic gate / profile code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.contract import Contract, Period, RangeRule, SameDay
from sluice.functions.time import months_in, season_of_month
from sluice.operators import dimension, profiles
from sluice.sources import columnar_json

# ---------------------------------------------------------------- fixed values
# These must equal the source pipeline's contract and dimension for equal results.
#
# Observation table: column and type, in file order.
OBSERVATION_COLUMNS = [
    ("city_id", "string"),
    ("city_name", "string"),
    ("country_code", "string"),
    ("latitude", "double"),
    ("longitude", "double"),
    ("elevation_m", "double"),
    ("observed_at", "timestamp"),
    ("observed_date", "date"),
    ("temperature_2m_c", "double"),
    ("apparent_temperature_c", "double"),
    ("relative_humidity_2m_pct", "int"),
    ("precipitation_mm", "double"),
    ("wind_speed_10m_kmh", "double"),
    ("surface_pressure_hpa", "double"),
    ("cloud_cover_pct", "int"),
]
KEY = ("city_id", "observed_at")
# Checked as required, in this order (city_id also must not be blank).
CHECKED_REQUIRED = ("observed_at", "observed_date", "city_id", "temperature_2m_c")
# Declared required in the schema document but not checked by the source pipeline.
DECLARED_REQUIRED = ("city_name", "country_code", "latitude", "longitude", "elevation_m")
# Physically possible bounds, inclusive.
RANGES = [
    ("temperature_2m_c", -90.0, 60.0),
    ("apparent_temperature_c", -110.0, 70.0),
    ("relative_humidity_2m_pct", 0, 100),
    ("precipitation_mm", 0.0, 500.0),
    ("wind_speed_10m_kmh", 0.0, 500.0),
    ("surface_pressure_hpa", 300.0, 1100.0),
    ("cloud_cover_pct", 0, 100),
]
PERIOD = ("2024-01-01", "2025-01-01")  # end excluded
BATCH_BOUNDARY = "2024-07-01"
SUMMER_RANGE = ("2024-06-01", "2024-09-01")  # the timed hourly-profile query
SEASONS = {"winter": [12, 1, 2], "summer": [6, 7, 8]}
# API hourly variable -> table column, in file order.
HOURLY_VARIABLES = [
    ("temperature_2m", "temperature_2m_c"),
    ("apparent_temperature", "apparent_temperature_c"),
    ("relative_humidity_2m", "relative_humidity_2m_pct"),
    ("precipitation", "precipitation_mm"),
    ("wind_speed_10m", "wind_speed_10m_kmh"),
    ("surface_pressure", "surface_pressure_hpa"),
    ("cloud_cover", "cloud_cover_pct"),
]
API_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
UNMATCHED = "Не сопоставлен"
# City dimension: city_id, city_name_ru, federal_district, utc_offset_hours.
CITY_REFERENCE = [
    ("moscow", "Москва", "Центральный", 3),
    ("saint_petersburg", "Санкт-Петербург", "Северо-Западный", 3),
    ("murmansk", "Мурманск", "Северо-Западный", 3),
    ("nizhny_novgorod", "Нижний Новгород", "Приволжский", 3),
    ("kazan", "Казань", "Приволжский", 3),
    ("rostov_on_don", "Ростов-на-Дону", "Южный", 3),
    ("sochi", "Сочи", "Южный", 3),
    ("yekaterinburg", "Екатеринбург", "Уральский", 5),
    ("novosibirsk", "Новосибирск", "Сибирский", 7),
    ("krasnoyarsk", "Красноярск", "Сибирский", 7),
    ("yakutsk", "Якутск", "Дальневосточный", 9),
    ("vladivostok", "Владивосток", "Дальневосточный", 10),
]
CITY_REFERENCE_SCHEMA = "city_id string, city_name_ru string, federal_district string, utc_offset_hours int"
# ----------------------------------------------------------------------------


def observation_schema() -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in OBSERVATION_COLUMNS])


def observation_contract(enforce_declared: bool = False) -> Contract:
    """The observation contract; ``enforce_declared`` also checks the columns the
    schema document declares required but the source pipeline never checked."""
    required = CHECKED_REQUIRED + (DECLARED_REQUIRED if enforce_declared else ())
    return Contract(
        fields=observation_schema(), key=KEY, required=required, blank=("city_id",),
        same_day=(SameDay("observed_date", "observed_at"),), period=Period("observed_at", *PERIOD),
        ranges=tuple(RangeRule(c, lo, hi) for c, lo, hi in RANGES))


def payload_schema() -> T.StructType:
    types = dict(OBSERVATION_COLUMNS)
    return columnar_json.columnar_schema(
        [T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
         T.StructField("elevation", T.DoubleType())],
        "time", [T.StructField(api, T._parse_datatype_string(types[col])) for api, col in HOURLY_VARIABLES])


def payload_rows(spark: SparkSession, path: str, cities: DataFrame,
                 multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """API payloads (one ``<city_id>.json`` per city) to observation rows.

    The city comes from the file name; ``cities`` (city_id, city_name,
    country_code) adds its names.  Returns ``(rows, rejected_payloads)``.
    """
    objects = (columnar_json.read_columnar(spark, path, payload_schema(), multi_line=multi_line)
               .withColumn("city_id", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)))
    values = [api for api, _ in HOURLY_VARIABLES]
    rows, rejected = columnar_json.explode_columnar(objects, "time", values, ts_name="observed_at",
                                                    date_name="observed_date", time_format=API_TIME_FORMAT,
                                                    ntz=False)
    named = rows.join(cities.select("city_id", "city_name", "country_code"), "city_id", "left")
    out = named.select(
        "city_id", "city_name", "country_code", "latitude", "longitude",
        F.col("elevation").alias("elevation_m"), "observed_at", "observed_date",
        *[F.col(api).cast(dict(OBSERVATION_COLUMNS)[col]).alias(col) for api, col in HOURLY_VARIABLES])
    return out, rejected


def city_reference(spark: SparkSession) -> DataFrame:
    return dimension.inline_dimension(spark, CITY_REFERENCE, CITY_REFERENCE_SCHEMA)


def summer_hourly_profile(obs: DataFrame) -> DataFrame:
    """Mean temperature (3 digits) and count per city and UTC hour, June to August.

    Columns: city_id, hour_utc, mean_temperature_c, observations.
    """
    return profiles.hourly_profile(obs, "city_id", "observed_at", "temperature_2m_c", *SUMMER_RANGE, digits=3,
                                   mean_name="mean_temperature_c")


def seasonal_answer(obs: DataFrame) -> DataFrame:
    """Daily temperature cycle per city, winter against summer.

    Columns: city_id, season, coldest_hour_mean_c, warmest_hour_mean_c,
    daily_amplitude_c, coldest_hour_utc, warmest_hour_utc.
    """
    prof = profiles.seasonal_profile(obs, "city_id", "temperature_2m_c",
                                     season_of_month("observed_at", SEASONS), F.hour("observed_at"),
                                     where=months_in("observed_at", SEASONS))
    return prof.select("city_id", "season", F.col("min_mean").alias("coldest_hour_mean_c"),
                       F.col("max_mean").alias("warmest_hour_mean_c"),
                       F.col("amplitude").alias("daily_amplitude_c"),
                       F.col("min_hour").alias("coldest_hour_utc"), F.col("max_hour").alias("warmest_hour_utc"))


def district_rollup(spark: SparkSession, obs: DataFrame) -> DataFrame:
    """Cities, observations, mean/min/max temperature per federal district (unmatched kept)."""
    return dimension.dimension_rollup(dimension.measure_partials(obs, "city_id", "temperature_2m_c"),
                                      city_reference(spark), "city_id", "city_id", "federal_district",
                                      unmatched=UNMATCHED)


def local_answer(spark: SparkSession, obs: DataFrame) -> DataFrame:
    """Daily cycle in local time per district and season (matched cities only)."""
    return profiles.local_profile(obs, city_reference(spark), "city_id", "federal_district", "utc_offset_hours",
                                  "observed_at", "temperature_2m_c", season_of_month("observed_at", SEASONS),
                                  where=months_in("observed_at", SEASONS))


def control(obs: DataFrame) -> DataFrame:
    return profiles.control_aggregate(obs, "city_id", "temperature_2m_c")
