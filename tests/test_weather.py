"""The observation model end to end on small synthetic API payloads."""

import json
import math
import os

from pyspark.sql import functions as F

from sluice import weather
from sluice.plans import gate
from sluice.sources import ingestion
from sluice.sources.csv import read_permissive


def payload(base_temp, days):
    times, temp = [], []
    for day in days:
        for h in range(24):
            times.append(f"{day}T{h:02d}:00")
            temp.append(round(base_temp + 5 * math.sin(h / 24 * 2 * math.pi), 2))
    n = len(times)
    return {"latitude": 55.75, "longitude": 37.62, "elevation": 144.0,
            "hourly": {"time": times, "temperature_2m": temp, "apparent_temperature": temp,
                       "relative_humidity_2m": [80] * n, "precipitation": [0.0] * n,
                       "wind_speed_10m": [3.5] * n, "surface_pressure": [1000.0] * n, "cloud_cover": [50] * n}}


def test_weather_model(spark, workdir):
    src = os.path.join(workdir, "raw_json")
    os.makedirs(src)
    days = ["2024-01-15", "2024-07-15"]
    for city, base in [("moscow", -5.0), ("astana", 2.0)]:
        with open(os.path.join(src, f"{city}.json"), "w") as fh:
            json.dump(payload(base, days), fh, indent=2)
    cities = spark.createDataFrame([("moscow", "Москва", "RU"), ("astana", "Астана", "KZ")],
                                   "city_id string, city_name string, country_code string")
    rows, bad = weather.payload_rows(spark, src, cities)
    assert bad.count() == 0 and rows.count() == 96
    assert rows.columns == [c for c, _ in weather.OBSERVATION_COLUMNS]
    raw_root = os.path.join(workdir, "raw")
    ingestion.land(rows, raw_root, "2024-02-01")
    contract = weather.observation_contract()
    raw = ingestion.read_latest(spark, raw_root, lambda p: read_permissive(spark, p, contract)).drop("ingestion_date")
    res = gate.run_gate(raw, contract, os.path.join(workdir, "gate"), strict=True)
    assert res.metrics["accepted"] == 96
    obs = res.accepted(spark, contract)

    hourly = weather.summer_hourly_profile(obs).collect()
    assert len(hourly) == 48 and all(r["observations"] == 1 for r in hourly)
    ans = {(r["city_id"], r["season"]): r for r in weather.seasonal_answer(obs).collect()}
    w = ans[("moscow", "winter")]
    assert w["daily_amplitude_c"] == 10.0
    assert (w["warmest_hour_utc"], w["coldest_hour_utc"]) == (6, 18)
    assert "mean_temperature_c" in hourly[0].asDict()
    roll = {r["federal_district"]: r for r in weather.district_rollup(spark, obs).collect()}
    assert roll[weather.UNMATCHED]["observations"] == 48 and roll["Центральный"]["entities"] == 1
    local = {(r["federal_district"], r["season"]): r for r in weather.local_answer(spark, obs).collect()}
    assert local[("Центральный", "winter")]["warmest_hours"] == "9"      # 06 UTC + 3 h
    ctl = weather.control(obs).first()
    assert (ctl["observations"], ctl["entities"]) == (96, 2)
    assert F is not None
