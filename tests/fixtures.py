"""Test fixtures built from the schemas and printed outputs of the teaching
notebooks: an iris CSV and a weather Parquet dataset whose per-station row
counts equal the printed golden table."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import SparkSession

from tablejobs.schemas import WEATHER_SCHEMA

# The first 20 iris rows as printed (index, four measures, species).
IRIS_ROWS = [
    (1, "5.1", "3.5", "1.4", "0.2"), (2, "4.9", "3", "1.4", "0.2"),
    (3, "4.7", "3.2", "1.3", "0.2"), (4, "4.6", "3.1", "1.5", "0.2"),
    (5, "5", "3.6", "1.4", "0.2"), (6, "5.4", "3.9", "1.7", "0.4"),
    (7, "4.6", "3.4", "1.4", "0.3"), (8, "5", "3.4", "1.5", "0.2"),
    (9, "4.4", "2.9", "1.4", "0.2"), (10, "4.9", "3.1", "1.5", "0.1"),
    (11, "5.4", "3.7", "1.5", "0.2"), (12, "4.8", "3.4", "1.6", "0.2"),
    (13, "4.8", "3", "1.4", "0.1"), (14, "4.3", "3", "1.1", "0.1"),
    (15, "5.8", "4", "1.2", "0.2"), (16, "5.7", "4.4", "1.5", "0.4"),
    (17, "5.4", "3.9", "1.3", "0.4"), (18, "5.1", "3.5", "1.4", "0.3"),
    (19, "5.7", "3.8", "1.7", "0.3"), (20, "5.1", "3.8", "1.5", "0.3"),
]
# Rows of another species of the public iris data, so the species filter removes some.
IRIS_EXTRA = [(21, "7", "3.2", "4.7", "1.4"), (22, "6.4", "3.2", "4.5", "1.5"),
              (23, "6.9", "3.1", "4.9", "1.5")]
# Fixed value: the header line.
IRIS_HEADER = ["", "Sepal.Length", "Sepal.Width", "Petal.Length", "Petal.Width", "Species"]

# Station name, unit and number of daily rows (the golden counts).
WEATHER_STATIONS = [
    ("BARNABY CALIFORNIA, CA US", "C", 151),
    ("BIG ROCK CALIFORNIA, CA US", "C", 151),
    ("BLACK DIAMOND CALIFORNIA, CA US", "C", 151),
    ("BRIONES CALIFORNIA, CA US", "F", 151),
    ("CONCORD BUCHANAN FIELD, CA US", "F", 149),
    ("HAYWARD AIR TERMINAL, CA US", "F", 149),
    ("HOUSTON INTERCONTINENTAL AIRPORT, TX US", "F", 150),
    ("HOUSTON WILLIAM P HOBBY AIRPORT, TX US", "C", 150),
    ("LAS TRAMPAS CALIFORNIA, CA US", "C", 151),
    ("LOS PRIETOS CALIFORNIA, CA US", "F", 151),
    ("MERRITT ISLAND FLORIDA, FL US", "C", 151),
    ("OAKLAND NORTH CALIFORNIA, CA US", "F", 151),
    ("OAKLAND SOUTH CALIFORNIA, CA US", "F", 151),
    ("PULGAS CALIFORNIA, CA US", "F", 151),
    ("SAN FRANCISCO INTERNATIONAL AIRPORT, CA US", "C", 149),
    ("SPRING VALLEY CALIFORNIA, CA US", "F", 151),
    ("WOODACRE CALIFORNIA, CA US", "F", 151),
]


def iris_lines(sep: str = ",", header: bool = True, extra: bool = True) -> list[str]:
    rows = IRIS_ROWS + (IRIS_EXTRA if extra else [])
    out = []
    if header:
        out.append(sep.join(f'"{h}"' for h in IRIS_HEADER))
    for idx, a, b, c, d in rows:
        species = "setosa" if idx <= 20 else "versicolor"
        out.append(sep.join([f'"{idx}"', a, b, c, d, f'"{species}"']))
    return out


def write_iris(folder: str, sep: str = ",", header: bool = True, extra: bool = True,
               name: str = "iris.csv") -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write("\n".join(iris_lines(sep, header, extra)) + "\n")
    return path


def weather_rows(extras: bool = False) -> list[tuple]:
    """One row per station and day; positions, dates and temperatures are
    derived from the station index (they are not published)."""
    rows = []
    start = dt.date(2019, 12, 1)
    for i, (name, unit, n) in enumerate(WEATHER_STATIONS):
        station = f"USW{i:08d}"
        lat, lon, elev = 30.0 + i * 0.5, -122.0 + i * 0.25, 10.0 * i
        for d in range(n):
            base = 12.0 + (i % 5) + (d % 7) * 0.5
            tavg = base * 9 / 5 + 32 if unit == "F" else base
            rows.append((name, station, lat, lon, elev, start + dt.timedelta(days=d), unit, tavg))
    if extras:
        first = WEATHER_STATIONS[0][0]
        # NULL temperatures (three-key vs two-key counts differ) and a NULL elevation.
        rows.append((first, "USW00000000", 30.0, -122.0, 10.0 * 0, dt.date(2020, 6, 1), "C", None))
        rows.append((first, "USW00000000", 30.0, -122.0, 10.0 * 0, dt.date(2020, 6, 2), "C", None))
        rows.append(("NULL ELEVATION, XX US", "USW99999998", 1.0, 1.0, None,
                     dt.date(2020, 1, 1), "C", 5.0))
        # A station reporting from two positions: the consistency check must fail.
        rows.append(("MOVING STATION, XX US", "USW99999999", 1.0, 1.0, 1.0,
                     dt.date(2020, 1, 1), "F", 50.0))
        rows.append(("MOVING STATION, XX US", "USW99999999", 2.0, 1.0, 1.0,
                     dt.date(2020, 1, 2), "F", 51.0))
    return rows


def write_weather(spark: SparkSession, folder: str, extras: bool = False) -> str:
    path = os.path.join(folder, "stationData.parquet")
    spark.createDataFrame(weather_rows(extras), WEATHER_SCHEMA).repartition(4) \
        .write.mode("overwrite").parquet(path)
    return path
