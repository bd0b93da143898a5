"""Reference data: country to sales region (operator L8)."""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.schemas import COUNTRY_REGION_SCHEMA

#: the built-in seed: fixed values, the region of each country
BUILT_IN = Path(__file__).with_name("country_region.csv")


def country_region(spark: SparkSession) -> DataFrame:
    """The built-in seed, read where the package is installed: by the driver."""
    with BUILT_IN.open(encoding="utf-8", newline="") as file:
        rows = [(row["country"], row["region"]) for row in csv.DictReader(file)]
    return spark.createDataFrame(rows, COUNTRY_REGION_SCHEMA)


def read_country_region(spark: SparkSession, path: str) -> DataFrame:
    """A seed of the same two columns from a CSV file with a header."""
    return (
        spark.read.schema(COUNTRY_REGION_SCHEMA)
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
