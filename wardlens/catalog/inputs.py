"""Inputs derived from one scale factor's tables, and the shape registered results take."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.plans import clinical, gold, silver
from wardlens.session import apply_settings
from wardlens.sources import driver_tables

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """Raw and silver DataFrames of one scale factor, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def admissions_raw(self) -> DataFrame:
        return driver_tables.admissions_raw(self.spark, self.sf_dir)

    @cached_property
    def admissions(self) -> DataFrame:
        return silver.admissions(self.admissions_raw)

    @cached_property
    def beds(self) -> DataFrame:
        return silver.beds(self.beds_raw)

    @cached_property
    def stays(self) -> DataFrame:
        return silver.patient_days(self.stays_wide)

    @cached_property
    def occupancy(self) -> DataFrame:
        return silver.occupancy(self.stays, self.beds)

    @cached_property
    def beds_raw(self) -> DataFrame:
        return driver_tables.beds_raw(self.spark, self.sf_dir)

    @cached_property
    def stays_wide(self) -> DataFrame:
        return driver_tables.stays_wide(self.spark, self.sf_dir)

    @cached_property
    def features(self) -> DataFrame:
        """One row per hospital."""
        return gold.hospital_features(
            self.occupancy, self.admissions, self.beds, single_name=True
        )

    @cached_property
    def conversations(self) -> DataFrame:
        return driver_tables.table(self.spark, self.sf_dir, "conversations")

    @cached_property
    def diseases(self) -> DataFrame:
        return clinical.disease_dimension(
            driver_tables.disease_codes_raw(self.spark, self.sf_dir),
            driver_tables.disease_chapters_raw(self.spark),
        )


def portable(df: DataFrame) -> DataFrame:
    """Exact decimals, dates and narrow integers as types every engine prints alike."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(columns)


def over(plan: Callable[[Inputs], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_settings(spark)
        return portable(plan(Inputs(spark, sf_dir)))

    return query
