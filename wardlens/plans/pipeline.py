"""The whole build: bronze tables to silver tables to gold views.

Order is the dependency order. Silver tables are overwritten; gold views are stored text, so
they follow silver without being rebuilt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardlens.plans import clinical, cluster, gold, reports, silver, situation
from wardlens.session import cut_lineage
from wardlens.sources.bronze import TABLES as BRONZE
from wardlens.sources.tables import (
    define_view,
    materialize,
    materialize_by_hospital,
    materialize_by_month,
    recent_loads,
    reports_table,
)

def build_silver(
    spark: SparkSession,
    database: str,
    city: str = silver.CITY,
    buckets: int | None = None,
    partitions: int | None = None,
) -> None:
    def bronze(name: str):
        return spark.table(f"{database}.{BRONZE[name]}")

    def table(name: str):
        return f"{database}.{name}"

    materialize_by_month(
        silver.filed_admissions(bronze("admissions"), city),
        table("slv_internacao"),
        "co_cnes",
        "n_aih",
        partitions=partitions,
        finish=silver.typed_admissions,
    )
    materialize_by_hospital(
        silver.beds(bronze("beds"), city), table("slv_cnes_leitos"), "cnes", buckets=buckets
    )
    materialize_by_hospital(
        silver.patient_days(bronze("stays")), table("slv_sih_diasperm"), "co_cnes", buckets=buckets
    )
    materialize_by_hospital(
        silver.occupancy(
            spark.table(table("slv_sih_diasperm")), spark.table(table("slv_cnes_leitos"))
        ),
        table("slv_ocupacao"),
        "co_cnes",
        buckets=buckets,
    )
    materialize(
        clinical.disease_dimension(bronze("codes"), bronze("chapters")), table("dim_cid")
    )


def define_gold(spark: SparkSession, database: str) -> None:
    inputs = {
        "ocupacao": f"{database}.slv_ocupacao",
        "internacao": f"{database}.slv_internacao",
        "leitos": f"{database}.slv_cnes_leitos",
    }
    for view, sql in gold.VIEWS.items():
        define_view(spark, f"{database}.{view}", sql.format(**inputs), gold.MEANINGS)


def build(
    spark: SparkSession,
    database: str,
    city: str = silver.CITY,
    buckets: int | None = None,
    partitions: int | None = None,
) -> None:
    """`buckets` of the hospital-month tables and `partitions` of the admissions table default
    to the session's shuffle partitions."""
    build_silver(spark, database, city, buckets, partitions)
    define_gold(spark, database)
    materialize(
        clinical.clinical_profile(
            spark.table(f"{database}.slv_internacao"), spark.table(f"{database}.dim_cid")
        ),
        f"{database}.gld_perfil_clinico",
    )


def build_clusters(spark: SparkSession, database: str) -> None:
    """`gld_cluster` and `gld_fatores_hospital`, tables written from one pass over the features."""
    features = cut_lineage(
        gold.hospital_features(
            spark.table(f"{database}.slv_ocupacao"),
            spark.table(f"{database}.slv_internacao"),
            spark.table(f"{database}.slv_cnes_leitos"),
            single_name=True,
        )
    )
    fits = cluster.elbow(cluster.scaled_features(features))
    materialize(fits.assign(fits.best_k()), f"{database}.gld_cluster")
    grouped = features.join(spark.table(f"{database}.gld_cluster"), "co_cnes")
    materialize(
        cluster.pressure_factors(grouped, "cluster"), f"{database}.gld_fatores_hospital"
    )


def check_reports(spark: SparkSession, database: str) -> dict[str, Callable[[], DataFrame]]:
    """The printed checks of a finished build."""
    internacao, diasperm, leitos, ocupacao = (
        spark.table(f"{database}.{name}")
        for name in ("slv_internacao", "slv_sih_diasperm", "slv_cnes_leitos", "slv_ocupacao")
    )
    bronze = {name: f"{database}.{table}" for name, table in BRONZE.items()}
    checks = {
        "Admissions in bronze, by month": lambda: reports.bronze_volume(
            spark.table(bronze["admissions"])
        ),
        "Admissions kept, by month": lambda: reports.admissions_by_month(internacao),
        "Patient days of both sources": lambda: reports.reconciliation(internacao, diasperm),
        "Disease dictionary, codes and chapters": lambda: reports.dictionary_counts(
            spark.table(bronze["codes"]), spark.table(bronze["chapters"])
        ),
        "Admissions, first rows": lambda: reports.admissions_sample(internacao),
        "Admissions by complexity": lambda: reports.admissions_by_complexity(internacao),
        "Beds, first rows": lambda: reports.beds_sample(leitos),
        "Beds by kind of unit": lambda: reports.beds_by_unit_type(leitos),
        "Patient days, first rows": lambda: reports.patient_days_sample(diasperm),
        "Patient days by month": lambda: reports.patient_days_by_month(diasperm),
        "Occupancy, first rows": lambda: reports.occupancy_sample(ocupacao),
        "Occupancy by kind of unit": lambda: reports.occupancy_by_unit_type(ocupacao),
        "Highest rates now": lambda: reports.highest_now(ocupacao),
        "Hospitals per light now": lambda: reports.light_bands(ocupacao),
        "Fullest hospitals now": lambda: reports.top_critical(ocupacao),
        "Hospital features, first rows": lambda: reports.features_sample(
            ocupacao, internacao, leitos
        ),
        "Hospitals registered and reporting": lambda: situation.registry_gap(leitos, diasperm),
    }
    for name, table in bronze.items():
        if spark.catalog.tableExists(reports_table(table)):
            checks[f"Newest loads of {name}"] = lambda table=table: recent_loads(spark, table)
    return checks


def show_reports(spark: SparkSession, database: str) -> None:
    """Print every check with all its rows; they are reports of months, units or top lists."""
    for title, report in check_reports(spark, database).items():
        print(f"=== {title} ===")
        rows = report()
        rows.show(max(1, rows.count()), truncate=False)
