"""Silver, gold and report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardlens.catalog.inputs import Inputs, Query, over
from wardlens.plans import clinical, gold, reports, silver, situation
from wardlens.sources import driver_tables


def _padded_registry(i: Inputs) -> DataFrame:
    registry = silver.beds(driver_tables.beds_raw(i.spark, i.sf_dir, padded=False))
    return silver.occupancy(i.stays, registry, padded_keys=True)


RELATIONAL: dict[str, Query] = {
    "d1_slv_internacao": over(lambda i: i.admissions),
    "d2_slv_cnes_leitos": over(lambda i: i.beds),
    "d3_slv_sih_diasperm": over(lambda i: i.stays),
    "d4_slv_ocupacao": over(lambda i: i.occupancy),
    "d5_gld_ocupacao_mensal": over(lambda i: gold.monthly_occupancy(i.occupancy)),
    "d6_gld_features_hospital": over(
        lambda i: gold.hospital_features(i.occupancy, i.admissions, i.beds)
    ),
    "d6_features_single_name": over(
        lambda i: gold.hospital_features(i.occupancy, i.admissions, i.beds, single_name=True)
    ),
    "d7_admissions_by_month": over(lambda i: reports.admissions_by_month(i.admissions)),
    "d8_reconciliation": over(lambda i: reports.reconciliation(i.admissions, i.stays)),
    "d9_lights_now": over(lambda i: reports.lights_now(i.occupancy)),
    "d10_top_critical": over(lambda i: reports.top_critical(i.occupancy)),
    "d11_features_sample": over(
        lambda i: reports.features_sample(i.occupancy, i.admissions, i.beds)
    ),
    "d12_bronze_volume": over(lambda i: reports.bronze_volume(i.admissions_raw)),
    "d13_dictionary_counts": over(
        lambda i: reports.dictionary_counts(
            driver_tables.disease_codes_raw(i.spark, i.sf_dir),
            driver_tables.disease_chapters_raw(i.spark),
        )
    ),
    "d14_admissions_sample": over(lambda i: reports.admissions_sample(i.admissions)),
    "d15_admissions_by_complexity": over(
        lambda i: reports.admissions_by_complexity(i.admissions)
    ),
    "d16_beds_sample": over(lambda i: reports.beds_sample(i.beds)),
    "d17_beds_by_unit_type": over(lambda i: reports.beds_by_unit_type(i.beds)),
    "d18_patient_days_sample": over(lambda i: reports.patient_days_sample(i.stays)),
    "d19_patient_days_by_month": over(lambda i: reports.patient_days_by_month(i.stays)),
    "d20_occupancy_sample": over(lambda i: reports.occupancy_sample(i.occupancy)),
    "d21_occupancy_by_unit_type": over(lambda i: reports.occupancy_by_unit_type(i.occupancy)),
    "d22_highest_now": over(lambda i: reports.highest_now(i.occupancy)),
    "d23_dashboard_kpis": over(lambda i: reports.lights_now(i.occupancy)),
    "d23_light_bands": over(lambda i: reports.light_bands(i.occupancy)),
    "d23_ranking_board": over(lambda i: reports.ranking_board(i.occupancy)),
    "d23_trend": over(lambda i: reports.trend_feed(i.occupancy)),
    "d24_dim_cid": over(lambda i: i.diseases),
    "d25_clinical_profile": over(lambda i: clinical.clinical_profile(i.admissions, i.diseases)),
    "d27_gap": over(lambda i: situation.registry_gap(i.beds, i.stays)),
    "d27_without_movement": over(lambda i: situation.without_movement(i.beds, i.stays)),
    "d27_idle_capacity": over(lambda i: situation.idle_capacity(i.occupancy)),
    "d27_seasonality": over(lambda i: situation.seasonality(i.occupancy)),
    "d27_direction": over(lambda i: situation.direction(i.occupancy)),
    "d27_above_85": over(lambda i: situation.above_limit(i.occupancy)),
    "j5_padded_registry_key": over(_padded_registry),
}
