"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables (default sf0.1), BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wardlens.catalog import CATALOG  # noqa: E402
from wardlens.session import build_session  # noqa: E402

HEADLINE = [
    "d1_slv_internacao",
    "d3_slv_sih_diasperm",
    "d4_slv_ocupacao",
    "d5_gld_ocupacao_mensal",
    "d6_gld_features_hospital",
    "d7_admissions_by_month",
    "d8_reconciliation",
    "d9_lights_now",
    "d10_top_critical",
    "d11_features_sample",
    "d12_bronze_volume",
    "d15_admissions_by_complexity",
    "d17_beds_by_unit_type",
    "d19_patient_days_by_month",
    "d21_occupancy_by_unit_type",
    "d23_trend",
    "d25_clinical_profile",
    "d27_direction",
    "m5_zscores_by_size",
    "s3_read_glob",
    "s13_hospital_layout",
    "g1_incremental_ingest",
    "x21_answer_text",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        app="wardlens-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(CATALOG["d12_bronze_volume"], spark, sf_dir)  # start the JVM's pools and caches
    times = {key: round(run(CATALOG[key], spark, sf_dir), 3) for key in HEADLINE}
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
