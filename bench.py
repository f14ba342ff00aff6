"""Times the headline queries: one JSON line on standard output. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

import json
import os
import sys
import time

HEADLINE = ["anonymize_documents", "d1_email_phone_documents", "d1c_company_documents", "a1_build_mapping", "a4_replace_values", "g7_duplicates", "x8_x9_hashes", "v1_leaks_in_originals", "d11_filename_patterns", "g1_files_by_type", "x1_parse_projects"]


def main() -> None:
    here = os.path.dirname(os.path.abspath(__file__))
    sys.path.insert(0, here)
    os.environ["PYTHONPATH"] = os.pathsep.join([here, os.environ.get("PYTHONPATH", "")])
    from pyspark.sql import SparkSession

    from umbra.plans import catalogue

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        began = time.time()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
