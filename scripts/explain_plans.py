"""Write PLANS.md: the final (adaptive) physical plans of the headline queries.

Each query is executed (collected) first so the plan shows AQE's runtime
choices: join strategies, coalesced shuffles, skew handling.

    python scripts/explain_plans.py [SF_DIR] > PLANS.md
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NAMES = (
    "validate_orders",
    "valid_orders",
    "dedup_orders",
    "duplicate_summary_before",
    "referentially_valid_orders",
    "product_metrics",
    "sales_summary",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from orderflow.plans.catalog import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8], AQE on, 8 shuffle partitions)\n")
    print("Generated by `scripts/explain_plans.py` after running each query, so the")
    print("adaptive plans are final. Long lines are cut at 200 characters.\n")
    for name in NAMES:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        print(f"## {name}\n\n```")
        for line in text.splitlines():
            print(line if len(line) <= 200 else line[:197] + "...")
        print("```\n")


if __name__ == "__main__":
    main()
