"""Print the physical plans of the headline queries over a partitioned session table.

usage: python scripts/show_plans.py [sf_dir] [--full]
Without --full only the operator tree and the scan details (PartitionFilters,
PushedFilters, ReadSchema) are printed.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortex.catalog.setup import FIXTURE  # noqa: E402
from cohortex.context import local_session, scratch_path  # noqa: E402
from cohortex.plans.datasets import scoring_dataset, shared_feature_table, training_dataset  # noqa: E402
from cohortex.sources.fixtures import sessions_from_events  # noqa: E402
from cohortex.sources.sessions import read_sessions  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    full = "--full" in sys.argv
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session(4)
    spark.sparkContext.setLogLevel("ERROR")
    table = scratch_path(spark, "plans")
    sessions_from_events(spark, sf_dir).write.partitionBy("suffix").parquet(table)
    sessions = read_sessions(spark, table)
    for name, df in (
        ("training_dataset (fused)", training_dataset(sessions, FIXTURE, "fused")),
        ("training_dataset (literal)", training_dataset(sessions, FIXTURE, "literal")),
        ("scoring_dataset (fused)", scoring_dataset(sessions, FIXTURE)),
        ("shared training + scoring aggregate", shared_feature_table(sessions, FIXTURE)),
    ):
        text = formatted(df)
        print(f"===== {name}")
        if full:
            print(text)
            continue
        print(text.split("\n\n(")[0])
        for line in re.findall(r"^(?:PartitionFilters|PushedFilters|ReadSchema): .*$", text, re.M):
            print("   ", line[:240] + (" ..." if len(line) > 240 else ""))
    spark.stop()


if __name__ == "__main__":
    main()
