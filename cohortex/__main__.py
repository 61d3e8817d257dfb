"""Command-line run: ``python -m cohortex --source_table ...`` or
``spark-submit --py-files cohortex.zip cohortex/__main__.py --source_table ...``.

Options have the names of :class:`cohortex.config.AudienceConfig` fields and take text
values; ``--rules_file`` points to a JSON campaign (see ``rules_from_json``).
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import fields, replace

from cohortex.config import AudienceConfig

_TEXT_FIELDS = [f.name for f in fields(AudienceConfig) if f.name not in ("rules", "conversion_rule")]


def parse(argv: list[str] | None = None) -> tuple[AudienceConfig, str | None]:
    parser = argparse.ArgumentParser(prog="cohortex", description="Train, score and export an audience.")
    for name in _TEXT_FIELDS:
        parser.add_argument(f"--{name}", default=None)
    parser.add_argument("--rules_file", default=None, help="JSON campaign: rules and conversion rule")
    args = vars(parser.parse_args(argv))
    rules_file = args.pop("rules_file")
    return AudienceConfig.from_options(args), rules_file


def main(argv: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession

    from cohortex.functions.rules import rules_from_json
    from cohortex.plans.run import run

    logging.basicConfig(level=logging.INFO)
    cfg, rules_file = parse(argv)
    spark = SparkSession.builder.appName(f"cohortex-{cfg.name}").getOrCreate()
    if rules_file:
        text = "\n".join(r.value for r in spark.read.text(rules_file).collect())  # a small config file
        rules, conversion = rules_from_json(text)
        cfg = replace(cfg, rules=rules or cfg.rules, conversion_rule=conversion or cfg.conversion_rule)
    if not cfg.destination_table:
        raise SystemExit("--destination_table is required")
    run(spark, cfg)


if __name__ == "__main__":
    main()
