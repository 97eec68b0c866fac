"""python -m loomline.cli run --config FILE --stage NAME"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from loomline import config
from loomline.plans.stages import GROUPS, STAGES, Options, run_stage


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="loomline")
    run = top.add_subparsers(dest="command", required=True).add_parser("run")
    run.add_argument("--config", required=True)
    run.add_argument("--stage", required=True, help=f"of {', '.join([*GROUPS, *STAGES])}; several split by commas")
    run.add_argument("--limit", type=int)
    run.add_argument("--shard-id", type=int, default=0)
    run.add_argument("--num-shards", type=int, default=1)
    run.add_argument("--stub", action="store_true", help="expressions instead of a model")
    for flag in ("--dry-run", "--resume", "--overwrite"):
        run.add_argument(flag, action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    cfg = config.load(a.config)
    if a.dry_run:
        cfg = config.dry_run(cfg)
    spark = SparkSession.builder.appName("loomline").getOrCreate()
    print(run_stage(spark, cfg, a.stage, Options(a.limit, a.resume, a.overwrite, a.shard_id, a.num_shards, "stub" if a.stub else None)))


if __name__ == "__main__":
    main()
