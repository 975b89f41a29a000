"""Config files, sessions and logs of the jobs' command lines."""

from __future__ import annotations

import argparse
import logging
import tomllib
from collections.abc import Callable
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

log = logging.getLogger("jobs")


def load(path: str, needed: tuple[str, ...], known: tuple[str, ...]) -> dict[str, Any]:
    """The settings of a TOML file. ValueError where one is missing or unknown."""
    found = tomllib.loads(Path(path).read_text())
    if missing := [k for k in needed if not found.get(k)]:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    if unknown := sorted(set(found) - set(needed) - set(known)):
        raise ValueError(f"{path} has unknown settings: {', '.join(unknown)}")
    return found


def main(name: str, run: Callable[..., dict[str, int]], needed: tuple[str, ...], known: tuple[str, ...], argv: list[str] | None = None) -> int:
    """Run a job as its config file says, on the session that spark-submit or the environment sets up."""
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{name}", description=run.__doc__)
    parser.add_argument("--config", default=str(Path(__file__).with_name(f"{name}.toml")))
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    settings = load(args.config, needed, known)
    spark = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        from talkloom.session import ship

        ship(spark)
        run(spark, **settings)
        return 0
    finally:
        spark.stop()
