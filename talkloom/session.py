"""Sessions for local use, and shipping of this package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def local_session(cpus: int = 8, **conf: str) -> SparkSession:
    """A session on this machine with the settings that results depend on."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("talkloom")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers; nothing to do where PYTHONPATH already names it."""
    paths = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    app = spark.sparkContext.applicationId
    if str(ROOT) in paths or app in _shipped:
        return
    target = os.path.join(tempfile.mkdtemp(prefix="talkloom-"), "talkloom.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted((ROOT / "talkloom").rglob("*.py")):
            z.write(f, f.relative_to(ROOT))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
