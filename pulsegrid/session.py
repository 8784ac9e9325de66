"""Session settings the plans rely on."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "pulsegrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution, and the package on its executors; conf overrides and adds."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    spark = builder.config(map=DEFAULTS | conf).getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application, so nothing needs to be installed there."""
    context = spark.sparkContext
    if not getattr(context, "_pulsegrid_shipped", False):
        root = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/pulsegrid", "zip", root.parent, root.name)
        context.addPyFile(archive)
        context._pulsegrid_shipped = True


def scratch(spark: SparkSession) -> str:
    """A new folder name in the folder that spark.checkpoint.dir names; in a folder of this machine where none is named and
    this machine is the only one."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not context._jsc.sc().isLocal():
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="pulsegrid-"))
    return f"{context._jsc.sc().getCheckpointDir().get()}/{uuid4().hex}"
