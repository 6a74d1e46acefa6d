"""Session settings and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from tallybook.sources import folders


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the library relies on; timestamps mean UTC everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Row checks make large generated methods; HotSpot does not compile any above 8000
    # bytes, so Spark should fall back to smaller pieces there.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, as ``spark.checkpoint.dir`` names it.

    A local session that names none gets a folder of its own. On a cluster that would be
    a different disk on each machine, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-tallybook-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _own_scratch(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tallybook/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nobody has used yet."""
    return f"{_own_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's staged tables; frames that read them end here."""
    folders.remove(spark, _own_scratch(spark))


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application, for the steps that run in Python."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="run-tallybook-"), "tallybook_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
