"""Sending the package to a session's Python workers."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Adds this package to the session's Python path once, wherever its executors run."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="cartulary-package-")) / "cartulary.zip"
    with zipfile.ZipFile(target, "w") as out:
        for p in sorted(here.rglob("*.py")):
            out.write(p, p.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(target))
    _sent.add(app)


def shipped(function: Callable) -> Callable:
    """A query or stage (spark first) that sends the package before it runs."""

    @functools.wraps(function)
    def run(spark, *args):
        ship_package(spark)
        return function(spark, *args)

    return run
