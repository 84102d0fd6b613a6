"""This package for the Python workers of executors that have no installation of it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import millrace


def send_package(spark: SparkSession) -> None:
    """Hands the package to Spark, once per Spark context, which brings it to every executor."""
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(millrace.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.join("millrace", os.path.relpath(path, top)))
    context.addPyFile(target)
    context._millrace_shipped = True
