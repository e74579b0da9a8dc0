"""Running functions of this library inside Python workers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import gradus

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the library importable for the application's workers, wherever the driver found it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(gradus.__file__).parent
    folder = tempfile.mkdtemp()  # on the driver, for as long as Spark serves it to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "gradus.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
