"""Gridded climate-risk and exposure analytics on Spark: long cell tables in, DataFrames out."""

from __future__ import annotations


def ship(spark) -> None:
    """Make the package importable in Python workers that don't have it installed: once per Spark context, by addPyFile."""
    import os
    import shutil
    import tempfile

    sc = spark.sparkContext
    if getattr(sc, "_gridrisk_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="gridrisk-"), "gridrisk"), "zip", root_dir=root, base_dir="gridrisk")
    sc.addPyFile(made)
    sc._gridrisk_shipped = True
