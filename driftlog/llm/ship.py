"""Makes the library importable in Python workers."""

from __future__ import annotations

import io
import os
import zipfile

from pyarrow import fs
from pyspark.sql import SparkSession

import driftlog
from driftlog.llm.scratch import shared_folder


def shipped(spark: SparkSession) -> None:
    """Adds the package to the session's Python files, once a session.

    The functions that run in workers are found by import, and a cluster's
    workers need not have the library installed. The archive lies in the
    shared folder.
    """
    sc = spark.sparkContext
    if getattr(sc, "_driftlog_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(driftlog.__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    path = f"{shared_folder(spark, 'package')}/driftlog.zip"
    system, at = fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)
    system.create_dir(os.path.dirname(at), recursive=True)
    with system.open_output_stream(at) as out:
        out.write(packed.getvalue())
    sc.addPyFile(path)
    sc._driftlog_shipped = True
