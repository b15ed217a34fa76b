"""This package for executors: their Python workers import the functions that run on them."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame

_shipped: set[str] = set()


def with_package(df: DataFrame) -> DataFrame:
    """``df``, after this package was sent to its application's executors once.

    Functions are pickled by reference, so that workers keep their tables from
    task to task; an executor therefore needs the modules, installed or not.
    """
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="talus-package-")) / "talus.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return df
