"""Ship this package to the Python workers of a session, so that operators need no installation on executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
#: Columnar files are smaller than what they hold in memory; the planner's choice of broadcasts should know.
FACTOR = "spark.sql.sources.fileCompressionFactor"


def ship(spark: SparkSession) -> None:
    """Add the package's files to the session once; the driver serves them to executors, also to late ones."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    if float(spark.conf.get(FACTOR, "1.0")) == 1.0:
        spark.conf.set(FACTOR, "4.0")
    root = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="corvane-ship-")) / "corvane_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path("corvane") / p.relative_to(root))
    spark.sparkContext.addPyFile(str(target))
