"""What a session needs before Python functions of this subpackage run on its executors."""

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Rows of an Arrow batch: documents may be long, and a task holds a batch as a whole.
BATCH_ROWS = 1000

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Send the package to the executors, once an application, and keep Arrow batches small.

    Sessions started with `--py-files` have it already; a second copy does no harm.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="tierline-code-")
        archive = shutil.make_archive(
            f"{folder}/{package.name}", "zip", root_dir=package.parent, base_dir=package.name
        )
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark
