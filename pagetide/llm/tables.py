"""Reading documents and keeping intermediate tables, shared by the operators of this package."""

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import functions as F

import pagetide
from pagetide.session import scratch_folder

_shipped = set()

# Rows that a Python worker gets at once. Texts may be long, and Spark's own 10,000 are many.
MOST_ROWS = 2_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark):
    """Hand this package to the Python workers, once per application, as `--py-files` would.

    Batches for the workers are kept small as well, so that their memory does not grow with texts.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= MOST_ROWS:
        spark.conf.set(_BATCH, str(MOST_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(pagetide.__file__).parent
    if top.is_dir():
        path = Path(tempfile.mkdtemp(prefix="pagetide-")) / "pagetide.zip"
        with zipfile.ZipFile(path, "w") as package:
            for file in sorted(top.rglob("*.py")):
                package.write(file, file.relative_to(top.parent))
        context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def texts(docs):
    """`doc_id` and `text` alone; a null text is empty. Other columns, whatever their names, go."""
    ship(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def stored(rows, label):
    """The rows written to the shared scratch folder and read back.

    This cuts the lineage: an executor lost later costs one read, not the work before.
    """
    spark = rows.sparkSession
    path = scratch_folder(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
