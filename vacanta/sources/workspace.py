"""Where jobs put tables that must outlive one executor."""

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_folders: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """Shared folder of this application.

    Uses ``spark.checkpoint.dir``. Only a local-mode session that leaves it
    unset (tests) gets a temporary folder, because on a cluster the executors
    would not see it.
    """
    application = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/vacanta/{application}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="vacanta-")
    return _local_folders[application]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nothing has been written to yet."""
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
