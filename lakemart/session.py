"""Session settings and the shared folder for derived tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime re-planning does the size checks: small sides become broadcast joins
# once their real size is known, skewed join partitions are split, small
# shuffle partitions are merged.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: str = "*", partitions: int = 8, app: str = "lakemart") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for derived tables: the one the cluster names in
    ``spark.checkpoint.dir``. A temporary folder is made only when the setting
    is absent and everything runs in one local process."""
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="lakemart-")
    return _local_folders[app]
