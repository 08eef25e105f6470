"""Session defaults for local runs, and tables written to cut a plan in two."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []
_shipped: set[str] = set()


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidepanel")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def is_one_machine(spark: SparkSession) -> bool:
    """True for ``local`` and ``local[...]``, not for ``local-cluster[...]``."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def prepare(spark: SparkSession) -> None:
    """What entry points do for a session before they use the library.

    A one-machine session without a checkpoint folder gets one, deleted when Python ends; on a
    cluster the folder has to be configured. The package is sent to the workers, which needn't
    have it on their path.
    """
    if not configured_folder(spark) and is_one_machine(spark):
        folder = tempfile.mkdtemp(prefix="tidepanel-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    ship(spark)


def ship(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per application."""
    if spark.sparkContext.applicationId in _shipped:
        return
    _shipped.add(spark.sparkContext.applicationId)
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tidepanel-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/tidepanel-source.zip", "w") as z:
        for top, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    z.write(f"{top}/{name}", os.path.relpath(f"{top}/{name}", os.path.dirname(package)))
    spark.sparkContext.addPyFile(f"{folder}/tidepanel-source.zip")


def configured_folder(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir``, or the folder set with ``SparkContext.setCheckpointDir``."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can read; there is no fallback to a folder of one machine."""
    folder = configured_folder(spark)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted by :func:`release_tables`."""
    if not _written:
        atexit.register(_release_all)
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def write_table(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on what produced it: a lost executor costs a re-read, and
    two uses of the table see the same rows. Being Parquet it is still pruned by column.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_tables(spark: SparkSession) -> int:
    """Delete what this session wrote with :func:`write_table`; also done when Python ends."""
    mine = [path for owner, path in _written if owner is spark]
    _written[:] = [(owner, path) for owner, path in _written if owner is not spark]
    jvm, conf, count = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    for path in mine:
        path = jvm.org.apache.hadoop.fs.Path(path)
        count += bool(path.getFileSystem(conf).delete(path, True))
    return count


def _release_all() -> None:
    for spark in {id(owner): owner for owner, _ in _written}.values():
        try:
            release_tables(spark)
        except Exception:  # noqa: BLE001  the session has ended; its folder is the cluster's to clean
            pass
