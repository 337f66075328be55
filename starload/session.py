"""Session helpers: time zone, scratch locations that survive executor loss."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "starload") -> SparkSession:
    """Session used by tests and the bench. On a cluster the caller's own session is used instead."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_defaults(spark)
    return spark


def ensure_session_defaults(spark: SparkSession) -> None:
    """Naive timestamps are UTC in this data model; AQE re-plans joins and skew at runtime."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session leaves it unset (tests, local runs) is a private folder chosen and
    registered, so that lineage cuts and staged writes always land on storage every executor sees.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        conf_dir = conf_dir.get() if conf_dir.isDefined() else None
    if not conf_dir:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="starload-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", conf_dir)
        except Exception:  # noqa: BLE001 - some sessions refuse core settings at runtime
            pass
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one staged write."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct sub-folders of ``path`` (one listing call on the driver, no data)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory())


def list_files(spark: SparkSession, path: str, hidden: bool = False) -> list[str]:
    """Names of the files directly in ``path``, those that readers of tables skip only if asked for (one listing call, no data)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(hpath) if s.isFile())
    return sorted(n for n in names if not n.startswith("." if hidden else ("_", ".")))


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Creates the file, unless it is there: the file system decides between writers. Meant for small files."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hpath.getParent())
    if not text:
        try:
            return bool(fs.createNewFile(hpath))
        except Exception:  # noqa: BLE001 - file systems tell a lost race by different errors
            if fs.exists(hpath):
                return False
            raise
    out = fs.create(hpath, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text, read by the driver."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    source = fs.open(hpath)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hpath):
        fs.delete(hpath, True)


def rename_path(spark: SparkSession, src: str, dst: str) -> bool:
    jvm = spark.sparkContext._jvm
    spath = jvm.org.apache.hadoop.fs.Path(src)
    fs = spath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.rename(spath, jvm.org.apache.hadoop.fs.Path(dst)))


__all__ = [
    "build_session",
    "ensure_session_defaults",
    "shared_dir",
    "scratch_path",
    "path_exists",
    "list_dirs",
    "list_files",
    "create_new",
    "read_text",
    "delete_path",
    "rename_path",
]

