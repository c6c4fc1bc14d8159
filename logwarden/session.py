"""Session construction and the shared working folder.

Library code never invents machine-local folders: anything it writes that is
not an explicit user path goes below ``spark.checkpoint.dir`` (the shared
folder a cluster names). Only when that setting is absent, as in local tests,
is a private folder created and registered.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "logwarden", extra: dict | None = None) -> SparkSession:
    """Session with the settings the library relies on.

    On a cluster pass ``master=None`` and let the launcher decide; partitions
    default to AQE coalescing from a generous starting count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Coalesce shuffle partitions to the advisory size (64 MB), not to the
        # largest task count: fewer, fuller tasks on a shared cluster.
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Streaming state for many (window, service) keys lives in RocksDB, not
        # on the JVM heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # Commit state as a changelog per batch instead of a full snapshot.
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Zone-less log timestamps are read in the session zone; pin it to UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


_PRIVATE_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local-mode session without that setting (tests) gets a private
    folder; on a cluster the setting is required, because a machine-local
    folder is not visible to other executors and is lost with its host.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context; the setting is required
        sc = None
    if sc is None:
        if not d:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return d
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        if sc.applicationId not in _PRIVATE_DIRS:
            _PRIVATE_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="logwarden-ckpt-")
        d = _PRIVATE_DIRS[sc.applicationId]
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


_SCRATCH: dict[str, list[str]] = {}


def _session_key(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", "") or "session"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name below the shared folder; ``clear_scratch``
    removes what a session has made."""
    base = shared_dir(spark).rstrip("/")
    path = f"{base}/logwarden/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(_session_key(spark), []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete every scratch folder this session has made; returns their number.
    Frames that still read from them must not be used afterwards."""
    paths = _SCRATCH.pop(_session_key(spark), [])
    for p in paths:
        delete_path(spark, p)
    return len(paths)


def _file_system(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through Hadoop's file system (any scheme). Only "not
    found" is False: a storage, permission or class-path error is raised."""
    fs, jpath = _file_system(spark, path)
    return bool(fs.exists(jpath))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's entries, sorted; none for a missing folder."""
    fs, jpath = _file_system(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(e.getPath().getName() for e in fs.listStatus(jpath))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it is there."""
    fs, jpath = _file_system(spark, path)
    fs.delete(jpath, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: under a hidden name first, then renamed, so
    that no reader sees a part of it. An earlier file of the name is replaced."""
    fs, jpath = _file_system(spark, path)
    _, jpart = _file_system(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = fs.create(jpart, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(jpart, jpath):
        fs.delete(jpath, False)
        if not fs.rename(jpart, jpath):
            raise OSError(f"cannot write {path}")


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder (nothing to do for a missing one)."""
    fs, jsource = _file_system(spark, source)
    if fs.exists(jsource):
        _, jtarget = _file_system(spark, target)
        fs.mkdirs(jtarget.getParent())
        if not fs.rename(jsource, jtarget):
            raise OSError(f"cannot move {source} to {target}")


# ------------------------------------------------------------ versions -----
# A versioned folder holds ``v-<number>-<id>`` folders. A version counts once
# its ``meta`` part is complete (Spark's _SUCCESS file is created last), and
# the newest complete version is the current one: nothing is overwritten, so a
# reader always finds a whole version.

def versions(spark: SparkSession, base: str) -> list[str]:
    """Version folders, oldest first (complete or not)."""
    return [n for n in child_names(spark, base) if re.match(r"v-\d+-", n)]


def new_version(spark: SparkSession, base: str) -> str:
    """Name for the next version of ``base``."""
    last = max((int(n.split("-")[1]) for n in versions(spark, base)), default=0)
    return f"v-{last + 1:09d}-{uuid.uuid4().hex[:8]}"


def publish_version(spark: SparkSession, base: str, version: str, meta: dict) -> None:
    """Make a written version current."""
    row = json.dumps(dict(meta, version=version))
    spark.createDataFrame([(row,)], "meta string").coalesce(1).write.text(f"{base}/{version}/meta")


def current_version(spark: SparkSession, base: str) -> dict | None:
    """Meta of the newest complete version (None without one)."""
    for name in reversed(versions(spark, base)):
        if path_exists(spark, f"{base}/{name}/meta/_SUCCESS"):
            return json.loads(spark.read.text(f"{base}/{name}/meta").first()[0])
    return None
