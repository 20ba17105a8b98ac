"""Session helpers: building a session for tests and benches, and the shared scratch area.

On a cluster the scratch area is the folder named by ``spark.checkpoint.dir`` (a shared
file system). Only when that setting is absent (a bare local session) is a fresh
directory under the system temp folder created and registered, as tests need.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "keelson", memory: str = "8g") -> SparkSession:
    """A local session with the settings the library is tuned for (tests and benches)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Only a local session may be without one: it gets a folder of its own. On a cluster a
    missing setting is an error, since each executor would write to its own disk.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no context object
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc is not None and not configured:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="keelson-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def session_key(spark: SparkSession) -> str:
    """Identifies a running session (for per-session caches)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return f"session-{id(spark)}"


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system (of the JVM, so any store that Spark can read)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


_SCRATCH: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The session's own folder below the checkpoint root; removed when the session's JVM
    ends."""
    key = session_key(spark)
    if key not in _SCRATCH:
        root = f"{checkpoint_root(spark).rstrip('/')}/keelson-{uuid.uuid4().hex[:12]}"
        try:
            path, fs = hadoop_path(spark, root)
            fs.mkdirs(path)
            fs.deleteOnExit(path)
        except AttributeError:  # a remote session: its server owns the folder
            pass
        _SCRATCH[key] = root
    return _SCRATCH[key]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique path in the session's scratch folder for a table written by a job."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Session settings: shuffle files go when their query ends; partitions that a task may write at
#: once (beyond none, it sorts its rows by partition first).
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WRITERS_CONF = "spark.sql.maxConcurrentOutputFileWriters"
_SET: dict[tuple[int, str], list] = {}
_SET_LOCK = threading.Lock()


@contextmanager
def session_conf(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Set ``name`` in the session for a while; the first that enters sets it, the last that
    leaves puts back what was there (threads share a session)."""
    key = (id(spark), name)
    with _SET_LOCK:
        entry = _SET.setdefault(key, [0, spark.conf.get(name, None)])
        entry[0] += 1
        spark.conf.set(name, value)
    try:
        yield
    finally:
        with _SET_LOCK:
            entry[0] -= 1
            if not entry[0]:
                del _SET[key]
                if entry[1] is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, entry[1])


def freed_shuffles(spark: SparkSession):
    """Within it, the shuffle files of a query are deleted when it has ended. Otherwise they
    stay until the driver's garbage collector finds that nothing refers to them, so that those
    of all steps of a job lie on the disks at the same time."""
    return session_conf(spark, SHUFFLE_CLEANUP_CONF, "true")


def input_stamp(spark: SparkSession, paths: Iterable[str]) -> str:
    """Changes when a file below one of ``paths`` does: a digest of names, sizes and times.

    A file is asked for its status; the files of all folders are listed and digested by one
    Spark job, however many there are."""
    seen, folders = [], []
    for name in paths:
        path, fs = hadoop_path(spark, name)
        if not fs.exists(path):
            seen.append((name, "absent"))
            continue
        status = fs.getFileStatus(path)
        if status.isFile():
            seen.append((name, status.getLen(), status.getModificationTime()))
        else:
            folders.append(name)
    if folders:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .load(folders).select("path", "length", "modificationTime"))
        mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        seen.append((*folders, *files.agg(F.count("*"), F.sum(mark)).first()))
    return hashlib.sha256(repr(sorted(map(str, seen))).encode()).hexdigest()
