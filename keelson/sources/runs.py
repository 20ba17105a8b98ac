"""Published runs: a run writes a folder of its own, and a manifest that is written last
makes it the one that readers open.

``root/runs/<name>`` holds a run's tables and ``root/manifests/<number>.json`` says what they
are (their rows, where they came from). A manifest file is created exclusively under the next
number, so of two runs that end at the same time both are published, one after the other; a
manifest that was cut off by a crash does not parse and is passed over. A run that dies leaves
a folder that no manifest names: readers never see it, and the run before stays as it was. After
a publication the last ``keep`` runs stay; of the folders without a manifest those older than
``STALE_SECONDS`` go, so that a run still being written is left alone.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

from keelson.session import hadoop_path

KEEP_RUNS = 2
STALE_SECONDS = 7 * 86400


def new_run(root: str) -> str:
    """The folder that a new run writes to."""
    return f"{root.rstrip('/')}/runs/{uuid.uuid4().hex}"


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = hadoop_path(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


def _manifests(spark: SparkSession, root: str) -> list[tuple[int, dict]]:
    """(number, manifest) of the complete ones, in their order."""
    found = []
    for name in _names(spark, f"{root}/manifests"):
        path, fs = hadoop_path(spark, f"{root}/manifests/{name}")
        stream = fs.open(path)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            found.append((int(name.split(".")[0]), json.loads(text)))
        except ValueError:  # cut off, or not a manifest
            continue
        finally:
            stream.close()
    return found


def current_run(spark: SparkSession, root: str) -> dict | None:
    """The manifest published last, with its ``folder``; None where nothing is published."""
    found = _manifests(spark, root)
    if not found:
        return None
    manifest = found[-1][1]
    return {**manifest, "folder": f"{root.rstrip('/')}/runs/{manifest['run']}"}


def publish(spark: SparkSession, root: str, folder: str, manifest: dict,
            keep: int = KEEP_RUNS) -> int:
    """Make the finished run in ``folder`` the current one; returns its number."""
    text = json.dumps({**manifest, "run": folder.rsplit("/", 1)[1]})
    number = max([int(n.split(".")[0]) for n in _names(spark, f"{root}/manifests")
                  if n.split(".")[0].isdigit()], default=0)
    while True:
        number += 1
        path, fs = hadoop_path(spark, f"{root}/manifests/{number:012d}.json")
        try:
            stream = fs.create(path, False)
        except Exception:
            if fs.exists(path):  # another run was faster
                continue
            raise
        stream.write(text.encode())
        stream.close()
        break
    _clear(spark, root, keep)
    return number


def _clear(spark: SparkSession, root: str, keep: int) -> None:
    found = _manifests(spark, root)
    kept = {m["run"] for _, m in found[-keep:]}
    gone = {m["run"] for _, m in found[:-keep]} - kept
    for number, manifest in found[:-keep]:
        path, fs = hadoop_path(spark, f"{root}/manifests/{number:012d}.json")
        fs.delete(path, False)
    now = time.time()
    for name in _names(spark, f"{root}/runs"):
        path, fs = hadoop_path(spark, f"{root}/runs/{name}")
        age = now - fs.getFileStatus(path).getModificationTime() / 1000
        if name in gone or (name not in kept and age > STALE_SECONDS):
            fs.delete(path, True)
