"""Tables between the steps of an iteration, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import logging
import shutil
import tempfile
import uuid

from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; our own temporary folder on a single machine where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="markscribe-"))
        atexit.register(shutil.rmtree, _OWN[0], True)
    return _OWN[0]


def remove(path: str) -> None:
    """Delete a folder that no later step reads; where that fails it stays, and the log says so."""
    try:
        files, at = FileSystem.from_uri(path)
        files.delete_dir(at)
    except FileNotFoundError:
        pass
    except Exception:
        logging.getLogger("markscribe").warning("left behind: %s", path, exc_info=True)


class Scratch:
    """Written tables: lineage is cut, and a lost executor costs nothing that was written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.top, self.paths = spark, f"{shared_folder(spark)}/markscribe-{uuid.uuid4().hex}", {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read back; an earlier table of that name is deleted afterwards."""
        path, old = f"{self.top}/{name}-{uuid.uuid4().hex}", self.paths.get(name)
        df.write.parquet(path)
        self.paths[name] = path
        if old:
            remove(old)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, *names: str) -> None:
        """Delete all tables but these; those go when the driver exits."""
        for name in [n for n in self.paths if n not in names]:
            remove(self.paths.pop(name))
        atexit.register(remove, self.top)
