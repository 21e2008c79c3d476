"""The folder all executors can reach, for intermediate tables and checkpoints."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Folders that every machine has for itself, whatever its settings.
OWN_FOLDERS = ("/tmp", "/var/tmp", "/dev/shm", "/run")
_run: contextvars.ContextVar[str | None] = contextvars.ContextVar("run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may do without the setting;
    it then gets a new temporary folder. A cluster session without it is an error, because a
    machine-local folder would not be seen by the other machines; so is one that names the
    machine's temporary folder, or another that machines do not share. A mounted folder that all machines share may be named as a path.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    local = context.master.startswith("local")
    if named:
        path = f"/{named.removeprefix('file:').strip('/')}/"
        if not local and path.startswith(tuple(f"{own}/" for own in (tempfile.gettempdir(), *OWN_FOLDERS))):
            raise RuntimeError(f"spark.checkpoint.dir names {named}, which each machine has for itself")
        return named.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ratelens-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses. Nothing is created yet."""
    return f"{_run.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def intermediate_tables(spark: SparkSession) -> Iterator[str]:
    """All tables that are stored inside the block go when it ends, also when it fails.

    Results must be written, or fetched, before that, as they read those tables. Outside of any
    block stored tables stay until the caller deletes them.
    """
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back, for results used more than once."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
