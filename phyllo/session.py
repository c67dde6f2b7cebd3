"""Session helpers: a tuned local session, table loading, and lineage cuts that survive lost executors."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def get_session(name: str = "phyllo", cpus: str | None = None) -> SparkSession:
    """A local session for tests and bench; on a cluster the submitted session is used as it is."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", os.environ.get("PHYLLO_SHUFFLE", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", os.environ.get("PHYLLO_SHARED") or _own_folder())
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a context: they may have neither its path nor its disk."""
    context = spark.sparkContext
    if getattr(context, "_phyllo_shipped", False):
        return
    root = Path(__file__).resolve().parent
    into = Path(tempfile.mkdtemp(prefix="phyllo-")) / "phyllo.zip"
    with zipfile.ZipFile(into, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path("phyllo") / p.relative_to(root))
    context.addPyFile(str(into))
    context._phyllo_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _own_folder() -> str:
    """A folder of this machine, for local sessions only."""
    return "file://" + os.path.join(tempfile.gettempdir(), "phyllo-shared")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Where that is unset, a local session takes a folder of its machine, and any other raises: executors on several
    machines would each write to their own disk, and what the driver reads back would lack their parts.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        found = _own_folder()
    if found.startswith("file://"):
        os.makedirs(found[7:], exist_ok=True)
    return found.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, what: str = "step") -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends at files that no lost executor takes away."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/phyllo/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    back = spark.read.schema(df.schema).parquet(path)
    back._phyllo_path = path
    return back


def keep_until_exit(spark: SparkSession, path: str) -> None:
    """Have a folder of intermediate files deleted when the driver ends."""
    _written.append((spark, path))


def release(df: DataFrame) -> None:
    """Delete the files of a table that materialize returned; df may not be read afterwards."""
    path = getattr(df, "_phyllo_path", None)
    if path:
        _delete(df.sparkSession, path)
        _written[:] = [x for x in _written if x[1] != path]


@contextmanager
def scratch() -> Iterator[None]:
    """Delete at the end of the block what materialize wrote within it; results must be written or collected by then."""
    before = {path for _, path in _written}
    try:
        yield
    finally:
        for spark, path in [x for x in _written if x[1] not in before]:
            _delete(spark, path)
            _written.remove((spark, path))


@atexit.register
def _cleanup() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the session has ended; the cluster's own retention takes the rest
            return
