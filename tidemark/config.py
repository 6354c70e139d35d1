"""Session set-up, tunable thresholds and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Thresholds:
    """Banding limits. Defaults are the published values of the catalogue; callers scale them to their money range."""

    customer: tuple[int, int, int] = (5000, 2000, 500)
    product: tuple[int, int, int] = (10000, 5000, 1000)
    order: tuple[int, int] = (2000, 500)
    engagement_days: tuple[int, int, int] = (30, 90, 180)
    cohort_min_size: int = 5
    portfolio_margin: int = 30
    portfolio_revenue: int = 1000


# Limits used with the generated test tables, whose money range is about a thousand times larger.
TEST_THRESHOLDS = Thresholds(
    customer=(4_000_000, 3_000_000, 1_500_000),
    product=(2_000_000, 1_700_000, 1_300_000),
    order=(375_000, 125_000),
)
ORDERS_AS_OF = datetime(2001, 8, 2)
EVENTS_AS_OF = datetime(2024, 1, 31)


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the checkpoint location every executor can reach.

    Only a single-machine session may go without ``spark.checkpoint.dir``; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tidemark-")
    path = f"{root.rstrip('/')}/tidemark/{purpose}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


_MADE: list[str] = []


def remove_scratch(spark: SparkSession) -> int:
    """Delete every folder ``shared_dir`` has handed out in this process. Call it when no frame that reads one is needed
    any more; returns how many there were."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _MADE:
        path = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For frames that several branches of one query read: the costly upstream runs once, later branches read only the
    columns they need, and a lost executor re-reads files instead of recomputing the lineage.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
