"""Intermediate results written once and read many times.

A pinned result lies in the shared folder that the cluster names in
`spark.checkpoint.dir`, so a lost executor costs no recomputation of what led
to it, and its size is known before anything is joined to it.

Pins belong to the `with pins(spark):` block they were made in, else to their
session. They are deleted with their owner and with nothing else.
"""

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field
from typing import Any
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerline.functions.hadoop import delete

_block: ContextVar[str | None] = ContextVar("pins_block", default=None)
_sessions: WeakKeyDictionary[SparkSession, str] = WeakKeyDictionary()
_actions: dict[str, list[Callable[[], None]]] = {}


@dataclass(frozen=True)
class Pinned:
    """A stored result with its measured size, and the bounds of one column."""

    df: DataFrame
    rows: int
    bytes: int
    low: Any = None
    high: Any = None
    # What filters found out about the keys.
    ranges: dict[str, list] = field(default_factory=dict, compare=False)

    @property
    def small(self) -> bool:
        """Whether the whole result is within the session's broadcast limit."""
        return self.bytes <= broadcast_limit(self.df.sparkSession)

    @property
    def side(self) -> DataFrame:
        """The result as one side of a join, broadcast only when small."""
        return F.broadcast(self.df) if self.small else self.df


@contextmanager
def pins(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was pinned inside. Use the results inside."""
    name = uuid.uuid4().hex
    token = _block.set(name)
    try:
        yield
    finally:
        _block.reset(token)
        _end(spark, name)


def clear_pins(spark: SparkSession) -> None:
    """Delete what this session pinned outside of blocks, once it is used."""
    if spark in _sessions:
        _end(spark, _sessions.pop(spark))


def at_end(spark: SparkSession, action: Callable[[], None]) -> None:
    """Do `action` when what is pinned here is deleted."""
    _actions.setdefault(_owner(spark), []).append(action)


def _end(spark: SparkSession, owner: str) -> None:
    try:
        for action in _actions.pop(owner, []):
            action()
    finally:
        delete(spark, f"{_application_folder(spark)}/{owner}")


def _owner(spark: SparkSession) -> str:
    return _block.get() or _sessions.setdefault(spark, uuid.uuid4().hex)


def pin(df: DataFrame, bounds: str | None = None) -> Pinned:
    """Store `df` in the shared folder and measure it in the same job.

    With `bounds`, the smallest and largest value of that column are measured too.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    measures = [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes"),
    ]
    if bounds is not None:
        measures += [F.min(bounds).alias("low"), F.max(bounds).alias("high")]
    seen = Observation()
    df.observe(seen, *measures).write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    return Pinned(stored, **seen.get)


def new_folder(spark: SparkSession) -> str:
    """A path in the shared folder that is not used yet and goes with its owner's pins."""
    return f"{_application_folder(spark)}/{_owner(spark)}/{uuid.uuid4().hex}"


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes Spark may broadcast in this session; negative means none."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-z]*)\s*", text.lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit[0] if unit.rstrip("b") else " ")


def fits_broadcast(df: DataFrame, rows: int) -> bool:
    """Whether `rows` rows of `df`, which has no strings, may be broadcast."""
    if any(isinstance(field.dataType, StringType) for field in df.schema):
        raise ValueError("strings have no fixed width")
    return rows * _fixed_bytes(df) <= broadcast_limit(df.sparkSession)


def _fixed_bytes(df: DataFrame) -> int:
    # A null mask and 8 bytes per column; 24 covers a decimal that is kept apart.
    return 8 + sum(
        24 if field.dataType.typeName() == "decimal" else 8 for field in df.schema
    )


def _row_bytes(df: DataFrame):
    width = F.lit(_fixed_bytes(df)).cast("long")
    for field in df.schema:
        if isinstance(field.dataType, StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return width


def _application_folder(spark: SparkSession) -> str:
    return f"{_shared_folder(spark)}/ledgerline/{spark.sparkContext.applicationId}"


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        # The warehouse is the other folder that all executors of a cluster reach.
        folder = spark.conf.get("spark.sql.warehouse.dir")
        if folder.startswith(("file:", "/")) and not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return folder.rstrip("/")
