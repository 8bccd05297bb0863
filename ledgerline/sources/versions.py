"""A Parquet table kept as numbered versions, so that it can be rewritten.

Spark cannot overwrite files that the same query reads. Each write goes to a
folder of its own, and counts from the moment its own commit marker is there, so
readers see either the old version or the whole new one. A writer says which
version it started from and claims the next number for itself; another that
started from the same version, or an older one, is refused.

A version is a list of parts, each a folder of rows within a range of the key. An
update writes the parts that it changes, and names the others where they are.
"""

import json
import re
import time
import uuid
from collections.abc import Callable
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.filters import key_ranges
from ledgerline.functions.hadoop import claim, create_new, delete, list_names, list_times, read_text, write_text
from ledgerline.functions.pinning import Pinned, at_end
from ledgerline.sources.tables import conform

_NAME = re.compile(r"version-(\d+)\.(claimed|committed|lease)(?:\..*)?")
_RANGE = "__range"
_DAY = 86_400


class StaleVersionError(RuntimeError):
    """Another writer has made, or is making, the version to be written."""


class _Part(NamedTuple):
    """A folder below the root, and the bounds of its keys (none: they are all null)."""

    folder: str
    low: Any
    high: Any


class VersionedTable:
    """Versions of one table below the folder `root`, cut by ranges of `key`.

    `parts` is how many ranges a whole write makes; about a gigabyte each is a good size.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: StructType, key: str = "batch_id", parts: int = 16
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.key = key
        self.parts = parts

    def versions(self) -> list[int]:
        """Numbers of the complete versions, oldest first."""
        return sorted(self._marked("committed"))

    def newest(self) -> int | None:
        return max(self._marked("committed"), default=None)

    def read(self, version: int | None = None) -> DataFrame:
        """A version, checked against the schema; the newest complete one by default.

        It is leased, and does not expire, until the `pins` block ends in which it is
        read; outside of one, until the session's pins are cleared.
        """
        number = version if version is not None else self.newest()
        if number is not None:
            lease = f"{self._path(number)}.lease.{uuid.uuid4().hex}"
            create_new(self.spark, lease)
            at_end(self.spark, lambda: delete(self.spark, lease))
        # The lease is there first: what is complete now, stays.
        if number not in self._marked("committed"):
            raise LookupError(f"{self.root} has no such version: {number}")
        return self._rows(self._parts(number))

    def write(self, df: DataFrame, base: int | None) -> int:
        """Store `df`, made from version `base`, as the next one; return its number.

        `base` is None for the first version. Raises StaleVersionError, without
        running `df`, when there is a newer version than `base` or another writer is
        making one. A write that fails gives its number back; that of a writer which
        died is free after `release`.
        """
        return self._store(df, base, [], self.parts)

    def update(self, base: int, changed: Pinned, change: Callable[[DataFrame], DataFrame]) -> int:
        """Store version `base` with `change` made to it as the next one, like `write`.

        `changed` has the keys of all rows that `change` makes a difference to, pinned
        with their bounds; rows must keep their keys. Parts in whose range none of them
        can lie are taken over as they are.
        """
        ranges = key_ranges(changed, self.key)
        touched, others = [], []
        for part in self._parts(base):
            near = part.low is not None and any(a <= part.high and part.low <= b for a, b in ranges)
            (touched if near else others).append(part)
        return self._store(change(self._rows(touched)), base, others, len(touched))

    def _store(self, df: DataFrame, base: int | None, kept: list[_Part], parts: int) -> int:
        table = df.select(self.schema.names)
        for field, declared in zip(table.schema, self.schema, strict=True):
            if field.dataType != declared.dataType:
                raise ValueError(f"column {field.name} is not the declared type")
        self._require_newest(base)
        number = (base or 0) + 1
        if not claim(self.spark, self._marker(number, "claimed")):
            raise StaleVersionError(f"{self.root}: version {number} is being written")
        try:
            made = self._written(table, number, parts) if parts else []
            text = json.dumps([p._asdict() for p in [*kept, *made]])
            write_text(self.spark, self._marker(number, "parts"), text)
            # The number may have been written, and have expired, in between.
            self._require_newest(base)
            if not create_new(self.spark, self._marker(number, "committed")):
                raise StaleVersionError(f"{self.root} has version {number} already")
        except StaleVersionError:
            raise
        except BaseException:
            self.release(number)
            raise
        return number

    def _written(self, table: DataFrame, number: int, parts: int) -> list[_Part]:
        # Rows of one key, or without any, may fill more than one part.
        order = [F.col(self.key), F.xxhash64(*table.columns)]
        ranged = table.repartitionByRange(parts, *order).withColumn(_RANGE, F.spark_partition_id())
        path = self._path(number)
        ranged.write.mode("overwrite").partitionBy(_RANGE).parquet(path)
        if not any(name.startswith(_RANGE) for name in list_names(self.spark, path)):
            return []
        stored = self.spark.read.parquet(path).groupBy(_RANGE)
        found = stored.agg(F.min(self.key).alias("low"), F.max(self.key).alias("high")).collect()
        folder = path.removeprefix(f"{self.root}/")
        ends = ((r[_RANGE], *(None if r[x] is None else int(r[x]) for x in ("low", "high"))) for r in found)
        return [_Part(f"{folder}/{_RANGE}={i}", low, high) for i, low, high in sorted(ends)]

    def release(self, number: int) -> None:
        """Give up a version that was claimed and not committed."""
        if number in self._marked("committed"):
            raise ValueError(f"version {number} is complete")
        delete(self.spark, self._path(number))
        delete(self.spark, self._marker(number, "parts"))
        self._delete_marks(number, "claimed")

    def expire(self, keep: int, lease_seconds: float = 7 * _DAY) -> list[int]:
        """Delete all but the newest `keep` versions; return the numbers deleted.

        Versions that are being read stay, and so do parts that a version which stays
        takes over. Leases older than `lease_seconds` are of readers that died.
        """
        if keep < 1:
            raise ValueError("the newest version cannot expire")
        gone = []
        for number in self.versions()[:-keep]:
            if self._leased(number, lease_seconds):
                continue
            # First what makes it visible. A reader leases before it looks for that.
            delete(self.spark, self._marker(number, "committed"))
            if self._leased(number, lease_seconds):
                create_new(self.spark, self._marker(number, "committed"))
                continue
            gone.append(number)
        staying = {part.folder for number in self.versions() for part in self._parts(number)}
        for number in gone:
            for part in self._parts(number):
                if part.folder not in staying:
                    delete(self.spark, f"{self.root}/{part.folder}")
            if not any(f.startswith(self._path(number).removeprefix(f"{self.root}/") + "/") for f in staying):
                delete(self.spark, self._path(number))
            delete(self.spark, self._marker(number, "parts"))
            self._delete_marks(number, "lease")
            # The claim goes last.
            self._delete_marks(number, "claimed")
        return gone

    def _rows(self, parts: list[_Part]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.root}/{part.folder}" for part in parts]
        return conform(self.spark.read.schema(self.schema).parquet(*paths), self.schema)

    def _parts(self, number: int) -> list[_Part]:
        return [_Part(**p) for p in json.loads(read_text(self.spark, self._marker(number, "parts")))]

    def _require_newest(self, base: int | None) -> None:
        newest = self.newest()
        if newest != base:
            raise StaleVersionError(f"{self.root} is at version {newest}, not {base}")

    def _leased(self, number: int, lease_seconds: float) -> bool:
        oldest = time.time() - lease_seconds
        names = list_times(self.spark, self.root).items()
        found = ((_NAME.fullmatch(name), changed) for name, changed in names)
        return any(m and m[2] == "lease" and int(m[1]) == number and changed >= oldest for m, changed in found)

    def _delete_marks(self, number: int, how: str) -> None:
        for name in list_names(self.spark, self.root):
            match = _NAME.fullmatch(name)
            if match and match[2] == how and int(match[1]) == number:
                delete(self.spark, f"{self.root}/{name}")

    def _marked(self, how: str) -> set[int]:
        found = map(_NAME.fullmatch, list_names(self.spark, self.root))
        return {int(match[1]) for match in found if match and match[2] == how}

    def _marker(self, number: int, how: str) -> str:
        return f"{self._path(number)}.{how}"

    def _path(self, number: int) -> str:
        return f"{self.root}/version-{number:06d}"
