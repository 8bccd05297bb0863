"""Files and folders on whatever file system a path names."""

import time
import uuid

from pyspark.sql import SparkSession

# File systems on which creating a file that is there fails for all but one.
ATOMIC_CREATE = ("file", "hdfs", "viewfs", "webhdfs")
# Longer than any writer takes from a listing to its next write.
SETTLE_SECONDS = 5.0


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none when it does not exist."""
    return list(list_times(spark, path))


def list_times(spark: SparkSession, path: str) -> dict[str, float]:
    """Names of the entries of a folder, and when they were changed, in seconds."""
    files, where = _open(spark, path)
    if not files.exists(where):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in files.listStatus(where)}


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false when there is one of that name already."""
    files, where = _open(spark, path)
    return files.createNewFile(where)


def claim(spark: SparkSession, path: str, settle: float | None = None) -> bool:
    """Claim the name `path`, which one of any number of writers gets.

    Where the file system creates files atomically, the file `path` is the claim. Object
    stores check first and create then, so two could have it. There each writer that
    finds no claim puts one with a token of its own beside `path`, waits until all that
    found none have put theirs, and lists them: the least token has it, the others take
    theirs back. That holds while listings are consistent, as those of the large stores
    are, and no writer takes longer than `settle` seconds from its listing to its claim.
    """
    files, where = _open(spark, path)
    if settle is None:
        settle = 0.0 if files.getUri().getScheme() in ATOMIC_CREATE else SETTLE_SECONDS
    if not settle:
        return files.createNewFile(where)
    folder, name = path.rsplit("/", 1)

    def claims() -> list[str]:
        return sorted(n for n in list_names(spark, folder) if n == name or n.startswith(f"{name}."))

    if claims():
        return False
    token = f"{name}.{uuid.uuid4().hex}"
    files.createNewFile(where.suffix(token.removeprefix(name)))
    time.sleep(settle)
    if claims()[0] == token:
        return True
    delete(spark, f"{folder}/{token}")
    return False


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of one of that name."""
    files, where = _open(spark, path)
    stream = files.create(where, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    files, where = _open(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all in it."""
    files, where = _open(spark, path)
    files.delete(where, True)
