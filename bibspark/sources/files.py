"""Files on any file system that Spark can read, through the Hadoop interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files of a folder that aren't hidden."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0
    if not fs.getFileStatus(p).isDirectory():
        return fs.getFileStatus(p).getLen()
    return sum(s.getLen() for s in fs.listStatus(p) if s.isFile() and not s.getPath().getName().startswith((".", "_")))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, sorted."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())


def walk(spark: SparkSession, folder: str) -> list[str]:
    """Paths of all files below a folder, sorted, in the form in which the folder is given."""
    fs, p = _fs(spark, folder)
    root = fs.makeQualified(p).toString().rstrip("/")
    out, found = [], fs.listFiles(p, True)
    while found.hasNext():
        out.append(f"{folder.rstrip('/')}/{found.next().getPath().toString()[len(root) + 1 :]}")
    return sorted(out)


def head(spark: SparkSession, path: str, most: int = 65536) -> bytes:
    """The first bytes of a file; of a folder, those of its first file that isn't hidden."""
    fs, p = _fs(spark, path)
    if fs.getFileStatus(p).isDirectory():
        first = next((n for n in names(spark, path) if not n.startswith((".", "_"))), None)
        return b"" if first is None else head(spark, f"{path.rstrip('/')}/{first}", most)
    jvm, stream = spark._jvm, fs.open(p)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, most)))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small document."""
    return head(spark, path, size(spark, path)).decode("utf-8")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small document, replacing what was there."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
