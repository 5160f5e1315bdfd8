"""Names and small files of a folder, through the session's file system."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: Files whose first lines are read at the same time.
PROBES = 16


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def fingerprint(spark: SparkSession, root: str) -> tuple:
    """Names, sizes and times of change of the files in a folder and in its sub-folders."""
    fs, p = _fs(spark, root)
    out = []
    for st in fs.listStatus(p):
        files = fs.listStatus(st.getPath()) if st.isDirectory() else [st]
        out += [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files]
    return tuple(sorted(out))


def list_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    fs, p = _fs(spark, root)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def list_folders(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of the folders ``<root>/<prefix>...``."""
    return [n[len(prefix):] for n in list_names(spark, root) if n.startswith(prefix)]


def list_versions(spark: SparkSession, root: str, prefix: str) -> list[int]:
    """Numeric suffixes of ``<root>/<prefix><n>`` folders that hold a committed write."""
    found = [n for n in list_folders(spark, root, prefix) if n.isdigit()]
    return sorted(int(n) for n in found if exists(spark, f"{root}/{prefix}{n}/_SUCCESS"))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str, draft: str) -> None:
    """Write a small file that appears whole: under the name ``draft``, then renamed.  Fails if it is
    there already."""
    fs, p = _fs(spark, path)
    d = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(draft)
    out = fs.create(d, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p) or not fs.rename(d, p):
        fs.delete(d, False)
        raise FileExistsError(f"{path} was committed by another writer")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def first_line(spark: SparkSession, uri: str) -> tuple[str, str | None]:
    """Path and first line of a file (null if it is empty); reads no further than one buffer (8 KB)
    beyond the line.  Compressed files are read like Spark's text source reads them."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(uri))
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        plain = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"), 8192)
        return p.toString(), reader.readLine()
    finally:
        stream.close()


def first_lines(spark: SparkSession, path: str) -> list[tuple[str, str | None]]:
    """Path and first line of every file that Spark would read under ``path``: no job, one short read a
    file, several files at a time."""
    uris = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(PROBES) as pool:
        return list(pool.map(lambda uri: first_line(spark, uri), uris))
