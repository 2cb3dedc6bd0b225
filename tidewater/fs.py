"""Small file-system helpers over the Hadoop FileSystem the session is configured with.

They work for every scheme the cluster can read (hdfs://, s3a://, abfs://, file:),
unlike Python's ``os``/``shutil`` which only see the driver's local disk.
"""
from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def is_complete(spark: SparkSession, path: str) -> bool:
    """A directory written by a Spark job that committed (``_SUCCESS`` marker present)."""
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly in a folder; none if it does not exist."""
    fs, hpath = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def has_data(spark: SparkSession, path: str) -> bool:
    """A folder with anything but hidden entries and markers in it."""
    return any(not n.startswith(("_", ".")) or "=" in n for n in list_names(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, hsrc = _fs(spark, src)
    if not fs.rename(hsrc, _fs(spark, dst)[1]):
        raise OSError(f"rename {src} -> {dst} failed")


def scheme(spark: SparkSession, path: str) -> str:
    fs, hpath = _fs(spark, path)
    return str(fs.getUri().getScheme() or "file")


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.mkdirs(hpath)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hpath = _fs(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file unless it is there; of several callers one succeeds. HDFS and the local file
    system decide that in one step; a store does where its connector creates conditionally."""
    jvm = spark.sparkContext._jvm
    fs, hpath = _fs(spark, path)
    fs.mkdirs(hpath.getParent())
    if scheme(spark, path) == "file":  # Hadoop's local file system looks first and creates then
        nio = jvm.java.nio.file
        bare = hpath.toUri().getPath()
        if not jvm.java.io.File(bare).createNewFile():
            return False
        nio.Files.write(jvm.java.io.File(bare).toPath(), bytearray(text.encode("utf-8")),
                        spark.sparkContext._gateway.new_array(nio.OpenOption, 0))
        return True
    try:
        out = fs.create(hpath, False)
    except Py4JJavaError as failed:
        if "AlreadyExists" in failed.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _fs(spark, path)
    stream = fs.open(hpath)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    return [str(s.getPath().toString()) for s in fs.listStatus(hpath) if s.isDirectory()]


def partition_dirs(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Relative paths (``a=1/b=2``) of the partition folders ``depth`` levels below root."""
    fs, hroot = _fs(spark, root)
    if not fs.exists(hroot):
        return []
    level = [("", hroot)]
    for _ in range(depth):
        nxt = []
        for rel, hp in level:
            for st in fs.listStatus(hp):
                name = st.getPath().getName()
                if st.isDirectory() and "=" in name and not name.startswith((".", "_")):
                    nxt.append((f"{rel}/{name}" if rel else name, st.getPath()))
        level = nxt
    return sorted(rel for rel, _ in level)
