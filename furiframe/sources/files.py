"""File-backed sources: whole-text files, globbed listings, images, binaries, JSONL.

A directory of small files is a table whose key is the file stem. Spark
lists and splits the files across tasks; nothing is read on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furiframe.functions.text import file_name, stem
from furiframe.operators.dataset import MESSAGES


def _require(spark: SparkSession, path: str) -> None:
    """The folder or file must be named and there (a metadata call to its own file system)."""
    if not path:
        raise ValueError("a source path is required")
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem API
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):  # noqa: SLF001
        raise FileNotFoundError(f"no such source: {path}")


def require_match(df: DataFrame, what: str) -> DataFrame:
    """``df`` itself, or an error if not a single file matched (reads one row)."""
    if df.limit(1).count() == 0:
        raise FileNotFoundError(f"no matching {what}")
    return df


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` itself, or an error that lists the missing columns."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def wholetext_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file: ``name, stem, text`` (the whole file as one value).

    ``wholetext`` must be passed to ``text()`` itself: an ``option`` is
    overridden by the method's default.
    """
    _require(spark, path)
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.text(path, wholetext=True)
    name = file_name(F.col("_metadata.file_path"))
    return df.select(name.alias("name"), stem(name).alias("stem"), F.col("value").alias("text"))


def binary_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``name, stem, size, content`` for every (non-empty) file."""
    _require(spark, path)
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path)
    name = file_name("path")
    return df.select(name.alias("name"), stem(name).alias("stem"), F.col("length").alias("size"), "content")


def image_files(spark: SparkSession, path: str, glob: str | None = "*.png",
                drop_invalid: bool = False) -> DataFrame:
    """Decoded images (``image`` struct, BGR(A) bytes) with ``name`` and ``stem``.
    Undecodable files stay as rows with ``image.height = -1`` unless dropped."""
    _require(spark, path)
    reader = spark.read.format("image").option("dropInvalid", drop_invalid)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path)
    name = file_name("image.origin")
    return df.select(name.alias("name"), stem(name).alias("stem"), "image")


def file_manifest(spark: SparkSession, path: str, kind: str, glob: str | None = None) -> DataFrame:
    """``name, stem, kind, size`` listing that keeps zero-byte files.

    ``binaryFile`` (like every Spark file source) skips empty files, so the
    listing is taken from the file system through Spark's Hadoop layer
    (``listStatus``), which is a metadata call, not a data read.
    """
    _require(spark, path)
    sc = spark.sparkContext
    jvm = sc._jvm  # noqa: SLF001 - Hadoop FileSystem API for a plain directory listing
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())  # noqa: SLF001
    import fnmatch

    rows = []
    for st in fs.listStatus(p):
        if st.isFile():
            n = st.getPath().getName()
            if glob is None or fnmatch.fnmatch(n, glob):
                rows.append((n, kind, int(st.getLen())))
    df = spark.createDataFrame(rows, "name string, kind string, size long")
    return df.select("name", stem("name").alias("stem"), "kind", "size")


def read_messages_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines with a ``messages`` field (explicit schema, no inference)."""
    _require(spark, path)
    return spark.read.schema(f"messages {MESSAGES}").json(path)
