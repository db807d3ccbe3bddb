"""File sources and sinks (S1-S9, K1-K4).

Reading: CSV with a legacy encoding, one multi-path read per header layout,
header repairs as projections, the period taken from each file's name via
``_metadata.file_path`` (no driver-side listing of data), explicit schemas.

Writing: Parquet (default) or JSON, optionally partitioned; reuse-or-rebuild
of prepared datasets decided by the commit marker of the earlier write.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import base_name, file_period
from ..operators.clean import union_all

INDEX_COLUMN = "_c0"  # name Spark gives an unnamed (index) header column


# ---------------------------------------------------------------- S1
def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
             encoding: str = "cp949", header: bool = True) -> DataFrame:
    """CSV scan without type inference.

    With a ``schema`` the header must match it by name (``enforceSchema`` off,
    so a file whose columns are in another order fails instead of silently
    swapping values).  Without one every column is text.
    """
    r = spark.read.option("header", header).option("encoding", encoding)
    if schema is not None:
        r = r.schema(schema).option("enforceSchema", False)
    return r.csv(path if isinstance(path, str) else list(path))


# ---------------------------------------------------------------- S4 / S5 / S6
def fix_shifted_header(df: DataFrame) -> DataFrame:
    """Header names sit one place right of the data: drop the last (empty)
    column and give column i the name of column i+1."""
    cols = df.columns
    return df.drop(cols[-1]).toDF(*cols[1:])


def strip_header_chars(df: DataFrame, chars: str = "~", from_pos: int = 8) -> DataFrame:
    """Remove ``chars`` from the names of the columns at positions >= from_pos."""
    renames = {}
    for c in df.columns[from_pos:]:
        new = c
        for ch in chars:
            new = new.replace(ch, "")
        if new != c:
            renames[c] = new
    return df.withColumnsRenamed(renames) if renames else df


def drop_index_column(df: DataFrame) -> DataFrame:
    return df.drop(INDEX_COLUMN) if INDEX_COLUMN in df.columns else df


def conform_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name with lenient casts (bad text -> null).

    Unknown columns are ignored; a missing required column is an error.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


# ---------------------------------------------------------------- S2 / S3
LAYOUT_REPAIRS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "plain": lambda df: df,
    "shifted": fix_shifted_header,
    "tilde": lambda df: strip_header_chars(df, "~", 8),
}


def read_monthly(spark: SparkSession, layouts: Mapping[str, Sequence[str]], schema: T.StructType,
                 encoding: str = "cp949", name_level: int = 0,
                 repairs: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """Read periodic files of several header layouts into ONE DataFrame.

    ``layouts`` maps a layout name (``plain``, ``shifted``, ``tilde`` or a key
    of ``repairs``) to paths or globs; each layout is one multi-path scan.
    Every row gets ``source_file`` and ``period`` (first day of the month in
    the file name; ``name_level=1`` takes the name of the enclosing folder,
    for datasets written by Spark as folders).  A file whose name holds no
    period is an error.
    """
    fixes = {**LAYOUT_REPAIRS, **(repairs or {})}
    frames = []
    src = F.col("_metadata.file_path")
    for layout, paths in layouts.items():
        for raw in read_by_header(spark, paths, encoding, lambda path: file_period(base_name(path, name_level))["period"]):
            fixed = drop_index_column(fixes[layout](raw))
            frames.append(conform_schema(fixed, schema)
                          .withColumn("source_file", base_name(src, name_level))
                          .withColumn("period", file_period(base_name(src, name_level))["period"]))
    return union_all(frames)


def _one_file_a_task(spark: SparkSession) -> SparkSession:
    """A session like this one that reads every file whole in a task of its own."""
    single = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.legacy.javaCharsets"):
        single.conf.set(key, spark.conf.get(key))
    whole = 1 << 42
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        single.conf.set(key, str(whole))
    single.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    return single


def _first_line(batches):
    for b in batches:
        if b.num_rows:
            yield b.slice(0, 1)
            return          # the rest of the file is not read


def first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, line): the first line of every file as bytes, in one job that stops
    reading a file after it.  ``path`` is written as file listings write it."""
    lines = _one_file_a_task(spark).read.text(list(paths))
    at = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return (lines.select(F.regexp_replace(at, "^file:///", "file:/").alias("path"), F.col("value").cast("binary").alias("line"))
            .mapInArrow(_first_line, "path string, line binary"))


def read_by_header(spark: SparkSession, paths: Sequence[str], encoding: str = "cp949",
                   needed: Callable[[str], Column] | None = None) -> list[DataFrame]:
    """One all-text scan per distinct header among the files of ``paths``.

    Spark takes the first file's header for all files of a read, which would
    swap the columns of a file in another order without an error.  File names
    and header lines come to the driver, from one job for all files; the names
    in a header line are then parsed once per distinct line.  Files of no bytes are
    not listed by Spark.  A file without a header, or for which ``needed`` (an expression of its path) is null, is an
    error: its rows would be missing without a word.
    """
    if not paths:
        return []
    heads = first_lines(spark, paths)
    listed = spark.read.format("binaryFile").load(list(paths)).select("path").distinct().join(heads, "path", "left").collect()
    known = spark.read.format("binaryFile").load(list(paths)).where(needed("path").isNull()).select("path").collect() if needed else []
    files = sorted((r["path"], r["line"] and bytes(r["line"])) for r in listed)
    for what, bad in (("a header", [f for f, line in files if line is None]),
                      ("what is needed of the file name", [r["path"] for r in known])):
        if bad:
            raise ValueError(f"{len(bad)} input files without {what}, e.g. {bad[:3]}")
    by_header: dict[bytes, list[str]] = {}
    for f, line in files:
        by_header.setdefault(line, []).append(f)
    frames = []
    for group in by_header.values():
        columns = read_csv(spark, group[0], None, encoding).columns
        text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        frames.append(read_csv(spark, group, text, encoding))
    return frames


def file_names(spark: SparkSession, path: str, name_level: int = 0) -> DataFrame:
    """(file, digits, ext, period) of every file under ``path`` (metadata only)."""
    files = (spark.read.format("binaryFile").load(path)
             .select(base_name("path", name_level).alias("file")).distinct())
    return files.select("file", file_period("file").alias("p")).select("file", "p.*")


# ---------------------------------------------------------------- S9
def audit_encoding(spark: SparkSession, path: str, name_level: int = 0) -> DataFrame:
    """(file, encoding) -- ``utf-8-sig`` with a byte-order mark, ``utf-8`` when
    every line is valid UTF-8, else ``cp949``.

    A splittable scan of raw lines (the text source does not decode), reduced
    per file: validity is ``is_valid_utf8`` over every line.  The line reader
    drops a leading byte-order mark, so it shows as exactly three bytes of the
    file that no line accounts for: with ``lineSep="\n"`` every line owns its
    bytes plus one separator, a final line may lack it, a ``\r`` stays in the
    line.  No file is ever held in one row.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    per_file = lines.groupBy(F.col("_metadata.file_path").alias("path"),
                             F.col("_metadata.file_size").alias("size")).agg(
        F.sum(F.octet_length("value") + 1).alias("seen"),
        F.bool_and(F.is_valid_utf8("value")).alias("valid"))
    unseen = F.col("size") - F.col("seen")
    enc = (F.when(unseen.isin(2, 3), F.lit("utf-8-sig"))
           .when(F.col("valid"), F.lit("utf-8"))
           .otherwise(F.lit("cp949")))
    return per_file.select(base_name("path", name_level).alias("file"), enc.alias("encoding"))


# ---------------------------------------------------------------- S7 / K1
def write_prepared(df: DataFrame, path: str, fmt: str = "parquet",
                   partition_by: Sequence[str] = (), max_files: int | None = None,
                   mode: str = "overwrite") -> None:
    """Write a prepared dataset (overwrite by default).

    ``max_files`` caps the number of output files with a shuffle
    (``repartition``), so the upstream stage keeps its parallelism; with
    ``partition_by`` and no cap the rows are rebalanced by adaptive execution,
    which splits an oversized partition value across tasks.
    """
    if max_files:
        df = df.repartition(max_files)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def read_prepared(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  fmt: str = "parquet") -> DataFrame:
    """Read a prepared dataset with an explicit schema (column order, types and
    all-null columns survive a JSON round trip)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    return df.select(*schema.fieldNames()) if schema is not None else df


def _store(spark: SparkSession, path: str):
    """The file system of ``path`` and its path type: PySpark has no call of its own
    to rename a folder or to look for a marker file."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    store, place = _store(spark, path)
    return store.exists(place(path))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed (its ``_SUCCESS`` marker is there);
    an interrupted write leaves none and is not reused."""
    return _exists(spark, path.rstrip("/") + "/_SUCCESS")


# ---------------------------------------------------------------- K3
MANIFEST = "_manifest"      # a folder of the dataset that readers of it skip


def fingerprint(spark: SparkSession, paths: Sequence[str], *parameters: object) -> str:
    """One short text for the files of ``paths`` (names, sizes, modification
    times, in any order) and the ``parameters`` a dataset is built with.

    The files are listed by Spark and reduced to one row; contents are not read.
    """
    parts = [repr(p) for p in parameters]
    if paths:
        files = spark.read.format("binaryFile").load(list(paths)).select("path", "length", "modificationTime")
        one = files.distinct().agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
        parts.append(repr(tuple(one)))
    return hashlib.sha256("\x00".join(parts).encode()).hexdigest()


def read_manifest(spark: SparkSession, path: str) -> str | None:
    """The fingerprint the dataset at ``path`` was published with, if any."""
    at = f"{path.rstrip('/')}/{MANIFEST}"
    return spark.read.text(at).agg(F.max("value")).first()[0] if _exists(spark, at) else None


def publish(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
            manifest: str | None = None) -> None:
    """Replace the dataset at ``path`` by ``df`` without losing it on the way.

    Rows are written beside it, counted while they are written and again as
    they are read back; only then does the new folder take the place of the
    old, by renaming.  A failed or interrupted build leaves the old dataset as it
    was; one interrupted between the two renames is put back by the next call of
    ``recover``.  ``df`` may be built from the dataset it replaces.
    """
    spark = df.sparkSession
    base, tag = path.rstrip("/"), uuid.uuid4().hex[:12]
    staged, old = f"{base}.staged-{tag}", f"{base}.old-{tag}"
    count = Observation(f"publish-{tag}")
    write_prepared(df.observe(count, F.count(F.lit(1)).alias("n")), staged, fmt, partition_by)
    if manifest is not None:
        spark.range(1).select(F.lit(manifest).alias("value")).write.text(f"{staged}/{MANIFEST}")
    found = read_prepared(spark, staged, df.schema, fmt).agg(F.count(F.lit(1))).first()[0]
    if found != count.get["n"] or not is_complete(spark, staged):
        raise RuntimeError(f"{staged}: {found} rows read back of {count.get['n']} written; {base} is left as it was")
    store, place = _store(spark, base)
    if store.exists(place(base)) and not store.rename(place(base), place(old)):
        raise RuntimeError(f"cannot move {base} aside")
    if not store.rename(place(staged), place(base)):
        store.rename(place(old), place(base))
        raise RuntimeError(f"cannot move {staged} to {base}")
    store.delete(place(old), True)


def recover(spark: SparkSession, path: str) -> None:
    """Put back the dataset of ``path`` if publishing stopped between its two renames."""
    base = path.rstrip("/")
    store, place = _store(spark, base)
    if not store.exists(place(base)):
        left = store.globStatus(place(f"{base}.old-*"))
        if left:
            store.rename(left[0].getPath(), place(base))


def is_current(spark: SparkSession, path: str, manifest: str | None = None) -> bool:
    """Whether ``path`` holds a committed dataset built with this ``manifest``."""
    if not is_complete(spark, path):
        return False
    return manifest is None or read_manifest(spark, path) in (None, manifest)


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame], refresh: bool = False,
                schema: T.StructType | None = None, fmt: str = "parquet",
                partition_by: Sequence[str] = (), manifest: str | None = None) -> DataFrame:
    """Reuse the dataset at ``path`` if its write was committed, or build, publish
    and re-read it.

    With a ``manifest`` (a ``fingerprint``) a dataset that was published with
    another one is built anew; one that has none was made before there were any
    and is reused.  Reading back (instead of returning ``build()``) cuts the
    lineage: later stages read files from the shared folder rather than
    recomputing.
    """
    recover(spark, path)
    if not refresh and is_current(spark, path, manifest):
        return read_prepared(spark, path, schema, fmt)
    publish(build(), path, fmt, partition_by, manifest)
    return read_prepared(spark, path, schema, fmt)


# ---------------------------------------------------------------- S8 / K2
CLUSTER_META_SCHEMA = T.StructType([
    T.StructField("silhouette", T.DoubleType()),
    T.StructField("k", T.IntegerType()),
    T.StructField("mode", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
])


def cluster_meta(silhouette, k, mode, columns) -> list:
    return [(None if silhouette is None else float(silhouette), int(k), str(mode), list(columns))]


def write_cluster_meta(meta: DataFrame, path: str) -> None:
    """Write the one-row clustering summary (silhouette, k, mode, columns) as JSON."""
    meta.select(*CLUSTER_META_SCHEMA.fieldNames()).coalesce(1).write.mode("overwrite").json(path)


def read_cluster_meta(spark: SparkSession, path: str) -> DataFrame:
    return read_prepared(spark, path, CLUSTER_META_SCHEMA, "json")


# ---------------------------------------------------------------- K4
def transcode_csv(spark: SparkSession, src: str, dst: str, from_encoding: str = "utf-8",
                  to_encoding: str = "cp949") -> None:
    """Rewrite a CSV folder in another text encoding (header kept, text columns)."""
    df = read_csv(spark, src, None, from_encoding)
    df.write.mode("overwrite").option("header", True).option("encoding", to_encoding).csv(dst)
