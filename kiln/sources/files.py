"""File scans and sinks (S1-S13) with explicit schemas.

Schemas are always given (no inference pass over the data); malformed rows
are dropped or counted as asked; exports drop array/map
columns that CSV cannot hold.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LONG = "_long_line"
# Fixed value: schema of the headerless news CSV (label 1..4, title, description).
NEWS_SCHEMA = "label INT, title STRING, description STRING"


def read_csv(spark: SparkSession, path: str, schema, header: bool = True, null_values=("", "na"),
             long_lines: str = "keep", **options) -> DataFrame:
    """Header CSV with a given schema.

    A line with fewer fields than the schema is padded with NULL. One with more is cut to the schema's fields, or
    left out with ``long_lines='skip'`` (``skipped_lines`` counts those). Every null marker (pandas
    reads both '' and 'na' as missing) becomes NULL, and so does a field that does not cast; the row stays.
    """
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    raw = _raw_csv(spark, path, st, header, options)
    if long_lines == "skip":
        raw = raw.filter(~F.col(_LONG))
    elif long_lines != "keep":
        raise ValueError(f"long_lines is 'keep' or 'skip', not {long_lines!r}")
    cols = []
    for f in st.fields:
        v = F.col(f"`{f.name}`")
        for m in null_values:
            v = F.nullif(v, F.lit(m))
        cols.append(v.try_cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def skipped_lines(spark: SparkSession, path: str, schema, header: bool = True, **options) -> DataFrame:
    """One row with the number of lines that ``read_csv(..., long_lines='skip')`` leaves out."""
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    raw = _raw_csv(spark, path, st, header, options)
    return raw.agg(F.count(F.when(F.col(_LONG), 1)).alias("skipped"))


def _raw_csv(spark: SparkSession, path: str, st: T.StructType, header: bool, options: dict) -> DataFrame:
    """Every field as text, and ``_LONG``: whether the line has more fields than the schema.

    The reader gets one field more than the schema. A line that fills it exactly is too long by one; every other line
    is a corrupt record to the reader, whose text tells by its separators outside quotes.
    """
    names = [*[f.name for f in st.fields], "_past", "_line"]
    r = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    for k, v in {"header": header, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line", "columnPruning": False,
                 **options}.items():
        r = r.option(k, v)
    sep = options.get("sep", ",")
    bare = F.regexp_replace("_line", '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    # Spark refuses to read the line without any field, so the first field is always part of the test
    never = F.coalesce(F.col(f"`{names[0]}`") == "\u0000", F.lit(False))
    return r.csv(path).withColumn(_LONG, never | F.when(F.col("_line").isNull(), True).otherwise(fields > len(st.fields))) \
        .drop("_past", "_line")


def read_news_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Headerless quoted CSV; label shifted to 0-based; text = title +
    ' ' + description (a short row has a NULL description). ``multi_line``
    allows line ends inside quotes, at the price of one task per file."""
    df = (spark.read.schema(NEWS_SCHEMA).option("header", False).option("quote", '"')
          .option("escape", '"').option("multiLine", multi_line).csv(path))
    return df.select((F.col("label") - 1).alias("label"),
                     F.concat_ws(" ", "title", "description").alias("text"))


def read_pairs_tsv(spark: SparkSession, path: str, reverse: bool = False) -> DataFrame:
    """S3 + P11: tab-separated sentence pairs, first two fields kept."""
    parts = F.split(F.col("value"), "\t")
    df = spark.read.text(path).select(parts.getItem(0).alias("src"), parts.getItem(1).alias("tgt"))
    return df.select(F.col("tgt").alias("src"), F.col("src").alias("tgt")) if reverse else df


def read_json_doc(spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = False) -> DataFrame:
    """JSON documents with a given schema, one per line or, with ``multi_line``, one per file."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


_COMMIT, _VERSION = "_committed", "v-"


def materialised(spark: SparkSession, path: str, build) -> DataFrame:
    """Reuse the committed copy in folder ``path`` when there is one, else build, write and commit it.

    A copy is written under a fresh name and becomes the table by one rename of a marker file that names it; the rename
    fails where a marker exists. So a job killed while it writes leaves nothing that is read, of two writers the
    first to commit wins and the other returns that copy and removes its own, and nothing is overwritten. A folder that a plain
    Spark job has finished (with its success mark) is read as it is; any other folder with files of other origin is an error. The
    rename must not replace a file, as on HDFS; a store without such a rename needs a single writer.
    """
    folder = _Folder(spark, path)
    version = folder.committed()
    if version is None:
        names = folder.names()
        if "_SUCCESS" in names:
            return spark.read.parquet(path)
        if any(not n.startswith((_VERSION, "_", ".")) for n in names):
            raise FileExistsError(f"{path} holds files of an unfinished or other job")
        own = f"{_VERSION}{uuid.uuid4().hex}"
        build().write.mode("errorifexists").parquet(f"{path}/{own}")
        version = folder.commit(own)
        if version != own:
            folder.remove(own)
    return spark.read.parquet(f"{path}/{version}")


class _Folder:
    """The few file operations of a committed table, in whatever store the path is."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.root = self.hadoop.Path(path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs, self.context = self.root.getFileSystem(conf), self.hadoop.FileContext.getFileContext(self.root.toUri(), conf)
        self.jvm = spark.sparkContext._jvm

    def at(self, name: str):
        return self.hadoop.Path(self.root, name)

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.root)] if self.fs.exists(self.root) else []

    def committed(self) -> str | None:
        """The version that the marker names; none without a marker."""
        if not self.fs.exists(self.at(_COMMIT)):
            return None
        stream = self.fs.open(self.at(_COMMIT))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def commit(self, version: str) -> str:
        """Make ``version`` the table unless another is; the version that is."""
        draft = self.at(f"_draft-{version}")
        stream = self.fs.create(draft, False)
        stream.write(version.encode())
        stream.close()
        nothing = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            self.context.rename(draft, self.at(_COMMIT), nothing)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            self.fs.delete(draft, False)
        return self.committed()

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def load_or_default(spark: SparkSession, paths, defaults: dict[str, str]) -> DataFrame:
    """(key, value, source): each key of ``defaults`` and of the JSON documents at ``paths``, with the value of the first document that
    has one, else the default. A missing document is passed over, as is one that is no JSON object; null values count as absent.
    ``source`` is the number of the document, from 1, and 0 for defaults. Values are text, nested ones as JSON.
    """
    found = spark.createDataFrame([(k, v, len(paths) + 1, 0) for k, v in defaults.items()], "key string, value string, place int, source int")
    for n, path in enumerate(paths, 1):
        try:
            text = spark.read.text(path, wholetext=True)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        document = F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>")
        rows = text.select(F.explode(document).alias("key", "v")).select(
            "key", F.coalesce(F.try_variant_get("v", "$", "string"), F.to_json("v")).alias("value"), F.lit(n).alias("place"), F.lit(n).alias("source"))
        found = found.unionByName(rows.where("value IS NOT NULL AND value <> 'null'"))
    return found.groupBy("key").agg(F.min_by(F.struct("value", "source"), "place").alias("b")).select("key", "b.value", "b.source")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> None:
    """Overwrite a table at ``path`` (csv gets a header)."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def export_results(df: DataFrame, path: str, fmt: str = "csv") -> DataFrame:
    """Drop array/map/struct columns (not CSV-representable), then write."""
    flat = [f.name for f in df.schema.fields
            if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    out = df.select(*flat)
    write_table(out, path, fmt)
    return out


def profile(df: DataFrame) -> DataFrame:
    """Count, mean, stddev, min, quartiles, max per column (one pass per
    statistic group, computed by Spark)."""
    return df.summary()


def column_metadata(df: DataFrame) -> DataFrame:
    """The schema as a table (position, name, type, nullable)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def require_columns(df: DataFrame, cols) -> DataFrame:
    """Fail early when columns are missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def drop_null_rows(df: DataFrame, subset) -> tuple[DataFrame, DataFrame]:
    """Rows with NULL in ``subset`` removed, plus a one-row count of the
    dropped rows (a lazy aggregate, not a driver-side count)."""
    cond = F.lit(False)
    for c in subset:
        cond = cond | F.col(c).isNull()
    dropped = df.agg(F.sum(F.when(cond, 1).otherwise(0)).alias("dropped"))
    return df.na.drop(subset=list(subset)), dropped


def coerce_timestamps(df: DataFrame, col: str, fmt: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split rows whose ``col`` parses as a timestamp from those that
    do not (summary rows in a CSV)."""
    ts = F.try_to_timestamp(F.col(col), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(col))
    d = df.withColumn("_ts", ts)
    return (d.filter(F.col("_ts").isNotNull()).withColumn(col, F.col("_ts")).drop("_ts"),
            d.filter(F.col("_ts").isNull()).drop("_ts"))


def save_model(model, path: str) -> None:
    """Persist a fitted pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A fitted pipeline written by ``save_model``."""
    return PipelineModel.load(path)
