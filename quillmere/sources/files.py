"""File sources: listings, sectioned annotation files, JSON lines, delimited tables, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, folder, name, extension, size, modified) of all files below ``path``; contents aren't read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    p = F.col("path")
    name = F.regexp_extract(p, r"([^/]+)$", 1)
    return f.select(p, F.regexp_extract(p, r"([^/]+)/[^/]+$", 1).alias("folder"), name.alias("name"), extension(name).alias("extension"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def extension(name: Column) -> Column:
    """Lower-case extension; trend files count as one kind, a name without one as 'none'."""
    return F.when(name.rlike(r"(?i)\.mg2.*\.(raw|ar)$"), ".mg2_trend").otherwise(F.coalesce(F.nullif(F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)), F.lit("")), F.lit("none")))


def plain_path(uri: Column) -> Column:
    """A file's path as a listing shows it: metadata columns percent-encode it."""
    return F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def entity_folders(files: DataFrame, skip: list[str] = (), parsed: bool = False) -> DataFrame:
    """Distinct folders, without hidden, system and listed ones; ``parsed`` leaves out names that aren't those of an entity."""
    from ..functions.names import loose_folder

    f = files.select("folder").filter(~F.col("folder").rlike(r"^[$.]")).distinct()
    if parsed:
        f = f.filter(loose_folder(F.col("folder"))["last_name"].isNotNull())
    if not skip:
        return f
    denied = files.sparkSession.createDataFrame([(s,) for s in skip], "folder string")
    return f.join(denied, "folder", "left_anti")


def with_suffix(files: DataFrame, suffix: str, but: str = ".backup") -> DataFrame:
    """Files whose name ends with the suffix, without backups."""
    n = F.lower("name")
    return files.filter(F.endswith(n, F.lit(suffix.lower())) & ~F.contains(n, F.lit(but)))


def session_keys(paths: DataFrame, path: str = "path", suffix: str = "_channels.tsv") -> DataFrame:
    """Add ``subject`` and ``session`` of paths .../sub-X/ses-Y/...; only paths with both and the suffix stay."""
    p = F.col(path)
    d = paths.filter(F.endswith(p, F.lit(suffix))).withColumns({"subject": F.regexp_extract(p, r"(?:^|/)(sub-[^/_]+)", 1), "session": F.regexp_extract(p, r"(?:^|/)(ses-[^/_]+)", 1)})
    return d.filter("subject <> '' and session <> ''")


def row_counts(spark: SparkSession, path: str) -> DataFrame:
    """(csv_rows, physical_lines) of delimited files with a header: quoted line breaks count in the second alone."""
    parsed = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path).select(F.count("*").alias("csv_rows"))
    files = spark.read.text(path).select(F.input_file_name().alias("f")).groupBy("f").agg(F.count("*").alias("n"))
    return parsed.join(F.broadcast(files.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("physical_lines"))))  # one row each


def shard_counters(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(key, n) summed over the counters of all workers' files below ``path`` (columns ``key``, n)."""
    return spark.read.schema(f"{key} string, n bigint").option("header", "true").option("recursiveFileLookup", "true").csv(path).groupBy(key).agg(F.sum("n").alias("n"))


def folder_inventory(files: DataFrame, sized: list[str]) -> DataFrame:
    """(folder, n_files, sized_bytes, kinds): files per kind as a map, sizes of some kinds alone."""
    g = files.groupBy("folder", "extension").agg(F.count("*").alias("n"), F.sum(F.when(F.col("extension").isin(sized), F.col("size")).otherwise(0)).alias("b"))
    return g.groupBy("folder").agg(F.sum("n").alias("n_files"), F.sum("b").alias("sized_bytes"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("extension", "n")))).alias("kinds"))


def comment_rows(lines: DataFrame, file: str, order: str, line: str, strict: bool = False) -> DataFrame:
    """Rows of the [Comments] section: onset, duration, text.

    Lines of fewer than five parts become text alone with zeros, or go if ``strict``.
    """
    from ..operators.sections import with_last

    t = F.trim(F.col(line))
    head = t.rlike(r"^\[.*\]$")
    d = with_last(lines, file, order, F.when(head, F.struct(order, t.alias("s"))), "__s").filter((F.col("__s.s") == "[Comments]") & ~head & (t != ""))
    p = F.split(t, ",", 5)
    full = F.size(p) >= 5
    d = d.filter(full) if strict else d
    number = lambda i: F.coalesce(F.when(full, F.get(p, F.lit(i)).try_cast("double")), F.lit(0.0))
    return d.select(file, order, number(0).alias("onset_sec"), number(1).alias("duration_sec"), F.when(full, F.btrim(F.trim(F.get(p, F.lit(4))), F.lit('"'))).otherwise(t).alias("text"))


def lay_files(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Annotation rows of all .lay files below ``path``, in file order."""
    whole = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.lay").text(path, wholetext=True).select(plain_path(F.col("_metadata.file_path")).alias("file"), "value")
    lines = whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))
    return comment_rows(lines, "file", "line_no", "line", strict)


PAGE_SCHEMA = "page int, chars int, ocr_used boolean, text string"


def page_lines(spark: SparkSession, path: str) -> DataFrame:
    """Pages from JSON lines; blank and broken lines are skipped."""
    return spark.read.schema(PAGE_SCHEMA).option("mode", "DROPMALFORMED").json(path).filter("page is not null")


def documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Nested JSON documents below ``path`` with their file as ``path``; unreadable ones have null fields."""
    return spark.read.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true").json(path).withColumn("path", plain_path(F.col("_metadata.file_path")))


def table_or_empty(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """A delimited table, every cell text, empty text kept; a missing file gives no rows."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", "true").option("sep", sep).option("emptyValue", "").option("nullValue", "\u0000").option("multiLine", "true").csv(path)


def edf_headers(spark: SparkSession, path: str) -> DataFrame:
    """Fixed-width header fields of EDF files, sliced from the first bytes; signals aren't decoded."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.edf").load(path)
    cut = lambda a, n: F.trim(F.decode(F.substring("content", a, n), "ISO-8859-1"))
    d = f.select("path", "length", cut(9, 80).alias("patient"), cut(89, 80).alias("recording"), cut(169, 8).alias("startdate"), cut(177, 8).alias("starttime"), cut(237, 8).alias("records"), cut(245, 8).alias("record_sec"), cut(253, 4).alias("signals"))
    n, s = F.col("records").try_cast("bigint"), F.col("record_sec").try_cast("double")
    ok = n.isNotNull() & s.isNotNull()
    return d.select("path", "length", "patient", "recording", "startdate", "starttime", n.alias("n_data_records"), F.col("signals").try_cast("int").alias("n_channels"), (n * s).alias("duration_sec"), F.when(ok, F.lit("")).otherwise("unreadable header").alias("error"))


def last_matching(lines: DataFrame, group: str, order: str, line: str, *patterns: str) -> DataFrame:
    """The last line of each group that fits the first pattern, or where none does, the next one."""
    c = F.col(line)
    fits = F.coalesce(*[F.when(c.rlike(p), -i) for i, p in enumerate(patterns)])
    return lines.filter(fits.isNotNull()).groupBy(group).agg(F.max_by(line, F.struct(fits, F.col(order))).alias(line))
