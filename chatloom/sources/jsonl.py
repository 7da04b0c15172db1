"""Line-oriented sources and sinks. The physical line number is a column, as rows have no order of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.functions.strings import strip

CHAT_SCHEMA = "conversations array<struct<`from`:string,value:string>>, id string, label_letter string, label_text string, exact_match boolean, try_count int"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, line_no (from 0, per file), raw. Blocks of a file are counted and offset; no file is read in one task. The texts
    stay where they are read: the table of blocks, a row for each split of the files, goes to them. If the two readings of the
    files were dealt into tasks differently, that is an error."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw")
    )
    blocks = raw.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("block")) - F.col("n")
    found = raw.join(F.broadcast(blocks.withColumn("before", before)), ["path", "block"], "left")
    at = F.col("at") - F.col("first")
    number = F.when((at >= 0) & (at < F.col("n")), at + F.col("before")).otherwise(F.raise_error(F.lit("lines were read in other splits than they were counted in")).cast("long"))
    return found.select("path", number.alias("line_no"), "raw")


def ordered_head(rows: DataFrame, n: int, chunk: int = 1 << 16) -> DataFrame:
    """The first ``n`` rows by (path, line_no), whatever filters went before. Rows are counted by chunks of lines, sums over the
    chunks tell which ones are needed, and only the one at the border is ranked row by row: nothing is sorted as a whole.
    ``n`` of 0 or less gives none."""
    if n <= 0:
        return rows.filter(F.lit(False))
    of = rows.withColumn("_chunk", F.expr(f"line_no div {chunk}"))
    counts = of.groupBy("path", "_chunk").agg(F.count("*").alias("_n"))
    # Sums inside each file, then over the files: neither has a window over all chunks.
    files = counts.groupBy("path").agg(F.sum("_n").alias("_all"))
    files = files.withColumn("_files", F.sum("_all").over(Window.orderBy("path")) - F.col("_all")).drop("_all")
    inside = F.sum("_n").over(Window.partitionBy("path").orderBy("_chunk")) - F.col("_n")
    before = counts.withColumn("_inside", inside).join(files, "path").select("path", "_chunk", "_n", (F.col("_files") + F.col("_inside")).alias("_before"))
    kept = of.join(before.filter(F.col("_before") < n), ["path", "_chunk"])
    whole = F.col("_before") + F.col("_n") <= n
    border = kept.filter(~whole).withColumn("_at", F.row_number().over(Window.partitionBy("path", "_chunk").orderBy("line_no")))
    border = border.filter(F.col("_before") + F.col("_at") <= n).drop("_at")
    return kept.filter(whole).unionByName(border).select(*rows.columns)


def read_chat(spark: SparkSession, path: str | list[str], limit: int | None = None, limit_of: str = "lines") -> DataFrame:
    """Strict scan: blank lines are skipped, a bad line fails. ``limit_of`` says what ``limit`` counts, as the scripts differ:
    ``lines`` counts physical lines of each file, blank ones too, and 0 gives no row; ``rows`` counts rows over all files,
    and 0 is no limit. None is no limit in either."""
    if limit_of not in ("lines", "rows"):
        raise ValueError(f"limit_of={limit_of!r}: lines or rows")
    lines = read_lines(spark, path)
    if limit is not None and limit_of == "lines":
        lines = lines.filter(F.col("line_no") < limit)
    lines = lines.filter(F.trim("raw") != "")
    if limit and limit_of == "rows":
        lines = ordered_head(lines, limit)
    return lines.select("path", "line_no", F.from_json("raw", CHAT_SCHEMA, {"mode": "FAILFAST"}).alias("row"), "raw").select("path", "line_no", "row.*", "raw")


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """A list of datasets: pos and path of each line that is neither blank nor a # comment."""
    lines = read_lines(spark, path).select(F.col("line_no").alias("pos"), F.trim("raw").alias("path"))
    return lines.filter("path <> '' AND NOT startswith(path, '#')")


def read_documents(spark: SparkSession, path: str | list[str], limit: int | None = None) -> DataFrame:
    """path, line_no and text of rows with a text; blank ends are cut, empty texts dropped. ``limit`` counts the rows that
    are left, in the files' order; None and 0 are no limit."""
    lines = read_lines(spark, path).filter(F.trim("raw") != "")
    text = strip(F.from_json("raw", "text string", {"mode": "FAILFAST"})["text"])
    found = lines.select("path", "line_no", text.alias("text")).filter("text <> ''")
    return ordered_head(found, limit) if limit else found


def read_samples(spark: SparkSession, root: str) -> DataFrame:
    """file, raw: the lines of all .jsonl files below ``root``."""
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").text(root)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw"))


def classify_lines(lines: DataFrame) -> DataFrame:
    """Add ``reject``: blank, invalid, non_object, no_conversations, or null for good chat rows."""
    # Wrapped in an array, as text after a complete value is not an error to the parser otherwise.
    wrapped = F.try_parse_json(F.concat(F.lit("["), "raw", F.lit("\n]")))
    alone = F.try_variant_get(wrapped, "$[1]", "variant").isNull()
    v = F.when(alone, F.try_variant_get(wrapped, "$[0]", "variant"))
    kind = F.schema_of_variant(v)
    conv = F.schema_of_variant(F.try_variant_get(v, "$.conversations", "variant"))
    reject = (
        F.when(F.trim("raw") == "", "blank")
        .when(v.isNull(), "invalid")
        .when(~kind.startswith("OBJECT"), "non_object")
        .when(~F.coalesce(conv.startswith("ARRAY"), F.lit(False)), "no_conversations")
    )
    return lines.withColumn("reject", reject)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object per line, nulls written."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_lines(df: DataFrame, path: str, new: str = "line", raw: str = "raw", mode: str = "errorifexists") -> None:
    """In the order of line_no, the new line, or the old one as it was where there is none."""
    df.orderBy("line_no").select(F.coalesce(new, raw).alias("value")).write.mode(mode).text(path)


def write_summary(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A one-row table as one JSON object, in one file."""
    write_jsonl(df.coalesce(1), path, mode)


def replace_jsonl(df: DataFrame, path: str, backup: str) -> None:
    """Write ``df``, which may read ``path``, in its place; what was there moves to ``backup``, which must not exist. The
    new rows are complete beside it before anything moves. A folder cannot be moved over another, so this takes two moves;
    after a crash between them ``finish_replace`` makes the second. ``versions.publish`` has no such gap."""
    spark = df.sparkSession
    fs, place = _files(spark, path)
    if fs.exists(place(backup)):
        raise FileExistsError(backup)
    beside = f"{path.rstrip('/')}.new"
    if fs.exists(place(beside)) and fs.exists(place(path)):
        fs.delete(place(beside), True)  # of a run that ended before anything moved
    write_jsonl(df, beside)
    _move(fs, place(path), place(backup))
    _move(fs, place(beside), place(path))


def finish_replace(spark: SparkSession, path: str, backup: str) -> bool:
    """After a crash of ``replace_jsonl``: make the move that is missing, if one is; whether there was one."""
    fs, place = _files(spark, path)
    beside = f"{path.rstrip('/')}.new"
    if fs.exists(place(path)) or not fs.exists(place(backup)) or not fs.exists(place(f"{beside}/_SUCCESS")):
        return False
    _move(fs, place(beside), place(path))
    return True


def _files(spark: SparkSession, path: str):
    place = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    return place(path).getFileSystem(spark._jsc.hadoopConfiguration()), place


def _move(fs, old, new) -> None:
    if not fs.rename(old, new):
        raise OSError(f"could not move {old.toString()} to {new.toString()}")
