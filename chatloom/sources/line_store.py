"""Lines of many files, kept so that a look-up reads only the chunks that hold wanted lines.

Text files can only be read from their beginning, as nothing tells where a line starts. The store has the lines of each file in
chunks, one folder each; which chunks a look-up needs follows from the wanted numbers, and Spark prunes the folders by them
while the query runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.sources.jsonl import read_lines

CHUNK = 1 << 14
SCHEMA = "path string, line_no long, raw string, part long"


def _part(size: int) -> Column:
    """The folder of a line: ten bits of its path's hash before the number of its chunk. One column, as Spark prunes by
    each partition column alone and would read all pairs of wanted files and wanted chunks."""
    return F.expr(f"shiftleft(pmod(xxhash64(path), 1024), 48) + line_no div {size}")


def _plain(path: str) -> Column:
    """Local paths as rows name them: without a scheme."""
    return F.regexp_replace(path, "^file:/+", "/")


def build(spark: SparkSession, paths: str | list[str], folder: str, chunk: int = CHUNK) -> None:
    """Write the lines of ``paths`` to ``folder``, which must not exist. Each chunk is one task's, whatever a file's size."""
    lines = read_lines(spark, paths).withColumn("path", _plain("path")).withColumn("part", _part(chunk))
    lines.repartition("part").sortWithinPartitions("part", "path", "line_no").write.partitionBy("part").parquet(folder)
    spark.createDataFrame([(chunk,)], "lines int").coalesce(1).write.json(f"{folder}/_chunk")


def look_up(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """(path, line_no, raw) of the lines that ``wanted`` (path, line_no) asks for and that are not blank, each once; local
    paths have no scheme. Numbers
    below 0 and null ones match nothing, nor do unknown paths."""
    (size,) = spark.read.schema("lines int").json(f"{folder}/_chunk").first()
    asked = wanted.filter("line_no >= 0").select(_plain("path").alias("path"), "line_no").distinct().withColumn("part", _part(size))
    # The filter above and the partition column among the keys are what makes Spark prune folders by what was asked.
    lines = spark.read.schema(SCHEMA).parquet(folder).filter(F.trim("raw") != "")
    return lines.join(asked, ["part", "path", "line_no"], "left_semi").select("path", "line_no", "raw")
