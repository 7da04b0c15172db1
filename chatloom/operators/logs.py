"""Mining of ordered log lines: (file, line_no, value) to one row per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_line(pattern: str, group: int = 0) -> Column:
    v = F.col("value")
    return F.min_by(F.when(v.rlike(pattern), F.regexp_extract(v, pattern, group)), F.when(v.rlike(pattern), F.col("line_no")))


def last_line(pattern: str, group: int = 0) -> Column:
    v = F.col("value")
    return F.max_by(F.when(v.rlike(pattern), F.regexp_extract(v, pattern, group)), F.when(v.rlike(pattern), F.col("line_no")))


# What a training error looks like, the gravest class first.
CLASSES = {
    "OOM": r"(?i)cudnn_status_alloc_failed|cublas_status_alloc_failed|out of memory",
    "NAN": r"(?i)\bnan\b|loss is nan|nan loss",
    "FILES": r"(?i)too many open files|errno 24",
    "FINISHED": r"(?i)training finished|training completed",
}


def summarise(lines: DataFrame) -> DataFrame:
    """One row per file; error_line is the first line that shows the class, null for IDK."""
    v, at = F.col("value"), F.col("line_no")
    pretrained = F.min_by("value", F.when(v.contains("pretrained="), at))
    times = F.when(v.rlike("(?i)elapsed"), F.regexp_extract_all("value", F.lit("[0-9]{2}:[0-9]{2}:[0-9]{2}"), F.lit(0)))
    last_time = F.try_element_at(times, F.lit(-1))
    s = lines.groupBy("file").agg(
        last_line(r"Exit code: ([0-9]+)", 1).alias("exit_code"),
        first_line(r"MODEL_PATH=(.*)", 1).alias("model_path"),
        pretrained.alias("pretrained"),
        F.max_by(last_time, F.when(last_time.isNotNull(), at)).alias("elapsed"),
        *[F.min_by("value", F.when(v.rlike(pattern), at)).alias(name) for name, pattern in CLASSES.items()],
        F.count("*").alias("n_lines"),
    )
    status = F.when(F.col("exit_code") == "0", "COMPLETED").when(F.col("exit_code").isNotNull(), "FAILED").otherwise("UNKNOWN")
    kind = F.coalesce(*[F.when(F.col(name).isNotNull(), name) for name in CLASSES], F.lit("IDK"))
    # A line without a value after pretrained= is given whole.
    named = F.coalesce(F.nullif(F.regexp_extract("pretrained", r".*pretrained=([^, ]+)", 1), F.lit("")), F.col("pretrained"))
    model = F.coalesce(F.nullif(F.coalesce("model_path", named), F.lit("")), F.lit("UNKNOWN"))
    return s.select(
        "file", status.alias("status"), kind.alias("error_class"), F.coalesce(*CLASSES).alias("error_line"), "exit_code", model.alias("model_path"), "elapsed", "n_lines"
    )


def completed(summary: DataFrame) -> DataFrame:
    return summary.filter("status = 'COMPLETED'")


def bins(df: DataFrame, x: str, y: str, width: int, height: int) -> DataFrame:
    """Grid cells of a series. A flat series has one row of cells."""
    low_x, high_x, low_y, high_y = df.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()

    def cell(v: str, a: float | None, b: float | None, n: int) -> Column:
        a, b = a or 0.0, b or 0.0
        return ((F.col(v) - F.lit(a)) / F.lit(b - a + (1e-9 if a == b else 0.0)) * (n - 1)).cast("int")

    cells = df.select(cell(x, low_x, high_x, width).alias("bin_x"), cell(y, low_y, high_y, height).alias("bin_y"))
    return cells.groupBy("bin_x", "bin_y").agg(F.count("*").alias("n"))


def plot_lines(df: DataFrame, x: str, y: str, width: int = 80, height: int = 20, mark: str = "•") -> DataFrame:
    """The series as a text drawing: (line_no, line), ``height`` lines between two borders, the highest value on top, with the
    highest, middle and lowest value in front. Null points are left out; without any point there is no line."""
    points = df.select(F.col(x).alias("x"), F.col(y).cast("double").alias("y")).dropna()
    low, high = points.agg(F.min("y"), F.max("y")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "line_no int, line string")
    high += 1e-9 if low == high else 0.0
    cells = bins(points, "x", "y", width, height)
    marks = cells.groupBy((F.lit(height) - F.col("bin_y")).alias("line_no")).agg(F.collect_set("bin_x").alias("at"))
    # From here on there are height rows of width cells at most.
    drawn = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.when(F.array_contains("at", i), mark).otherwise(" ")), "")
    label = F.when(F.col("line_no") == 1, f"{high:.2f}").when(F.col("line_no") == height, f"{low:.2f}").when(F.col("line_no") == height // 2 + 1, f"{(high + low) / 2:.2f}").otherwise("")
    rows = df.sparkSession.range(1, height + 1).select(F.col("id").cast("int").alias("line_no")).join(F.broadcast(marks), "line_no", "left")
    inside = rows.select("line_no", F.concat(F.lpad(label, F.greatest(F.lit(5), F.char_length(label)), " "), F.lit("│"), F.coalesce(drawn, F.lit(" " * width)), F.lit("│")).alias("line"))
    border = df.sparkSession.createDataFrame([(0, "   ┌" + "─" * width + "┐"), (height + 1, "   └" + "─" * width + "┘")], "line_no int, line string")
    return inside.unionAll(border)


def first_responses(lines: DataFrame) -> DataFrame:
    """(file, line_no, raw) JSON samples to one row per file with responses: the first one, its length, the number and the
    mean length of all. A file whose line 0 is an object without a response counts as having none."""
    v = F.try_parse_json("raw")

    def text(path: str) -> Column:
        is_text = F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING"
        return F.nullif(F.when(is_text, F.try_variant_get(v, path, "string")), F.lit(""))

    said = lines.select("file", "line_no", F.coalesce(text("$.resps[0][0]"), text("$.resps[0]")).alias("said"), F.schema_of_variant(v).startswith("OBJECT").alias("object"))
    stops = F.coalesce(F.bool_or((F.col("line_no") == 0) & F.col("object") & F.col("said").isNull()), F.lit(False))
    per_file = said.groupBy("file").agg(
        F.min_by("said", F.when(F.col("said").isNotNull(), F.col("line_no"))).alias("first_response"),
        F.count("said").alias("n"),
        F.avg(F.length("said")).alias("mean_chars"),
        stops.alias("stops"),
    )
    return per_file.filter("NOT stops AND n > 0").select("file", "first_response", F.length("first_response").cast("long").alias("first_chars"), "n", "mean_chars")


# What an error line looks like after a traceback, and without one.
RAISED = "(Error|Exception|ChildFailedError)"
FAILED = "ERROR:|Error:|FAILED|exit code: [1-9]"


def error_lines(lines: DataFrame) -> DataFrame:
    """(file, line_no from 1, value) to file, error: the last error after the first traceback, else "N:" and the first line
    that tells of a failure, else UNKNOWN."""
    v, at = F.col("value"), F.col("line_no")
    began = lines.filter(v.contains("Traceback")).groupBy("file").agg(F.min("line_no").alias("began"))
    x = lines.join(began, "file", "left")
    raised, failed = v.rlike(RAISED) & (at >= F.col("began")), v.rlike(FAILED)
    last = F.max_by("value", F.when(raised, at))
    first = F.min_by(F.concat(at.cast("string"), F.lit(":"), v), F.when(failed, at))
    return x.groupBy("file").agg(F.coalesce(last, first, F.lit("UNKNOWN")).alias("error"))


def first_tables(lines: DataFrame, header: str = r"^\|\s*Tasks\s*\|") -> DataFrame:
    """The lines of each file's first table: from its header on, up to the first line that is no table row."""
    head = lines.filter(F.col("value").rlike(header)).groupBy("file").agg(F.min("line_no").alias("h"))
    x = lines.join(head, "file").filter("line_no >= h")
    end = x.filter(~F.col("value").startswith("|")).groupBy("file").agg(F.min("line_no").alias("e"))
    return x.join(end, "file", "left").filter("e IS NULL OR line_no < e").select("file", "line_no", "value")


def missing_keys(rows: DataFrame, keys: list[str], raw: str = "raw") -> DataFrame:
    """key, missing: how many rows lack the key; a null under the key is not a lack."""
    there = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    counts = rows.agg(*[F.count_if(~F.array_contains(there, k)).alias(k) for k in keys])
    return counts.unpivot([], keys, "key", "missing")


def with_results(reports: DataFrame, folders: DataFrame) -> DataFrame:
    """Add ``job_id`` and ``folders`` (sorted paths of the result folders whose names end in _<job id>) to reports; no folders, no
    job id or no match give an empty list. ``reports`` has file, ``folders`` has path; both meet in one join by job id."""
    job = F.nullif(F.regexp_extract(F.substring_index("file", "/", -1), r"\.([0-9]+)\.", 1), F.lit(""))
    of = F.nullif(F.regexp_extract("path", r"_([0-9]+)/?\z", 1), F.lit(""))
    grouped = folders.select(of.alias("job_id"), "path").filter("job_id IS NOT NULL").groupBy("job_id").agg(F.sort_array(F.collect_set("path")).alias("folders"))
    rows = reports.withColumn("job_id", job).join(grouped, "job_id", "left")
    return rows.withColumn("folders", F.coalesce("folders", F.array().cast("array<string>")))
