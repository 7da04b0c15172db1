from chatloom.operators import logs


def test_first_table_and_errors(spark):
    text = {"a": ["x", "|Tasks|n|", "|---|", "|t|1|", "", "|Tasks|m|"], "b": ["|Tasks|", "|z|"], "c": ["Error: early", "Traceback", "KeyError: 1", "ValueError: 2", "done"], "d": ["ok", "exit code: 3", "FAILED"]}
    lines = spark.createDataFrame([(f, i, v) for f, vs in text.items() for i, v in enumerate(vs, 1)], "file string, line_no long, value string")
    assert sorted((r.file, r.line_no) for r in logs.first_tables(lines).collect()) == [("a", 2), ("a", 3), ("a", 4), ("b", 1), ("b", 2)]
    assert {r.file: r.error for r in logs.error_lines(lines).collect()} == {"a": "UNKNOWN", "b": "UNKNOWN", "c": "ValueError: 2", "d": "2:exit code: 3"}


def test_summary_patterns(spark):
    text = {
        "files": ["OSError: [Errno 24]", "Too many open files", "pretrained=a,x pretrained=org/m, b", "Training finished"],
        "oom": ["too many open files", "CUBLAS_STATUS_ALLOC_FAILED", "Exit code: 0", "MODEL_PATH=", "pretrained=z"],
        "done": ["Elapsed 00:00:01 of 00:00:09", "training completed", "Exit code: 1", "01:02:03 left, ELAPSED", "elapsed ?"],
        "idk": ["Exit code: 0", "MODEL_PATH=/m/1", "pretrained=z", "financenan"],
    }
    lines = spark.createDataFrame([(f, i, v) for f, vs in text.items() for i, v in enumerate(vs, 1)], "file string, line_no long, value string")
    got = {r.file: (r.error_class, r.error_line, r.status, r.model_path, r.elapsed) for r in logs.summarise(lines).collect()}
    assert got == {
        "files": ("FILES", "OSError: [Errno 24]", "UNKNOWN", "org/m", None),
        "oom": ("OOM", "CUBLAS_STATUS_ALLOC_FAILED", "COMPLETED", "UNKNOWN", None),
        "done": ("FINISHED", "training completed", "FAILED", "UNKNOWN", "01:02:03"),
        "idk": ("IDK", None, "COMPLETED", "/m/1", None),
    }
