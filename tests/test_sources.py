import json

import pytest

from chatloom.sources import jsonl, trainer


def test_trainer_states(spark, tmp_path):
    for model, name, step in (("a", "checkpoint-9", 9), ("a", "checkpoint-10", 10), ("b", "checkpoint-7", 7), ("b", "", 1)):
        d = tmp_path / model / name
        d.mkdir(parents=True, exist_ok=True)
        (d / trainer.STATE).write_text(json.dumps({"log_history": [{"step": step, "loss": 1.0}, {"step": step, "eval_loss": 2.0}, {"step": step}]}, indent=1))
    points = trainer.loss_points(trainer.latest_states(trainer.read_states(spark, str(tmp_path)))).collect()
    assert sorted((r.step, r.series, r.value) for r in points) == [(1, "eval_loss", 2.0), (1, "loss", 1.0), (10, "eval_loss", 2.0), (10, "loss", 1.0)]


def test_replace_keeps_a_backup(spark, tmp_path):
    path, backup = str(tmp_path / "rows"), str(tmp_path / "old")
    jsonl.write_jsonl(spark.range(3), path)
    jsonl.replace_jsonl(spark.read.schema("id long").json(path).filter("id > 0"), path, backup)
    assert spark.read.json(path).count() == 2 and spark.read.json(backup).count() == 3
    with pytest.raises(FileExistsError):
        jsonl.replace_jsonl(spark.range(1), path, backup)


def test_a_replacement_is_finished_after_a_crash(spark, tmp_path, monkeypatch):
    path, backup = str(tmp_path / "rows"), str(tmp_path / "old")
    jsonl.write_jsonl(spark.range(3), path)
    moved, move = [], jsonl._move

    def crash_at(n):
        def once(fs, old, new):
            if len(moved) == n:
                raise KeyboardInterrupt
            moved.append(new)
            move(fs, old, new)

        return once

    for n, left in ((0, 3), (1, 2)):
        moved.clear()
        with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
            m.setattr(jsonl, "_move", crash_at(n))
            jsonl.replace_jsonl(spark.read.schema("id long").json(path).filter("id > 0"), path, backup)
        assert jsonl.finish_replace(spark, path, backup) == (n == 1)
        assert spark.read.json(path).count() == left and not jsonl.finish_replace(spark, path, backup)
    assert spark.read.json(backup).count() == 3


def test_lists_documents_and_samples(spark, tmp_path):
    (tmp_path / "list").write_text("# all\n/a\n\n  /b \n")
    assert sorted(tuple(r) for r in jsonl.read_list(spark, str(tmp_path / "list")).collect()) == [(1, "/a"), (3, "/b")]
    deep = tmp_path / "r" / "x" / "y"
    deep.mkdir(parents=True)
    (deep / "s.jsonl").write_text('{"text": " t\\u00a0"}\n\n{"text": " "}\n{"n": 1}\n')
    (deep / "other.txt").write_text("no\n")
    assert jsonl.read_samples(spark, str(tmp_path / "r")).count() == 4
    docs = jsonl.read_documents(spark, str(deep / "s.jsonl")).collect()
    assert [(r.line_no, r.text) for r in docs] == [(0, "t")]


def test_old_lines_stay_where_there_is_no_new_one(spark, tmp_path):
    rows = spark.createDataFrame([(2, "{", None), (0, "", None), (1, "a", "b")], "line_no long, raw string, line string")
    jsonl.write_lines(rows, str(tmp_path / "out"))
    assert [r.raw for r in jsonl.read_lines(spark, str(tmp_path / "out/*.txt")).orderBy("path", "line_no").collect()] == ["", "b", "{"]
    jsonl.write_summary(spark.sql("SELECT 1 AS n, CAST(NULL AS STRING) AS note"), str(tmp_path / "sum"))
    assert [r.value for r in spark.read.text(str(tmp_path / "sum")).collect()] == ['{"n":1,"note":null}']
