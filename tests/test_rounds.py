import pytest
from pyspark.sql import functions as F

from chatloom.functions import strings as S
from chatloom.functions import turns as T
from chatloom.operators import datasets as D
from chatloom.operators import logs as L
from chatloom.operators import open_keys as K
from chatloom.sources import jsonl
from chatloom.sources import logs as FL

ROWS = "id int, prompt string, label_letter string, value string, exact_match boolean, try_count int, extra int"


def test_generate_twice_on_one_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, prompt string")
    for _ in range(2):
        out = D.generate(df, lambda prompts: [None if p is None else p * 2 for p in prompts])
        assert df.columns == ["id", "prompt"] and sorted(tuple(r) for r in out.collect()) == [(1, "a", "aa"), (2, None, None)]


def test_distill_stops_early_and_writes_every_attempt(spark, tmp_path):
    rows = [(1, "p", "B", "old", None, None, 7), (2, "p", None, "old", None, None, 8), (3, None, "A", "old", True, 4, 9), (4, "p", "E", "old", False, 2, 10)]
    df = spark.createDataFrame(rows, ROWS)

    def make(prompts, attempt):
        return [f"  Answer: {'ABCDE'[attempt % 5]} " for _ in prompts]

    done = D.distill(df, make, S.answer_matches, 8, str(tmp_path / "out"))
    got = {r.id: (r.value, r.exact_match, r.try_count, r.extra) for r in done.collect()}
    assert got == {1: ("Answer: B", True, 1, 7), 2: ("Answer: B", None, 1, 8), 3: ("old", True, 4, 9), 4: ("Answer: E", True, 4, 10)}
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == [f"attempt-{k}" for k in (1, 2, 3, 4)]
    resumed = D.distill(df, make, S.answer_matches, 1, str(tmp_path / "again"), resume=True)
    assert {r.id: r.try_count for r in resumed.collect()} == {1: 1, 2: 0, 3: 4, 4: 1}


def test_distill_goes_on_after_a_crash(spark, tmp_path):
    rows = [(k, "p" if k % 9 else None, "ABCDE"[k % 5] if k % 7 else None, "old", k == 18, None, k) for k in range(60)]
    df = spark.createDataFrame(rows, ROWS).withColumnRenamed("extra", "open_")

    def make(prompts, attempt):
        return [f"Answer: {'ABCDE'[attempt % 5]}" for _ in prompts]

    def dies(prompts, attempt):
        if attempt == 3:
            raise RuntimeError("lost")
        return make(prompts, attempt)

    def counts(prompts, attempt):
        (tmp_path / f"asked-{attempt}").touch()
        return make(prompts, attempt)

    def told(out):
        return sorted(map(tuple, out.collect()), key=str)

    want = told(D.distill(df, make, S.answer_matches, 4, str(tmp_path / "whole")))
    assert len(want) == 60
    folder = tmp_path / "run"
    with pytest.raises(Exception, match="lost"):
        D.distill(df, dies, S.answer_matches, 4, str(folder))
    half = folder / "attempt-3"
    half.mkdir(exist_ok=True)
    (half / "part-0.parquet").write_text("half written")
    (folder / "attempt-9").mkdir()
    assert told(D.distill(df, counts, S.answer_matches, 4, str(folder))) == want
    asked = sorted(p.name for p in tmp_path.glob("asked-*"))
    assert asked == ["asked-3", "asked-4"]
    # A run that is done only reads; a longer one goes on.
    assert told(D.distill(df, dies, S.answer_matches, 4, str(folder))) == want
    assert sorted(p.name for p in folder.iterdir()) == [f"attempt-{k}" for k in (1, 2, 3, 4)]
    longer = D.distill(df, make, S.answer_matches, 8, str(folder))
    assert longer.filter("label_letter IS NOT NULL AND prompt IS NOT NULL AND NOT exact_match").isEmpty() and longer.columns == df.columns
    # What is written shrinks with the rows that are still tried.
    sizes = [spark.read.parquet(str(folder / f"attempt-{k}")).count() for k in (1, 2, 3)]
    assert sizes[0] == 60 and sizes[0] > sizes[1] > sizes[2]
    assert D.distill(df.limit(0), make, S.answer_matches, 4, str(tmp_path / "none")).count() == 0


def test_pools_must_not_be_empty(spark):
    pools = spark.createDataFrame([(1, "q", "a", True)], "id int, question string, answer string, labeled boolean")
    with pytest.raises(ValueError, match="unlabelled"):
        D.pool_prompts(pools, "id", 2.0)
    both = pools.unionAll(spark.createDataFrame([(k, "q", "a", False) for k in range(2, 9)], pools.schema))
    drawn = D.pool_prompts(both, "id", 1.5).collect()
    assert sum(r.labeled for r in drawn) == 1 and sum(not r.labeled for r in drawn) == int(7 * 1.5) * 5
    for p in {r.prompt for r in drawn if not r.labeled}:
        assert len({r.id for r in drawn if r.prompt == p and not r.labeled}) == 5


def test_logs_of_a_folder(spark, tmp_path):
    (tmp_path / "a.out").write_text("Exit code: 0\nx\n")
    (tmp_path / "b.out").write_text("Exit code: 2\n")
    (tmp_path / "empty").write_text("")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "c.out").write_text("Exit code: 0\n")
    lines = FL.read_logs(spark, str(tmp_path))
    assert sorted((r.file.rpartition("/")[2], r.line_no, r.value) for r in lines.collect()) == [("a.out", 1, "Exit code: 0"), ("a.out", 2, "x"), ("b.out", 1, "Exit code: 2")]
    assert [r.file.rpartition("/")[2] for r in L.completed(L.summarise(lines)).collect()] == ["a.out"]
    times = FL.oldest_first(lines.select("file", "mtime").distinct()).collect()
    assert times == sorted(times, key=lambda r: (r.mtime, r.file))


def test_three_kinds_of_limits(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": "1"}\n\n{"id": "2"}\n')
    path = str(tmp_path / "x.jsonl")
    assert [jsonl.read_chat(spark, path, n).count() for n in (None, 0, 1, 2, 3)] == [2, 0, 1, 1, 2]
    assert [jsonl.read_chat(spark, path, n, "rows").count() for n in (None, 0, 1, 2, 3)] == [2, 2, 1, 2, 2]
    with pytest.raises(ValueError):
        jsonl.read_chat(spark, path, 1, "bytes")
    (tmp_path / "d.jsonl").write_text('{"text": " "}\n{"text": "a"}\n\n{"no": 1}\n{"text": " b "}\n{"text": "c"}\n')
    docs = str(tmp_path / "d.jsonl")
    told = [sorted(r.text for r in jsonl.read_documents(spark, docs, n).collect()) for n in (None, 0, 1, 2, 9)]
    assert told == [["a", "b", "c"], ["a", "b", "c"], ["a"], ["a", "b"], ["a", "b", "c"]]


def test_ordered_head_in_file_order(spark):
    rows = [(p, i, f"{p}{i}") for p in "ba" for i in range(0, 500, 3)]
    df = spark.createDataFrame(rows, "path string, line_no long, raw string").repartition(7)
    order = [r[2] for r in sorted(rows)]
    for n in (0, 1, 10, 11, 166, 167, 168, 200, 333, 334, 999):
        assert sorted(r.raw for r in jsonl.ordered_head(df, n, chunk=32).collect()) == sorted(order[:n])
    plan = jsonl.ordered_head(df, 10)._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "TakeOrdered" not in plan


def test_status_of_the_last_assistant_turn(spark):
    df = spark.sql("SELECT array(named_struct('from', ' Model', 'value', '<unused94>a'), named_struct('from', 'gpt', 'value', CAST(NULL AS STRING))) AS c UNION ALL SELECT NULL UNION ALL SELECT array()")
    rows = [tuple(r.r) for r in df.select(T.map_with_status(F.col("c"), S.think_text, S.think_status).alias("r")).collect()]
    assert [r[1] for r in rows] == ["no_legacy_tags", "no_conversations", "no_assistant_turn"]
    assert [t.value for t in rows[0][0]] == ["<think>\na\n</think>", "None"]


def test_shuffling_keeps_rows_and_depends_on_the_seed(spark):
    df = spark.range(200)
    orders = [[r.id for r in D.shuffled(df, "id", seed).collect()] for seed in (1, 1, 2)]
    assert orders[0] == orders[1] != orders[2] and sorted(orders[0]) == sorted(orders[2]) == list(range(200))


def test_core_keys_first(spark):
    row = K.entries(F.lit('{"zeta":1,"label":2,"a":3,"true_label":4}'))
    assert spark.range(1).select(K.to_line(row, K.CORE)).first()[0] == '{"true_label":4,"label":2,"a":3,"zeta":1}'
