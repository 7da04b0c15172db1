import dataclasses
import random
import subprocess

import pytest
from pyspark.sql import functions as F

from chatloom.functions import strings as S
from chatloom.functions import templates as TP
from chatloom.operators import logs as L
from chatloom.operators import provenance as PV
from chatloom.sources import jsonl
from chatloom.sources import line_store as LS
from chatloom.sources import mixture as M
from chatloom.sources import versions as V


def ids(spark, root):
    at = V.current(spark, root)
    return None if at is None else sorted(r.id for r in spark.read.schema("id long").json(at).collect())


def test_a_crash_after_any_step_leaves_old_or_new(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    assert ids(spark, root) is None
    V.publish(spark.range(2), root)
    assert ids(spark, root) == [0, 1]

    class Crash(Exception):
        pass

    def half(df, path):
        jsonl.write_jsonl(df.limit(1), path)
        raise Crash

    def crash(*_):
        raise Crash

    with pytest.raises(Crash):
        V.publish(spark.range(3), root, half)
    assert ids(spark, root) == [0, 1]
    with monkeypatch.context() as m, pytest.raises(Crash):  # written whole, no pointer
        m.setattr(V, "_point", crash)
        V.publish(spark.range(3), root)
    assert ids(spark, root) == [0, 1]
    (tmp_path / "t" / ".half").write_text("")  # the pointer's file before its rename
    assert ids(spark, root) == [0, 1]
    reads_itself = spark.read.schema("id long").json(V.current(spark, root)).withColumn("id", F.col("id") + 7)
    open_before = spark.read.schema("id long").json(V.current(spark, root))
    V.publish(reads_itself, root)
    assert ids(spark, root) == [7, 8] and open_before.count() == 2
    assert len(V.prune(spark, root, keep=2)) == 2 and open_before.count() == 2
    assert len(V.prune(spark, root, keep=1)) == 1 and ids(spark, root) == [7, 8]
    with pytest.raises(ValueError):
        V.prune(spark, root, keep=0)


def test_the_second_of_two_writers_fails(spark, tmp_path):
    root = str(tmp_path / "t")

    def slow(df, path):
        V.publish(spark.range(1), root)
        jsonl.write_jsonl(df, path)

    with pytest.raises(FileExistsError):
        V.publish(spark.range(5), root, slow)
    assert ids(spark, root) == [0]
    V.publish(spark.range(2), root)
    assert ids(spark, root) == [0, 1]


CONFIG = """
base_model: $ROOT/model
datasets:
  - &chat
    path: ${ROOT}/a.jsonl
    ds_type: json
    type: chat_template
    field_messages: conversations
    message_property_mappings: {role: from, content: value}
    roles: {system: [system], user: [user, human], assistant: [assistant, gpt]}
  - <<: *chat
    path: $ROOT/b.jsonl
    field_messages: messages
    message_property_mappings: {role: role, content: the content}
  - path: $ROOT/c.jsonl
    ds_type: json
    type: completion
    field: body
  - path: $ROOT/d.jsonl
    ds_type: json
    type: user_defined.default
    field_chosen: good
  - path: $ROOT/e.jsonl
    type: custom
  - <<: *chat
    type: axolotl.integrations.kd.chat_template
    path: $ROOT/f.jsonl
    logprobs_field: lp
    temperature: 1.0
sequence_len: 60
sample_packing: true
train_on_inputs: false
"""


@pytest.fixture()
def mixture(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "an answer", "x": 1}]}\n\n{"id": 1}\n')
    (tmp_path / "b.jsonl").write_text('{"messages": [{"role": "odd", "the content": null}, {"role": "assistant", "the content": "b"}]}\n')
    (tmp_path / "c.jsonl").write_text('{"body": "plain text"}\n{"text": "not read"}\n{"body": "' + "long " * 90 + '"}\n')
    (tmp_path / "d.jsonl").write_text('{"prompt": "p", "good": "g", "rejected": "r"}\n')
    (tmp_path / "e.jsonl").write_text('{"prompt": "only asked"}\n')
    (tmp_path / "f.jsonl").write_text('{"conversations": [{"from": "gpt", "value": "z"}], "lp": [[-0.5, {"a": 1}]]}\n')
    (tmp_path / "config.yaml").write_text(CONFIG)
    return M.load(spark, str(tmp_path / "config.yaml"), {"ROOT": str(tmp_path)})


def test_mixture_of_a_configuration(spark, mixture):
    assert (mixture.context, mixture.packing, mixture.train_on_inputs, len(mixture.sources)) == (60, True, False, 6)
    rows = {(r.pos, r.line_no): r for r in M.read_mixture(spark, mixture).collect()}
    assert sorted(rows) == [(0, 0), (0, 2), (1, 0), (2, 0), (2, 1), (2, 2), (3, 0), (4, 0), (5, 0)]
    assert (rows[4, 0].prompt, rows[4, 0].kind, rows[5, 0].logprobs, rows[0, 0].logprobs) == ("only asked", "prompt", '[[-0.5,{"a":1}]]', None)
    assert [tuple(t) for t in rows[0, 0].conversations] == [("user", "q"), ("assistant", "an answer")]
    assert [tuple(t) for t in rows[1, 0].conversations] == [("odd", None), ("assistant", "b")]
    assert rows[0, 2].conversations is None and rows[2, 0].text == "plain text" and rows[2, 1].text is None
    assert (rows[3, 0].prompt, rows[3, 0].chosen, rows[3, 0].rejected, rows[3, 0].kind) == ("p", "g", "r", "preference")
    again = M.read_mixture(spark, mixture).select(M.shuffle_key().alias("k")).distinct().count()
    assert again == 9


def test_rows_for_the_trainer(spark, mixture):
    rows = {(r.pos, r.line_no): r for r in M.training_rows(spark, mixture).collect()}
    assert len(rows) == 9 and not any(rows[4, 0].token_loss) and all(len(r.token_ids) == len(r.token_loss) == r.tokens for r in rows.values())
    assert not all(rows[0, 0].token_loss) and any(rows[0, 0].token_loss) and all(rows[2, 0].token_loss)
    assert rows[2, 2].pack is None and rows[2, 2].tokens > 60 and rows[2, 1].pack is None and rows[0, 2].tokens == 0
    packs = {}
    for r in rows.values():
        if r.pack is not None:
            packs.setdefault(r.pack, []).append((r.begin, r.begin + r.tokens))
    for spans in packs.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 60 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert sum(map(len, packs.values())) == 6 == sum(0 < r.tokens <= 60 for r in rows.values())


def test_packed_rows_are_tokenised_once(spark, mixture, tmp_path):
    # Files of a folder repeat line numbers, so keys repeat with other lengths and with the same one.
    for part in range(3):
        (tmp_path / "many").mkdir(exist_ok=True)
        (tmp_path / "many" / f"{part}.json").write_text("".join(f'{{"text": "{"word " * (k % 4 + part // 2)}"}}\n' for k in range(20)))
    several = dataclasses.replace(mixture, sources=(M.Source(str(tmp_path / "many"), "completion", {"text": "text"}),) * 2)
    packed = M.training_rows(spark, several)
    assert "MapInArrow" not in packed._jdf.queryExecution().executedPlan().toString()
    whole = M.training_rows(spark, dataclasses.replace(several, packing=False))
    assert whole._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1 and whole.columns == packed.columns
    said = lambda rows: sorted((r.pos, r.line_no, r.text, r.token_ids, r.token_loss, r.tokens) for r in rows)
    rows = packed.collect()
    assert len(rows) == 120 and said(rows) == said(whole.collect())
    spans = sorted((r.pack, r.begin, r.begin + r.tokens) for r in rows if r.pack is not None)
    assert len(spans) == sum(r.tokens > 0 for r in rows) and all(a[0] != b[0] or a[2] == b[1] for a, b in zip(spans, spans[1:], strict=False))


def test_validation_rows_are_exactly_as_many(spark, mixture):
    rows = M.read_mixture(spark, mixture)
    for size, n in ((0, 0), (0.3, 3), (2, 2)):
        train, val = M.split_validation(rows, dataclasses.replace(mixture, validation=size))
        assert (train.count(), val.count()) == (9 - n, n) and train.columns == rows.columns
        assert train.unionAll(val).select("pos", "line_no").distinct().count() == 9
    with pytest.raises(ValueError):
        M.split_validation(rows, dataclasses.replace(mixture, validation=9))


def test_unknown_keys_and_values_are_errors():
    chat = {"path": "x", "type": "chat_template"}
    for bad in ({**chat, "feild_messages": "m"}, {**chat, "type": "other"}, {"type": "completion"}, {**chat, "ds_type": "csv"}, {**chat, "message_property_mappings": {"who": "x"}}, {"path": "x", "type": "custom", "field": "y"}, {**chat, "roles": {"user": ["a"], "assistant": ["a"]}}):
        with pytest.raises(ValueError):
            M.compile_mixture({"datasets": [bad]})
    for config in ({}, {"datasets": [chat], "chat_template": "nobody's"}):
        with pytest.raises(ValueError):
            M.compile_mixture(config)
    with pytest.raises(KeyError):
        M.substitute("a $NOT b", {})
    assert M.substitute("$A/${A}b $$A", {"A": "x"}) == "x/xb $A"


def test_natural_order_is_version_sort(spark):
    random.seed(11)
    names = ["checkpoint-9", "checkpoint-10", "a1", "a01", "a1~", "a1b", "a1.2.tar.gz", "a1.10.tar.gz", "a-1", "a_1", "A1", "", ".", "..", ".hidden2", ".hidden10", "x" + "9" * 30, "x" + "1" + "0" * 30, "no digits", "007", "7", "1.5", "1.50", "a.b", "a.b.c1", "~", "1~rc2"]
    names += ["".join(random.choice("ab019.-~_ Z") for _ in range(random.randint(1, 8))).strip() or "q" for _ in range(400)]
    names = sorted(set(names))
    want = subprocess.run(["sort", "-V"], input="\n".join(names) + "\n", capture_output=True, text=True, env={"LC_ALL": "C"}).stdout.split("\n")[:-1]
    df = spark.createDataFrame([(n,) for n in names], "n string").repartition(5)
    got = [r.n for r in df.orderBy(S.natural_key(F.col("n"))).collect()]
    assert got == want
    assert spark.range(1).select(S.natural_key(F.lit(None).cast("string"))).first()[0] is None


def plain_plot(points, width, height):
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    x0, x1, y0, y1 = min(xs), max(xs), min(ys), max(ys)
    x1, y1 = x1 + (1e-9 if x0 == x1 else 0), y1 + (1e-9 if y0 == y1 else 0)
    grid = [[" "] * width for _ in range(height)]
    for x, y in points:
        grid[height - 1 - int((y - y0) / (y1 - y0) * (height - 1))][int((x - x0) / (x1 - x0) * (width - 1))] = "•"
    labels = {0: f"{y1:.2f}", height - 1: f"{y0:.2f}"} | ({height // 2: f"{(y0 + y1) / 2:.2f}"} if height > 2 else {})
    lines = [f"{labels.get(i, ''):>5}│{''.join(row)}│" for i, row in enumerate(grid)]
    return ["   ┌" + "─" * width + "┐", *lines, "   └" + "─" * width + "┘"]


def test_drawing_equals_a_plain_one(spark):
    random.seed(12)
    for points in ([(i, 5 / (1 + i) + random.random()) for i in range(300)], [(3, 2.0)], [(i, 7.5) for i in range(9)], [(0, -1234567.0), (9, 5.0)]):
        df = spark.createDataFrame([*points, (1, None)], "step int, loss double")
        for size in ((80, 20), (45, 12)):
            got = [r.line for r in L.plot_lines(df, "step", "loss", *size).orderBy("line_no").collect()]
            assert got == plain_plot(points, *size)
    assert L.plot_lines(df.limit(0), "step", "loss").count() == 0


def plain_render(t, conv, generate):
    name = lambda r: t.opening.get(r) or t.before.replace("{role}", t.names.get(r, r))
    turns = [(f or "", v or "") for f, v in conv or []]
    turns = [(f, v.strip() if t.trim else v) for f, v in turns]
    if turns and t.default_system and all(f != "system" for f, _ in turns):
        turns.insert(0, ("system", t.default_system))
    if t.system == "first_user":
        system = next((v for f, v in turns if f == "system"), None)
        turns = [x for x in turns if x[0] != "system"]
        at = next((i for i, x in enumerate(turns) if x[0] == "user"), None)
        if system is not None and at is not None:
            turns[at] = ("user", system + "\n\n" + turns[at][1])
    out = t.begin
    for i, (f, v) in enumerate(turns):
        out += name(f) + v + (t.last if t.last and i == len(turns) - 1 and f == "assistant" else t.after)
    return out + (name("assistant") if generate else "")


def test_templates_equal_a_plain_renderer(spark):
    random.seed(13)
    rows = [(i, [(random.choice(["system", "user", "user", "assistant", "assistant", "tool", None]), random.choice([" hi\n", "", None, "{role}", "<|im_end|>", "ok"])) for _ in range(random.randint(0, 6))]) for i in range(80)]
    rows += [(80, None), (81, [("user", "q"), ("assistant", "a")]), (82, [("system", "s"), ("assistant", "a")])]
    df = spark.createDataFrame(rows, "id int, c array<struct<`from`:string,value:string>>")
    for name, t in TP.TEMPLATES.items():
        got = df.select("id", TP.render(t, F.col("c")).alias("a"), TP.render(t, F.col("c"), True).alias("b"), TP.pieces(t, F.col("c")).alias("p")).collect()
        for r in got:
            conv = dict(rows)[r.id]
            assert (r.a, r.b) == (plain_render(t, conv, False), plain_render(t, conv, True)), (name, conv)
            assert "".join(p.text for p in r.p) == r.a
            assert sum(p.loss for p in r.p) == 2 * sum(f == "assistant" for f, _ in conv or [])


def test_look_ups_read_only_the_chunks_they_need(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"s{k}.jsonl").write_text("".join(f'{{"k": {k}, "i": {i}}}\n' if i % 10 else " \n" for i in range(1000)))
    paths = [str(tmp_path / f"s{k}.jsonl") for k in range(3)]
    store = str(tmp_path / "store")
    LS.build(spark, paths, store, chunk=100)
    named = paths
    asked = [(named[0], 5), (f"file://{named[0]}", 5), (named[0], 199), (named[2], 990), (named[2], 991), (named[1], -1), ("file:///none", 3), (named[1], None), (named[1], 10**9)]
    wanted = spark.createDataFrame(asked, "path string, line_no long")
    want = sorted((p, n, f'{{"k": {p[-7]}, "i": {n}}}') for p, n in {(named[0], 5), (named[0], 199), (named[2], 991)})
    assert sorted(map(tuple, LS.look_up(spark, store, wanted).collect())) == want
    assert _full_scan(spark, paths, wanted) == want
    # All that was not asked for can be gone bad.
    for part in (tmp_path / "store").glob("part=*/*.parquet"):
        rows = {(r.path, r.line_no // 100) for r in spark.read.parquet(str(part)).select("path", "line_no").collect()}
        if not rows & {(p, n // 100) for p, n, _ in want}:
            part.write_bytes(b"PAR1 no longer a table")
            (part.parent / f".{part.name}.crc").unlink()
    wanted.write.parquet(str(tmp_path / "wanted"))
    assert sorted(map(tuple, LS.look_up(spark, store, spark.read.parquet(str(tmp_path / "wanted"))).collect())) == want


def _full_scan(spark, paths, wanted):
    return sorted(map(tuple, PV.wanted_lines(jsonl.read_lines(spark, paths).withColumn("path", F.regexp_replace("path", "^file:/+", "/")), wanted).select("path", "line_no", "raw").collect()))
