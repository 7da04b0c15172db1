"""Registered queries of the chat pipeline, each with its SQL twin.

The tables hold no markup, so both sides inject the same one with portable SQL expressions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import prompts as Q
from chatloom.functions import strings as S
from chatloom.functions import turns as T
from chatloom.operators import datasets as D
from chatloom.operators import logs as L
from chatloom.operators import open_keys as K
from chatloom.operators import provenance as V
from chatloom.operators import sampling as P
from chatloom.sources import trainer as R
from chatloom.sources.scratch import scratch_dir

LETTER = "chr(65 + CAST(conv_id % 5 AS INT))"
LABEL = f"CASE WHEN conv_id % 7 = 0 THEN NULL ELSE {LETTER} END"
MARKED = f"""CASE WHEN role <> 'assistant' THEN text
 WHEN conv_id % 6 = 0 THEN '<|channel|>analysis<|message|> ' || text || ' <|end|><|start|>assistant<|channel|>final<|message|> Answer: ' || {LETTER} || ' '
 WHEN conv_id % 6 = 1 THEN '<|channel|>analysis<|message|>' || text
 WHEN conv_id % 6 = 2 THEN '<unused94>thought' || chr(10) || text || '<unused95>' || chr(10) || 'Answer: B.'
 WHEN conv_id % 6 = 3 THEN text || '<unused95>' || '**B. x**'
 WHEN conv_id % 6 = 4 THEN '<unused94>' || text
 ELSE 'so **B. ' || text END"""
CTE = f"WITH c AS (SELECT conv_id, turn, role, {MARKED} AS text, {LABEL} AS label_letter, 1 + conv_id % 8 AS try_count FROM conversations)"
ASST = CTE + ", a AS (SELECT * FROM c WHERE role = 'assistant')"
RUBRIC = """CASE WHEN doc_id % 5 = 4 THEN text ELSE '**Difficulty level:** ' || CAST(1 + doc_id % 6 AS VARCHAR(9)) || chr(10) || '- **Clinical relevance:** ' ||
 CAST(1 + doc_id % 5 AS VARCHAR(9)) || chr(10) || '**Overall Recommendation:** ' || CASE WHEN doc_id % 3 = 0 THEN 'keep' WHEN doc_id % 3 = 1 THEN 'Revise' ELSE '[Keep' END ||
 chr(10) || '**Feedback:** ' || text END"""
BLOCKS = "CASE WHEN doc_id % 3 = 0 THEN text ELSE '<qa><question>' || lang || '</question><answer>' || source || '</answer></qa> x <QA><question>q2</question><answer>' || CASE WHEN doc_id % 2 = 0 THEN '' ELSE lang END || '</answer></QA>' END"
SINGLE = "'<|channel|>final<|message|>old<|channel|>final<|message|><question>' || lang || CASE WHEN doc_id % 2 = 0 THEN '</question><answer>' ELSE '--- Answer ---' END || source || '</answer>'"

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _of_events(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A SELECT over the table events, without leaving a view in the session."""
    name = f"events_{uuid.uuid4().hex}"
    _read(spark, sf_dir, "events").createTempView(name)
    try:
        return spark.sql(text.replace("FROM events", f"FROM {name}"))
    finally:
        spark.catalog.dropTempView(name)


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "role", f"{MARKED} AS text", f"{LABEL} AS label_letter", "1 + conv_id % 8 AS try_count")


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation, turns in order."""
    turns = F.sort_array(F.collect_list(F.struct("turn", F.struct(F.col("role").alias("from"), F.col("text").alias("value")).alias("t"))))
    g = marked(spark, sf_dir).groupBy("conv_id").agg(turns.alias("ts"), F.first("label_letter").alias("label_letter"), F.first("try_count").alias("try_count"))
    return g.select("conv_id", F.col("ts.t").alias("conversations"), "label_letter", "try_count")


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(spark, sf_dir).filter("role = 'assistant'")


IDX = """, u AS (SELECT conv_id, min(turn) FILTER (WHERE role IN ('human', 'user')) AS u FROM c GROUP BY conv_id),
 i AS (SELECT c.conv_id, u.u, min(c.turn) FILTER (WHERE c.role = 'assistant' AND c.turn > u.u) AS a, min(c.turn) FILTER (WHERE c.role = 'system') AS s0 FROM c JOIN u ON c.conv_id = u.conv_id GROUP BY c.conv_id, u.u)"""


@query("turn_indices", CTE + IDX + " SELECT conv_id, CAST(u AS BIGINT) AS user_idx, CAST(a AS BIGINT) AS assistant_idx, CAST(CASE WHEN a IS NULL OR s0 < a THEN s0 END AS BIGINT) AS system_idx FROM i")
def turn_indices(spark, sf_dir):
    c, k = F.col("conversations"), lambda x: x.cast("long")
    return chats(spark, sf_dir).select("conv_id", k(T.user_index(c)).alias("user_idx"), k(T.assistant_index(c)).alias("assistant_idx"), k(T.system_index(c)).alias("system_idx"))


@query("drop_system_turns", CTE + " SELECT conv_id, count(*) AS n, string_agg(role, ',' ORDER BY turn) AS roles FROM c WHERE role <> 'system' GROUP BY conv_id")
def drop_system_turns(spark, sf_dir):
    c = chats(spark, sf_dir).withColumn("c", T.drop_system(F.col("conversations")))
    return c.filter(F.size("c") > 0).select("conv_id", F.size("c").cast("long").alias("n"), F.array_join("c.from", ",").alias("roles"))


_AN, _FI = S.ANALYSIS.replace("'", "''"), S.FINAL.replace("'", "''")
_STRIP = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_strip = lambda e: f"regexp_replace({e}, '^{_STRIP}+|{_STRIP}+\\z', '', 'g')"
_VALID = f"regexp_matches(text, '{_AN}') AND regexp_matches(text, '{_FI}')"
_think, _final = _strip(f"regexp_extract(text, '{_AN}', 1)"), _strip(f"regexp_extract(text, '{_FI}', 1)")


@query("harmony_clean", ASST + f" SELECT conv_id, turn, {_VALID} AS valid, CASE WHEN {_VALID} THEN '<think>' || chr(10) || {_think} || chr(10) || '</think>' || chr(10) || chr(10) || {_final} ELSE text END AS text FROM a")
def harmony_clean(spark, sf_dir):
    t = F.col("text")
    return answers(spark, sf_dir).select("conv_id", "turn", S.harmony_valid(t).alias("valid"), S.harmony_text(t).alias("text"))


@query("harmony_clean_no_reasoning", ASST + f" SELECT conv_id, turn, CASE WHEN {_VALID} THEN {_final} ELSE text END AS text FROM a")
def harmony_clean_no_reasoning(spark, sf_dir):
    return answers(spark, sf_dir).select("conv_id", "turn", S.harmony_text(F.col("text"), False).alias("text"))


@query("harmony_invalid_count", ASST + f" SELECT count(*) AS rows_seen, count(*) FILTER (WHERE NOT ({_VALID})) AS invalid FROM a")
def harmony_invalid_count(spark, sf_dir):
    return answers(spark, sf_dir).agg(F.count("*").alias("rows_seen"), F.count_if(~S.harmony_valid(F.col("text"))).alias("invalid"))


#: Every way in which old tags stand in a text, by conversation.
OLD_TAGS = """CASE CAST(conv_id % 15 AS INT) WHEN 0 THEN text WHEN 1 THEN '' WHEN 2 THEN '<unused94>thought' || chr(10) || text || '<unused95>' || chr(10) || 'Answer: B.'
 WHEN 3 THEN text || '<unused95>' || '**B. x**' WHEN 4 THEN '<unused94>' || text WHEN 5 THEN '<unused94>' || text || '<unused95>b<unused95>c'
 WHEN 6 THEN 'a<UNUSED94> Thought' || chr(10) || chr(10) || text || chr(10) || '<unused95>' || chr(10) || chr(10) || 'x' WHEN 7 THEN '<unused94>' || text || '<unused94>b'
 WHEN 8 THEN 'abc<unused94>' || text || chr(10) || chr(10) WHEN 9 THEN '<unused94>' || text || '</think>' WHEN 10 THEN '<unused95>x<unused94>' || text
 WHEN 11 THEN chr(10) || '<unused94>' || text || '<UNUSED95>' WHEN 12 THEN chr(10) || chr(10) || '<unused94>' || text || '<unused95>' || chr(10)
 WHEN 13 THEN chr(10) || text || '<unused95>a<unused95>' || chr(10) ELSE text || chr(10) || '<unused94> ' || chr(10) || '<unused95>' END"""
_OLD = rf"(?i)<unused94>{_STRIP}*(?:thought)?{_STRIP}*"
_PARTS = rf"(?s)^(.*?)(?i:<unused94>){_STRIP}*(?i:thought)?{_STRIP}*(.*)\z"
_THINK = f"""p AS (SELECT *, regexp_matches(text, '{_OLD}') AS st, contains(text, '<unused95>') AS en, regexp_extract(text, '{_PARTS}', 1) AS pre, regexp_extract(text, '{_PARTS}', 2) AS post FROM o),
 s AS (SELECT *, CASE WHEN text = '' THEN 'empty' WHEN NOT st AND NOT en THEN 'no_legacy_tags' WHEN st AND contains(post, '<unused95>') THEN 'paired_rewritten' WHEN NOT st THEN 'end_only_wrapped'
 ELSE 'start_only_closed' END AS status, regexp_replace(text, '{_OLD}', '<think>' || chr(10), 'g') AS opened, CASE WHEN st THEN post ELSE text END AS said FROM p),
 e AS (SELECT *, strpos(said, '<unused95>') AS spot, ltrim(replace(substr(said, strpos(said, '<unused95>') + 10), '<unused95>', ''), chr(10)) AS answer FROM s),
 f AS (SELECT *, '<think>' || chr(10) || trim(substr(said, 1, spot - 1), chr(10)) || chr(10) || '</think>' || CASE WHEN answer <> '' THEN chr(10) || answer ELSE '' END AS built FROM e),
 t AS (SELECT * EXCLUDE (text), CASE status WHEN 'paired_rewritten' THEN CASE WHEN pre <> '' THEN rtrim(pre, chr(10)) || chr(10) ELSE '' END || built WHEN 'end_only_wrapped' THEN built
 WHEN 'start_only_closed' THEN CASE WHEN contains(opened, '</think>') THEN opened ELSE rtrim(opened, chr(10)) || chr(10) || '</think>' END ELSE text END AS text FROM f)"""
_TAGGED = f"WITH o AS (SELECT conv_id, turn, {OLD_TAGS} AS text FROM conversations WHERE role = 'assistant'), {_THINK}"


def _tagged(spark, sf_dir):
    return _read(spark, sf_dir, "conversations").filter("role = 'assistant'").selectExpr("conv_id", "turn", f"{OLD_TAGS} AS text")


@query("think_tags", _TAGGED + " SELECT conv_id, turn, status, text FROM t")
def think_tags(spark, sf_dir):
    t = F.col("text")
    return _tagged(spark, sf_dir).select("conv_id", "turn", S.think_status(t).alias("status"), S.think_text(t).alias("text"))


@query("think_status_counts", _TAGGED + " SELECT status, count(*) AS n FROM t GROUP BY 1")
def think_status_counts(spark, sf_dir):
    return _tagged(spark, sf_dir).groupBy(S.think_status(F.col("text")).alias("status")).agg(F.count("*").alias("n"))


_ROLE = "CASE WHEN role = 'assistant' AND conv_id % 11 = 0 THEN 'tool' WHEN role = 'assistant' AND conv_id % 4 = 0 THEN ' GPT' ELSE role END"
_ROWS = f"""WITH o AS (SELECT conv_id, turn, {_ROLE} AS role, CASE WHEN conv_id % 13 = 0 THEN 'None' WHEN role = 'assistant' THEN {OLD_TAGS} ELSE text END AS text FROM conversations), {_THINK},
 l AS (SELECT conv_id, turn, role, lower(trim(role)) IN ('assistant', 'gpt', 'model') AS asst, status, text FROM t)"""


@query("think_rows", _ROWS + """ SELECT l.conv_id, coalesce(arg_max(l.status, l.turn) FILTER (WHERE asst), 'no_assistant_turn') AS status,
 string_agg(l.role || ':' || CASE WHEN asst THEN l.text WHEN l.conv_id % 13 = 0 THEN '' ELSE o.text END, '|' ORDER BY l.turn) AS said FROM l JOIN o ON l.conv_id = o.conv_id AND l.turn = o.turn GROUP BY l.conv_id""")
def think_rows(spark, sf_dir):
    text = F.expr(f"CASE WHEN conv_id % 13 = 0 THEN NULL WHEN role = 'assistant' THEN {OLD_TAGS} ELSE text END")
    turn = F.struct("turn", F.struct(F.expr(_ROLE).alias("from"), text.alias("value")).alias("t"))
    rows = _read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("ts"))
    row = rows.select("conv_id", T.map_with_status(F.col("ts.t"), S.think_text, S.think_status).alias("r"))
    said = F.transform("r.conversations", lambda t: F.concat(t["from"], F.lit(":"), F.coalesce(t["value"], F.lit(""))))
    return row.select("conv_id", "r.status", F.array_join(said, "|").alias("said"))


_LAST = f"upper(regexp_extract_all(text, '{S.ANSWER}', 1)[-1])"
_MATCH = f"CASE WHEN coalesce(label_letter, '') <> '' THEN coalesce({_LAST} = upper(label_letter), false) END"
_ACC = "count(*) FILTER (WHERE coalesce(label_letter, '') <> '') AS labeled, count(*) FILTER (WHERE m) AS correct, count(*) FILTER (WHERE m) * 100.0::DOUBLE / nullif(count(*) FILTER (WHERE coalesce(label_letter, '') <> ''), 0) AS pct"


def _judged(spark, sf_dir):
    return answers(spark, sf_dir).withColumn("exact_match", S.answer_matches(F.col("text"), F.col("label_letter")))


@query("accuracy", ASST + f", m AS (SELECT *, {_MATCH} AS m FROM a) SELECT {_ACC} FROM m")
def accuracy(spark, sf_dir):
    return D.accuracy(_judged(spark, sf_dir))


@query("accuracy_by_try", ASST + f", m AS (SELECT *, {_MATCH} AS m FROM a) SELECT try_count, {_ACC} FROM m GROUP BY try_count")
def accuracy_by_try(spark, sf_dir):
    return D.accuracy(_judged(spark, sf_dir), "try_count")


_CHOICE = f"""coalesce({_LAST}, nullif(regexp_extract(text, '{S.BOLD_CHOICE}', 1), ''), chr(64 + CAST(nullif(regexp_extract(text, '{S.OPTION}', 1), '') AS INT)), 'Unknown')"""


@query("choice_distribution", ASST + f" SELECT {_CHOICE} AS choice, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct FROM a GROUP BY 1")
def choice_distribution(spark, sf_dir):
    from pyspark.sql import Window

    n = answers(spark, sf_dir).groupBy(S.choose_answer(F.col("text")).alias("choice")).agg(F.count("*").alias("n"))
    return n.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


@query("reward_accuracy", ASST + f" SELECT conv_id, turn, CASE WHEN {_LAST} = upper(label_letter) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS reward FROM a")
def reward_accuracy(spark, sf_dir):
    return answers(spark, sf_dir).select("conv_id", "turn", S.reward_accuracy(F.col("text"), F.col("label_letter")).alias("reward"))


@query("reward_format", _TAGGED + " SELECT conv_id, turn, CASE WHEN contains(text, '<think>') AND contains(text, '</think>') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS reward FROM t")
def reward_format(spark, sf_dir):
    return _tagged(spark, sf_dir).select("conv_id", "turn", S.reward_format(S.think_text(F.col("text"))).alias("reward"))


@query("rewrite_assistants", CTE + " SELECT conv_id, string_agg(role || ':' || CASE WHEN role = 'assistant' THEN 'new' ELSE text END, '|' ORDER BY turn) || CASE WHEN count(*) FILTER (WHERE role = 'assistant') = 0 THEN '|assistant:new' ELSE '' END AS said FROM c GROUP BY conv_id")
def rewrite_assistants(spark, sf_dir):
    c = T.rewrite_assistants(F.col("conversations"), F.lit("new"))
    return chats(spark, sf_dir).select("conv_id", F.array_join(F.transform(c, lambda t: F.concat(t["from"], F.lit(":"), t["value"])), "|").alias("said"))


@query("role_map", CTE + " SELECT conv_id, string_agg(CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END, ',' ORDER BY turn) AS roles, count(*) FILTER (WHERE role = 'assistant') AS n_loss FROM c GROUP BY conv_id")
def role_map(spark, sf_dir):
    c = T.map_roles(F.col("conversations"), {"user": "human", "assistant": "gpt"})
    return chats(spark, sf_dir).select("conv_id", F.array_join(c["from"], ",").alias("roles"), F.size(F.filter(T.loss_mask(c), lambda x: x)).cast("long").alias("n_loss"))


_D = f"WITH d AS (SELECT *, {RUBRIC} AS rubric, {BLOCKS} AS blocks, {SINGLE} AS single FROM documents)"
_num = lambda p: f"CAST(nullif(regexp_extract(rubric, '{p.replace('(?![0-9])', '')}', 1), '') AS INT)"
_EF = f"{_num(S.DIFFICULTY)} AS eval_difficulty, {_num(S.RELEVANCE)} AS eval_relevance"
_REC = f"nullif(regexp_extract(rubric, '{S.RECOMMENDATION}', 1), '')"
_EFS = f"{_EF}, upper({_REC}[1]) || lower({_REC}[2:]) AS eval_recommendation, CASE WHEN regexp_matches(rubric, '{S.FEEDBACK}') THEN {_strip(f'regexp_extract(rubric, {chr(39)}{S.FEEDBACK}{chr(39)}, 1)')} END AS eval_feedback"


def _evaluated(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").withColumn("rubric", F.expr(RUBRIC))
    return d.select("doc_id", *[c.alias(n) for n, c in S.eval_fields(F.col("rubric")).items()])


@query("eval_fields", _D + f" SELECT doc_id, {_EFS} FROM d")
def eval_fields(spark, sf_dir):
    return _evaluated(spark, sf_dir)


_EV = _D + f", e AS (SELECT doc_id, {_EF} FROM d), f AS (SELECT e.*, l.doc_id IS NOT NULL AS has_label, l.quality FROM e LEFT JOIN labels l ON e.doc_id = l.doc_id WHERE eval_difficulty IS NOT NULL AND eval_relevance IS NOT NULL)"
_AVG = "count(*) AS n, avg(eval_difficulty) AS avg_difficulty, avg(eval_relevance) AS avg_relevance"


def _compared(spark, sf_dir):
    e = _evaluated(spark, sf_dir).filter("eval_difficulty IS NOT NULL AND eval_relevance IS NOT NULL")
    return e.join(_read(spark, sf_dir, "labels").withColumn("has", F.lit(True)), "doc_id", "left").withColumn("has_label", F.coalesce("has", F.lit(False)))


_AGGS = lambda: (F.count("*").alias("n"), F.avg("eval_difficulty").alias("avg_difficulty"), F.avg("eval_relevance").alias("avg_relevance"))


@query("eval_labeled_vs_unlabeled", _EV + f" SELECT has_label, {_AVG} FROM f GROUP BY has_label")
def eval_labeled_vs_unlabeled(spark, sf_dir):
    return _compared(spark, sf_dir).groupBy("has_label").agg(*_AGGS())


_TRY = "CASE WHEN doc_id % 9 = 0 THEN 'Unknown' ELSE CAST(1 + doc_id % 8 AS VARCHAR(9)) END"


@query("eval_by_try", _EV + f" SELECT {_TRY} AS try_count, {_AVG} FROM f GROUP BY 1")
def eval_by_try(spark, sf_dir):
    return _compared(spark, sf_dir).groupBy(F.expr(_TRY).alias("try_count")).agg(*_AGGS())


@query("eval_recommendations", _D + f", e AS (SELECT {_TRY} AS try_count, {_EF}, upper({_REC}[1]) || lower({_REC}[2:]) AS recommendation FROM d) SELECT try_count, recommendation, count(*) AS n FROM e WHERE eval_difficulty IS NOT NULL AND eval_relevance IS NOT NULL AND recommendation IS NOT NULL GROUP BY 1, 2")
def eval_recommendations(spark, sf_dir):
    """How often each recommendation is given, by try count."""
    rated = _evaluated(spark, sf_dir).filter("eval_difficulty IS NOT NULL AND eval_relevance IS NOT NULL AND eval_recommendation IS NOT NULL")
    return rated.groupBy(F.expr(_TRY).alias("try_count"), F.col("eval_recommendation").alias("recommendation")).agg(F.count("*").alias("n"))


_PAIRS = _D + f", p AS (SELECT doc_id, unnest(list_zip(regexp_extract_all(blocks, '{S.QA}', 1), regexp_extract_all(blocks, '{S.QA}', 2))) AS z FROM d)"
_qz, _az = _strip("z[1]"), _strip("z[2]")


@query("qa_blocks", _PAIRS + f" SELECT doc_id, {_qz} AS question, {_az} AS answer FROM p WHERE {_qz} <> '' AND {_az} <> ''")
def qa_blocks(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select("doc_id", F.explode(S.qa_pairs(F.expr(BLOCKS))).alias("p"))
    return d.select("doc_id", "p.question", "p.answer")


@query("qa_yield", _PAIRS + f" SELECT (SELECT count(*) FROM d) AS requested, count(*) AS extracted FROM p WHERE {_qz} <> '' AND {_az} <> ''")
def qa_yield(spark, sf_dir):
    d = _read(spark, sf_dir, "documents")
    return d.agg(F.count("*").alias("requested"), F.coalesce(F.sum(F.size(S.qa_pairs(F.expr(BLOCKS))).cast("long")), F.lit(0).cast("long")).alias("extracted"))


@query("qa_single", "SELECT doc_id, lang AS question, source AS answer FROM documents")
def qa_single(spark, sf_dir):
    q, a = S.single_qa(S.final_channel(F.col("single")))
    return _read(spark, sf_dir, "documents").withColumn("single", F.expr(SINGLE)).select("doc_id", q.alias("question"), a.alias("answer"))


ABC = "CASE WHEN doc_id % 6 = 0 THEN 'b' WHEN doc_id % 6 = 1 THEN ' C ' END"
TRUE_LABEL = "CASE WHEN doc_id % 6 = 2 THEN 'option 3' WHEN doc_id % 6 = 3 THEN 'NaN' WHEN doc_id % 6 = 4 THEN lang END"
IDX_ = "CASE WHEN doc_id % 6 = 5 THEN CAST(doc_id % 29 AS INT) END"
_CL = f"""WITH d AS (SELECT doc_id, lang, doc_id % 6 AS k, doc_id % 29 AS i FROM documents),
 c AS (SELECT doc_id, CASE WHEN k = 0 THEN 'B' WHEN k IN (1, 2) THEN 'C' WHEN k = 5 AND i <= 25 THEN chr(65 + CAST(i AS INT)) END AS label_letter, CASE WHEN k = 4 THEN lang END AS label_text FROM d)"""


def _condensed(spark, sf_dir):
    d = _read(spark, sf_dir, "documents")
    letter = D.condensed_letter(F.expr(ABC), F.lit(None).cast("string"), F.expr(TRUE_LABEL), F.expr(IDX_))
    return d.select("doc_id", letter.alias("label_letter"), D.condensed_text(F.lit(None).cast("string"), F.expr(TRUE_LABEL)).alias("label_text"))


@query("condense_labels", _CL + " SELECT * FROM c")
def condense_labels(spark, sf_dir):
    return _condensed(spark, sf_dir)


_SR = "WITH n AS (SELECT source AS path, count(*) AS n FROM documents GROUP BY source), r AS (SELECT path, CAST(sum(n) OVER (ORDER BY path) AS BIGINT) - n AS range_start, CAST(sum(n) OVER (ORDER BY path) AS BIGINT) - 1 AS range_end FROM n)"


def _ranges(spark, sf_dir):
    n = _read(spark, sf_dir, "documents").groupBy(F.col("source").alias("path")).agg(F.count("*").alias("n"))
    return D.source_ranges(n.withColumn("pos", F.col("path"))).drop("pos")


@query("source_ranges", _SR + " SELECT * FROM r")
def source_ranges(spark, sf_dir):
    return _ranges(spark, sf_dir)


@query("range_attribution", _SR + " SELECT doc_id, path, doc_id - range_start AS source_index FROM documents LEFT JOIN r ON doc_id BETWEEN range_start AND range_end")
def range_attribution(spark, sf_dir):
    return D.attribute_rows(_read(spark, sf_dir, "documents").select("doc_id"), _ranges(spark, sf_dir), "doc_id")


@query("condense_stats", _CL + _SR.replace("WITH n AS", ", n AS") + " SELECT count(*) AS written, count(label_letter) AS with_letter, count(label_text) AS with_text, count(path) AS with_path, count(path) AS with_index, count(*) FILTER (WHERE label_letter IS NULL AND label_text IS NULL) AS without_label FROM c LEFT JOIN r ON c.doc_id BETWEEN range_start AND range_end")
def condense_stats(spark, sf_dir):
    rows = D.attribute_rows(_condensed(spark, sf_dir), _ranges(spark, sf_dir), "doc_id")
    return D.condense_counts(rows.withColumnRenamed("path", "source_path"))


_JSON_INDEX = "CASE CAST(doc_id % 8 AS INT) WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN '\"1\"' WHEN 3 THEN '2.0' WHEN 4 THEN 'null' WHEN 5 THEN '-1' ELSE '' || doc_id % 31 END"


@query("index_letters", "SELECT doc_id, CASE WHEN doc_id % 8 = 0 THEN 'B' WHEN doc_id % 8 = 1 THEN 'A' WHEN doc_id % 8 > 5 AND doc_id % 31 < 26 THEN chr(65 + CAST(doc_id % 31 AS INT)) END AS letter FROM documents")
def index_letters(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", S.json_index_letter(F.expr(_JSON_INDEX)).alias("letter"))


_TRUE = """CASE WHEN doc_id % 3 = 0 THEN ',"true_label":"b"' WHEN doc_id % 3 = 1 THEN ',"true_label":[1,"c"]' ELSE '' END"""
_GOLD = "CASE WHEN doc_id % 2 = 0 THEN '{\"a\":1.5}' ELSE '\"' || lang || '\"' END"
_LABELLED = f"""'{{"doc_id":' || doc_id || ',"split":"train"' || CASE WHEN doc_id % 5 < 3 THEN ',"my_label":' || doc_id % 7 ELSE '' END || {_TRUE} || CASE WHEN doc_id % 4 = 0 THEN ',"gold":' || {_GOLD} || ',"label":true' ELSE ',"label":' || doc_id % 11 || ',"gold":' || {_GOLD} END
 || ',"question_id":4,"answer":' || CASE WHEN doc_id % 2 = 0 THEN 'null' ELSE '[]' END || '}}'"""
_LABEL = "CASE WHEN doc_id % 4 = 0 THEN 'true' ELSE CAST(doc_id % 11 AS VARCHAR(9)) END"
_MINE = """CASE WHEN doc_id % 5 < 3 THEN ',"my_label":' || doc_id % 7 ELSE '' END"""


@query("drop_label_fields", f"""SELECT doc_id, '{{"answer":' || CASE WHEN doc_id % 2 = 0 THEN 'null' ELSE '[]' END || ',"doc_id":' || doc_id || ',"gold":' || {_GOLD} || ',"label":' || {_LABEL} || {_MINE} || '}}' AS line FROM documents""")
def drop_label_fields(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", K.to_line(K.without(K.entries(F.expr(_LABELLED)))).alias("line"))


@query("core_labels_first", f"""SELECT doc_id, '{{' || substr({_TRUE} || ',"label":' || {_LABEL} || CASE WHEN doc_id % 2 = 0 THEN '' ELSE ',"answer":[]' END || ',"gold":' || {_GOLD} || {_MINE}, 2) || '}}' AS line FROM documents""")
def core_labels_first(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", K.to_line(K.labels_of(K.entries(F.expr(_LABELLED))), K.CORE).alias("line"))


_EN = "WITH e AS (SELECT d.doc_id, quality, toxic, CASE WHEN l.doc_id IS NULL THEN 'source_lookup_miss' WHEN quality IS NULL AND toxic IS NULL THEN 'source_row_without_labels' ELSE 'enriched' END AS lookup FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def _enriched(spark, sf_dir):
    return D.enrich(_read(spark, sf_dir, "documents").select("doc_id"), _read(spark, sf_dir, "labels"), ["doc_id"], ["quality", "toxic"])


@query("enrich_labels", _EN + " SELECT * FROM e")
def enrich_labels(spark, sf_dir):
    return _enriched(spark, sf_dir)


@query("enrich_stats", _EN + " SELECT lookup, count(*) AS n FROM e GROUP BY lookup")
def enrich_stats(spark, sf_dir):
    return _enriched(spark, sf_dir).groupBy("lookup").agg(F.count("*").alias("n"))


_KIND = "CASE WHEN event_id % 5 = 0 THEN ' ' WHEN event_id % 5 = 1 THEN props || '}' WHEN event_id % 5 = 2 THEN '[1]' WHEN event_id % 5 = 3 THEN '{\"conversations\": []}' ELSE props END"


@query("reject_reasons", "SELECT CASE event_id % 5 WHEN 0 THEN 'blank' WHEN 1 THEN 'invalid' WHEN 2 THEN 'non_object' WHEN 3 THEN 'good' ELSE 'no_conversations' END AS reject, count(*) AS n FROM events GROUP BY 1")
def reject_reasons(spark, sf_dir):
    from chatloom.sources.jsonl import classify_lines

    lines = classify_lines(_read(spark, sf_dir, "events").select(F.expr(_KIND).alias("raw")))
    return lines.groupBy(F.coalesce("reject", F.lit("good")).alias("reject")).agg(F.count("*").alias("n"))


_PAGE_ROW = """CASE CAST(page_id % 3 AS INT) WHEN 0 THEN '{"id":"' || url || '"}' WHEN 1 THEN '{"id":" ","distilled_source_path":"' || url || '","distilled_source_index":' || page_id || '}' ELSE '{"id":7}' END"""


@query("fallback_id", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url WHEN page_id % 3 = 1 THEN regexp_extract(url, '([^/]+)/*$', 1) || ':' || page_id ELSE 'line:' || (page_id + 1) END AS id FROM pages")
def fallback_id(spark, sf_dir):
    row = K.entries(F.expr(_PAGE_ROW))
    return _read(spark, sf_dir, "pages").select("page_id", V.row_id(row, F.col("page_id") + 1).alias("id"))


@query("mix_union", "SELECT 'chat' AS dataset, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations UNION ALL SELECT 'completion', count(*), CAST(sum(length(text)) AS BIGINT) FROM documents UNION ALL SELECT 'exam', count(*), CAST(sum(length(text)) AS BIGINT) FROM benchmark")
def mix_union(spark, sf_dir):
    parts = {"chat": _read(spark, sf_dir, "conversations"), "completion": _read(spark, sf_dir, "documents").select("doc_id", "text"), "exam": _read(spark, sf_dir, "benchmark")}
    return D.union_datasets(parts).groupBy("dataset").agg(F.count("*").alias("n"), F.sum(F.length("text").cast("long")).alias("chars"))


_H = "((doc_id % 2147483648) * 2654435761 + 42) % 4294967296"


@query("val_split", f"WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {_H}, doc_id) AS k, count(*) OVER () AS n FROM documents) SELECT doc_id, k <= n // 20 AS held_out FROM r")
def val_split(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select("doc_id")
    return D.smallest(d, D.arithmetic_hash(F.col("doc_id"), 42), d.count() // 20, "doc_id").withColumnRenamed("chosen", "held_out")


_LOG = """SELECT event_type || '-' || (event_id % 40) AS file, event_id AS line_no, CASE WHEN j = 2 AND event_id % 8 = 7 THEN 'CUBLAS_STATUS_ALLOC_FAILED' WHEN j = 3 AND event_id % 8 = 0 THEN 'CUDA out of memory'
 WHEN j = 4 AND event_id % 8 = 1 THEN 'loss NaN.' WHEN j = 4 AND event_id % 8 = 2 THEN 'OSError: Too many open files' WHEN j = 5 AND event_id % 8 IN (1, 2, 3, 4) THEN 'Training completed ' || event_id
 WHEN j = 6 AND event_id % 5 < 2 THEN 'Exit code: ' || (event_id % 5) WHEN j = 7 AND event_id % 4 = 1 THEN 'MODEL_PATH=/m/' || event_id WHEN j = 8 AND event_id % 4 IN (1, 2) THEN 'args pretrained=/p/' || event_id || ',dtype=x'
 WHEN j = 9 AND event_id % 10 = 0 THEN '00:01:' || (10 + event_id % 50) || ' elapsed' WHEN j = 10 AND event_id % 10 IN (0, 5) THEN 'Elapsed: 01:00:00 then 02:00:' || (10 + event_id % 50) ELSE 'finance ' || props END AS value
 FROM (SELECT *, CAST(floor(event_id / 40) AS BIGINT) % 11 AS j FROM events)"""
_TIME = "[0-9]{2}:[0-9]{2}:[0-9]{2}"
_CLASS = lambda p: f"arg_min(value, line_no) FILTER (WHERE regexp_matches(value, '{p}'))"
_LS = f"""WITH l AS ({_LOG}), s AS (SELECT file, arg_max(regexp_extract(value, 'Exit code: ([0-9]+)', 1), line_no) FILTER (WHERE value LIKE 'Exit code: %') AS exit_code,
 arg_min(substr(value, 12), line_no) FILTER (WHERE value LIKE 'MODEL_PATH=%') AS named, arg_min(regexp_extract(value, 'pretrained=([^, ]+)', 1), line_no) FILTER (WHERE value LIKE '%pretrained=%') AS pretrained,
 arg_max(regexp_extract_all(value, '{_TIME}')[-1], line_no) FILTER (WHERE value ILIKE '%elapsed%') AS elapsed, {_CLASS("(?i)alloc_failed|out of memory")} AS oom, {_CLASS("(?i)(^|[^a-z0-9_])nan([^a-z0-9_]|$)")} AS nan,
 {_CLASS("(?i)too many open files")} AS files, {_CLASS("(?i)training completed")} AS finished, count(*) AS n_lines FROM l GROUP BY file),
 t AS (SELECT file, CASE WHEN exit_code = '0' THEN 'COMPLETED' WHEN exit_code IS NOT NULL THEN 'FAILED' ELSE 'UNKNOWN' END AS status, CASE WHEN oom IS NOT NULL THEN 'OOM' WHEN nan IS NOT NULL THEN 'NAN'
 WHEN files IS NOT NULL THEN 'FILES' WHEN finished IS NOT NULL THEN 'FINISHED' ELSE 'IDK' END AS error_class, coalesce(oom, nan, files, finished) AS error_line, exit_code,
 coalesce(named, pretrained, 'UNKNOWN') AS model_path, elapsed, n_lines FROM s)"""


def _summary(spark, sf_dir):
    return L.summarise(_of_events(spark, sf_dir, _LOG))


@query("log_summary", _LS + " SELECT * FROM t")
def log_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@query("completed_reports", _LS + " SELECT file, model_path FROM t WHERE status = 'COMPLETED'")
def completed_reports(spark, sf_dir):
    return L.completed(_summary(spark, sf_dir)).select("file", "model_path")


_TABLE = "CASE WHEN event_id % 97 = 0 THEN '|Tasks  |n|' WHEN event_id % 97 IN (1, 2) THEN '|t|' || event_id || '|' WHEN event_id % 97 = 50 THEN '|late|' ELSE 'x' END"


@query("first_tables", f"WITH l AS (SELECT event_id // 500 AS file, event_id AS line_no, {_TABLE} AS value FROM events), h AS (SELECT file, min(line_no) AS h FROM l WHERE value LIKE '|Tasks%' GROUP BY file), e AS (SELECT l.file, h, min(line_no) FILTER (WHERE line_no > h AND value NOT LIKE '|%') AS e FROM l JOIN h ON l.file = h.file GROUP BY l.file, h) SELECT l.file, line_no, value FROM l JOIN e ON l.file = e.file WHERE line_no >= h AND (e IS NULL OR line_no < e)")
def first_tables(spark, sf_dir):
    return L.first_tables(_read(spark, sf_dir, "events").selectExpr("event_id div 500 AS file", "event_id AS line_no", f"{_TABLE} AS value"))


@query("invalid_rate", "WITH d AS (SELECT CASE WHEN doc_id % 3 = 0 THEN '[Invalid] ' || text || '[invalid]' ELSE text END AS t FROM documents) SELECT CAST(sum(len(regexp_extract_all(t, '(?i)\\[invalid\\]'))) AS BIGINT) AS invalid, count(*) AS lines, sum(len(regexp_extract_all(t, '(?i)\\[invalid\\]'))) * 100.0::DOUBLE / count(*) AS pct FROM d")
def invalid_rate(spark, sf_dir):
    t = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("[Invalid] "), "text", F.lit("[invalid]"))).otherwise(F.col("text"))
    hits = F.sum(F.regexp_count(t, F.lit(r"(?i)\[invalid\]")).cast("long"))
    return _read(spark, sf_dir, "documents").agg(hits.alias("invalid"), F.count("*").alias("lines"), F.try_divide(hits * 100.0, F.count("*")).alias("pct"))


@query("loss_bins", "WITH r AS (SELECT min(event_id) AS x0, max(event_id) AS x1, min(value) AS y0, max(value) AS y1 FROM events) SELECT CAST(trunc((event_id - x0) / (x1 - x0)::DOUBLE * 79) AS INT) AS bin_x, CAST(trunc((value - y0) / (y1 - y0) * 19) AS INT) AS bin_y, count(*) AS n FROM events, r GROUP BY 1, 2")
def loss_bins(spark, sf_dir):
    return L.bins(_read(spark, sf_dir, "events"), "event_id", "value", 80, 20)


def _stub(attempt: int) -> Column:
    return F.expr(f"'Answer: ' || chr(65 + CAST((conv_id + {attempt}) % 5 AS INT))")


@query("retry_rounds", CTE + IDX + " , q AS (SELECT c.conv_id, c.label_letter, CASE WHEN c.label_letter IS NULL THEN 1 ELSE 5 END AS tries FROM c JOIN i ON c.conv_id = i.conv_id AND c.turn = i.a) SELECT conv_id, CASE WHEN label_letter IS NULL THEN NULL ELSE true END AS exact_match, tries AS try_count FROM q")
def retry_rounds(spark, sf_dir):
    c = chats(spark, sf_dir).filter(T.assistant_index(F.col("conversations")).isNotNull())
    rows = c.select("conv_id", "label_letter", F.lit("").alias("value"), F.lit(False).alias("exact_match"), F.lit(0).alias("try_count"))
    return D.retry_rounds(rows, _stub, S.answer_matches, 8).select("conv_id", "exact_match", "try_count")


def _make(prompts: list, attempt: int) -> list:
    """A stand-in for a model: the letter moves on with every attempt."""
    return [f" Answer: {'ABCDE'[(len(p) + attempt) % 5]}\n" for p in prompts]


@query("distill_rounds", CTE + IDX + """, q AS (SELECT i.conv_id, length(c.text) AS n, i.conv_id % 5 AS want, c.label_letter FROM i LEFT JOIN c ON c.conv_id = i.conv_id AND c.turn = i.u WHERE i.conv_id % 10 <> 9),
 k AS (SELECT *, CASE WHEN label_letter IS NULL THEN 1 WHEN (want - n % 5 + 5) % 5 = 0 THEN 5 ELSE (want - n % 5 + 5) % 5 END AS tries FROM q)
 SELECT conv_id, CASE WHEN tries > 3 THEN 3 ELSE tries END AS try_count, CASE WHEN label_letter IS NOT NULL THEN tries <= 3 END AS exact_match,
 'Answer: ' || substr('ABCDE', CAST((n + CASE WHEN tries > 3 THEN 3 ELSE tries END) % 5 + 1 AS INT), 1) AS value FROM k
 UNION ALL SELECT conv_id, 0, false, NULL FROM i WHERE conv_id % 10 = 9""")
def distill_rounds(spark, sf_dir):
    """Three attempts of a generator; conversations without a user turn are never tried."""
    conv = F.col("conversations")
    prompt = F.when(F.col("conv_id") % 10 != 9, T.first_value(conv, T.user_index(conv)))
    none = {t: F.lit(None).cast(t) for t in ("string", "boolean", "int")}
    rows = chats(spark, sf_dir).select("conv_id", "label_letter", prompt.alias("prompt"), none["string"].alias("value"), none["boolean"].alias("exact_match"), none["int"].alias("try_count"))
    done = D.distill(rows, _make, S.answer_matches, 3, f"{scratch_dir(spark)}/chatloom-{uuid.uuid4().hex}")
    return done.select("conv_id", "try_count", "exact_match", "value")


_POOL = CTE + IDX + f", p AS (SELECT q.conv_id, {_strip('q.text')} AS question, {_strip('w.text')} AS answer, q.label_letter IS NOT NULL AS labeled FROM i JOIN c q ON q.conv_id = i.conv_id AND q.turn = i.u JOIN c w ON w.conv_id = i.conv_id AND w.turn = i.a)"


def _pools(spark, sf_dir):
    return D.qa_pools(chats(spark, sf_dir).select("conv_id", "conversations", "label_letter"))


@query("qa_pools", _POOL + " SELECT * FROM p")
def qa_pools(spark, sf_dir):
    return _pools(spark, sf_dir).drop("label_letter")


_DRAW1 = lambda j: f"((((prompt % 2147483648) * 2654435761 + 42) % 4294967296 + ({j}) * 40503) % 4294967296) % (({j}) + 1)"


@query("pool_prompts", _POOL + f""", n AS (SELECT *, row_number() OVER (PARTITION BY labeled ORDER BY ((conv_id % 2147483648) * 2654435761 + 42) % 4294967296, conv_id) - 1 AS place, count(*) OVER (PARTITION BY labeled) AS n FROM p),
 r AS (SELECT labeled, n, unnest(range(CAST(floor(n * 1.5) AS BIGINT))) AS prompt FROM (SELECT DISTINCT labeled, n FROM n)), d AS (SELECT *, {_DRAW1("n - 2")} AS x0, {_DRAW1("n - 1")} AS t1 FROM r),
 s AS (SELECT labeled, prompt, 0 AS shot, x0 AS place FROM d UNION ALL SELECT labeled, prompt, 1, CASE WHEN t1 = x0 THEN n - 1 ELSE t1 END FROM d)
 SELECT s.labeled, prompt, shot, conv_id FROM s JOIN n ON s.labeled = n.labeled AND s.place = n.place""")
def pool_prompts(spark, sf_dir):
    return D.pool_prompts(_pools(spark, sf_dir), "conv_id", 1.5, 2).select("labeled", "prompt", "shot", "conv_id")


@query("expected_pairs", "SELECT count(*) AS documents, count(*) * 10 AS expected FROM documents WHERE text IS NOT NULL")
def expected_pairs(spark, sf_dir):
    return D.expected_pairs(_read(spark, sf_dir, "documents").filter("text IS NOT NULL"))


_AGREED = "CASE CAST(doc_id % 4 AS INT) WHEN 0 THEN 'fail' WHEN 1 THEN 'pass' WHEN 2 THEN 'unknown' END"


@query("not_failed", f"SELECT doc_id FROM documents WHERE {_AGREED} IS DISTINCT FROM 'fail'")
def not_failed(spark, sf_dir):
    return D.not_failed(_read(spark, sf_dir, "documents").withColumn("label_agreement", F.expr(_AGREED))).select("doc_id")


@query("durations", "SELECT event_id, lpad('' || CAST(floor(event_id * 7 / 3600) AS BIGINT), CAST(greatest(2, length('' || CAST(floor(event_id * 7 / 3600) AS BIGINT))) AS INT), '0') || ':' || lpad('' || CAST(floor(event_id * 7 / 60) AS BIGINT) % 60, 2, '0') || ':' || lpad('' || (event_id * 7) % 60, 2, '0') AS took FROM events")
def durations(spark, sf_dir):
    return _read(spark, sf_dir, "events").select("event_id", S.duration(F.col("event_id") * 7).alias("took"))


@query("safe_tags", "SELECT page_id, regexp_replace(regexp_replace(lower(regexp_extract('/m/_' || replace(url, 'e', ' É'), '([^/]*)$', 1)), '[^a-z0-9_.-]', '_', 'g'), '^_|_$', '', 'g') AS tag FROM pages")
def safe_tags(spark, sf_dir):
    return _read(spark, sf_dir, "pages").select("page_id", S.safe_tag(F.concat(F.lit("/m/_"), F.replace("url", F.lit("e"), F.lit(" É")))).alias("tag"))


@query("clean_accuracy", CTE + IDX + f", a AS (SELECT c.* FROM c JOIN i ON c.conv_id = i.conv_id AND c.turn = i.a) SELECT count(*) FILTER (WHERE coalesce(label_letter, '') <> '') AS labeled, count(*) FILTER (WHERE {_MATCH}) AS correct, count(*) FILTER (WHERE NOT ({_VALID})) AS invalid FROM a")
def clean_accuracy(spark, sf_dir):
    """The whole cleaning plan: find the answer, turn channels into think tags, drop system turns, count."""
    c = F.col("conversations")
    rows = chats(spark, sf_dir).withColumn("at", T.assistant_index(c)).filter("at IS NOT NULL").withColumn("said", F.get(c["value"], F.col("at")))
    rows = rows.withColumn("conversations", T.drop_system(T.set_value(c, F.col("at"), S.harmony_text(F.col("said")))))
    rows = rows.withColumn("exact_match", S.answer_matches(F.col("said"), F.col("label_letter")))
    labeled = F.count_if(F.coalesce("label_letter", F.lit("")) != "")
    return rows.agg(labeled.alias("labeled"), F.count_if("exact_match").alias("correct"), F.count_if(~S.harmony_valid(F.col("said"))).alias("invalid"))


_OWN = "'{\"doc_id\":' || doc_id || CASE doc_id % 4 WHEN 0 THEN '}' WHEN 1 THEN ',\"label\":\"nan\"}' WHEN 2 THEN ',\"label\":0}' ELSE ',\"label\":null}' END"
_SOURCE = "'{\"label\":' || coalesce(quality, 0) || ',\"gold_answer\":' || coalesce(toxic, 0) || ',\"note\":1,\"label_agreement\":\"x\"}'"
_MERGED = "'{\"doc_id\":' || doc_id || ',\"gold_answer\":' || t || ',\"label\":' || q || '}'"
_OK = "WITH e AS (SELECT d.doc_id, coalesce(quality, 0) AS q, coalesce(toxic, 0) AS t, d.doc_id % 4 AS k FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


def _merged(spark, sf_dir, keep: bool):
    d = _read(spark, sf_dir, "documents").select("doc_id", F.expr(_OWN).alias("own"))
    s = _read(spark, sf_dir, "labels").select("doc_id", F.expr(_SOURCE).alias("source_raw"))
    rows = d.join(s, "doc_id").withColumns({"own": K.entries(F.col("own")), "copied": K.labels_of(K.entries(F.col("source_raw")))})
    m = K.merge(F.col("own"), F.col("copied"), keep)
    return rows.select("doc_id", "source_raw", m["merged"].alias("merged"), m["added"].alias("added"), m["overwritten"].alias("overwritten"))


@query("merge_open_keys", _OK + f" SELECT doc_id, {_MERGED} AS line, CAST(CASE WHEN k = 0 THEN 2 ELSE 1 END AS BIGINT) AS added, CAST(CASE WHEN k = 2 AND q <> 0 THEN 1 ELSE 0 END AS BIGINT) AS overwritten FROM e")
def merge_open_keys(spark, sf_dir):
    return _merged(spark, sf_dir, False).select("doc_id", K.to_line(F.col("merged")).alias("line"), "added", "overwritten")


@query("merge_open_keys_keep", _OK.replace("coalesce(quality, 0) AS q", "CASE WHEN d.doc_id % 4 = 2 THEN 0 ELSE coalesce(quality, 0) END AS q") + f" SELECT doc_id, {_MERGED} AS line, CAST(CASE WHEN k = 0 THEN 2 ELSE 1 END AS BIGINT) AS added, CAST(0 AS BIGINT) AS overwritten FROM e")
def merge_open_keys_keep(spark, sf_dir):
    return _merged(spark, sf_dir, True).select("doc_id", K.to_line(F.col("merged")).alias("line"), "added", "overwritten")


@query("embed_source_rows", f"WITH e AS (SELECT doc_id, {_SOURCE} AS r FROM labels) SELECT doc_id, '{{\"doc_id\":' || doc_id || ',\"source_row_payload\":' || r || ',\"source_row_raw_json\":\"' || replace(r, '\"', chr(92) || '\"') || '\"}}' AS line FROM e")
def embed_source_rows(spark, sf_dir):
    own = K.entries(F.concat(F.lit('{"doc_id":'), "doc_id", F.lit("}")))
    return _read(spark, sf_dir, "labels").select("doc_id", K.to_line(K.embed(own, F.expr(_SOURCE))).alias("line"))


_DRAW = lambda p, j: f"((({p} % 2147483648) * 2654435761 + 42) % 4294967296 + ({j}) * 40503) % 4294967296 % (({j}) + 1)"
_FS = f"""WITH b AS (SELECT item_id, row_number() OVER (ORDER BY {_H.replace("doc_id", "item_id")}, item_id) - 1 AS place FROM benchmark), n AS (SELECT count(*) AS n FROM benchmark),
 a AS (SELECT doc_id, n, {_DRAW("doc_id", "n - 3")} AS x0, {_DRAW("doc_id", "n - 2")} AS t1, {_DRAW("doc_id", "n - 1")} AS t2 FROM documents, n),
 c AS (SELECT *, CASE WHEN t1 = x0 THEN n - 2 ELSE t1 END AS x1 FROM a), d AS (SELECT *, CASE WHEN t2 IN (x0, x1) THEN n - 1 ELSE t2 END AS x2 FROM c),
 s AS (SELECT doc_id, 0 AS shot, x0 AS place FROM d UNION ALL SELECT doc_id, 1, x1 FROM d UNION ALL SELECT doc_id, 2, x2 FROM d)"""


@query("few_shot", _FS + " SELECT doc_id, CAST(shot AS INT) AS shot, item_id FROM s JOIN b ON s.place = b.place")
def few_shot(spark, sf_dir):
    return P.few_shot(_read(spark, sf_dir, "documents").select("doc_id"), "doc_id", _read(spark, sf_dir, "benchmark").select("item_id"), "item_id", 3)


_RAW = "CASE doc_id % 4 WHEN 0 THEN '{\"resps\": [[\"' || lang || '\"]]}' WHEN 1 THEN '{\"resps\": [\"' || lang || lang || '\"]}' WHEN 2 THEN '{\"resps\": []}' ELSE 'no json' END"


@query("first_responses", "WITH s AS (SELECT coalesce(source, '') AS file, doc_id, CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN lang || lang END AS said FROM documents) SELECT file, arg_min(said, doc_id) AS first_response, CAST(length(arg_min(said, doc_id)) AS BIGINT) AS first_chars, count(*) AS n, avg(length(said)) AS mean_chars FROM s WHERE said <> '' GROUP BY file")
def first_responses(spark, sf_dir):
    d = _read(spark, sf_dir, "documents")
    return L.first_responses(d.select(F.coalesce("source", F.lit("")).alias("file"), F.col("doc_id").alias("line_no"), F.expr(_RAW).alias("raw")))


def _states(spark, sf_dir):
    path = "'/m/' || event_type || '/checkpoint-' || event_id || '/trainer_state.json' AS path"
    log = "array(named_struct('step', event_id, 'loss', CASE WHEN event_id % 3 <> 0 THEN value END, 'eval_loss', CASE WHEN event_id % 3 <> 1 THEN value END)) AS log_history"
    return _read(spark, sf_dir, "events").selectExpr(path, log)


@query("loss_points", "WITH e AS (SELECT '/m/' || event_type || '/checkpoint-' || event_id || '/trainer_state.json' AS path, event_id AS step, value FROM events WHERE value IS NOT NULL) SELECT path, step, 'loss' AS series, value FROM e WHERE step % 3 <> 0 UNION ALL SELECT path, step, 'eval_loss', value FROM e WHERE step % 3 <> 1")
def loss_points(spark, sf_dir):
    return R.loss_points(_states(spark, sf_dir))


@query("latest_states", "SELECT '/m/' || event_type AS model, '/m/' || event_type || '/checkpoint-' || max(event_id) || '/trainer_state.json' AS path FROM events GROUP BY event_type")
def latest_states(spark, sf_dir):
    return R.latest_states(_states(spark, sf_dir)).select("model", "path")


_ERR = "SELECT event_type AS file, event_id + 1 AS line_no, CASE WHEN event_type = 'click' AND event_id % 301 = 0 THEN 'Traceback' WHEN event_id % 307 = 0 THEN 'ValueError x' || event_id WHEN event_id % 311 = 0 THEN 'run FAILED' ELSE 'fine' END AS value FROM events"


@query("error_lines", f"WITH l AS ({_ERR}), b AS (SELECT file, min(line_no) AS b FROM l WHERE value = 'Traceback' GROUP BY file) SELECT l.file, coalesce(arg_max(value, line_no) FILTER (WHERE value LIKE '%Error%' AND line_no >= b), arg_min(line_no || ':' || value, line_no) FILTER (WHERE value LIKE '%FAILED%'), 'UNKNOWN') AS error FROM l LEFT JOIN b ON l.file = b.file GROUP BY l.file")
def error_lines(spark, sf_dir):
    return L.error_lines(_of_events(spark, sf_dir, _ERR))


@query("missing_keys", f"WITH k AS (SELECT doc_id % 4 AS k FROM documents) SELECT 'doc_id' AS key, CAST(0 AS BIGINT) AS missing UNION ALL SELECT 'label', count(*) FILTER (WHERE k = 0) FROM k UNION ALL SELECT 'id', count(*) FROM k")
def missing_keys(spark, sf_dir):
    return L.missing_keys(_read(spark, sf_dir, "documents").select(F.expr(_OWN).alias("raw")), ["doc_id", "label", "id"])


_text = lambda x: "'" + x.replace(chr(10), "' || chr(10) || '") + "'"
_LOOSE = "text"
for _mark, _new in S.FALLBACK.items():
    _LOOSE = f"replace({_LOOSE}, {_text(_mark)}, {_text(_new)})"


@query("harmony_fallback", ASST + f" SELECT conv_id, turn, CASE WHEN {_VALID} THEN '<think>' || chr(10) || {_think} || chr(10) || '</think>' || chr(10) || chr(10) || {_final} ELSE {_strip(_LOOSE)} END AS text FROM a")
def harmony_fallback(spark, sf_dir):
    return answers(spark, sf_dir).select("conv_id", "turn", S.harmony_fallback(F.col("text")).alias("text"))


_DA = """CASE doc_id % 5 WHEN 0 THEN '{"distilled_answer_b":"' || lang || '","distilled_answer_a":5}' WHEN 1 THEN '{"distilled_answer":"","distilled_answer_a":"x"}'
 WHEN 2 THEN '{"mine":"' || lang || 'm","distilled_answer":"y"}' WHEN 3 THEN '{"mine":7,"distilled_answer_z":"z","distilled_answer_c":"c"}' ELSE '{"distilled_answer":null}' END"""


@query("pick_answer", "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN lang WHEN 2 THEN lang || 'm' WHEN 3 THEN 'c' ELSE '' END AS answer FROM documents")
def pick_answer(spark, sf_dir):
    row = K.entries(F.expr(_DA))
    return _read(spark, sf_dir, "documents").select("doc_id", K.pick_answer(row, "mine").alias("answer"))


_INDEX = """CASE doc_id % 7 WHEN 0 THEN '" ' || doc_id || ' "' WHEN 1 THEN doc_id || '.7' WHEN 2 THEN 'true' WHEN 3 THEN '"1_' || doc_id || '"' WHEN 4 THEN '"12.5"' WHEN 5 THEN 'null' ELSE '' || doc_id END"""


@query("whole_indexes", "SELECT doc_id, CASE WHEN doc_id % 7 IN (0, 1, 6) THEN doc_id WHEN doc_id % 7 = 2 THEN 1 WHEN doc_id % 7 = 3 THEN CAST('1' || doc_id AS BIGINT) END AS source_index FROM documents")
def whole_indexes(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", K.integer_of(F.expr(_INDEX)).alias("source_index"))


_ID = """CASE doc_id % 5 WHEN 0 THEN '{"id": "' || lang || '"}' WHEN 1 THEN '{"id": ' || doc_id || '.0}' WHEN 2 THEN '{"id": null}' WHEN 3 THEN '{"id": true}' ELSE '{"x": 1}' END"""


@query("id_texts", "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN lang WHEN 1 THEN doc_id || '.0' WHEN 2 THEN 'None' WHEN 3 THEN 'True' END AS id FROM documents")
def id_texts(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", K.id_text(F.expr(_ID)).alias("id"))


@query("drop_empty_answers", CTE + ", b AS (SELECT conv_id, arg_min(CASE WHEN conv_id % 9 = 0 THEN ' ' ELSE text END, turn) FILTER (WHERE role = 'assistant') AS said, count(*) AS n FROM c GROUP BY conv_id) SELECT conv_id, n, said FROM b WHERE trim(said) <> ''")
def drop_empty_answers(spark, sf_dir):
    blank = T.map_assistants(F.col("conversations"), lambda v: F.when(F.col("conv_id") % 9 == 0, F.lit(" ")).otherwise(v))
    c = chats(spark, sf_dir).withColumn("conversations", blank).withColumn("said", T.first_assistant_text(F.col("conversations")))
    return c.filter(S.strip(F.col("said")) != "").select("conv_id", F.size("conversations").cast("long").alias("n"), "said")


@query("set_system", CTE + IDX + " SELECT c.conv_id, c.turn, CASE WHEN i.s0 = c.turn AND (i.a IS NULL OR i.s0 < i.a) THEN 'Reasoning: low' ELSE c.text END AS text FROM c JOIN i ON c.conv_id = i.conv_id")
def set_system(spark, sf_dir):
    new = T.set_system(F.col("conversations"), F.lit("Reasoning: low"))
    c = chats(spark, sf_dir).select("conv_id", F.posexplode(new).alias("turn", "t"))
    return c.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("t.value").alias("text"))


_RF, _RP = "'/logs/R-' || event_type || '.' || (event_id % 50) || '.err'", "'/results/m' || (page_id % 3) || '_' || (page_id % 40)"


@query("report_results", f"WITH f AS (SELECT DISTINCT {_RP} AS path, '' || (page_id % 40) AS job_id FROM pages) SELECT event_id, '' || (event_id % 50) AS job_id, coalesce(p, '') AS folders FROM events LEFT JOIN (SELECT job_id, string_agg(path, ',' ORDER BY path) AS p FROM f GROUP BY job_id) g ON g.job_id = '' || (event_id % 50)")
def report_results(spark, sf_dir):
    reports = _read(spark, sf_dir, "events").selectExpr("event_id", f"{_RF} AS file")
    found = L.with_results(reports, _read(spark, sf_dir, "pages").selectExpr(f"{_RP} AS path"))
    return found.select("event_id", "job_id", F.array_join("folders", ",").alias("folders"))


_NL = "chr(10)"


@query("few_shot_prompts", _FS + f", t AS (SELECT s.doc_id, s.shot, '--- Example ' || (s.shot + 1) || ' ---' || {_NL} || '<question>' || b.item_id || {_NL} || '<answer>' || coalesce(m.text, '') || {_NL} || {_NL} AS x FROM s JOIN b ON s.place = b.place JOIN benchmark m ON m.item_id = b.item_id) SELECT doc_id, 'Examples:' || {_NL} || string_agg(x, '' ORDER BY shot) || 'Now one in ' || coalesce((SELECT lang FROM documents d WHERE d.doc_id = t.doc_id), '') || '.' AS prompt FROM t GROUP BY doc_id")
def few_shot_prompts(spark, sf_dir):
    docs, pool = _read(spark, sf_dir, "documents").select("doc_id", "lang"), _read(spark, sf_dir, "benchmark").select("item_id", "text")
    drawn = P.few_shot(docs.select("doc_id"), "doc_id", pool.select("item_id"), "item_id", 3).join(pool, "item_id")
    shot = F.struct("shot", F.struct(F.col("item_id").cast("string").alias("question"), F.col("text").alias("answer")).alias("e"))
    shots = drawn.groupBy("doc_id").agg(F.sort_array(F.collect_list(shot)).alias("s"))
    prompt = Q.fill("Examples:\n{examples}Now one in {lang}.", examples=Q.numbered_examples(F.col("s.e")), lang=F.col("lang"))
    return docs.join(shots, "doc_id").select("doc_id", prompt.alias("prompt"))


@query("long_prompts", "WITH t AS (SELECT doc_id, CAST(len(regexp_extract_all('Read this:' || chr(10) || coalesce(text, ''), '[^ \\t\\n\\v\\f\\r]+')) AS BIGINT) AS tokens FROM documents) SELECT doc_id, tokens, tokens * 4 > 3 * 512 AS long FROM t")
def long_prompts(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select("doc_id", Q.fill("Read this:\n{text}", text=F.col("text")).alias("prompt"))
    return Q.with_tokens(d, "prompt", 512).drop("prompt")


_REF = """CASE doc_id % 7 WHEN 0 THEN ' ' WHEN 1 THEN '{' WHEN 2 THEN '[1]' WHEN 3 THEN '{"distilled_source_path":" ","distilled_source_index":1}' WHEN 4 THEN
 '{"distilled_source_path":"a","distilled_source_index":"x"}' ELSE '{"distilled_source_path":"f' || (doc_id % 4) || '","distilled_source_index":' || (doc_id % 90) || '}' END"""
_KINDS = "CASE doc_id % 7 WHEN 0 THEN 'blank' WHEN 1 THEN 'invalid' WHEN 2 THEN 'non_object' WHEN 3 THEN 'source_path' WHEN 4 THEN 'source_index' ELSE 'good' END"


def _references(spark, sf_dir):
    return V.references(_read(spark, sf_dir, "documents").select("doc_id", F.expr(_REF).alias("raw")))


@query("source_references", f"SELECT {_KINDS} AS reject, count(*) AS n, count(DISTINCT CASE WHEN doc_id % 7 > 4 THEN doc_id % 4 END) AS n_files FROM documents GROUP BY 1")
def source_references(spark, sf_dir):
    return _references(spark, sf_dir).groupBy(F.coalesce("reject", F.lit("good")).alias("reject")).agg(F.count("*").alias("n"), F.countDistinct("source_path").alias("n_files"))


@query("source_lookup", """WITH w AS (SELECT DISTINCT 'f' || (doc_id % 4) AS path, doc_id % 90 AS line_no FROM documents WHERE doc_id % 7 > 4),
 l AS (SELECT 'f' || (page_id % 3) AS path, page_id // 3 AS line_no FROM pages)
 SELECT path, count(*) AS requested, count(*) FILTER (WHERE (path, line_no) IN (SELECT (path, line_no) FROM l)) AS found, path NOT IN (SELECT path FROM l) AS missing FROM w GROUP BY path""")
def source_lookup(spark, sf_dir):
    wanted = _references(spark, sf_dir).filter("reject IS NULL").select(F.col("source_path").alias("path"), F.col("source_index").alias("line_no"))
    lines = _read(spark, sf_dir, "pages").selectExpr("'f' || (page_id % 3) AS path", "page_id div 3 AS line_no", "url AS raw")
    return V.lookup_stats(lines, wanted)


_OPEN = """CASE doc_id % 5 WHEN 0 THEN '{"id":"x' || doc_id || '","label_agreement":"pass"}' WHEN 1 THEN '{"id":7,"question_id":"q' || doc_id || '","label_agreement":5}'
 WHEN 2 THEN '{"id":" ","distilled_source_path":"/a/b.jsonl","distilled_source_index":' || doc_id || '}' WHEN 3 THEN '{"answer_id":"a","label_agreement":""}'
 ELSE '{"extra":1,"distilled_model":"m"}' END"""


@query("target_rows", """SELECT doc_id, '{"conversations":null,"distilled_model":' || CASE WHEN doc_id % 5 = 4 THEN '"m"' ELSE 'null' END || ',"distilled_source_index":' ||
 CASE WHEN doc_id % 5 = 2 THEN doc_id || ',"distilled_source_path":"/a/b.jsonl"' ELSE 'null,"distilled_source_path":null' END || ',"distilled_timestamp_utc":null,"id":"' ||
 CASE doc_id % 5 WHEN 0 THEN 'x' || doc_id WHEN 1 THEN 'q' || doc_id WHEN 2 THEN 'b.jsonl:' || doc_id WHEN 3 THEN 'a' ELSE 'line:' || (doc_id + 1) END ||
 '","label_agreement":"' || CASE WHEN doc_id % 5 = 0 THEN 'pass' ELSE 'unknown' END || '"}' AS line FROM documents""")
def target_rows(spark, sf_dir):
    rows = _read(spark, sf_dir, "documents").select("doc_id", K.entries(F.expr(_OPEN)).alias("row"))
    return rows.select("doc_id", K.to_line(V.to_target(F.col("row"), F.col("doc_id") + 1)).alias("line"))


@query("target_rows_logprobs", """SELECT doc_id, '{"conversations":[],"distilled_model":null,"distilled_source_index":null,"distilled_source_path":null,"distilled_timestamp_utc":null,"distilled_token_logprobs":' ||
 CASE WHEN doc_id % 2 = 0 THEN '[-0.5]' ELSE 'null' END || ',"id":"d' || doc_id || '","label_agreement":"unknown"}' AS line FROM documents""")
def target_rows_logprobs(spark, sf_dir):
    row = K.entries(F.expr("""'{"id":"d' || doc_id || '","conversations":[],"x":1' || CASE WHEN doc_id % 2 = 0 THEN ',"distilled_token_logprobs":[-0.5]}' ELSE '}' END"""))
    line = K.to_line(V.to_target(row, F.col("doc_id") + 1, V.TARGET_WITH_LOGPROBS))
    return _read(spark, sf_dir, "documents").select("doc_id", line.alias("line"))


@query("enrich_totals", _OK + " SELECT count(*) AS rows_enriched, coalesce(CAST(sum(CASE WHEN k = 0 THEN 2 ELSE 1 END) AS BIGINT), 0) AS fields_added, coalesce(CAST(sum(CASE WHEN k = 2 AND q <> 0 THEN 1 ELSE 0 END) AS BIGINT), 0) AS fields_overwritten FROM e")
def enrich_totals(spark, sf_dir):
    return D.enrichment_totals(_merged(spark, sf_dir, False))


@query("copy_all_fields", """SELECT doc_id, '{"doc_id":' || doc_id || ',"gold_answer":' || coalesce(toxic, 0) || ',"label":' || coalesce(quality, 0) || ',"note":1}' AS line FROM labels""")
def copy_all_fields(spark, sf_dir):
    own = K.entries(F.concat(F.lit('{"doc_id":'), "doc_id", F.lit(',"label":"old"}')))
    m = K.merge(own, K.all_but_skipped(K.entries(F.expr(_SOURCE))))
    return _read(spark, sf_dir, "labels").select("doc_id", K.to_line(m["merged"]).alias("line"))
