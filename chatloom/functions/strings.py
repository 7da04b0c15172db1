"""Text functions of the chat pipeline, Column to Column, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markup and patterns that model outputs use. The answer pattern is linear in the text's length; a
# non-word character or the end must follow the letter.
_W = r"[\s\x1c-\x1f\x85\p{Z}]"
ANSWER = r"(?i)Answer[^A-E]*(?:(?:boxed)+[^A-E]*)?([A-E])(?:[^\p{L}\p{N}_]|\z)"
BOLD_CHOICE = r"\*\*\s*([A-E])\s*[\.\-–]"
OPTION = r"(?i)Option\s*([1-5])"
ANALYSIS = r"(?s)<\|channel\|>analysis<\|message\|>(.*?)(?:<\|end\|>|<\|start\|>|<\|channel\|>|\z)"
FINAL = r"(?s)<\|channel\|>final<\|message\|>(.*?)(?:<\|end\|>|\z)"
FINAL_MARK = "<|channel|>final<|message|>"
#: Replaced one after the other, in this order.
FALLBACK = {
    "<|channel|>analysis<|message|>": "<think>\n",
    "<|end|><|start|>assistant<|channel|>final<|message|>": "\n</think>\n\n",
    "<|channel|>final<|message|>": "\n</think>\n\n",
    "<|end|>": "",
}
OLD_START = rf"(?i)<unused94>{_W}*(?:thought)?{_W}*"
OLD_FIRST = rf"(?s)^(.*?)(?i:<unused94>){_W}*+(?i:thought)?+{_W}*+(.*)\z"
OLD_END = "<unused95>"
DIFFICULTY = r"(?i)difficulty(?:\s+level)?:?\**:?\s*([1-5])(?![0-9])"
RELEVANCE = r"(?i)relevance:?\**:?\s*([1-5])(?![0-9])"
RECOMMENDATION = r"(?i)recommendation:?\**:?\s*(Keep|Revise|Discard)"
FEEDBACK = r"(?is)feedback:?\**:?\s*(.*)\z"
QUESTION = r"(?is)<question>(.*?)(?:</question>|<answer>|---\s*Answer\s*---)"
ANSWER_REST = r"(?is)(?:<answer>|---\s*Answer\s*---)(.*)\z"
QA = r"(?is)<qa>\s*<question>(.*?)</question>\s*<answer>(.*?)</answer>\s*</qa>"
STATUSES = ("empty", "no_legacy_tags", "paired_rewritten", "end_only_wrapped", "start_only_closed")


def strip(c: Column) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(c, rf"^{_W}+|{_W}+\z", "")


def strip_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"^\n+|\n+\z", "")


def last_answer(text: Column) -> Column:
    """The last answer letter in upper case, null if none. The first A-E after "Answer" counts even within a word's
    start, so "Answer: The best is C" gives E."""
    return F.upper(F.try_element_at(F.regexp_extract_all(text, F.lit(ANSWER), F.lit(1)), F.lit(-1)))


def answer_matches(text: Column, label: Column) -> Column:
    """Null without a label; false without an answer."""
    return F.when(F.coalesce(label, F.lit("")) != "", F.coalesce(last_answer(text) == F.upper(label), F.lit(False)))


def _first(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def choose_answer(text: Column) -> Column:
    number = _first(text, OPTION).cast("int")
    return F.coalesce(last_answer(text), _first(text, BOLD_CHOICE), F.chr(number + 64), F.lit("Unknown"))


def harmony_valid(text: Column) -> Column:
    return F.coalesce(text.rlike(ANALYSIS) & text.rlike(FINAL), F.lit(False))


def harmony_text(text: Column, reasoning: bool = True) -> Column:
    """Reasoning and answer from channel markup; unchanged if either channel is missing."""
    thought, final = strip(F.regexp_extract(text, ANALYSIS, 1)), strip(F.regexp_extract(text, FINAL, 1))
    new = F.concat(F.lit("<think>\n"), thought, F.lit("\n</think>\n\n"), final) if reasoning else final
    return F.when(harmony_valid(text), new).otherwise(text)


def harmony_fallback(text: Column) -> Column:
    """As harmony_text; where a channel is missing, what marks there are become think tags."""
    loose = text
    for mark, new in FALLBACK.items():
        loose = F.replace(loose, F.lit(mark), F.lit(new))
    return F.when(harmony_valid(text), harmony_text(text)).otherwise(strip(loose))


def _old_parts(text: Column) -> tuple[Column, Column, Column]:
    """Whether an old start tag is there, what stands before the first one, and what behind it."""
    return text.rlike(OLD_START), F.regexp_extract(text, OLD_FIRST, 1), F.regexp_extract(text, OLD_FIRST, 2)


def think_status(text: Column) -> Column:
    start, _, after = _old_parts(text)
    end = text.contains(OLD_END)
    return (
        F.when(text == "", STATUSES[0])
        .when(~start & ~end, STATUSES[1])
        .when(start & after.contains(OLD_END), STATUSES[2])
        .when(~start, STATUSES[3])
        .when(start, STATUSES[4])
    )


def think_text(text: Column) -> Column:
    """Old reasoning tags become think tags: the first pair, or all up to the first end tag, or every start tag with the
    end added if it has none. End tags behind the first one go."""
    nl = F.lit("\n")
    _, before, after = _old_parts(text)

    def built(said: Column) -> Column:
        """What stands before the first end tag as reasoning, the rest as answer."""
        body = F.substring_index(said, OLD_END, 1)
        answer = F.ltrim(F.replace(F.substring(said, F.char_length(body) + len(OLD_END) + 1, F.char_length(said)), F.lit(OLD_END), F.lit("")), nl)
        tail = F.when(answer != "", F.concat(nl, answer)).otherwise(F.lit(""))
        return F.concat(F.lit("<think>\n"), F.trim(body, nl), F.lit("\n</think>"), tail)

    head = F.when(before != "", F.concat(F.rtrim(before, nl), nl)).otherwise(F.lit(""))
    opened = F.regexp_replace(text, OLD_START, "<think>\n")
    closed = F.when(opened.contains("</think>"), opened).otherwise(F.concat(F.rtrim(opened, nl), F.lit("\n</think>")))
    status = think_status(text)
    return (
        F.when(status == STATUSES[2], F.concat(head, built(after)))
        .when(status == STATUSES[3], built(text))
        .when(status == STATUSES[4], closed)
        .otherwise(text)
    )


def eval_fields(text: Column) -> dict[str, Column]:
    return {
        "eval_difficulty": _first(text, DIFFICULTY).cast("int"),
        "eval_relevance": _first(text, RELEVANCE).cast("int"),
        "eval_recommendation": F.initcap(_first(text, RECOMMENDATION)),
        "eval_feedback": F.when(text.rlike(FEEDBACK), strip(F.regexp_extract(text, FEEDBACK, 1))),
    }


def final_channel(text: Column) -> Column:
    return F.substring_index(text, FINAL_MARK, -1)


def single_qa(text: Column) -> tuple[Column, Column]:
    answer = F.regexp_replace(F.regexp_extract(text, ANSWER_REST, 1), r"(?i)</answer>\s*\z", "")
    return strip(F.regexp_extract(text, QUESTION, 1)), strip(answer)


def qa_pairs(text: Column) -> Column:
    """array<struct<question, answer>> of all blocks with both parts."""
    q, a = F.regexp_extract_all(text, F.lit(QA), F.lit(1)), F.regexp_extract_all(text, F.lit(QA), F.lit(2))
    pairs = F.zip_with(q, a, lambda x, y: F.struct(strip(x).alias("question"), strip(y).alias("answer")))
    return F.filter(pairs, lambda p: (p["question"] != "") & (p["answer"] != ""))


def letter_of(c: Column) -> Column:
    """A single letter, or option N (1 to 26) as a letter."""
    s = F.upper(strip(c))
    n = F.nullif(F.regexp_extract(s, r"^OPTION\s*([0-9]{1,9})$", 1), F.lit("")).cast("int")
    return F.when(s.rlike(r"^[A-Z]\z"), s).when(n.between(1, 26), F.chr(n + 64))


def index_letter(c: Column) -> Column:
    return F.when(c.between(0, 25), F.chr(c + 65))


def json_index_letter(json: Column) -> Column:
    """As index_letter from a JSON text: whole numbers, and true and false as 1 and 0; null for any other JSON."""
    number = F.when(json == "true", 1).when(json == "false", 0).when(json.rlike(r"^-?[0-9]+\z"), json.try_cast("int"))
    return index_letter(number)


def non_empty(c: Column) -> Column:
    """Trimmed text; null for blank, none, null and nan."""
    s = strip(c)
    return F.when(~F.lower(s).isin("", "none", "null", "nan"), s)


def reward_accuracy(text: Column, label: Column) -> Column:
    return F.when(last_answer(text) == F.upper(label), 1.0).otherwise(0.0)


def reward_format(text: Column) -> Column:
    return F.when(text.contains("<think>") & text.contains("</think>"), 1.0).otherwise(0.0)


#: Scorers by name, as a configuration refers to them: (text, label) to Column.
REWARDS = {"accuracy": reward_accuracy, "format": lambda text, label: reward_format(text)}


def duration(seconds: Column) -> Column:
    s = seconds.cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def safe_tag(path: Column) -> Column:
    base = F.regexp_replace(F.lower(F.substring_index(path, "/", -1)), r"[^a-z0-9_.-]", "_")
    return F.regexp_replace(base, r"^_|_\z", "")


#: ASCII characters that are neither letters nor digits, and what they become in a key: they come after all letters, but
#: the tilde, which comes before the end of a name.
_SIGNS = "".join(chr(b) for b in range(1, 128) if not chr(b).isalnum() and chr(b) != "~")
_AFTER = "".join(chr(0x100 + ord(c)) for c in _SIGNS)


def _version_key(c: Column) -> Column:
    def part(run: Column) -> Column:
        digits = F.regexp_replace(F.regexp_extract(run, "([0-9]*)$", 1), "^0+", "")
        text = F.translate(F.regexp_extract(run, "^[^0-9]*", 0), _SIGNS + "~", _AFTER + "\x01")
        return F.concat(text, F.lit("\x02"), F.lpad(F.char_length(digits).cast("string"), 9, "0"), digits)

    # The last match is empty, so that every key ends in the end of a text.
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit("[^0-9]*[0-9]*"), F.lit(0)), part), "")


def natural_key(c: Column) -> Column:
    """A text whose byte order is the natural order of names: runs of digits compare as numbers of any length, letters come
    before other signs, a tilde before the end. Endings like .tar.gz count only where the rest is the same, names that
    differ in leading zeros alone are ordered by their bytes, and null stays null. For ASCII names this is version sort;
    other characters compare by code point, after the signs."""
    ending = F.regexp_extract(c, r"((?:\.[A-Za-z~][A-Za-z0-9~]*)*)$", 1)
    stem = F.substring(c, F.lit(1), F.char_length(c) - F.char_length(ending))
    hidden = F.when(c == "", "0").when(c == ".", "1").when(c == "..", "2").when(c.startswith("."), "3").otherwise("4")
    return F.concat(hidden, _version_key(stem), F.lit("\x00"), _version_key(c), F.lit("\x00"), c)
