"""Rules on the quality of a text, as DataFrame expressions, run as a short-circuit cascade.

Cost and rejection of each rule are measured on a sample; the rule that rejects most for its
cost comes first, and later rules see only what earlier ones kept. The order changes the work,
never the verdict: a text is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.common import WORD

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
SAMPLE_ROWS = 1000
_TRIM = " \t\n\x0b\f\r"


def _words(text: Column) -> Column:
    """The words of a text as an array."""
    inner = F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, rf"{SPACE}+"))


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash for each window of eight words, from the hashes of the words."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(F.array().cast("array<int>"))
    # the array of word hashes is made once and bound to a name by the outer transform
    bound = F.transform(F.array(hashes), lambda h: F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW)))))
    return F.get(bound, F.lit(0))


def _covered(grams: Column) -> Column:
    """Words inside windows whose hash stands twice or more in `grams`."""

    def of(g: Column) -> Column:
        pairs = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            same = lambda x, i: F.coalesce((F.get(s, i - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce((F.get(s, i + 1)["h"] == x["h"]), F.lit(False))
            return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

        starts = F.get(F.transform(F.array(pairs), repeated), F.lit(0))
        new = lambda d: F.aggregate(
            F.transform(d, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(d, k + 1) - at, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b
        )
        return F.get(F.transform(F.array(starts), new), F.lit(0))

    distinct = F.size(F.array_distinct(grams)) == F.size(grams)
    return F.when(distinct, F.lit(0)).otherwise(F.get(F.transform(F.array(grams), of), F.lit(0))).cast("long")


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return F.get(F.transform(F.array(lines), lambda a: F.size(a) - F.size(F.array_distinct(a))), F.lit(0)).cast("long")


#: name of a feature -> (expression of the features it names, names it needs)
FEATURES = {
    "words": (lambda c: _words(c("text")), ("text",)),
    "n_words": (lambda c: F.size(c("words")).cast("long"), ("words",)),
    "word_chars": (lambda c: (F.char_length(c("text")) - F.regexp_count(c("text"), F.lit(SPACE))).cast("long"), ("text",)),
    "n_symbols": (lambda c: F.regexp_count(c("text"), F.lit(SYMBOLS)).cast("long"), ("text",)),
    "n_capitals": (lambda c: F.regexp_count(c("text"), F.lit("[A-Z]")).cast("long"), ("text",)),
    "n_dup_lines": (lambda c: _dup_lines(c("text")), ("text",)),
    "n_lines": (lambda c: F.regexp_count(c("text"), F.lit(rf"(?md)^[^\n]*?{WORD}[^\n]*$")).cast("long"), ("text",)),
    "grams": (lambda c: _window_hashes(c("words")), ("words",)),
    "n_repeat_words": (lambda c: _covered(c("grams")), ("grams",)),
}


@dataclass(frozen=True)
class Rule:
    """Rejects a text where `rejects`, an expression of the named features, holds."""

    name: str
    rejects: str
    needs: tuple[str, ...]


#: The two rules of the contract; texts of few words, and of much repetition.
BASE = (
    Rule("few words", "{n_words} < 20", ("n_words",)),
    Rule("repeated words", "100 * {n_repeat_words} > 30 * {n_words}", ("n_words", "n_repeat_words")),
)
RULES = (
    *BASE,
    Rule("symbols", "10 * {n_symbols} > {n_words}", ("n_words", "n_symbols")),
    Rule("word length", "{word_chars} < 2 * {n_words} OR {word_chars} > 15 * {n_words}", ("n_words", "word_chars")),
    Rule("capitals", "2 * {n_capitals} > {word_chars}", ("word_chars", "n_capitals")),
    Rule("repeated lines", "10 * {n_dup_lines} > 3 * {n_lines}", ("n_dup_lines", "n_lines")),
)


def _name(feature: str) -> str:
    return f"_q_{feature}"


def with_features(df: DataFrame, names: Sequence[str], text_col: str, only: Column | None = None) -> DataFrame:
    """`df` with the named features, and those they need, as columns `_q_<name>`; missing where not `only`."""
    for name in names:
        if _name(name) in df.columns:
            continue
        if name == "text":
            df = df.withColumn(_name("text"), F.coalesce(F.col(text_col), F.lit("")))
            continue
        build, needs = FEATURES[name]
        df = with_features(df, needs, text_col, only)
        value = build(lambda n: F.col(_name(n)))
        df = df.withColumn(_name(name), value if only is None else F.when(only, value))
    return df


def _rejects(rule: Rule) -> Column:
    return F.expr(rule.rejects.format(**{n: f"`{_name(n)}`" for n in FEATURES}))


def rule_order(df: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on a sample of about `sample_rows` rows.

    The seconds of a rule are the best of three runs, less those of a run without any rule.
    """
    total = df.count()
    if not total:
        return list(rules)
    sample = df.select(text_col).sample(min(1.0, sample_rows / total), seed=9).repartition(1).cache()

    def measure(frame: DataFrame) -> tuple[int, float]:
        frame.collect()  # compiles the plan
        best = float("inf")
        for _ in range(3):
            start = time.perf_counter()
            count = frame.collect()[0][0]
            best = min(best, time.perf_counter() - start)
        return count, best

    try:
        empty = measure(sample.agg(F.sum(F.length(text_col))))[1]
        gain = {}
        for rule in rules:
            rejected, seconds = measure(with_features(sample, rule.needs, text_col).agg(F.count_if(_rejects(rule))))
            gain[rule.name] = rejected / max(seconds - empty, 1e-3)
    finally:
        sample.unpersist()
    return sorted(rules, key=lambda r: -gain[r.name])


def with_verdict(df: DataFrame, rules: Sequence[Rule], text_col: str = "text") -> DataFrame:
    """`df` with the column `_q_kept`: whether no rule rejects the text, tried in the given order.

    A feature that only later rules need is computed for the rows that earlier ones kept, and is
    missing in the others; each is computed once.
    """
    kept = F.lit(True)
    for k, rule in enumerate(rules):
        df = with_features(df, rule.needs, text_col, kept if k else None)
        verdict = ~_rejects(rule) if not k else F.when(kept, ~_rejects(rule)).otherwise(False)
        df = df.withColumn(_name(f"kept_{k}"), verdict)
        kept = F.col(_name(f"kept_{k}"))
    return df.withColumn(_name("kept"), kept)


def cascade(df: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of `df` that no rule rejects, with their own columns.

    A missing text counts as empty and so has too few words. Columns of `df` may have any names;
    whole texts are read, however long. The verdict leaves through a one-element explode: a filter
    on it cannot move below that, where it would compute the features again for each rule.
    """
    columns = df.columns
    row = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row")
    texts = df.select(row, F.col(f"`{text_col}`").alias("_text"))
    judged = with_verdict(texts, rule_order(texts, rules, "_text"), "_text")
    kept = judged.select("_row", F.explode(F.array(_name("kept"))).alias("_kept")).where("_kept")
    return kept.select(*(F.col("_row")[c].alias(c) for c in columns))


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts of each text, whether the base rules fail it, and whether all rules keep it.

    The verdict tries the rules in the order of the sample and stops at the first rejection.
    A missing text counts as empty: no words, base failed. Repeated rows give repeated results.
    """
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    texts = df.select(id_col, text_col)
    out = with_verdict(with_features(texts, counts, text_col), rule_order(texts, RULES, text_col), text_col)
    failed = _rejects(BASE[0]) | _rejects(BASE[1])
    return out.select(id_col, *(F.col(_name(n)).alias(n) for n in counts), failed.alias("base_failed"), F.col(_name("kept")).alias("kept"))
