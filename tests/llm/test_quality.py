"""Counts of the quality rules against Python, and the cascade against single rules."""

from collections import Counter

from corpus_helpers import DATA, WORD
from pyspark.sql import functions as F

from commerce_lake.llm import quality, queries


def counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n_symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), n_symbols, len(lines) - len(set(lines)), len(covered)


def check(df):
    texts = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=str)
    want = Counter((i, *counts(t)) for i, t in texts)
    rows = quality.quality(df).collect()
    assert Counter((r["doc_id"], r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    return rows


def test_edge_cases(docs, no_docs):
    rows = check(docs)
    out = quality.cascade(docs)
    assert out.columns == docs.columns and out.count() == sum(r.kept for r in rows)
    assert quality.quality(no_docs).count() == 0 and quality.cascade(no_docs).count() == 0


def test_order_does_not_change_the_verdict(docs):
    a = quality.cascade(docs, quality.RULES).count()
    assert a == quality.cascade(docs, quality.RULES[::-1]).count()
    assert {r.name for r in quality.rule_order(docs)} == {r.name for r in quality.RULES}


def test_cascade_computes_a_feature_once(docs):
    """Filters between the features would be pushed below them and repeat them for each rule."""
    out = quality.cascade(docs.withColumn("_q_words", F.lit("own")).withColumn("a.b", F.lit(1)))
    assert out.columns == [*docs.columns, "_q_words", "a.b"]
    assert all(r["_q_words"] == "own" for r in out.collect())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == quality.with_features(docs, ("words", "n_dup_lines"), "text")._jdf.queryExecution().optimizedPlan().toString().count("split(")


def test_features_of_rejected_texts_are_left_out(docs):
    judged = quality.with_verdict(docs, quality.RULES)
    assert judged.where("_q_kept IS NULL").count() == 0
    first = F.col("_q_kept_0")
    assert judged.where(~first & F.col("_q_n_symbols").isNotNull()).count() == 0
    assert judged.where(first & F.col("_q_grams").isNull()).count() == 0


def test_query_keeps_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels"))
    rows = {r.doc_id: r for r in check(docs)}
    assert len(rows) == queries.op9_quality_rules(spark, str(DATA)).count()
    good = [rows[r.doc_id] for r in labels.where("quality = 1").collect()]
    assert sum(r.kept or r.base_failed for r in good) >= 0.98 * len(good)
    plan = queries.op9_quality_rules(spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_line_separators_beside_the_spaces_of_the_contract(spark):
    """U+0085, U+2028 and U+2029 are characters of words, also at the end of a text."""
    marks = ("\x85", " ", " ", "\r", " ", "x \n")
    texts = [f"{a}foo {b}" for a in ("", *marks[:3]) for b in marks]
    texts += [f"one one\ntwo{c}\none one" for c in marks]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
