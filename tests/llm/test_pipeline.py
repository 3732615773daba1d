"""The pipeline: what each stage returns, and its result against the stages in Python."""

from collections import Counter

from corpus_helpers import DATA

import __spark_entry__ as contract
import corpus_pipeline
from commerce_lake.llm import quality, simhash
from test_exact_dedup import fold
from test_packing import check
from test_simhash import components, reference


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.dtypes
    frames = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frames[-1], str(DATA))
        out.write.parquet(str(tmp_path / str(k)))
        frames.append(spark.read.parquet(str(tmp_path / str(k))))
    assert all(f.dtypes == columns for f in frames[:-1])
    start, good, exact, near, clean, packed = (f.collect() for f in frames)
    kept = {r.doc_id for r in quality.quality(docs).where("kept").collect()}
    assert {r.doc_id for r in good} == kept
    first = {}
    for r in sorted(good):
        first.setdefault(fold(r.text), r.doc_id)
    assert {r.doc_id for r in exact} == set(first.values())
    label = components({reference(r.text) for r in exact})
    least = {}
    for r in sorted(exact):
        least.setdefault(label[reference(r.text)], r.doc_id)
    assert {r.doc_id for r in near} == set(least.values())
    assert Counter(r.doc_id for r in clean) == Counter(r.doc_id for r in near)
    assert all(r.n_chars == len(r.text) for r in clean) and not any("@" in r.text and ".com" in r.text for r in clean)
    check(packed, [(r.doc_id, r.text) for r in clean], 2048)


def test_run_is_registered(spark):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, str(DATA)).count() > 0
    assert simhash.MAX_DIFFERENT == 2 and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_each_operator_is_registered():
    names = {int(n[2:].split("_")[0]) for n in contract.queries() if n.startswith("op")}
    assert names == set(range(1, 14))
