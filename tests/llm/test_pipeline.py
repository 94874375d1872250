import corpus_pipeline
from riskmart.llm import jaccard, queries, secrets
from tests.llm.conftest import words
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_substrings import brute as passages

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_the_other(spark, staging):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, steps = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(staging.table(stage(spark, steps[-1], SF), name))
    rows = [[(r.doc_id, r.text) for r in s.collect()] for s in steps[:-1]]
    assert all(s.columns == columns for s in steps[:-1])
    given, good, single, fresh, clean = rows
    assert {d for d, _ in good} < {d for d, _ in given} and all(len(words(t)) >= 10 for _, t in good)
    assert sorted(d for d, _ in single) == sorted({c for _, _, c in groups(good, 5, 80)})
    left = [(d, n - gone) for d, n, gone, _ in passages(single, 35) if n > gone]
    assert sorted((d, len(words(t))) for d, t in fresh) == sorted(left)
    assert [d for d, _ in sorted(clean)] == [d for d, _ in sorted(fresh)]
    assert steps[4].filter("n_chars != char_length(text)").count() == 0
    assert secrets.with_spans(steps[4]).filter("size(base) > 0").count() == 0
    assert {r.doc_id for r in steps[5].select("doc_id").collect()} == {d for d, _ in clean}


def test_odd_documents(spark, documents):
    schema = "doc_id long, text string, lang string, source string, n_chars long, body string"
    rows = [(1, None, None, None, None, "b"), (2, "", "en", "s", 0, None), (None, "one two " * 8, "en", "s", 1, "x"), (3, "alpha beta gamma " * 5, "en", "s", 1, "x")]
    text = " ".join(f"w{i}" for i in range(60))
    rows += [(4, text + " token=abcdefgh", "en", "s", 1, "x")] * 2
    docs = documents(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, SF).collect()} == {4}


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert corpus_pipeline.PERCENT == 80 and jaccard.PERCENT == 85
