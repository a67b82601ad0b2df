from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sparkprep.llm.bpe import vocabulary_path
from sparkprep.llm.quality import op9_quality_rules
from cases import ODD

SF = "/root/testdata/sf0.001"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage gets and gives."""
    from sparkprep.llm.common import documents
    from sparkprep.workspace import settle

    docs, out = documents(spark, SF), []
    for name, stage in corpus_pipeline.STAGES:
        found = settle(stage(spark, docs, SF), f"test-{name}")
        out.append((docs, found))
        docs = found
    return out


def test_columns(stages):
    assert len(stages) == 5
    for docs, found in stages[:-1]:
        assert found.dtypes == docs.dtypes


def test_quality(spark, stages):
    docs, found = stages[0]
    kept = {r.doc_id for r in op9_quality_rules(spark, SF).where("kept").collect()}
    assert rows(found) == rows(docs.where(docs.doc_id.isin(list(kept))))


def test_line_dedup(stages):
    before = {r.doc_id: r.text for r in stages[1][0].collect()}
    after = {r.doc_id: r for r in stages[1][1].collect()}
    assert set(before) == set(after)
    lines = Counter(x for t in set(before.values()) for x in set(t.split("\n")))
    assert any(r.text != before[i] for i, r in after.items())
    for i, r in after.items():
        gone = Counter(before[i].split("\n")) - Counter(r.text.split("\n"))
        assert all(lines[x] >= 3 for x in gone)
        assert r.n_chars == len(r.text) or r.text == before[i]


def test_one_of_each_near_duplicate_stays(stages):
    from test_shingle_join import brute

    docs, found = stages[2]
    given = [(r.doc_id, r.text) for r in docs.collect()]
    least = {c for _, _, c in brute(given)}
    assert {r.doc_id for r in found.collect()} == least


def test_decontamination(spark, stages):
    from test_decontaminate import brute

    docs, found = stages[3]
    given = docs.collect()
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {d.doc_id for d, (_, hit, _) in zip(given, brute([d.text for d in given], items, 10)) if not hit}
    assert {r.doc_id for r in found.collect()} == clean


def test_encoding(stages):
    library = Tokenizer.from_file(vocabulary_path())
    texts = {r.doc_id: r.text for r in stages[4][0].collect()}
    found = stages[4][1].collect()
    assert {r.doc_id for r in found} == set(texts)
    for r in found:
        assert list(r["ids"]) == library.encode(texts[r.doc_id], add_special_tokens=False).ids


def test_run_is_the_stages(spark, stages):
    found = corpus_pipeline.run(spark, SF)
    key = lambda df: {(r.doc_id, r.n_tokens) for r in df.collect()}
    assert key(found) == key(stages[-1][1])


def test_odd_rows(spark, table):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, table([]), SF).count() == 0
        assert stage(spark, table(ODD), SF).count() >= 0
    staying = corpus_pipeline.near_duplicates(spark, table(ODD), SF).collect()
    assert Counter(r.text for r in staying)["alike"] == 1


CLASHING = ("kept", "n_words", "items", "spans", "_text", "_hash", "dropped", "Kept_Text", "_ranges", "n_hit", "stays")


def test_given_columns_stay_as_they_are(spark, table):
    """Columns with names that operators use go through every stage but the last unchanged."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in CLASHING})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF)
        assert found.columns == docs.columns
        kept = found.collect()
        assert kept and all(r[c] == f"{c}-{r.doc_id}" for r in kept for c in CLASHING)


def test_repeated_rows_with_other_columns(spark):
    """Of rows with one id and text the least by the other columns stays, wherever it stands."""
    rows = [(1, "a b c d e f", lang, "s", n) for n, lang in enumerate(("fr", "de", "en", None))]
    names = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for given in (rows[:3], rows[2::-1]):
        (row,) = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(given, names), SF).collect()
        assert row.lang == "de"
