import re

from pyspark.sql import functions as F

from sparkprep.llm import quality


def test_character_classes_are_counted_without_a_regular_expression_each(spark):
    texts = ["a\\b[c]ÿÞ😀x́ Ö9\t#*<>|&%$^~", "", None, "😀ßß\\\\ \r\n 42 (ok)!"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    described = quality.describe(df, carry_text=False)
    plan = described._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan
    found = {r["doc_id"]: r for r in described.collect()}
    for i, t in enumerate(texts):
        classes = [len(re.findall(p, t or "")) for p in quality.CHARACTER_CLASSES.values()]
        space = list(quality.CHARACTER_CLASSES).index("space")
        assert found[i]["_classes"][:-1] == [float(n) for n in classes]
        assert found[i]["word_chars"] == len(t or "") - classes[space]
        assert found[i]["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t or ""))
