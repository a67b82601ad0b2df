from collections import Counter

from sparkprep.operators import text


def test_term_counts_take_more_tasks_for_more_text(spark, monkeypatch):
    monkeypatch.setattr(text, "TASK_TEXT_BYTES", 64)
    rows = [(i, " ".join(f"w{(i * j) % 7}" for j in range(40))) for i in range(20)] + [(3, "w1 x"), (None, "a a"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = text.term_frequencies(df, "doc_id", "text")
    size = sum(len(t.encode()) for _, t in rows if t is not None)
    assert found.rdd.getNumPartitions() == -(-size // 64) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    expected = Counter()
    for key, t in rows:
        for w in (t or "").lower().split(" "):
            if w:
                expected[(key, w)] += 1
    assert {(r["doc_id"], r["term"]): r["tf"] for r in found.collect()} == dict(expected)
