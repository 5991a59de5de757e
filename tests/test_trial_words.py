from pyspark.sql import functions as F

from topicweave.operators import tuning
from topicweave.scratch import Scratch


def test_words_of_trials_are_counted_once(spark, monkeypatch):
    """The counts of a trial's words, and the words kept, are written once and read by all that follows."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(n):
        calls.add(1)
        return n

    words = [(d, w, 1) for d in range(6) for w in ("a", "b", f"own{d}")]
    counts = spark.createDataFrame(words, "doc_id long, word string, n long").withColumn("n", seen("n"))
    topics = spark.createDataFrame([(0, d, d % 2) for d in range(6)], "trial_id int, doc_id long, topic int")
    written = []
    plain = Scratch.table
    monkeypatch.setattr(Scratch, "table", lambda self, df, name="t", *a, **k: written.append(name) or plain(self, df, name, *a, **k))
    top = tuning.trial_top_words(counts, topics, 1, 2, 2).collect()
    assert written == ["counts", "kept"] and calls.value == len(words)
    assert {(r.topic, r["rank"]) for r in top} == {(0, 1), (0, 2), (1, 1), (1, 2)}
