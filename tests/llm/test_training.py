"""What the toxicity chain learns from."""

import pytest
from pyspark.sql import functions as F

from kinelane.llm import common, toxicity


@pytest.fixture(autouse=True)
def package_on_executors(spark):
    common.shipped(spark)


def test_shared_passages_are_no_copies(spark):
    """Texts that share a quarter of their words stay, copies with one other word go."""
    passage = " ".join(f"licence{k}" for k in range(50))
    texts = [f"{passage} " + " ".join(f"own{i}x{k}" for k in range(150)) for i in range(40)]
    texts += [t + " end" for t in texts[:5]] + ["", "two words", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = df.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    rows = toxicity._sample(df, labels, ["quality", "toxic"], 100).orderBy("doc_id").collect()
    keep = toxicity._first_of_copies([r.sketch for r in rows])
    assert [r.doc_id for r, k in zip(rows, keep) if not k] == [40, 41, 42, 43, 44]
