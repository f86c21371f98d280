"""Rows that must not get lost or scored differently: repeated ids, clashing layouts, batch shapes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import chat, near_dup, quality
from ledgerwatch.session import ship_package


@pytest.fixture(scope="module")
def spark(spark):
    ship_package(spark)
    return spark


def test_kept_documents_decides_by_row_not_by_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (5, b), (5, None), (9, c), (7, a + " more"), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)).withColumn("node", F.lit("x"))
    got = near_dup.kept_documents(docs)
    assert got.columns == docs.columns
    want = [(3, a), (5, b), (5, b), (5, None), (9, c), (None, a)]
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("extra", ["array<struct<role: string, content: string>>", "string"])
def test_row_layout_wins_over_a_clashing_column(spark, extra):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "ho")], "conv_id long, turn long, role string, text string")
    for name in ("messages", "prompt", "completion"):
        df = df.withColumn(name, F.lit(None).cast(extra))
    got = sorted(tuple(r) for r in chat.canonical_turns(df).collect())
    assert got == [(1, 0, "user", "hi"), (1, 1, "assistant", "ho")]


def test_equal_features_score_alike_in_any_batch():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, quality.FEATURES))
    network = quality.Network(x, (x[:, 0] > 0).astype(float))
    one = [network.scores(x[i:i + 1])[0] for i in range(40)]
    for lo, hi in ((0, 300), (0, 3), (1, 40), (7, 24)):
        assert network.scores(x[lo:hi])[:max(0, 40 - lo)].tolist() == one[lo:hi]
