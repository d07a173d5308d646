"""Exact copies by content sort, against a dictionary."""
import hashlib
import random
from collections import defaultdict

import pytest

from gridtel.llm import exact_dedup as X


def brute(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[t or ""].append(i)
    out = []
    for i, t in docs:
        ids = groups[t or ""]
        top = max((x for x in ids if x is not None), default=None)
        out.append((i, top, len(ids), i == top, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(1)
    same = "p" * 80
    texts = [same + str(rnd.randrange(12)) for _ in range(60)] + ["hot text"] * 150 + ["", None, "é", "É", "é", " é"] + \
            [str(i) for i in range(50)] + [same, same + same, "x" * 50_000, "x" * 50_000, "x" * 50_001]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_against_brute_force(spark, partitions):
    docs = corpus()
    df = spark.createDataFrame([(*d, 1, "clash") for d in docs], "doc_id long, text string, group_size int, __run string")
    out = [tuple(r) for r in X.copies(df.repartition(5), partitions).collect()]
    assert sorted(out, key=str) == brute(docs)


def test_a_hot_text_spreads_over_partitions(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"t{i}") for i in range(3000)], "doc_id long, text string")
    from pyspark.sql import functions as F
    per = X.content_sort(df, 20).where("text = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(per) > 8 and max(r["count"] for r in per) < 600
    got = X.copies(df, 20).where("kept").count()
    assert got == 1001


def test_keep_one_carries_columns(spark):
    rows = [(1, "a", "en"), (5, "a", "de"), (2, "b", None), (None, "a", "fr"), (None, "c", "x"), (5, "a", "de"), (7, None, "n"), (8, "", "m")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = X.keep_one(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(5, "a", "de"), (2, "b", None), (None, "c", "x"), (8, "", "m")], key=str)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert X.copies(df).count() == 0 and X.keep_one(df).count() == 0
