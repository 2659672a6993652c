import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from isolake.llm import terms as T
from tests.conftest import rows


def brute(records, length):
    n, held = defaultdict(int), defaultdict(set)
    for r, xs in records:
        for i in range(len(xs)):
            for k in range(1, length + 1):
                if i + k <= len(xs):
                    g = tuple(xs[i : i + k])
                    n[g] += 1
                    held[g].add(r)
    return {g: (n[g], len(held[g])) for g in n}


def counted(df, length):
    return {tuple(x for x in r[:length] if x is not None): (r.occurrences, r.records) for r in df.collect()}


@pytest.mark.parametrize("length,rows_per_task", [(1, 10**6), (3, 10**6), (3, 20), (4, 7)])
def test_ngrams_equal_brute_force(spark, length, rows_per_task):
    rnd = random.Random(length)
    records = [(f"r{k % 37}", [rnd.choice("aaaabcd") for _ in range(rnd.randrange(12))]) for k in range(50)]
    df = spark.createDataFrame(records, "record string, terms array<string>")
    s = T.suffixes(df, length)
    assert counted(T.ngram_counts(s, length, rows_per_task), length) == brute(records, length)


def test_a_record_set_spans_batches_and_rows_may_be_grouped_before(spark):
    rows_ = [(("x",), f"r{k % 50}", 1, k % 3 > 0) for k in range(400)] + [(("y",), None, 2, True)]
    df = spark.createDataFrame([(t[0], r, n, h) for t, r, n, h in rows_], "t1 string, record string, n long, holds boolean")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = counted(T.ngram_counts(df, 1), 1)
        grouped = df.groupBy("t1", "record").agg(F.sum("n").alias("n"), F.max("holds").alias("holds"))
        assert got == counted(T.ngram_counts(grouped, 1), 1) == {("x",): (400, 50), ("y",): (2, 0)}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_gene_marks(spark):
    data = [("common", f"s{k}", 1) for k in range(19)] + [("rare", f"s{k}", 1) for k in range(3)] + [("useful", f"s{k}", 1) for k in range(4)]
    data += [(" rare ", "s0", 1), ("absent", "s19", 0), ("absent", None, 1), ("useful", "s19", None), (None, "s19", 1), ("Rare", "s1", 1), ("none", None, None)]
    df = spark.createDataFrame(data, "gene string, sample_id string, present int").withColumn("mark", F.lit("clash"))
    got = rows(T.gene_marks(df, rows_per_task=5), "gene", "occurrences", "records", "mark")
    assert got == [("Rare", 1, 1, "rare"), ("absent", 2, 0, "rare"), ("common", 19, 19, "common"), ("none", 1, 0, "rare"), ("rare", 4, 3, "rare"), ("useful", 5, 4, None)]
    assert T.gene_marks(df.limit(0)).count() == 0


def test_text_terms_with_nulls_and_long_texts(spark):
    long = "word " * 60_000
    df = spark.createDataFrame([(1, "A b, a b!"), (1, "A b, a b!"), (2, None), (3, ""), (4, long), (5, "...")], "doc_id long, text string").withColumn("terms", F.lit("clash"))
    got = {r.ngram: (r.terms, r.occurrences, r.records) for r in T.text_terms(df, 2).collect()}
    assert got["a"] == (1, 4, 1) and got["a b"] == (2, 4, 1) and got["b a"] == (2, 2, 1) and got["word word"] == (2, 59_999, 1)
