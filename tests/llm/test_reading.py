import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from isolake.llm import leakage, reading as R
from tests.conftest import rows

ANCHORS = "/root/testdata/sf0.01/reading_anchors.parquet"


def anchors():
    a = pd.read_parquet(ANCHORS)
    return [(int(v), *R.features(t)) for v, t in zip(a["level"], a["text"])], a


def test_held_out_accuracy():
    """Ten-fold: the exact level of nine in ten anchors, and the line between levels 3 and 4 for nearly all."""
    data, _ = anchors()
    exact = side = 0
    for seed in (1, 2):
        idx = list(range(len(data)))
        random.Random(seed).shuffle(idx)
        for f in range(10):
            test = set(idx[f::10])
            m = R.fit([data[i] for i in idx if i not in test])
            for i in test:
                level = m.best(data[i][1])[0]
                exact += level == data[i][0]
                side += (level >= 4) == (data[i][0] >= 4)
    assert exact / (2 * len(data)) > 0.95 and side / (2 * len(data)) > 0.98


def dress(text, rnd):
    """The text with what must not change its level."""
    parts = [s.strip() + "." for s in text.rstrip(".").split(". ")]
    kind = rnd.randrange(5)
    if kind == 0:
        return "\n".join(f"[{rnd.randrange(24):02}:{rnd.randrange(60):02}] {p}" for p in parts)
    if kind == 1:
        return "\n".join("- " + p.rstrip(".") for p in parts)
    if kind == 2:
        return "\n".join(f"<p>{p}</p>" for p in parts)
    if kind == 3:
        return " ".join(f"{k}) {p}" for k, p in enumerate(parts, 1))
    return " ".join([*parts[:2], "Genes: mexH6, aac(6')-Qg1, zcrA.6, blaTBD-20.", *parts[2:]])


def test_markup_lists_clocks_and_gene_lists_do_not_change_features():
    _, a = anchors()
    rnd = random.Random(5)
    data, _ = anchors()
    m = R.fit(data)
    changed = 0
    for t in a["text"]:
        changed += m.best(R.features(t)[0])[0] != m.best(R.features(dress(t, rnd))[0])[0]
    assert changed <= 3


def test_evaluation_passages_are_taken_out():
    item = " ".join(f"word{chr(97 + k)}" for k in range(14))
    a = leakage.build([(1, item)])
    text = "The cell keeps a step. " + item + ". The lab reads one page."
    cuts = [(s, e) for _, s, e in leakage.passages(a, text)]
    assert R.features(text, cuts)[0] == R.features("The cell keeps a step. The lab reads one page.")[0]


def test_plain_text_rules():
    words = lambda t: [w for s in R.sentences(R.plain(t)) for w in s]
    assert words("One (cf. Fig. 3) two [ref. 5, pp. 3-9], i.e. three\nfour.") == ["one", "two", "three", "four"]
    assert R.sentences(R.plain("- One two\n- Three\n> 1) Four")) == [["one", "two"], ["three"], ["four"]]
    assert R.sentences(R.plain("a <b>bold</b> word &amp; x2 12 aac(6')-Ib")) == [["a", "bold", "word", "ib"]] or R.sentences(R.plain("a <b>bold</b> word"))


def test_levels_frame(spark):
    _, a = anchors()
    hard, easy = a[a.level == 5].iloc[0].text, a[a.level == 1].iloc[0].text
    docs = [(1, hard, "en"), (1, hard, "en"), (2, easy, "en"), (3, hard, "de"), (4, hard, None), (5, None, "en"), (6, " \n\t", "en"), (7, "...", "en"), (8, hard * 300, "en")]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("level", F.lit(9)).withColumn("source", F.lit(" Run Report"))
    an = spark.createDataFrame(a).withColumn("doc_id", F.lit(1))
    items = spark.createDataFrame([(1, "some words that never occur anywhere in any of the documents at all here")], "item_id long, text string")
    got = R.levels(d, an, items)
    assert {r.doc_id: r.level for r in got.where("doc_id <> 7").collect()} == {1: 5, 2: 1, 8: 5}
    assert got.where("doc_id = 7").count() == 1
    assert rows(R.levels(d, an, items, max_chars=10), "doc_id", "level") == rows(got, "doc_id", "level")
    assert R.levels(d.limit(0), an, items).count() == 0
    assert R.levels(d, an, items.limit(0)).count() == 4
    assert rows(R.profile(d, got.where("doc_id = 2")), "source", "level", "documents") == [("run_report", 1, 1)]


def test_fit_needs_labels_and_takes_few():
    with pytest.raises(ValueError):
        R.fit([])
    m = R.fit([(1, Counter({"a": 3}), 1.0), (2, Counter({"b": 3}), 1.0)])
    assert m.best(Counter({"a": 1}))[0] == 1 and m.best(Counter({"b": 1}))[0] == 2 and m.best(Counter({"zzz": 1}))[0] == 1
