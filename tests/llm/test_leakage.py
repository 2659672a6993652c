import random
import re

from pyspark.sql import functions as F

from isolake.llm import leakage as L
from tests.conftest import rows

WORDS = [f"w{k}" for k in range(40)]


def words(text):
    return re.findall("[a-z0-9]+", text.lower())


def brute(docs, items):
    out = set()
    for d, t in docs:
        w = words(t or "")
        for i, s in items:
            x = words(s or "")
            n = min(12, len(x))
            runs = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)} if n else set()
            if any(tuple(w[k : k + n]) in runs for k in range(len(w) - n + 1)):
                out.add((d, i))
    return sorted(out)


def corpus(seed):
    rnd = random.Random(seed)
    items = [(i, " ".join(rnd.choice(WORDS) for _ in range(rnd.choice([1, 3, 11, 12, 13, 30])))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "?!"), (1, items[1][1]), (93, items[2][1])]
    docs = []
    for d in range(120):
        parts = [rnd.choice(WORDS) for _ in range(rnd.randrange(40))]
        if rnd.random() < 0.5:
            x = words(rnd.choice(items[:25])[1])
            s = rnd.randrange(max(1, len(x) - 10))
            parts[5:5] = x[s : s + rnd.choice([5, 11, 12, 20])]
        docs.append((d, rnd.choice([" ", ", ", "\n", "</b> ", " É "]).join(p.upper() if rnd.random() < 0.2 else p for p in parts)))
    return docs + [(500, None), (501, ""), (502, "İ" * 50 + " w1 w2")], items


def test_leaks_equal_brute_force(spark):
    docs, items = corpus(4)
    d = spark.createDataFrame(docs + docs[:20], "doc_id long, text string").withColumn("item_id", F.lit(1))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = brute(docs, items)
    assert len(want) > 20
    assert rows(L.leaks(d, i)) == want
    assert rows(L.leaks(d, i, max_chars=300)) == want  # several automata


def test_offsets_point_into_the_original(spark):
    item = " ".join(WORDS[:14])
    text = "Intro İİ: " + item.upper().replace(" ", ", ") + ". End"
    a = L.build([(7, item)])
    [(i, s, e)] = L.passages(a, text)
    assert (i, words(text[s:e])) == (7, words(item))
    assert text[s:e].startswith("W0") and text[s:e].endswith("W13")
    twice = item + " gap " + item
    assert [twice[s:e] for _, s, e in L.passages(a, twice)] == [item, item]


def test_long_texts_and_empty_tables(spark):
    item = " ".join(WORDS[:12])
    d = spark.createDataFrame([(1, "x " * 300_000 + item), (2, "y" * 500_000)], "doc_id long, text string")
    i = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert rows(L.leaks(d, i)) == [(1, 1)]
    assert L.leaks(d.limit(0), i).count() == 0
    assert L.leaks(d, i.limit(0)).count() == 0
    assert rows(L.leaked_items(d, i.withColumn("suite", F.lit("s")))) == [(1, "s", 1)]


def test_shared_runs_are_found_wherever_they_begin():
    """Runs of exactly 12 words at every offset of an item, with other words around; 11 words are no case."""
    words_ = [f"v{k}" for k in range(40)]
    m = L.build([(1, " ".join(words_))])
    for k in range(29):
        text = "x " + " ".join(words_[k : k + 12]) + " y"
        assert [text[s:e] for _, s, e in L.passages(m, text)] == [" ".join(words_[k : k + 12])]
        assert L.passages(m, "x " + " ".join(words_[k : k + 11]) + " y") == []


def test_an_automaton_has_about_one_node_a_word():
    rnd = random.Random(1)
    items = [(i, " ".join(rnd.choice(WORDS) + str(rnd.randrange(50)) for _ in range(100))) for i in range(50)]
    a = L.build(items).automaton
    assert a.get_stats()["nodes_count"] < 1.1 * 50 * 100


def test_a_worker_builds_once_for_each_query():
    a = L.built_once("t1", [(1, "one two")])
    assert L.built_once("t1", [(9, "other")]) is a
    assert L.built_once("t2", [(9, "other")]) is not a and L.built_once("t3", []) is None
