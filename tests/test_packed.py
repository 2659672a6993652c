import json
import random
import re

import pytest
from pyspark.sql import functions as F

from isolake.operators import packed as P
from tests.conftest import rows


def by_rule(text):
    """The field rule, character by character."""
    t = text.strip(" \t\r\n")
    if t in ("", ".", "NA", "MISSING"):
        return []
    if t.startswith("["):
        try:
            return [x for x in json.loads(t) if x is not None]
        except ValueError:
            pass
    pieces, cur, inside = [], "", False
    for ch in text:
        if ch == '"':
            inside = not inside
        if ch in ",;|\r\n" and not inside:
            pieces.append(cur)
            cur = ""
        else:
            cur += ch
    pieces = [p.strip(" \t\r\n") for p in [*pieces, cur]]
    return [p[1:-1].replace('""', '"') if re.fullmatch(r'"(?:[^"]|"")*"', p, re.S) else p for p in pieces if p]


def run(spark, texts, **kw):
    df = spark.createDataFrame([(str(i), t, "clash", 1) for i, t in enumerate(texts)], "k string, f string, value string, pos int")
    out = P.parsed([("t", df, "k", ["f"])], **kw)
    got = {r.row_key: (list(r["values"]), r.agrees) for r in out.collect()}
    return [got.get(str(i), ([], True)) for i in range(len(texts))]


CASES = ["a,b;c|d\ne", '"x, y",z', "a,,b, ,", "aac(6')-Ib , ant(2'')-Ia", '["p","q \\"r\\"","p"]', "[]", "[broken, x", '"a ""b"" c";d', "", "  ", None, ".", "NA", "MISSING", "single", ' " keep " ;x', "a\r\nb", '"open, x;y', '""', "a'b,c'd"]


def rule_values(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    held = ~F.trim(F.coalesce("t", F.lit(""))).isin(*P.NO_VALUES)
    return [list(r.v) if r.v is not None else [] for r in df.select("i", F.when(held, P.split_by_rule(F.col("t"))).alias("v")).orderBy("i").collect()]


def test_the_field_rule(spark):
    assert rule_values(spark, CASES) == [by_rule(c) if c is not None else [] for c in CASES]


def collection(seed, n=400):
    rnd = random.Random(seed)
    names = [f"gene{k}.{k % 7}" for k in range(30)]
    texts = []
    for _ in range(n):
        vals = [rnd.choice(names) for _ in range(rnd.randrange(1, 6))]
        if rnd.random() < 0.2:
            vals = [f"{v}, like" if rnd.random() < 0.5 else v for v in vals]
            texts.append(json.dumps(vals) if rnd.random() < 0.5 else rnd.choice([",", ";", " | "]).join(f'"{v}"' for v in vals))
        else:
            texts.append(rnd.choice([",", ";", "|", "\n", ", ", " ; "]).join(vals))
    return texts


def test_the_cheapest_dialect_is_the_rule_on_recurring_values(spark):
    texts = collection(2)
    got = run(spark, texts)
    assert [v for v, _ in got] == [by_rule(t) for t in texts]
    assert all(agrees for _, agrees in got)


def test_description_lengths_decide(spark, monkeypatch):
    """With every price the same nothing is worth dividing, so other dialects win: no rule stands behind the choice."""
    texts = collection(3, 150)
    monkeypatch.setattr(P, "_priced", lambda model, spark: _flat)
    got = run(spark, texts)
    assert sum(not agrees for _, agrees in got) > 50
    assert sum(v != by_rule(t) for (v, _), t in zip(got, texts)) > 50


def _flat(batches):
    import pyarrow as pa

    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("field"), b.column("value"), *[pa.array([100.0] * b.num_rows) for _ in P.CONVENTIONS]], names=["field", "value", *[f"b{i}" for i in range(len(P.CONVENTIONS))]])


def test_another_convention_is_found(spark):
    """Values quoted by apostrophes: the same method takes that convention where the collection has it, which the field rule would not."""
    rnd = random.Random(9)
    names = [f"word{k} of, {k % 7}; end" for k in range(12)]
    texts = [rnd.choice([",", ";"]).join(f"'{rnd.choice(names)}'" for _ in range(rnd.randrange(2, 6))) for _ in range(300)]
    got = run(spark, texts)
    assert all(v == re.findall(r"'([^']*)'", t) and not agrees for (v, agrees), t in zip(got, texts))


def test_trigrams_and_spelling():
    import numpy as np
    import pyarrow as pa

    tri, at = P._trigrams(pa.array(["ab", "", "é"]))
    a, b, o, n = ord("a") - 29, ord("b") - 29, 2, P.ALPHABET
    assert at.tolist() == [0, 3, 4] and tri.tolist() == [a, a * n + b, (a * n + b) * n + 1, 1, o, o * n + 1]
    counts = np.bincount(tri, minlength=n**3)[None].astype(float)
    bits = P.spelling_bits(counts)
    assert np.allclose((2.0 ** -bits).reshape(-1, n).sum(1), 1)  # a probability after every pair


@pytest.mark.parametrize("seed", [1, 2])
def test_the_rule_on_random_texts_and_a_choice_for_each(spark, seed):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice('ab1,;|\n\r" \'[]\\\u0001') for _ in range(rnd.randrange(30))) for _ in range(300)]
    texts = [t for t in texts if not t.strip(" \t\r\n").startswith("[")]
    assert rule_values(spark, texts) == [by_rule(t) for t in texts]
    got = run(spark, texts)
    assert all(agrees == (v == by_rule(t)) for (v, agrees), t in zip(got, texts) if t.strip(" \t\r\n") not in P.NO_VALUES)


def test_long_texts_repeats_nulls_and_positions(spark):
    long = ",".join(f"v{i}" for i in range(60_000)) + ',"' + "q;" * 50_000 + '"'
    df = spark.createDataFrame([("1", long), ("2", "a,a"), ("2", "a,a"), (None, "x"), ("3", None)], "k string, f string")
    out = P.exploded(P.parsed([("t", df, "k", ["f"])]))
    assert out.where("row_key = '1'").count() == 60_001
    assert rows(out.where("row_key = '2'"), "pos", "value") == [(1, "a"), (2, "a")]
    assert rows(out.where("row_key IS NULL"), "pos", "value") == [(1, "x")]
    assert dict(out.dtypes)["pos"] == "int"
    assert P.exploded(P.parsed([("t", df.limit(0), "k", ["f"])])).count() == 0


def test_one_text_may_hold_most_rows(spark):
    """Values recur in longer lists, as without that nothing tells a delimiter from a character."""
    name = lambda k: F.concat(F.lit("gene"), F.pmod(F.xxhash64("id", F.lit(k)), F.lit(40)).cast("string"))
    other = F.concat_ws(",", *[name(k) for k in range(6)])
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 > 0, "a,b").otherwise(other).alias("f"))
    out = P.exploded(P.parsed([("t", df, "k", ["f"])], rows_per_task=500))
    got = out.where("value LIKE 'gene%'").count(), out.where("value NOT LIKE 'gene%'").groupBy("value").count().collect()
    assert got[0] == 1667 * 6 and (got[1] == [("a,b", 3333)] or sorted(got[1]) == [("a", 3333), ("b", 3333)])


def test_a_collection_without_recurring_values_keeps_its_commas(spark):
    """The defined result where no value occurs twice: dividing saves no bits, so each text stays whole, and `agrees` says that the rule would divide."""
    got = run(spark, [f"x,{k}" for k in range(300)])
    assert all(v == [f"x,{k}"] and not agrees for k, (v, agrees) in enumerate(got))
