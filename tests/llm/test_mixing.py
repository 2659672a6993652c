import os

import pytest
from pyspark.sql import functions as F

from isolake.llm import mixing as M

pytestmark = pytest.mark.skipif(not os.path.exists(M.TOKENIZER), reason="no tokenizer files")


def world(spark, extra=()):
    docs, k = [], 0
    for source, n, word in (("Abstract", 200, "gene"), ("forum", 100, "hello"), (" teaching ", 20, "lesson"), ("press", 10, "news")):
        for j in range(n):
            docs.append((k, f"{word} " * (20 + j % 5), source))
            k += 1
    docs += [(1000 + j, "lesson " * 20, None) for j in range(5)] + list(extra)
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("tokens", F.lit("clash")).withColumn("rate", F.lit(1))
    t = spark.createDataFrame([("abstract", 0.5, 1), ("forum", 0.3, 1), ("teaching", 0.2, 4), ("field_book", 0.0, 2)], "source string, target_share double, max_repeats int")
    return d, t


def test_shares_meet_targets_within_the_caps(spark):
    d, t = world(spark)
    mixed = M.mix(d, t)
    r = {x.source: x for x in M.report(mixed, t).collect()}
    for source, share in (("abstract", 0.5), ("forum", 0.3)):
        assert r[source].reached_share == pytest.approx(share, abs=0.02)
    assert r["teaching"].reached_share + r[None].reached_share == pytest.approx(0.2, abs=0.02)
    assert r["abstract"].expected_share == pytest.approx(0.5, abs=0.02) and r["teaching"].expected_share == pytest.approx(0.2, abs=0.02)
    assert 1 < r["teaching"].most_repeats <= 4 and r["press"].tokens_used == 0 and r["field_book"].documents == 0
    assert mixed.where("repeats > cap OR repeats < 0 OR rate > cap + 1e-9").count() == 0


def test_unlabelled_documents_get_posteriors(spark):
    d, t = world(spark)
    docs, goal = M.members(d, t)
    at = [g[0] for g in goal].index("teaching")
    p = [r.p[at] for r in docs.where("source IS NULL").collect()]
    assert len(p) == 5 and min(p) > 0.8
    assert all(abs(sum(r.p) - 1) < 1e-9 for r in docs.where("source IS NOT NULL AND source <> 'press'").collect())


def test_a_stated_total_is_met_and_impossible_shares_are_reported(spark):
    d, t = world(spark)
    docs, goal = M.members(d, t)
    rates, total = M.fit_rates(docs, goal, total_tokens=2000.0)
    got = rates.agg(F.sum(F.col("rate") * F.col("tokens"))).first()[0]
    assert total == 2000.0 and got == pytest.approx(2000, rel=0.01)
    rates, _ = M.fit_rates(docs, goal, total_tokens=1e6)
    assert rates.where("rate > cap").count() == 0


def test_soft_labels(spark):
    d, t = world(spark)
    docs, goal = M.members(d, t, label_trust=0.9)
    r = docs.where("source = 'abstract'").first()
    assert 0.5 < r.p[[g[0] for g in goal].index("abstract")] <= 1.0
    rates, _ = M.fit_rates(docs, goal)
    sums = [rates.agg(F.sum(F.col("rate") * F.col("tokens") * F.get("p", F.lit(i)))).first()[0] for i in range(4)]
    assert sums[0] / sum(sums) == pytest.approx(0.5, abs=0.03)


def test_nulls_repeats_empty_and_long_texts(spark):
    d, t = world(spark, [(2000, None, "forum"), (2001, "", "forum"), (0, "gene " * 20, "Abstract"), (2002, "a" * 200_000 + " b" * 50_000, "forum"), (2003, "x", "  ")])
    mixed = M.mix(d, t)
    assert mixed.count() == mixed.select("doc_id").distinct().count() == 339
    assert {r.doc_id: r.tokens for r in mixed.where("doc_id IN (2000, 2001)").collect()} == {2000: 0, 2001: 0}
    assert M.mix(d.limit(0), t).count() == 0
    assert M.mix(d, t.limit(0)).where("repeats > 0").count() == 0
    assert M.report(M.mix(d.limit(0), t), t).count() == 4


def test_token_counts_are_those_of_the_tokenizer(spark):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(M.TOKENIZER.replace(".tiktoken", ".json"))
    texts = ["A sample, aac(6')-Ib  called in 12 of 40.\n\nDon't", "élan 漢字 <|endoftext|>", " \t\n "]
    other.encode_special_tokens = True
    assert [len(M.encoding(M.TOKENIZER).encode_ordinary(x)) for x in texts] == [len(other.encode(x, add_special_tokens=False).ids) for x in texts]


def test_memberships_are_soft_and_trust_is_measured(spark):
    d, t = world(spark)
    names = [g[0] for g in M._goal(t)]
    m = M.fit_on(d, names)
    assert 0.5 <= m.trust <= M.MOST_TRUST
    i = names.index("abstract")
    sure, odd = m.membership("gene " * 25, i), m.membership("hello " * 25, i, 0.9)
    assert sure[i] > 0.98 > odd[i] and abs(odd.sum() - 1) < 1e-9 and odd[names.index("forum")] > 0.5
    # held-out labels that the texts speak against lower the trust
    texts = [(s, w * 20) for s, w in (("a", "gene "), ("b", "hello ")) for _ in range(40)]
    held = texts + [("a", "hello " * 20)] * 12
    assert M.fit_domains(texts, ["a", "b"], held).trust < M.fit_domains(texts, ["a", "b"], texts).trust == M.MOST_TRUST


def test_rare_sources_keep_their_labels(spark, monkeypatch):
    monkeypatch.setattr(M, "MAX_LABELLED", 60)
    d, t = world(spark)
    m = M.fit_on(d, [g[0] for g in M._goal(t)])
    assert [x for x, p in zip(m.domains, m.log_prior) if p > -50] == ["abstract", "forum", "teaching"]


def test_held_out_shares(spark):
    d, t = world(spark)
    r = {x.source: x for x in M.held_out_shares(d, t).collect()}
    assert set(r) == {"abstract", "forum", "teaching", "field_book"} and r["field_book"].documents == 0
    assert all(abs(x.true_share - x.expected_share) < 0.05 for x in r.values())


def test_the_descent_goes_on_until_it_has_converged(spark):
    """Strongly mixed memberships need far more than sixty steps."""
    docs = spark.createDataFrame([(k, "a", 10, 3, [0.6, 0.4] if k % 2 else [0.4, 0.6]) for k in range(100)], "doc_id long, source string, tokens long, cap int, p array<double>")
    goal = [("a", 0.505, 3), ("b", 0.495, 3)]
    rates, total = M.fit_rates(docs, goal, total_tokens=800.0, tolerance=1e-5)
    got = rates.agg(*[F.sum(F.get("p", F.lit(i)) * F.col("tokens") * F.col("rate")).alias(f"s{i}") for i in range(2)]).first()
    assert got.s0 == pytest.approx(404, abs=0.2) and got.s1 == pytest.approx(396, abs=0.2) and rates.count() == 100
