"""Mixing sources to target token shares by soft membership.

A classifier trained on documents whose source is known gives every document a posterior over the target domains. A document's own label,
where it has one, is further evidence, weighed by how far labels can be trusted; that is measured on held-out labels, as is the sharpness of the
posteriors. Nonnegative document rates r, at most the repeats allowed, are then fitted by projected gradient descent to

    f(r) = 1/2 sum_k (A_k(r) - b_k)^2 / M_k,   A_k(r) = sum_d r_d tokens_d p_dk,   M_k = sum_d tokens_d p_dk,

where b_k is the domain's target share of the wanted total. In the metric that weighs a document by its tokens the gradient is
sum_k p_dk (A_k - b_k) / M_k and its Lipschitz constant is at most 1, so steps of length 1 converge. Memberships are kept in steps of 1 / GRID, and documents
with equal memberships and equal allowance have equal rates, so the descent runs over one row for each of those, with the sum of their tokens. An iteration
sends the workers one small vector of residuals and brings back one sum per domain.

Rates become whole repeats by systematic rounding within blocks of a source, which keeps each block's total within one document.
"""

from __future__ import annotations

import math
import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isolake.session import materialise

TOKENIZER = os.environ.get("ISOLAKE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the word pattern that belongs to the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The classifier is fitted and measured on at most so many labelled documents, an equal number a domain where there are as many, those of the least hashes.
MAX_LABELLED = 10_000
#: Memberships are multiples of 1 / GRID before they are made to sum to 1.
GRID = 256
#: A label is never trusted more than this, so that memberships stay soft.
MOST_TRUST = 0.995
FEATURES = 1 << 14
_TERM = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|\n")
_encodings: dict[str, object] = {}


def source_key(source: Column) -> Column:
    """A source name as compared: lower case, without outer blanks, words joined by underscores; empty is null."""
    key = F.regexp_replace(F.lower(F.btrim(source, F.lit(" \t\r\n"))), r"[\s_-]+", "_")
    return F.when(key != "", key)


def encoding(path: str):
    """The tokenizer of a rank file, built once a process."""
    if path not in _encodings:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def hashed(text: str) -> Counter:
    """Counts of hashed terms: words, number lengths, punctuation and line breaks."""
    return Counter(map(_feature, _TERM.findall(text.lower())))


@lru_cache(maxsize=100_000)
def _feature(term: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(f"<{len(term)}>" if term.isdigit() else term) % FEATURES


@dataclass
class DomainModel:
    domains: list[str]
    log_p: np.ndarray  # domain x feature
    log_prior: np.ndarray
    temperature: float
    trust: float = MOST_TRUST  # of a label, as measured
    _rows: np.ndarray | None = None

    def scores(self, counts: Counter) -> np.ndarray:
        if not counts:
            return np.zeros(len(self.domains))
        ids = np.fromiter(counts.keys(), int, len(counts))
        return np.fromiter(counts.values(), float, len(counts)) @ self._by_feature()[ids]

    def _by_feature(self) -> np.ndarray:
        """Log probabilities with one contiguous row a feature."""
        if self._rows is None:
            self._rows = np.ascontiguousarray(self.log_p.T)
        return self._rows

    def posterior(self, text: str | None) -> np.ndarray:
        """Domain posteriors of a text; without text, the priors. A domain without labelled texts gets 0."""
        if not np.isfinite(self.log_prior).any():
            return np.zeros(len(self.domains))
        s = self.log_prior + self.temperature * self.scores(hashed(text or ""))
        p = np.exp(s - s.max())
        return p / p.sum()

    def weighed(self, p: np.ndarray, label: int | None, trust: float | None = None) -> np.ndarray:
        """Posteriors weighed by the label (its place in `domains`) if there is one, in steps of 1 / GRID."""
        if label is not None:
            t = self.trust if trust is None else trust
            odds = np.full(len(self.domains), (1 - t) / max(1, len(self.domains) - 1))
            odds[label] = t
            p = p * odds
            if p.sum() <= 0:  # the domain has no labelled text to learn from
                p = odds
            p = p / p.sum()
        q = np.round(p * GRID)
        return q / q.sum() if q.sum() else p

    def membership(self, text: str | None, label: int | None, trust: float | None = None) -> np.ndarray:
        return self.weighed(self.posterior(text), label, trust)


def fit_domains(labelled: list[tuple[str, str]], domains: list[str], held: list[tuple[str, str]] | None = None) -> DomainModel:
    """Multinomial naive Bayes over hashed terms of (domain, text); held-out texts set the temperature of its posteriors and the trust in labels.

    Without `held`, a fifth of the texts are held out. A domain without labelled texts has no model and is never predicted.
    """
    if held is None:
        labelled, held = [x for i, x in enumerate(labelled) if i % 5 < 4], [x for i, x in enumerate(labelled) if i % 5 == 4]
    k = {d: i for i, d in enumerate(domains)}
    counts = np.full((len(domains), FEATURES), 0.01)
    prior = np.zeros(len(domains))
    for domain, text in labelled:
        prior[k[domain]] += 1
        for f, n in hashed(text).items():
            counts[k[domain], f] += n
    prior = np.where(prior > 0, prior + 1, 0)
    with np.errstate(divide="ignore"):
        log_prior = np.log(prior / max(prior.sum(), 1.0))
    model = DomainModel(domains, np.log(counts / counts.sum(1, keepdims=True)), log_prior, 0.0)
    seen = [(k[d], hashed(t)) for d, t in held if prior[k[d]] > 0]
    if not seen:
        return model
    at = np.array([d for d, _ in seen])
    scores = np.array([model.scores(c) for _, c in seen])
    best = -math.inf
    for temperature in (0.0, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0):
        s = model.log_prior + temperature * scores
        s = s - s.max(1, keepdims=True)
        log_p = s[np.arange(len(at)), at] - np.log(np.exp(s).sum(1))
        if log_p.sum() > best + 1e-9:
            best, model.temperature, own = float(log_p.sum()), temperature, np.exp(log_p)
    # the label is right with probability t, else any other domain's: the t under which the held-out labels are likeliest
    grid = np.linspace(0.5, MOST_TRUST, 200)
    likely = [float(np.log(t * own + (1 - t) / max(1, len(domains) - 1) * (1 - own)).sum()) for t in grid]
    model.trust = float(grid[int(np.argmax(likely))])
    return model


def _goal(targets: DataFrame) -> list[tuple[str, float, int]]:
    """(key, share, repeats) of the targets, one a source; their number is bounded by whoever states them."""
    rows = targets.select(source_key(F.col("source")).alias("k"), "target_share", "max_repeats").where("k IS NOT NULL").groupBy("k").agg(F.max("target_share").alias("s"), F.max("max_repeats").alias("m")).orderBy("k").collect()
    return [(r.k, float(r.s or 0.0), int(r.m or 0)) for r in rows]


def _held_out() -> Column:
    """A fifth of the documents, by hash, is never fitted on."""
    return F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(5)) == 4


def fit_on(documents: DataFrame, domains: list[str]) -> DomainModel:
    """The classifier of a bounded sample of labelled documents, drawn domain by domain so that rare ones keep their labels."""
    docs = documents.select("doc_id", "text", source_key(F.col("source")).alias("source"))
    known = docs.where(F.col("source").isin(domains) & F.col("text").isNotNull())
    n = {r["source"]: r["n"] for r in known.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most one row a target
    each = MAX_LABELLED // max(1, len(domains))
    part = F.lit(0)
    for d, there in n.items():
        part = F.when(F.col("source") == d, F.lit(int(min(1.0, 1.2 * each / there) * (1 << 30)))).otherwise(part)
    h = F.xxhash64("doc_id")
    sample = known.where(F.pmod(h, F.lit(1 << 30)) < part).select("source", "text", _held_out().alias("held"), h.alias("h")).orderBy("h", "text").limit(MAX_LABELLED)
    rows = list(sample.toLocalIterator())
    return fit_domains([(r.source, r.text) for r in rows if not r.held], domains, [(r.source, r.text) for r in rows if r.held])


def members(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, label_trust: float | None = None) -> tuple[DataFrame, list[tuple[str, float, int]]]:
    """((doc_id, source, tokens, cap, p, own), targets): tokens of every document, its memberships in the target domains, and its posteriors by text alone.

    A document whose source is no target has cap 0; one without a source may be used once. Empty and null texts have no tokens.
    Rows repeated under one doc_id count once. Targets are (key, share, repeats), one row a source. `label_trust` is measured unless given.
    """
    spark = documents.sparkSession
    goal = _goal(targets)
    model = fit_on(documents, [g[0] for g in goal])
    docs = documents.select("doc_id", "text", source_key(F.col("source")).alias("source"))
    shared = spark.sparkContext.broadcast((model, goal))
    schema = T.StructType().add("doc_id", "long").add("source", "string").add("tokens", "long").add("cap", "integer").add("p", T.ArrayType(T.DoubleType())).add("own", T.ArrayType(T.DoubleType()))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, goal = shared.value
        enc = encoding(tokenizer)
        at = {g[0]: i for i, g in enumerate(goal)}
        least = min((g[2] for g in goal if g[2] > 0), default=0)
        for b in batches:
            ids, texts, sources = (b.column(c).to_pylist() for c in ("doc_id", "text", "source"))
            tokens = [len(enc.encode_ordinary(t)) if t else 0 for t in texts]
            caps, ps, own = [], [], []
            for t, s in zip(texts, sources):
                posterior = model.posterior(t)
                own.append(model.weighed(posterior, None))
                if s is None:
                    caps.append(min(1, least))
                    ps.append(own[-1])
                elif s not in at:
                    caps.append(0)
                    ps.append(np.zeros(len(goal)))
                else:
                    caps.append(goal[at[s]][2])
                    ps.append(model.weighed(posterior, at[s], label_trust))
            lists = [pa.array([list(map(float, p)) for p in x], pa.list_(pa.float64())) for x in (ps, own)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sources, pa.string()), pa.array(tokens, pa.int64()), pa.array(caps, pa.int32()), *lists], names=["doc_id", "source", "tokens", "cap", "p", "own"])

    return materialise(docs.mapInArrow(assign, schema).dropDuplicates(["doc_id"]), "mixing"), goal


def fit_rates(docs: DataFrame, goal: list[tuple[str, float, int]], total_tokens: float | None = None, tolerance: float = 1e-4, keep: int = 8) -> tuple[DataFrame, float]:
    """`docs` with `rate`, and the wanted total of tokens.

    Without targets all rates are 0. Without `total_tokens` the total is the largest at which no domain with documents needs more than all its repeats.
    The descent ends when every domain's total is within `tolerance` of the wanted total, or no domain's total still moves by a hundredth of that: what
    is left of the gap then cannot be closed. Every `keep` steps the rates are written to the shared folder, so a step replays at most `keep` steps.
    """
    k = len(goal)
    if not k:
        return docs.withColumn("rate", F.lit(0.0)), 0.0
    groups = materialise(docs.groupBy("p", "cap").agg(F.sum("tokens").alias("tokens")), "mixing")
    sums = [F.sum(F.get("p", F.lit(i)) * F.col("tokens")).alias(f"m{i}") for i in range(k)] + [F.sum(F.get("p", F.lit(i)) * F.col("tokens") * F.col("cap")).alias(f"c{i}") for i in range(k)]
    row = groups.agg(*sums).first()
    mass = np.array([row[f"m{i}"] or 0.0 for i in range(k)])
    most = np.array([row[f"c{i}"] or 0.0 for i in range(k)])
    share = np.array([g[1] for g in goal])
    held = np.array([(row[f"c{i}"] or 0.0) > 1e-3 * (most.max(initial=0.0)) for i in range(k)])  # a domain that only strays of others reach cannot bound the total
    if total_tokens is None:
        fits = [most[i] / share[i] for i in range(k) if share[i] > 0 and held[i]]
        total_tokens = float(min(fits)) if fits else 0.0
    wanted = share * total_tokens
    usable = (mass > 0) & (most > 0)
    small = tolerance * max(total_tokens, 1.0)
    base, steps, before = groups.withColumn("r0", F.lit(0.0)), [], None
    while True:
        rate = _replay(steps)
        row = base.agg(*[F.sum(F.get("p", F.lit(i)) * F.col("tokens") * rate).alias(f"a{i}") for i in range(k)]).first()
        a = np.array([row[f"a{i}"] or 0.0 for i in range(k)])
        gap = np.where(usable, wanted - a, 0.0)
        if np.abs(gap).max(initial=0.0) <= small or (before is not None and np.abs(a - before).max(initial=0.0) <= small * 1e-2):
            break
        before = a
        steps.append(list(np.where(usable, gap / np.maximum(mass, 1e-9), 0.0)))
        if len(steps) == keep:
            base = materialise(base.withColumn("r0", _replay(steps)), "mixing")
            steps = []
    rates = base.select("p", "cap", _replay(steps).alias("rate"))
    return docs.join(rates, ["p", "cap"]).select(*docs.columns, "rate"), total_tokens


def _replay(steps: list[list[float]]) -> Column:
    """The rate after `steps`, from the kept rate `r0`: each adds sum_k p_k c_k and is projected onto [0, cap]."""
    if not steps:
        return F.col("r0")
    history = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])

    def step(r: Column, c: Column) -> Column:
        moved = r + F.aggregate(F.zip_with("p", c, lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y)
        return F.greatest(F.lit(0.0), F.least(moved, F.col("cap").cast("double")))

    return F.aggregate(history, F.col("r0"), step)


def whole_repeats(rates: DataFrame, block: int = 200_000) -> DataFrame:
    """`rates` with `repeats`, the rate rounded down or up.

    Documents of a source are put into blocks by hash and, by token count within a block, rounded so that the running
    total of repeats stays within one of the running total of rates.
    """
    n = rates.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    r = rates.join(n, rates.source.eqNullSafe(n.source)).drop(n.source)
    r = r.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    from pyspark.sql import Window

    w = Window.partitionBy("source", "block").orderBy("tokens", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = F.floor(F.col("rate") + 1e-9)
    part = F.when(F.col("rate") - whole > 1e-9, F.col("rate") - whole).otherwise(0.0)
    run = F.sum(part).over(w)
    extra = F.floor(run + 0.5) - F.floor(run - part + 0.5)
    return r.withColumn("repeats", F.least((whole + extra).cast("int"), F.col("cap"))).drop("blocks", "block")


def mix(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, total_tokens: float | None = None, label_trust: float | None = None) -> DataFrame:
    """(doc_id, source, tokens, cap, p, rate, repeats) of every document: how often the mix holds it."""
    docs, goal = members(documents, targets, tokenizer, label_trust)
    rates, _ = fit_rates(docs.drop("own"), goal, total_tokens)
    return whole_repeats(rates).select("doc_id", "source", "tokens", "cap", "p", "rate", "repeats")


def _goal_table(targets: DataFrame) -> DataFrame:
    g = targets.select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats").where("source IS NOT NULL")
    return g.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))


def report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """A row a source of documents or targets: its documents and tokens, target, the share its domain is expected to have by soft membership
    (`expected_share`), and the share of the mix that documents labelled with it have (`reached_share`)."""
    found = mixed.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens_there"), F.max("repeats").alias("most_repeats"), F.sum(F.col("tokens") * F.col("rate")).alias("expected"), F.sum(F.col("tokens") * F.col("repeats")).alias("tokens_used")
    )
    names = [g[0] for g in _goal(targets)]
    soft = mixed.agg(*[F.sum(F.get("p", F.lit(i)) * F.col("tokens") * F.col("repeats")).alias(f"s{i}") for i in range(len(names))], F.sum(F.col("tokens") * F.col("repeats")).alias("total")).first()
    share = lambda x: float(x or 0.0) / float(soft["total"] or 1)
    domain = F.lit(0.0)
    for i, d in enumerate(names):
        domain = F.when(F.col("source") == d, F.lit(share(soft[f"s{i}"]))).otherwise(domain)
    return _goal_table(targets).join(found, "source", "full_outer").select(
        "source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"),
        F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("tokens_there", F.lit(0)).alias("tokens_there"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
        F.round(F.coalesce("expected", F.lit(0.0)), 3).alias("tokens_expected"), F.coalesce("tokens_used", F.lit(0)).alias("tokens_used"),
        F.round(domain, 6).alias("expected_share"), F.round(F.coalesce(F.try_divide(F.col("tokens_used"), F.lit(soft["total"])), F.lit(0.0)), 6).alias("reached_share"),
    )


def held_out_shares(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(source, documents, true_share, expected_share) of the labelled documents the classifier was not fitted on: token shares by label, and by text alone."""
    docs, goal = members(documents, targets, tokenizer)
    names = [g[0] for g in goal]
    held = docs.where(_held_out() & F.col("source").isin(names))
    soft = held.agg(*[F.sum(F.get("own", F.lit(i)) * F.col("tokens")).alias(f"s{i}") for i in range(len(names))], F.sum("tokens").alias("total")).first()
    domain = F.lit(0.0)
    for i, d in enumerate(names):
        domain = F.when(F.col("source") == d, F.lit(float(soft[f"s{i}"] or 0.0) / float(soft["total"] or 1))).otherwise(domain)
    there = held.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))
    return _goal_table(targets).select("source").join(there, "source", "left").select(
        "source", F.coalesce("documents", F.lit(0)).alias("documents"), F.round(F.coalesce(F.col("tokens") / float(soft["total"] or 1), F.lit(0.0)), 4).alias("true_share"), F.round(domain, 4).alias("expected_share")
    )
