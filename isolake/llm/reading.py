"""Reading level of documents: smoothed unigram language models per grade level, highest posterior wins.

The vocabulary of a model is words and, for each sentence, `LENGTH_TOKENS` copies of a token for its length class, so that a
model sees how long sentences run as well as which words they use. A level is modelled as a small mixture of unigram models
(hard words in short sentences and easier words in long ones can be the same level), fitted by expectation
maximisation from a start that sorts the level's texts by mean sentence length; all steps are deterministic. Words that no anchor
text holds say nothing about a level and are left out.

What does not change a document's level is taken out before: tags, references in brackets, list marks, clock prefixes, lists of gene
names, and passages of evaluation items. Names and numbers (words with a digit) are left out too.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isolake.llm.leakage import MAX_CHARS, RUN, built_once, find_passages, item_blocks, passages

COMPONENTS, ALPHA, PULL, LENGTH_TOKENS, ROUNDS = 3, 0.5, 300.0, 3, 20
#: A level model is fitted on at most so many labelled texts, those of the least anchor ids.
MAX_ANCHORS = 20_000

_BREAK = "\n\n"
_TAG = re.compile(r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article)\b[^<>]{0,200}>", re.I)
_INLINE = re.compile(r"</?[a-zA-Z][^<>]{0,200}>|&[a-zA-Z]{2,8};|&#\d{1,6};")
_NOTE = re.compile(r"(?<![^\s])[\[(][^\[\]()]{0,80}\d[^\[\]()]{0,80}[\])]")
_CLOCK = re.compile(r"^[ \t>]*[\[(]?\d{1,2}:\d{2}(?::\d{2})?[\])]?(?:[ \t]*[-–:])?[ \t]+", re.M)
_MARK = re.compile(r"^[ \t]*(?:(?:[-*•>+#]+|\(?\d{1,3}[.)])[ \t]+)+", re.M)
_INNER_MARK = re.compile(r"(?<=[.!?])[ \t]+(?:\(?\d{1,3}\)[ \t]+|[-•][ \t]+)(?=[A-Z\"“])")
_GENES = re.compile(r"\bGenes?:\s*[^\s,]+(?:,\s+[^\s,]+)*")
_ABBREVIATION = re.compile(r"\b(?:i\.e|e\.g|cf|vs|pp|ref|fig|etc|al)\.", re.I)
_STOPS = tuple(f"{a}." for a in ("i.e", "e.g", "cf", "vs", "pp", "ref", "fig", "etc", "al"))
_WRAP = re.compile(r"(?<!\n)\n(?!\n)")
_SENTENCE = re.compile(r"[.!?]+(?=[\s\"”')\]*_]|$)|\n\s*\n")
_TOKEN = re.compile(r"[^\s.,;:!?\"“”()\[\]{}*_`<>|/=+]+")
_NAME = re.compile(r"[0-9]")


def plain(text: str, cuts: Iterable[tuple[int, int]] = ()) -> str:
    """The text in lower case, without what does not change its level; what was taken out between sentences leaves a break."""
    cuts = sorted(cuts)
    if cuts:
        kept, at = [], 0
        for s, e in cuts:
            if s > at:
                kept.append(text[at:s])
            at = max(at, e)
        text = _BREAK.join([*kept, text[at:]])
    if "<" in text or "&" in text:
        text = _INLINE.sub(" ", _TAG.sub(_BREAK, text))
    if "Gene" in text:
        text = _GENES.sub(_BREAK, text)
    if ":" in text:
        text = _CLOCK.sub(_BREAK, text)
    text = _MARK.sub(_BREAK, text)
    if ")" in text or "-" in text or "•" in text:
        text = _INNER_MARK.sub(_BREAK, text)
    if "(" in text or "[" in text:
        text = _NOTE.sub(" ", text)
    text = text.lower()
    if any(a in text for a in _STOPS):
        text = _ABBREVIATION.sub(" ", text)
    return _WRAP.sub(" ", text) if "\n" in text else text


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence of a plain text; words with a digit are names or numbers and left out."""
    out = []
    for s in _SENTENCE.split(text):
        w = [t if t.isalpha() else t.strip("'’-–") for t in _TOKEN.findall(s) if t.isalpha() or not _NAME.search(t)]
        if w and not all(w):
            w = [t for t in w if t]
        if w:
            out.append(w)
    return out


def features(text: str, cuts: Iterable[tuple[int, int]] = ()) -> tuple[Counter, float]:
    """Token counts and the mean sentence length of a text."""
    found = sentences(plain(text, cuts))
    c = Counter([w for s in found for w in s])
    for s in found:
        c[_length_token(len(s))] += LENGTH_TOKENS
    return c, sum(map(len, found)) / len(found) if found else 0.0


@lru_cache(maxsize=4096)
def _length_token(words: int) -> str:
    return f"<{min(12, int(2 * math.log2(words)))}>"


@dataclass
class LevelModel:
    vocabulary: dict[str, int]
    log_p: np.ndarray  # component x token
    log_prior: np.ndarray  # component
    level: np.ndarray  # component
    _rows: np.ndarray | None = None

    def posteriors(self, counts: Counter) -> dict[int, float]:
        """Posterior of each level. A text without known tokens gets the priors."""
        at = self.vocabulary.get
        ids = [at(w, -1) for w in counts]
        k = np.fromiter(counts.values(), float, len(ids))
        ids = np.array(ids, dtype=np.intp)
        seen = ids >= 0
        s = self.log_prior + k[seen] @ self._by_token()[ids[seen]]
        p = np.exp(s - s.max())
        return {int(v): float(p[self.level == v].sum() / p.sum()) for v in np.unique(self.level)}

    def _by_token(self) -> np.ndarray:
        """Log probabilities with one contiguous row a token."""
        if self._rows is None:
            self._rows = np.ascontiguousarray(self.log_p.T)
        return self._rows

    def best(self, counts: Counter) -> tuple[int, float]:
        """The most probable level (the lowest of equals) and its posterior."""
        p = self.posteriors(counts)
        level = max(p, key=lambda v: (round(p[v], 12), -v))
        return level, p[level]


def fit(anchors: Iterable[tuple[int, Counter, float]], components: int = COMPONENTS, alpha: float = ALPHA, pull: float = PULL) -> LevelModel:
    """A model from (level, token counts, mean sentence length) of labelled texts.

    `alpha` tokens of each kind smooth the level's unigram model, `pull` tokens drawn from that smooth its components.
    """
    anchors = list(anchors)
    if not anchors:
        raise ValueError("no labelled texts")
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*[c.keys() for _, c, _ in anchors])))}
    size = len(vocabulary)
    log_p, prior, level = [], [], []
    levels = sorted({v for v, _, _ in anchors})
    for v in levels:
        docs = sorted((x for x in anchors if x[0] == v), key=lambda x: (x[2], sorted(x[1].items())))
        k = max(1, min(components, len(docs) // 3))
        # counts as (text, token, number) triples: no text is spread over the whole vocabulary
        lengths = [len(c) for _, c, _ in docs]
        text = np.repeat(np.arange(len(docs)), lengths)
        token = np.fromiter((vocabulary[w] for _, c, _ in docs for w in c), np.intp, sum(lengths))
        n = np.fromiter((x for _, c, _ in docs for x in c.values()), float, sum(lengths))
        whole = np.bincount(token, n, size) + alpha
        whole /= whole.sum()
        r = np.zeros((len(docs), k))
        r[np.arange(len(docs)), np.arange(len(docs)) * k // len(docs)] = 1
        for _ in range(ROUNDS if k > 1 else 1):
            counts = np.array([np.bincount(token, n * r[text, j], size) for j in range(k)]) + (pull * whole if k > 1 else alpha)
            p = np.log(counts / counts.sum(1, keepdims=True))
            pi = np.log((r.sum(0) + 1) / (len(docs) + k))
            s = np.array([np.bincount(text, n * p[j, token], len(docs)) for j in range(k)]).T + pi
            r = np.exp(s - s.max(1, keepdims=True))
            r /= r.sum(1, keepdims=True)
        log_p.append(p)
        prior.append(pi - math.log(len(levels)))
        level += [v] * k
    return LevelModel(vocabulary, np.vstack(log_p), np.concatenate(prior), np.array(level))


def fit_anchors(anchors: DataFrame, **options) -> LevelModel:
    """Fit on at most MAX_ANCHORS labelled texts; null levels and blank texts are left out."""
    rows = anchors.where("level IS NOT NULL AND text IS NOT NULL").dropDuplicates(["anchor_id", "level", "text"]).orderBy("anchor_id", "level", "text").limit(MAX_ANCHORS).select("level", "text").collect()
    return fit(((r.level, *features(r.text)) for r in rows if r.text.strip()), **options)


def levels(documents: DataFrame, anchors: DataFrame, items: DataFrame, lang: str = "en", max_chars: int = MAX_CHARS, **options) -> DataFrame:
    """(doc_id, level, posterior) of the documents in `lang` whose text is not blank.

    A document with no word that the anchors know gets the lowest of the most probable levels by prior. Rows repeated under one doc_id
    give one row.
    """
    spark = documents.sparkSession
    model = fit_anchors(anchors, **options)
    blocks = list(item_blocks(items, max_chars)) if (items.agg(F.sum(F.length("text"))).first()[0] or 0) <= max_chars else None
    shared = spark.sparkContext.broadcast((model, (uuid.uuid4().hex, blocks[0]) if blocks else None))
    docs = documents.where((F.col("lang") == lang) & F.col("text").isNotNull() & (F.btrim("text", F.lit(" \t\r\n")) != "")).select("doc_id", "text")
    if blocks is None:  # too many items for one automaton: find passages in blocks first
        cuts = find_passages(docs, items, RUN, max_chars).groupBy("doc_id").agg(F.collect_set(F.struct("start_at", "end_at")).alias("cuts"))
        docs = docs.join(cuts, "doc_id", "left")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, block = shared.value
        matcher = built_once(*block) if block else None
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            given = b.column("cuts").to_pylist() if "cuts" in b.schema.names else [None] * len(ids)
            out = []
            for text, cuts in zip(texts, given):
                spans = [(c["start_at"], c["end_at"]) for c in cuts] if cuts else [(s, e) for _, s, e in passages(matcher, text)]
                out.append(model.best(features(text, spans)[0]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.float64())], names=["doc_id", "level", "posterior"])

    out = docs.mapInArrow(assign, "doc_id long, level int, posterior double")
    return out.groupBy("doc_id").agg(F.max_by("level", "posterior").alias("level"), F.max("posterior").alias("posterior"))


def profile(documents: DataFrame, found: DataFrame) -> DataFrame:
    """Documents and characters by source and level."""
    source = F.lower(F.regexp_replace(F.btrim("source"), r"[\s_-]+", "_"))
    d = documents.select("doc_id", source.alias("source"), F.length("text").alias("chars")).dropDuplicates(["doc_id"])
    return found.join(d, "doc_id").groupBy("source", "level").agg(F.count(F.lit(1)).alias("documents"), F.sum("chars").alias("chars"))
