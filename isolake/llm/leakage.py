"""Evaluation texts leaking into documents: one Aho-Corasick pass over normalised text, with offsets into the original.

Words are the longest runs of a-z and 0-9 after lower-casing. A document leaks an item if it has a run of `run` words in common
with it, or all words of an item that has fewer. The automaton reads word numbers, not characters. Of a longer item it holds the pieces of
(run + 1) / 2 words that begin at every multiple of that length: any common run holds such a piece whole, so a piece that is met is
extended word by word to both sides, and counts if that makes a run. So an automaton has about one node a word of the items.
Each document is scanned once.

The automaton is built once a worker from a broadcast list of items whose size is checked: items beyond `max_chars` characters of
text (some 200 MB when built) are handled in blocks, each with its own automaton and scan.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isolake.session import materialise

RUN = 12
#: A block of items has at most about so many characters.
MAX_CHARS = 8_000_000
_WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Matcher:
    """An automaton over pieces of items, with what it takes to extend a piece."""

    automaton: object
    vocabulary: dict[str, int]
    items: list[tuple[int, array]]  # item, its words as numbers
    owners: list[list[tuple[int, int]]]  # of each piece: (place in items, first word), first word -1 for a whole short item
    run: int


def build(items: Sequence[tuple[int, str | None]], run: int = RUN) -> Matcher | None:
    """The matcher of the items (item, text); None if they have no words."""
    import ahocorasick

    size = (run + 1) // 2
    vocabulary: dict[str, int] = {}
    kept: list[tuple[int, array]] = []
    places: dict[tuple[int, ...], int] = {}
    owners: list[list[tuple[int, int]]] = []
    for item, text in dict.fromkeys(items):
        words = array("I", [vocabulary.setdefault(w, len(vocabulary) + 1) for w in _WORD.findall((text or "").lower())])
        if not words:
            continue
        kept.append((item, words))
        starts = [-1] if len(words) < run else range(0, len(words) - size + 1, size)
        for s in starts:
            piece = tuple(words) if s < 0 else tuple(words[s : s + size])
            at = places.setdefault(piece, len(owners))
            if at == len(owners):
                owners.append([])
            owners[at].append((len(kept) - 1, s))
    if not owners:
        return None
    a = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for piece, at in places.items():
        a.add_word(piece, (len(piece), at))
    a.make_automaton()
    return Matcher(a, vocabulary, kept, owners, run)


_built: dict[str, Matcher | None] = {}


def built_once(token: str, items: Sequence[tuple[int, str | None]], run: int = RUN) -> Matcher | None:
    """The matcher of a worker process, built at its first task; `token` is new for every query, so nothing stale is met."""
    if token not in _built:
        _built.clear()
        _built[token] = build(items, run)
    return _built[token]


def offsets(text: str) -> tuple[list[int], list[int]]:
    """Start and end of each word in the original text."""
    low = text.lower()
    spans = [m.span() for m in _WORD.finditer(low)]
    if len(low) == len(text):
        return [s for s, _ in spans], [e for _, e in spans]
    at = np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])  # lower-casing can lengthen a character
    if len(at) != len(low):
        at = np.minimum(np.arange(len(low)), len(text) - 1)
    return [int(at[s]) for s, _ in spans], [int(at[e - 1]) + 1 for _, e in spans]


def word_spans(matcher: Matcher, words: Sequence[str]) -> dict[int, list[tuple[int, int]]]:
    """Item -> runs of words (first, last) that give it away, unsorted."""
    numbers = tuple(map(matcher.vocabulary.get, words, [0] * len(words)))
    hits: dict[int, list[tuple[int, int]]] = {}
    reached: dict[tuple[int, int], int] = {}  # how far a shared run of an item at an offset has been followed
    for end, (size, at) in matcher.automaton.iter(numbers):
        begin = end - size + 1
        for place, first in matcher.owners[at]:
            item, own = matcher.items[place]
            if first < 0:
                hits.setdefault(item, []).append((begin, end))
                continue
            shift = begin - first
            if reached.get((place, shift), -1) >= end:
                continue
            s, e = begin, end
            while s > 0 and s > shift and numbers[s - 1] == own[s - 1 - shift]:
                s -= 1
            while e + 1 < len(numbers) and e + 1 - shift < len(own) and numbers[e + 1] == own[e + 1 - shift]:
                e += 1
            reached[place, shift] = e
            if e - s + 1 >= matcher.run:
                hits.setdefault(item, []).append((s, e))
    return hits


def passages(matcher: Matcher | None, text: str | None) -> list[tuple[int, int, int]]:
    """(item, start, end) in the original text: overlapping runs of one item are one passage."""
    if matcher is None or not text:
        return []
    hits = word_spans(matcher, _WORD.findall(text.lower()))
    if not hits:
        return []
    starts, ends = offsets(text)
    out = []
    for item, spans in hits.items():
        merged: list[list[int]] = []
        for s, e in sorted(spans):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out += [(item, starts[s], ends[e]) for s, e in merged]
    return out


def item_blocks(items: DataFrame, max_chars: int = MAX_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items (item_id, text) in blocks of about `max_chars` characters, brought to the driver one block at a time."""
    items = items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").dropDuplicates()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // max_chars) or 1
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        yield [(r.item_id, r.text) for r in part.collect()]


def find_passages(documents: DataFrame, items: DataFrame, run: int = RUN, max_chars: int = MAX_CHARS) -> DataFrame:
    """(doc_id, item_id, start_at, end_at): every passage of an item in a document, as offsets [start, end) in characters.

    Documents of any language are scanned; null and empty texts hold nothing, items without words match nothing, and
    rows repeated under one doc_id count once.
    """
    spark = documents.sparkSession
    out = None
    for block in item_blocks(items, max_chars):
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, block))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            m = built_once(*shared.value, run)
            for b in batches:
                rows = [(d, *p) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()) if t for p in passages(m, t)]
                cols = list(zip(*rows)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32())], names=["doc_id", "item_id", "start_at", "end_at"])

        found = documents.select("doc_id", "text").mapInArrow(scan, "doc_id long, item_id long, start_at int, end_at int")
        out = found if out is None else out.unionByName(found)
    return out.dropDuplicates()


def leaks(documents: DataFrame, items: DataFrame, run: int = RUN, max_chars: int = MAX_CHARS) -> DataFrame:
    """(doc_id, item_id): which documents leak which items."""
    return find_passages(documents, items, run, max_chars).select("doc_id", "item_id").distinct()


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Every item with the number of documents that leak it (0 included)."""
    found = materialise(leaks(documents, items), "leakage")
    n = found.groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))
    return items.select("item_id", "suite").dropDuplicates().join(n, "item_id", "left").select("item_id", "suite", F.coalesce("documents", F.lit(0)).alias("documents"))
