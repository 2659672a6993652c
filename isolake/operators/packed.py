"""Several values packed in one field: choose a dialect by minimum description length, then split.

A dialect is a set of delimiters with a quoting convention, or a JSON array. Every text is parsed by each dialect that
could apply to it, and each parse is charged the bits needed to write it down, all of them learned from the collection itself:

* a value that recurs costs a reference to a code book, -log2 of its share, plus its part of spelling it there once; any other value is
  spelled out in place. Spelling is charged by a model of characters given the two before, counted over the distinct values;
* whether a delimiter or quote lies in a value, each kind by its rate in the parses chosen, every time (a book entry does not save it);
* the dialect: for each sign the text holds, whether it divides (or quotes) values, by its rate among the texts that hold it.

Rates and choices are improved in turn. As that finds the next best optimum only, it starts once from each quoting convention, with the
code book of that convention's parses, and for each field the start whose end result is shortest in all (code book, references, signs and
dialects) stands. Counting is distributed; to the driver come rates and character counts, whose number does not grow with the data.

The chosen dialect's values are the result. The field rule (`split_by_rule`) is only compared with them (`agrees`).

Only texts that hold a delimiter, a quote or an opening bracket are scored: all dialects read the others alike.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isolake.operators.skew import salted_join
from isolake.session import materialise

BLANKS = " \t\r\n"
#: Line breaks are one delimiter.
DELIMITERS = (",", ";", "|", "\r\n")
NO_VALUES = ("", ".", "NA", "MISSING")
#: Quoting conventions from which the choice starts.
CONVENTIONS = ('"', "", "'")
#: Characters of the spelling model: start, end, any other, and the printable ones of ASCII.
ALPHABET = 98
ROUNDS = 3
_CUT, _KEPT = "\u0001", "﷐"


def dialects() -> list[tuple[int, str, str, str]]:
    """(number, kind, delimiters, quote), the preferred ones first: JSON, then more delimiters, double quotes, none, apostrophes."""
    out = [("json", "", "")]
    for quote in ('"', "", "'"):
        for n in range(len(DELIMITERS), -1, -1):
            for some in combinations(DELIMITERS, n):
                out.append(("delimited", "".join(some), quote))
    return [(i, *d) for i, d in enumerate(out)]


def _trim(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def _translate(c: Column, of: Column, to: Column) -> Column:
    return F.call_function("translate", c, of, to)


def split_json(text: Column) -> Column:
    """Array of the strings of a JSON array; null if the text is none. Null elements are left out."""
    return F.filter(F.from_json(text, T.ArrayType(T.StringType())), lambda v: v.isNotNull())


def split_delimited(text: Column, delimiters: Column, quote: Column) -> Column:
    """Pieces between delimiters that are not inside quotes: blanks trimmed, empty pieces dropped, quotes taken off.

    A quote that does not close reaches to the end of the text.
    """
    safe = F.translate(text, _CUT, _KEPT)
    segments = F.when(quote == "", F.array(safe)).otherwise(F.split(safe, F.when(quote == "", F.lit("$^")).otherwise(quote)))
    cuts = F.repeat(F.lit(_CUT), F.length(delimiters))
    outside = F.transform(segments, lambda s, i: F.when(i % 2 == 0, _translate(s, delimiters, cuts)).otherwise(s))
    pieces = F.filter(F.transform(F.split(F.call_function("array_join", outside, quote), _CUT), _trim), lambda p: p != "")

    def unquote(p: Column) -> Column:
        d = F.when(p.startswith('"') & p.rlike(r'(?s)^"(?:[^"]++|"")*+"$'), F.replace(F.substr(p, F.lit(2), F.length(p) - 2), F.lit('""'), F.lit('"')))
        a = F.when(p.startswith("'") & p.rlike(r"(?s)^'(?:[^']++|'')*+'$"), F.replace(F.substr(p, F.lit(2), F.length(p) - 2), F.lit("''"), F.lit("'")))
        inner = F.when(quote == '"', d).when(quote == "'", a)
        return F.translate(F.coalesce(inner, p), _KEPT, _CUT)

    return F.transform(pieces, unquote)


def split_by_rule(text: Column) -> Column:
    """The field rule itself: JSON if the text begins with a bracket (and is JSON), else all delimiters outside double quotes."""
    delimited = split_delimited(text, F.lit("".join(DELIMITERS)), F.lit('"'))
    return F.when(_trim(text).startswith("["), F.coalesce(split_json(_trim(text)), delimited)).otherwise(delimited)


#: The kinds of signs that may lie in a value or divide a text: each delimiter, a double quote, an apostrophe at an end, a bracket at an end.
KINDS = len(DELIMITERS) + 3


def _lying(v: Column) -> list[Column]:
    """For each kind of sign whether it lies in the value (0 or 1)."""
    out = [v.rlike("[" + d.replace("|", "\\|") + "]") if len(d) > 1 else F.contains(v, F.lit(d)) for d in DELIMITERS]
    out += [F.contains(v, F.lit('"')), v.startswith("'") | v.endswith("'"), v.startswith("[") | v.endswith("]")]
    return [c.cast("int") for c in out]


def signs_used() -> np.ndarray:
    """dialect x kind: 1 where the dialect gives that sign a meaning."""
    return np.array([[*(float(d in some) for d in DELIMITERS), float(q == '"'), float(q == "'"), float(kind == "json")] for _, kind, some, q in dialects()])


def text_id(text: Column) -> Column:
    """A digest that stands for a text, so that long texts are not carried along with their values."""
    return F.unhex(F.sha2(text, 256))


_DIALECT = "struct<dialect:int,kind:string,delimiters:string,quote:string>"


def _literal(value: object, schema: str) -> Column:
    """A nested constant, as one literal in the plan."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _by_signs() -> Column:
    """For each combination of signs a text may hold, the dialects that could apply to it."""
    every, out = dialects(), []
    for signs in range(1 << (len(DELIMITERS) + 3)):
        held = {d for i, d in enumerate(DELIMITERS) if signs >> i & 1}
        quotes = {"", *(q for i, q in enumerate(('"', "'")) if signs >> (len(DELIMITERS) + i) & 1)}
        brackets = signs >> (len(DELIMITERS) + 2) & 1
        fits = [x for x in every if (brackets if x[1] == "json" else x[3] in quotes and all(d not in x[2] or d in held for d in DELIMITERS))]
        out.append([dict(zip(("dialect", "kind", "delimiters", "quote"), x)) for x in fits])
    return _literal(out, f"array<array<{_DIALECT}>>")


def _signs(text: Column) -> Column:
    """A bit for each kind of sign the text holds. An apostrophe counts only where a value could begin, as inside words it cannot quote."""
    tests = [text.rlike("[" + d.replace("|", "\\|") + "]") if len(d) > 1 else F.contains(text, F.lit(d)) for d in DELIMITERS]
    tests += [F.contains(text, F.lit('"')), text.rlike("(^|[,;|\r\n])[ \t]*'"), _trim(text).startswith("[")]
    out = F.lit(0)
    for i, t in enumerate(tests):
        out = out + F.when(t, 1 << i).otherwise(0)
    return out


def _parse(text: Column, d: Column) -> Column:
    return F.when(d["kind"] == "json", split_json(_trim(text))).otherwise(split_delimited(text, d["delimiters"], d["quote"]))


def candidates(texts: DataFrame) -> DataFrame:
    """(cid, field, tid, signs, cands) of each distinct text: its parses by the dialects that could apply, equal parses by the preferred dialect only.

    `signs` has a bit for each kind of sign the text holds. `cands` are (dialect, values, w): `w` has a weight for each quoting convention, which shares
    out the text among the parses of that convention (or, where it has none, those without quotes) and a JSON parse. `cid` is a short number for the
    row; it is only meaningful once the frame has been written.
    """
    t = F.col("text")
    made = F.transform(F.get(_by_signs(), _signs(t)), lambda d: F.struct(d["dialect"].alias("dialect"), d["kind"].alias("kind"), d["quote"].alias("quote"), _parse(t, d).alias("values")))
    x = texts.select("field", text_id(t).alias("tid"), _signs(t).alias("signs"), F.filter(made, lambda c: c["values"].isNotNull()).alias("c"))
    x = x.withColumn("c", F.filter("c", lambda c, i: ~F.exists(F.slice("c", 1, i), lambda o: o["values"] == c["values"])))

    def weight(c: Column, convention: str) -> Column:
        quoted = F.exists("c", lambda o: (o["kind"] != "json") & (o["quote"] == convention))
        return ((c["kind"] == "json") | (c["quote"] == F.when(quoted, F.lit(convention)).otherwise(F.lit("")))).cast("double")

    weighed = F.transform("c", lambda c: F.struct(c["dialect"].alias("dialect"), c["values"].alias("values"), F.array(*[weight(c, q) for q in CONVENTIONS]).alias("w")))
    x = x.withColumn("c", weighed)

    def summed(i: int) -> Column:
        return F.aggregate("c", F.lit(0.0), lambda s, c: s + F.get(c["w"], F.lit(i)))

    total = [summed(i) for i in range(len(CONVENTIONS))]
    share = lambda c, i: F.when(total[i] > 0, F.get(c["w"], F.lit(i)) / total[i]).otherwise(F.lit(1.0) / F.size("c"))
    cands = F.transform("c", lambda c: F.struct(c["dialect"].alias("dialect"), c["values"].alias("values"), F.array(*[share(c, i) for i in range(len(CONVENTIONS))]).alias("w")))
    return x.select(F.monotonically_increasing_id().alias("cid"), "field", "tid", "signs", cands.alias("cands"))


# spelling


def _trigrams(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(trigram codes of the characters and ends of all values, where each value's codes begin)."""
    text = values.to_pylist()
    lengths = np.fromiter((len(v) for v in text), np.int64, len(text))
    points = np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = np.where((points >= 32) & (points < 127), points - 29, 2)
    at = np.cumsum(lengths + 3) - (lengths + 3)  # two starts before, one end after
    chain = np.zeros(int((lengths + 3).sum()), np.int64)
    chain[at + 2 + lengths] = 1
    inner = np.repeat(at + 2 - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(points))
    chain[inner] = codes
    tri = (chain[:-2] * ALPHABET + chain[1:-1]) * ALPHABET + chain[2:]
    keep = np.ones(len(tri), bool)
    edge = np.concatenate([at[1:] - 2, at[1:] - 1])
    keep[edge] = False
    return tri[keep], np.cumsum(lengths + 1) - (lengths + 1)


def _character_counts(columns: Sequence[str]):
    """Arrow function: (field, value, a number a column) -> (field, code, a count a column): trigram counts of distinct values weighted by at most 1,
    and under the codes -1 and -2 the sums of n and of n * log2(n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        totals: dict[str, np.ndarray] = {}
        for b in batches:
            fields = np.array(b.column("field").to_pylist(), dtype=object)
            for f in set(fields.tolist()):
                rows = pa.array(np.flatnonzero(fields == f))
                n = np.array([b.column(c).take(rows).to_numpy(zero_copy_only=False) for c in columns])
                if f not in sums:
                    sums[f], totals[f] = np.zeros((len(columns), ALPHABET**3)), np.zeros((len(columns), 2))
                tri, at = _trigrams(b.column("value").take(rows))
                sizes = np.diff(np.append(at, len(tri)))
                for i in range(len(columns)):
                    sums[f][i] += np.bincount(tri, np.repeat(np.minimum(n[i], 1.0), sizes), ALPHABET**3)
                    totals[f][i] += [n[i].sum(), (n[i] * np.log2(np.maximum(n[i], 1e-300))).sum()]
        for f in sums:
            codes = np.flatnonzero(sums[f].any(0))
            found = np.hstack([totals[f], sums[f][:, codes]])
            yield pa.RecordBatch.from_arrays([pa.array([f] * (len(codes) + 2), pa.string()), pa.array(np.append([-1, -2], codes), pa.int64()), *[pa.array(x) for x in found]], names=["field", "code", *columns])

    return count


def _counted(book: DataFrame, columns: Sequence[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """field -> (sums and n log n, trigram counts), a row a column. What is collected is bounded by the alphabet, whatever the data."""
    schema = "field string, code long, " + ", ".join(f"{c} double" for c in columns)
    found = book.select("field", "value", *columns).mapInArrow(_character_counts(columns), schema)
    rows = found.groupBy("field", "code").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
    out = {}
    for f, part in rows.groupby("field"):
        totals, counts = np.zeros((len(columns), 2)), np.zeros((len(columns), ALPHABET**3))
        code = part["code"].to_numpy()
        n = part[list(columns)].to_numpy().T
        totals[:, 0], totals[:, 1] = n[:, code == -1].sum(1), n[:, code == -2].sum(1)
        counts[:, code[code >= 0]] = n[:, code >= 0]
        out[f] = (totals, counts)
    return out


def spelling_bits(counts: np.ndarray) -> np.ndarray:
    """Bits of each trigram's last character, from counts (rows x trigrams)."""
    before = counts.reshape(len(counts), -1, ALPHABET).sum(2, keepdims=True)
    return (-np.log2((counts.reshape(len(counts), -1, ALPHABET) + 1 / ALPHABET) / (before + 1))).reshape(counts.shape)


def _priced(model: dict[str, tuple[np.ndarray, np.ndarray]], spark) -> object:
    """Arrow function: (field, value, n0..) -> with the bits of a reference or spelling under each convention, b0.. ."""
    shared = spark.sparkContext.broadcast({f: (t[:, 0], spelling_bits(c).astype(np.float32)) for f, (t, c) in model.items()})
    k = len(CONVENTIONS)

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fields = np.array(b.column("field").to_pylist(), dtype=object)
            bits = np.zeros((k, b.num_rows))
            for f in set(fields.tolist()):
                at = np.flatnonzero(fields == f)
                total, spelled = shared.value[f]
                tri, starts = _trigrams(b.column("value").take(pa.array(at)))
                for i in range(k):
                    alone = np.add.reduceat(spelled[i][tri].astype(np.float64), starts)
                    n = b.column(f"n{i}").to_numpy(zero_copy_only=False)[at]
                    held = np.maximum(n, 1.0)
                    bits[i, at] = np.where(n >= 1, np.minimum(alone, alone / held + np.log2((total[i] + 1) / held)), alone)
            yield pa.RecordBatch.from_arrays([b.column("field"), b.column("value"), *[pa.array(x) for x in bits]], names=["field", "value", *[f"b{i}" for i in range(k)]])

    return price


# choice


class _Rates:
    """Bits of signs that lie in values and of signs that divide texts, for a field and a convention, from sums over parses."""

    def __init__(self, sums: np.ndarray) -> None:
        lying, used, held, values = sums[:KINDS], sums[KINDS : 2 * KINDS], sums[2 * KINDS : 3 * KINDS], sums[-1]
        p, u = (lying + 0.5) / (values + 1), (used + 0.5) / (held + 1)
        self.lies, self.lies_not, self.divides, self.divides_not = -np.log2(p), -np.log2(1 - p), -np.log2(u), -np.log2(1 - u)


class _Batch:
    """The parses of an Arrow batch of texts as flat arrays."""

    def __init__(self, b: pa.RecordBatch) -> None:
        used = signs_used()
        cs = b.column("cs")
        flat = cs.flatten()
        self.starts = cs.offsets.to_numpy()[:-1] - cs.offsets.to_numpy()[0]
        self.sizes = np.diff(cs.offsets.to_numpy())
        col = lambda name: flat.field(name).to_numpy(zero_copy_only=False)
        self.dialect = col("dialect")
        self.bits = np.array([col(f"b{i}") for i in range(len(CONVENTIONS))])
        self.weights = np.array([col(f"w{i}") for i in range(len(CONVENTIONS))])
        self.lying = np.array([col(f"f{i}") for i in range(KINDS)], dtype=float).T
        self.values = col("n").astype(float)
        held = np.repeat(b.column("signs").to_numpy(), self.sizes)[:, None] >> np.arange(KINDS) & 1
        self.used = used[self.dialect]
        self.held = held.astype(float)
        self.held[:, :-1] *= 1 - self.used[:, -1:]  # a JSON parse tells nothing of other signs
        self.used = self.used * self.held
        self.fields = np.array(b.column("field").to_pylist(), dtype=object)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.concatenate([weights @ self.lying, weights @ self.used, weights @ self.held, [weights @ self.values]])

    def chosen(self, field: str, i: int, r: _Rates) -> np.ndarray:
        """The place of the cheapest parse of each text of a field; of equals the preferred dialect."""
        texts = np.flatnonzero(self.fields == field)
        cost = self.bits[i] + self.lying @ r.lies + (self.values[:, None] - self.lying) @ r.lies_not + self.used @ r.divides + (self.held - self.used) @ r.divides_not
        order = np.lexsort((self.dialect, np.round(cost, 3), np.repeat(np.arange(len(self.sizes)), self.sizes)))
        return order[self.starts[texts]]


def _sums(stats: DataFrame, rates: dict | None) -> dict:
    """(field, convention) -> sums over the parses: weighted ones at first, then those chosen by rates. One number a kind comes to the driver."""
    width = 3 * KINDS + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[tuple[str, int], np.ndarray] = {}
        for raw in batches:
            if not raw.num_rows:
                continue
            b = _Batch(raw)
            for f in set(b.fields.tolist()):
                inside = np.repeat(b.fields == f, b.sizes)
                for i in range(len(CONVENTIONS)):
                    if rates is None:
                        w = np.where(inside, b.weights[i], 0.0)
                    else:
                        w = np.zeros(len(b.dialect))
                        w[b.chosen(f, i, rates[f, i])] = 1
                    out[f, i] = out.get((f, i), 0) + b.sums(w)
        keys = list(out)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), *[pa.array([out[k][j] for k in keys], pa.float64()) for j in range(width)]], names=["field", "i", *[f"s{j}" for j in range(width)]])

    schema = "field string, i int, " + ", ".join(f"s{j} double" for j in range(width))
    rows = stats.mapInArrow(add, schema).groupBy("field", "i").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(width)]).collect()
    return {(r.field, r.i): np.array(r[2:]) for r in rows}


def _learned(stats: DataFrame) -> dict:
    rates = {k: _Rates(s) for k, s in _sums(stats, None).items()}
    for _ in range(ROUNDS - 1):
        rates = {k: _Rates(s) for k, s in _sums(stats, rates).items()}
    return rates


def _assigned(stats: DataFrame, rates: dict) -> DataFrame:
    """(cid, field, tid, d0.., s0..): each convention's dialect of a text and the bits of its signs."""
    k = len(CONVENTIONS)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw in batches:
            if not raw.num_rows:
                continue
            b = _Batch(raw)
            d, bits = np.zeros((k, raw.num_rows), np.int32), np.zeros((k, raw.num_rows))
            for f in set(b.fields.tolist()):
                for i in range(k):
                    r = rates[f, i]
                    at = b.chosen(f, i, r)
                    d[i, b.fields == f] = b.dialect[at]
                    bits[i, b.fields == f] = b.lying[at] @ r.lies + (b.values[at][:, None] - b.lying[at]) @ r.lies_not + b.used[at] @ r.divides + (b.held[at] - b.used[at]) @ r.divides_not
            yield pa.RecordBatch.from_arrays([*[raw.column(c) for c in ("cid", "field", "tid")], *[pa.array(x) for x in d], *[pa.array(x) for x in bits]], names=["cid", "field", "tid", *[f"d{i}" for i in range(k)], *[f"s{i}" for i in range(k)]])

    return stats.mapInArrow(assign, "cid long, field string, tid binary, " + ", ".join(f"d{i} int" for i in range(k)) + ", " + ", ".join(f"s{i} double" for i in range(k)))


def _shortest(cand: DataFrame, assigned: DataFrame) -> dict[str, int]:
    """field -> the convention whose assignment is the shortest in all, its code book and characters counted anew from what it chose."""
    k = len(CONVENTIONS)
    of = lambda i: F.get(F.filter("cands", lambda c: c["dialect"] == F.col(f"d{i}")), F.lit(0))["values"]
    held = F.array(*[F.struct(F.lit(i).alias("i"), of(i).alias("vs")) for i in range(k)])
    x = cand.join(assigned.drop("field", "tid"), "cid").select("field", F.explode(held).alias("h")).select("field", "h.i", F.explode("h.vs").alias("value"))
    book = x.groupBy("field", "value").agg(*[F.count_if(F.col("i") == i).cast("double").alias(f"n{i}") for i in range(k)])
    counted = _counted(book, [f"n{i}" for i in range(k)])
    signs = {r["field"]: r for r in assigned.groupBy("field").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(k)]).collect()}
    out = {}
    for f, r in signs.items():
        if f not in counted:
            out[f] = 0
            continue
        totals, chars = counted[f]
        spelled = (chars * spelling_bits(chars)).sum(1)
        references = totals[:, 0] * np.log2(np.maximum(totals[:, 0], 1)) - totals[:, 1]
        length = [spelled[i] + references[i] + r[f"s{i}"] for i in range(k)]
        out[f] = int(np.argmin(np.round(length, 3)))
    return out


def choose(texts: DataFrame, rows_per_task: int = 2_000_000) -> DataFrame:
    """(field, tid, dialect): the dialect of the cheapest parse of each distinct text (field, text)."""
    spark, k = texts.sparkSession, len(CONVENTIONS)
    cand = materialise(candidates(texts), "packed")
    each = cand.select("field", F.explode("cands").alias("c")).select("field", "c.w", F.explode(F.array_distinct("c.values")).alias("value"))
    book = materialise(each.groupBy("field", "value").agg(*[F.sum(F.get("w", F.lit(i))).alias(f"n{i}") for i in range(k)], F.count(F.lit(1)).alias("n")), "packed")
    columns = [f"n{i}" for i in range(k)]
    model = _counted(book, columns)
    prices = book.select("field", "value", *columns).mapInArrow(_priced(model, spark), "field string, value string, " + ", ".join(f"b{i} double" for i in range(k)))
    values = cand.select("cid", "field", F.explode("cands").alias("c")).select("cid", "field", "c.dialect", F.explode_outer("c.values").alias("value"))
    # a value stands in at most one parse a dialect, repeats within a text aside; parses without values are kept
    counts = book.select("field", "value", (F.col("n") * 2).alias("n"))
    priced = salted_join(values, prices, ["field", "value"], "left", rows_per_task, F.xxhash64("cid"), counts)
    sums = [F.coalesce(F.sum(f"b{i}"), F.lit(0.0)).alias(f"b{i}") for i in range(k)] + [F.coalesce(F.sum(c), F.lit(0)).cast("int").alias(f"f{i}") for i, c in enumerate(_lying(F.col("value")))]
    parses = priced.groupBy("cid", "dialect").agg(*sums, F.count("value").cast("int").alias("n"))
    cells = F.struct("dialect", *[f"b{i}" for i in range(k)], *[f"f{i}" for i in range(KINDS)], "n")
    per = parses.groupBy("cid").agg(F.array_sort(F.collect_list(cells)).alias("ps"))  # at most one entry a dialect
    ws = cand.select("cid", "field", "tid", "signs", F.array_sort(F.transform("cands", lambda c: F.struct(c["dialect"].alias("dialect"), c["w"].alias("w")))).alias("ws"))
    both = F.zip_with("ps", "ws", lambda p, w: F.struct(*[p[c].alias(c) for c in ("dialect", *[f"b{i}" for i in range(k)], *[f"f{i}" for i in range(KINDS)], "n")], *[F.get(w["w"], F.lit(i)).alias(f"w{i}") for i in range(k)]))
    stats = materialise(ws.join(per, "cid").select("cid", "field", "tid", "signs", both.alias("cs")), "packed")
    assigned = materialise(_assigned(stats, _learned(stats)), "packed")
    best = _shortest(cand, assigned)
    pick = F.lit(None).cast("int")
    for f, i in best.items():
        pick = F.when(F.col("field") == f, F.col(f"d{i}")).otherwise(pick)
    return assigned.select("field", "tid", pick.alias("dialect"))


def packed_fields(sources: Sequence[tuple[str, DataFrame, str, Sequence[str]]]) -> DataFrame:
    """(table_name, row_key, field, text) of (table name, frame, key column, fields), without fields that have no values.

    Whole-row copies count once; a null key gives a null row_key.
    """
    out = None
    for name, df, key, fields in sources:
        for f in fields:
            x = df.select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("row_key"), F.lit(f).alias("field"), F.col(f).alias("text"))
            out = x if out is None else out.unionByName(x)
    return out.where(F.col("text").isNotNull() & ~_trim(F.col("text")).isin(*NO_VALUES)).dropDuplicates()


def parsed(sources: Sequence[tuple[str, DataFrame, str, Sequence[str]]], rows_per_task: int = 2_000_000) -> DataFrame:
    """(table_name, row_key, field, text, dialect, agrees, values): each field parsed by its dialect of least description length.

    `agrees` tells whether the field rule would give the same values; it changes none. Texts without any sign that a dialect could use are one value
    and have no dialect.
    """
    rows = packed_fields(sources)
    contested = F.col("text").rlike("[,;|\r\n\"\\[]")
    plain = rows.where(~contested).withColumn("dialect", F.lit(None).cast("int")).withColumn("agrees", F.lit(True)).withColumn("values", F.array(_trim(F.col("text"))))
    hard = rows.where(contested)
    best = choose(hard.select("field", "text").distinct(), rows_per_task)
    found = salted_join(hard.withColumn("tid", text_id(F.col("text"))), best, ["field", "tid"], "inner", rows_per_task, F.xxhash64("row_key", "table_name"))
    table = _literal([dict(zip(("dialect", "kind", "delimiters", "quote"), d)) for d in dialects()], f"array<{_DIALECT}>")
    found = found.withColumn("values", _parse(F.col("text"), F.get(table, F.col("dialect"))))
    return found.withColumn("agrees", F.col("values").eqNullSafe(split_by_rule(F.col("text")))).select(*plain.columns).unionByName(plain)


def exploded(parsed_fields: DataFrame) -> DataFrame:
    """One row a value, with its position from 1."""
    return parsed_fields.select("table_name", "row_key", "field", F.posexplode("values").alias("pos", "value")).withColumn("pos", (F.col("pos") + 1).cast("int"))
