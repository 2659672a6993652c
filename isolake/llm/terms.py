"""How often every term or n-gram occurs and in how many records: suffix-sorted n-gram counting.

Every position of a record gives the suffix that starts there, cut to the greatest n-gram length. Suffixes are routed by
their first term, so all n-grams beginning with a term meet in one task, and sorted in reverse lexicographic order there. A stack
of the prefixes of the current suffix then holds the open n-grams: when the next suffix leaves a prefix, its count and
record set are final, are emitted, and flow into the prefix one term shorter. Every suffix is shuffled once, whatever the n-gram length.

A first term with more rows than one task should take is also routed by a hash of the record, which keeps record sets
disjoint between its tasks; their counts are added up afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isolake.operators.skew import hot_keys


def suffixes(records: DataFrame, length: int) -> DataFrame:
    """(t1..tn, record, n, holds) of records (record, terms): one row a position, terms beyond the end null."""
    p = records.select("record", F.posexplode("terms").alias("i", "t1"), "terms").where("t1 IS NOT NULL")
    more = [F.get(F.col("terms"), F.col("i") + k).alias(f"t{k + 1}") for k in range(1, length)]
    return p.select("t1", *more, F.col("record").cast("string").alias("record"), F.lit(1).cast("long").alias("n"), F.lit(True).alias("holds"))


def _stack_count(length: int):
    names = [f"t{k}" for k in range(1, length + 1)]
    schema = pa.schema([*[(c, pa.string()) for c in names], ("occurrences", pa.int64()), ("records", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []  # [term, occurrences, record set] of each prefix of the current suffix
        out: list[tuple] = []

        def close(depth: int) -> None:
            """Emit the prefixes longer than `depth`, the longest first; their records flow into the prefix one term shorter."""
            while len(stack) > depth:
                ngram = [s[0] for s in stack]
                _, n, held = stack.pop()
                out.append((*ngram, *[None] * (length - len(ngram)), n, len(held)))
                if stack:
                    above = stack[-1]
                    above[1] += n
                    if len(held) > len(above[2]):  # the smaller set is poured into the larger one
                        above[2], held = held, above[2]
                    above[2] |= held

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [[] for _ in schema]
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
            out.clear()
            return batch

        for b in batches:
            if not b.num_rows:
                continue
            terms = [b.column(c) for c in names]
            # positions where a run of equal suffixes begins, and where its records end
            new = np.zeros(b.num_rows, bool)
            new[0] = True
            for c in terms:
                codes = c.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                new[1:] |= codes[1:] != codes[:-1]
            starts = np.flatnonzero(new)
            n = np.add.reduceat(b.column("n").to_numpy(zero_copy_only=False), starts)
            holds = b.column("holds").to_numpy(zero_copy_only=False).astype(bool)
            before = np.concatenate([[0], np.cumsum(holds)])
            held_from, held_to = before[starts].tolist(), before[np.append(starts[1:], b.num_rows)].tolist()
            record = b.column("record").filter(pa.array(holds)).to_pylist()
            heads = zip(*[c.take(pa.array(starts)).to_pylist() for c in terms])
            for suffix, k, s, e in zip(heads, n.tolist(), held_from, held_to):
                depth = 0
                while depth < len(stack) and suffix[depth] is not None and stack[depth][0] == suffix[depth]:
                    depth += 1
                close(depth)
                for t in suffix[depth:]:
                    if t is None:
                        break
                    stack.append([t, 0, set()])
                stack[-1][1] += k
                if e > s:
                    stack[-1][2].update(record[s:e])
            if len(out) >= 20_000:
                yield flush()
        close(0)
        yield flush()

    return count


def ngram_counts(rows: DataFrame, length: int, rows_per_task: int = 500_000, counted: DataFrame | None = None) -> DataFrame:
    """(t1..tn, occurrences, records) of every n-gram of up to `length` terms, from rows as `suffixes` gives them.

    `n` counts occurrences, only rows with `holds` put their record into the record set; a record may come in several rows. A null record
    holds nothing; unused positions are null. Hot first terms, with more than `rows_per_task` rows, are found by counting `counted`
    (a cheaper frame with at least as many rows of each t1), or `rows` itself; so an open record set holds about `rows_per_task` records at most.
    """
    names = [f"t{k}" for k in range(1, length + 1)]
    hot = F.broadcast(hot_keys(rows if counted is None else counted, ["t1"], rows_per_task))  # at most one row per rows_per_task rows
    salted = rows.join(hot, "t1", "left").withColumn("salt", F.pmod(F.xxhash64("record"), F.coalesce("__salts", F.lit(1))).cast("int"))
    routed = salted.withColumn("holds", F.col("holds") & F.col("record").isNotNull()).repartition("t1", "salt")
    ordered = routed.sortWithinPartitions("t1", "salt", *[F.col(c).desc_nulls_last() for c in names[1:]]).select(*names, "record", "n", "holds")
    schema = ", ".join([*[f"{c} string" for c in names], "occurrences long", "records long"])
    partial = ordered.mapInArrow(_stack_count(length), schema)
    return partial.groupBy(*names).agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))


def marked(counts: DataFrame, total: Column, rare_below: int = 4, common_percent: int = 95) -> DataFrame:
    """With `mark`: rare if in fewer than `rare_below` records, else common if in at least `common_percent` of 100 records, else null."""
    mark = F.when(F.col("records") < rare_below, "rare").when(F.col("records") * 100 >= total * common_percent, "common")
    return counts.withColumn("mark", mark)


def gene_rows(presence: DataFrame) -> DataFrame:
    """The suffixes of gene n-grams of length one: a row a row of the table, which holds its sample if it says present. Null genes are left out."""
    gene = F.btrim("gene", F.lit(" \t\r\n"))
    holds = F.coalesce(F.col("present") == 1, F.lit(False))
    return presence.select(gene.alias("t1"), F.col("sample_id").alias("record"), F.lit(1).cast("long").alias("n"), holds.alias("holds")).where("t1 IS NOT NULL")


def gene_marks(presence: DataFrame, rows_per_task: int = 500_000) -> DataFrame:
    """(gene, occurrences, records, mark) of every gene name; an empty table gives none."""
    names = presence.select(F.btrim("gene", F.lit(" \t\r\n")).alias("t1"))
    counts = ngram_counts(gene_rows(presence), 1, rows_per_task, names).withColumnRenamed("t1", "gene")
    return marked(counts, presence.agg(F.countDistinct("sample_id")).scalar())


def words(text: Column) -> Column:
    """Lower-case words of letters, digits and inner hyphens or apostrophes; an empty array for a null text."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:['’-][\p{L}\p{N}]+)*"), 0), F.array().cast("array<string>"))


def text_terms(documents: DataFrame, length: int, rows_per_task: int = 500_000) -> DataFrame:
    """(ngram, terms, occurrences, records, mark) of all word n-grams of the documents' texts.

    Marks are taken against all documents. Null and empty texts hold nothing.
    """
    names = [f"t{k}" for k in range(1, length + 1)]
    counts = ngram_counts(suffixes(documents.select(F.col("doc_id").alias("record"), words(F.col("text")).alias("terms")), length), length, rows_per_task)
    out = marked(counts, documents.agg(F.countDistinct("doc_id")).scalar())
    return out.select(F.concat_ws(" ", *names).alias("ngram"), F.size(F.array_compact(F.array(*names))).alias("terms"), "occurrences", "records", "mark")
