"""Measuring a locus in its own sequence from the blocks a protein search aligned to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isolake.functions.scalars import translate_sequence

REFUSALS = ("no_candidate_hit", "ambiguous_locus", "mixed_strands", "frame_not_anchorable", "contig_missing", "out_of_contig")


def _distinct_codons(spans: Column) -> Column:
    """How many codons a sorted array of (from, to) spans covers, overlaps once."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(acc: Column, s: Column) -> Column:
        fresh = F.greatest(s["lo"].cast("long"), acc["end"] + 1)
        return F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), s["hi"].cast("long") - fresh + 1)).alias("n"), F.greatest(acc["end"], s["hi"].cast("long")).alias("end"))

    return F.aggregate(spans, start, add, lambda acc: acc["n"])


def measure_locus(hits: DataFrame, contigs: DataFrame, samples: DataFrame, codons: int, min_identity: float) -> DataFrame:
    """One row a sample: where its locus lies and how its reading frame runs, or why that was refused.

    `hits` (sample_id, contig, identity, q_lo, q_hi in reference codons, s_lo, s_hi in bases from 1, strand 1 or -1), `contigs` (sample_id, contig, seq).
    Hits below the identity are of another locus. The contig whose hits cover the most codons is taken; two that cover equally many are refused, as are hits
    on both strands and a locus whose hits do not reach the reference's first codon, since its frame is unknown. The bases from there to the aligned end are
    read on their strand and translated. A first stop is the reference's own end only if the last codon is aligned, the frame is native and it is the last
    codon read. Columns: refused, contig, strand, coverage_pct, identity_pct, foot_lo, foot_hi, n_hits, protein_stop (codons before the first stop, null
    without one), net_frame, frameshift, own_terminator, at_edge.

    Per contig hits are folded into spans; what is gathered of a sample is one row a contig.
    """
    h = hits.where((F.col("identity") >= min_identity) & F.col("sample_id").isNotNull() & F.col("contig").isNotNull())
    span = F.struct(F.col("q_lo").alias("lo"), F.col("q_hi").alias("hi"))
    by_contig = h.groupBy("sample_id", "contig").agg(
        _distinct_codons(F.array_sort(F.collect_set(span))).alias("covered"),  # at most codons^2 spans, repeats once
        F.min("identity").alias("identity_pct"), F.min("q_lo").alias("q_lo"), F.max("q_hi").alias("q_hi"), F.min("s_lo").alias("foot_lo"), F.max("s_hi").alias("foot_hi"),
        F.count(F.lit(1)).alias("n_hits"), F.min("strand").alias("strand"), (F.min("strand") != F.max("strand")).alias("mixed"),
        F.min_by(F.struct("s_lo", "s_hi"), F.col("q_lo")).alias("first"),
    )
    best = F.struct(F.col("covered").alias("__covered"), *[F.col(c) for c in by_contig.columns if c not in ("sample_id", "covered")])
    top = by_contig.groupBy("sample_id").agg(F.max_by(best, F.struct("covered", F.xxhash64("contig"))).alias("b"), F.max("covered").alias("most"), F.collect_list("covered").alias("all"))
    top = top.select("sample_id", "b.*", (F.size(F.filter("all", lambda c: c == F.col("most"))) > 1).alias("tied"))
    m = samples.select("sample_id").distinct().join(top, "sample_id", "left").join(contigs.select("sample_id", "contig", "seq"), ["sample_id", "contig"], "left")
    size = F.length("seq")
    refused = (
        F.when(F.col("contig").isNull(), "no_candidate_hit").when(F.col("tied"), "ambiguous_locus").when(F.col("mixed"), "mixed_strands").when(F.col("q_lo") != 1, "frame_not_anchorable")
        .when(F.col("seq").isNull(), "contig_missing").when((F.col("foot_lo") < 1) | (F.col("foot_hi") > size), "out_of_contig")
    )
    m = m.withColumn("refused", refused)
    forward = F.col("strand") > 0
    begin = F.when(forward, F.col("first.s_lo")).otherwise(F.col("foot_lo"))
    end = F.when(forward, F.col("foot_hi")).otherwise(F.col("first.s_hi"))
    bases = F.upper(F.substr("seq", begin, end - begin + 1))
    coding = F.when(F.col("refused").isNull(), F.when(forward, bases).otherwise(F.reverse(F.translate(bases, "ACGT", "TGCA"))))
    m = m.withColumn("coding", coding)
    protein = translate_sequence(F.col("coding"), "X")
    m = m.withColumn("protein", protein)
    stop = F.nullif(F.instr("protein", "*"), F.lit(0)) - 1
    net = F.length("coding") - 3 * (F.col("q_hi") - F.col("q_lo") + 1)
    ok = F.col("refused").isNull()
    known = ~F.coalesce(F.col("refused").isin("no_candidate_hit", "ambiguous_locus"), F.lit(False))
    return m.select(
        "sample_id", "refused", F.when(known, F.col("contig")).alias("contig"), F.when(known & ~F.coalesce("mixed", F.lit(False)), F.when(forward, "+").otherwise("-")).alias("strand"),
        F.when(known, F.round(100.0 * F.col("__covered") / codons, 4)).otherwise(0.0).alias("coverage_pct"), F.when(known, F.col("identity_pct")).alias("identity_pct"),
        F.when(known, F.col("foot_lo")).alias("foot_lo"), F.when(known, F.col("foot_hi")).alias("foot_hi"), F.when(known, F.col("n_hits")).alias("n_hits"),
        stop.cast("int").alias("protein_stop"), F.when(ok, net).cast("long").alias("net_frame"), F.when(ok, net % 3 != 0).alias("frameshift"),
        F.when(ok, F.coalesce((F.col("q_hi") == codons) & (net % 3 == 0) & (stop == F.length("protein") - 1), F.lit(False))).alias("own_terminator"),
        F.when(ok, (F.col("foot_lo") == 1) | (F.col("foot_hi") == size)).alias("at_edge"),
    )
