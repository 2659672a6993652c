"""Scalar functions on columns: cleaning, tokens, codons, sort keys. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\r\n"
#: What the readers take as no value (compared after trimming, case ignored).
TSV_NULLS = ("", ".", "na", "nan", "none", "null", "-")
MODEL_NULLS = ("", ".", "na", "nan", "none", "null")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_blanks(c: Column | str) -> Column:
    return F.btrim(_c(c), F.lit(BLANKS))


def null_if_in(c: Column | str, words: Sequence[str], fold: bool = False) -> Column:
    """The trimmed text, or null if it is one of `words` (case ignored if `fold`)."""
    t = trim_blanks(c)
    return F.when(~(F.lower(t) if fold else t).isin(*words), t)


def clean_cell(c: Column | str, nulls: Sequence[str] = TSV_NULLS) -> Column:
    return null_if_in(c, nulls, fold=True)


def format_cell(c: Column, kind: str) -> Column:
    """A value as written to a text table: `.` for null, 6 significant digits, lower-case booleans, `;` between values."""
    if kind in ("double", "float"):
        text = _six_digits(c)
    elif kind == "boolean":
        text = F.when(c, "true").otherwise("false")
    elif kind.startswith("array"):
        text = F.array_join(c.cast("array<string>"), ";")
    elif kind.startswith("map"):
        pairs = F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string")))
        text = F.array_join(pairs, ";")
    else:
        text = c.cast("string")
    return F.coalesce(F.when(c.isNotNull(), text), F.lit("."))


def _six_digits(c: Column) -> Column:
    """Six significant digits, without trailing zeros, with an exponent beyond 1e-5 and 1e6."""
    e = F.floor(F.log10(F.abs(c)))
    plain = F.regexp_replace(F.format_string("%.12f", F.round(c * F.pow(F.lit(10.0), 5 - e)) / F.pow(F.lit(10.0), 5 - e)), r"\.?0+$", "")
    mantissa = F.regexp_replace(F.format_string("%.5f", c / F.pow(F.lit(10.0), e)), r"\.?0+$", "")
    exponent = F.concat(F.when(e < 0, "-").otherwise("+"), F.lpad(F.abs(e).cast("string"), 2, "0"))
    return F.when(c == 0, "0").when((e < -4) | (e >= 6), F.concat(mantissa, F.lit("e"), exponent)).otherwise(plain)


def split_point_symbol(symbol: Column) -> tuple[Column, Column]:
    """(gene, variant) of `<gene>_<variant>`: the variant is a residue change such as T83I; else (symbol, null)."""
    pattern = r"^(.+)_([A-Z*][0-9]+(?:[A-Z*]|fs|del|ins)?)$"
    hit = symbol.rlike(pattern)
    return F.when(hit, F.regexp_extract(symbol, pattern, 1)).otherwise(symbol), F.when(hit, F.regexp_extract(symbol, pattern, 2))


def feature_type(name: Column) -> Column:
    """What stands before the first `__`, or `unspecified`."""
    return F.when(F.instr(name, "__") > 0, F.substring_index(name, "__", 1)).otherwise("unspecified")


def feature_label(name: Column) -> Column:
    return F.when(F.instr(name, "__") > 0, F.substr(name, F.instr(name, "__") + 2)).otherwise(name)


def gene_token(symbol: Column, prefix: str = "bla") -> Column:
    """Upper-case token without a leading class prefix and without what follows a tilde."""
    return F.upper(F.regexp_replace(F.substring_index(symbol, "~", 1), f"^{prefix}", ""))


def residue_position(variant: Column, patterns: Sequence[str] = (r"^[A-Z*]([0-9]+)", r"([0-9]+)")) -> Column:
    """The first number that one of the patterns finds, in their order."""
    return F.coalesce(*[F.nullif(F.regexp_extract(variant, p, 1), F.lit("")).try_cast("int") for p in patterns])


def sanitise(name: Column) -> Column:
    return F.btrim(F.regexp_replace(name, r"[^0-9A-Za-z._-]", "_"), F.lit("_"))


def normalise_label(name: Column) -> Column:
    """Without a layer mark `L<n>_` and then without a type `<type>__`."""
    return F.regexp_replace(F.regexp_replace(name, r"^L[0-9]+_", ""), r"^[A-Za-z0-9]+__", "")


def accession_key(accession: Column) -> Column:
    """Natural sort key (number, version) of an accession such as GCX_000000012.3."""
    return F.struct(F.regexp_extract(accession, r"_([0-9]+)", 1).try_cast("long").alias("number"), F.regexp_extract(accession, r"\.([0-9]+)$", 1).try_cast("int").alias("version"))


def binarise(category: Column, positive: Sequence[str], negative: Sequence[str]) -> Column:
    return F.when(category.isin(*positive), 1).when(category.isin(*negative), 0)


def log_trait(value: Column, base: float = 2.0) -> Column:
    """Logarithm of a measured trait; null and values not above 0 are null. A base of 1 or less is refused."""
    if base <= 1:
        raise ValueError("the base must be above 1")
    return F.when(value > 0, F.log(float(base), value))


def breakpoint_category(value: Column, low: float | None, high: float | None) -> Column:
    """S up to `low`, I up to `high`, else R; null where no breakpoints are configured or no value is known."""
    if low is None or high is None:
        return F.lit(None).cast("string")
    return F.when(value <= low, "S").when(value <= high, "I").when(value.isNotNull(), "R")


def is_indel(ref: Column, alt: Column) -> Column:
    return (F.length(ref) != 1) | (F.length(alt) != 1)


def variant_kind(ref: Column, alt: Column) -> Column:
    """SNV, MNV, insertion, deletion or complex by lengths and shared first base; unknown if either is null or empty."""
    r, a = F.length(ref), F.length(alt)
    shared = F.substring(ref, 1, 1) == F.substring(alt, 1, 1)
    return (
        F.when(ref.isNull() | alt.isNull() | (r == 0) | (a == 0), "unknown")
        .when((r == 1) & (a == 1), "SNV")
        .when(r == a, "MNV")
        .when((r < a) & shared, "insertion")
        .when((r > a) & shared, "deletion")
        .otherwise("complex")
    )


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTN", "TGCAN"))


def codon_number(pos: Column, start: Column, end: Column, strand: Column) -> Column:
    """1-based codon of a 1-based position in a closed span; counted from the end on the minus strand."""
    offset = F.when(strand == "-", end - pos).otherwise(pos - start)
    return F.floor(offset / 3).cast("int") + 1


def codon_at(seq: Column, number: Column) -> Column:
    return F.substr(seq, (number - 1) * 3 + 1, F.lit(3))


#: Fixed value: the standard genetic code, codons in TCAG order.
_BASES, _AMINO = "TCAG", "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def codon_table() -> dict[str, str]:
    triples = (a + b + c for a in _BASES for b in _BASES for c in _BASES)
    return dict(zip(triples, _AMINO))


def translate_sequence(seq: Column, unknown: str | None = None) -> Column:
    """Protein of the whole codons of a sequence. A codon with another letter raises, or gives `unknown` if set."""
    table = F.create_map(*[x for k, v in codon_table().items() for x in (F.lit(k), F.lit(v))])
    n = F.floor(F.length(seq) / 3).cast("int")
    amino = lambda i: F.try_element_at(table, F.substr(F.upper(seq), (i - 1) * 3 + 1, F.lit(3)))
    fail = F.lit(unknown) if unknown is not None else F.raise_error(F.lit("codon with a letter other than ACGT"))
    return F.when(seq.isNull(), F.lit(None).cast("string")).when(n == 0, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.coalesce(amino(i), fail)), ""))


def variant_class(ref: Column, alt: Column, ref_codon: Column, alt_codon: Column) -> Column:
    """UNKNOWN, PREMATURE_STOP, SNV, INDEL (length change divisible by 3) or FRAMESHIFT."""
    stops = ("TAA", "TAG", "TGA")
    change = F.abs(F.length(alt) - F.length(ref))
    return (
        F.when(ref.isNull() | alt.isNull() | (ref == "") | (alt == ""), "UNKNOWN")
        .when((F.length(ref) == 1) & (F.length(alt) == 1) & alt_codon.isin(*stops) & ~ref_codon.isin(*stops), "PREMATURE_STOP")
        .when(F.length(ref) == F.length(alt), "SNV")
        .when(change % 3 == 0, "INDEL")
        .otherwise("FRAMESHIFT")
    )


#: Levels of a claim, weakest first.
CLAIMS = ("UNKNOWN", "DETECTED", "PREDICTED", "ASSOCIATED", "SUPPORTED")


def claim_rank(claim: Column) -> Column:
    """0 for the weakest claim; an unknown word or null is the weakest."""
    return F.greatest(F.coalesce(F.array_position(F.array(*[F.lit(x) for x in CLAIMS]), F.upper(claim)) - 1, F.lit(0)), F.lit(0)).cast("int")


def claim_of(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in CLAIMS]), rank + 1)


def clamp_claim(claim: Column, ceiling: Column) -> Column:
    """The requested claim, but not above the ceiling; a null ceiling does not bind."""
    return claim_of(F.least(claim_rank(claim), F.coalesce(F.when(ceiling.isNotNull(), claim_rank(ceiling)), F.lit(len(CLAIMS) - 1))))


def parse_distances(text: Column) -> Column:
    """Numbers of a packed vector; separators are semicolons, commas and blanks, other words give null."""
    return F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), r"[;,\s]+"), lambda x: x != ""), lambda x: x.try_cast("double"))


def mixed_sort_key(c: Column) -> list[Column]:
    """Ascending order for values of mixed kinds: numbers before text, nulls last."""
    number = c.cast("string").try_cast("double")
    return [c.isNull(), number.isNull(), number, c.cast("string")]


def sorted_set(c: Column, sep: str = ",") -> Column:
    """Aggregate: sorted distinct values joined, null if there are none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(c)), sep), F.lit(""))
