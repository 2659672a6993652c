"""Tables of detection and typing tools, free-text fields, wide presence tables and trees."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isolake.errors import ContractError
from isolake.functions.scalars import null_if_in
from isolake.operators.packed import split_by_rule, split_delimited

#: Words a typing table uses for no type.
TYPE_NULLS = ("", ".", "NA", "N/A", "none", "None", "-", "0")


def determinant_rows(report: DataFrame, kind: str = "AMR", type_column: str = "Type") -> DataFrame:
    """Rows of one kind of a detection report; a missing type column is refused."""
    if type_column not in report.columns:
        raise ContractError(f"missing column {type_column}")
    return report.where(F.col(type_column) == kind)


def map_determinants(calls: DataFrame, mechanisms: DataFrame, strict: bool = False) -> DataFrame:
    """Calls with the mechanism of their gene; with `strict`, unmapped calls get the antibiotic `unmapped`."""
    out = calls.drop("mechanism").join(mechanisms.select("gene", "mechanism").dropDuplicates(["gene"]), "gene", "left")
    return out.withColumn("antibiotic", F.when(F.lit(strict) & F.col("mechanism").isNull(), "unmapped").otherwise(F.col("antibiotic")))


def alleles_map(text: Column) -> Column:
    """Map locus -> allele of `locus:allele;...`; null words become null alleles, the last of repeated loci wins."""
    from isolake.sources.variants import key_values

    return F.transform_values(key_values(F.coalesce(text, F.lit("")), ";", ":"), lambda k, v: null_if_in(v, TYPE_NULLS))


def typing_rows(table: DataFrame, st: str = "ST", alleles: str = "alleles", min_loci: int = 5) -> DataFrame:
    """`table` with parsed alleles, cleaned type and status: no_call without alleles, partial (and no type) with fewer known loci or without a type, else complete."""
    t = table.withColumn("allele_map", alleles_map(F.col(alleles))).withColumn("st_clean", null_if_in(F.col(st).cast("string"), TYPE_NULLS))
    known = F.size(F.map_filter("allele_map", lambda k, v: v.isNotNull()))
    t = t.withColumn("known_loci", known)
    status = F.when(F.col("known_loci") == 0, "no_call").when((F.col("known_loci") < min_loci) | F.col("st_clean").isNull(), "partial").otherwise("complete")
    return t.withColumn("status", status).withColumn("st_clean", F.when(F.col("status") == "complete", F.col("st_clean")))


def antibiogram(fields: DataFrame, key: str, text: str, vocabulary: Sequence[str] = ("R", "I", "S", "SDD", "ND")) -> DataFrame:
    """(key, drug, category, state) of `drug=CAT,...`: agreeing repeats give the value, disagreeing ones `ambiguous`, unknown words `invalid`."""
    pieces = F.explode(split_delimited(F.col(text), F.lit(",;"), F.lit('"')))
    p = fields.where(F.col(text).isNotNull()).select(key, pieces.alias("p")).where(F.instr("p", "=") > 0)
    g = p.select(key, F.lower(F.trim(F.substring_index("p", "=", 1))).alias("drug"), F.upper(F.trim(F.substring_index("p", "=", -1))).alias("cat")).groupBy(key, "drug").agg(F.array_sort(F.collect_set("cat")).alias("cats"))
    state = F.when(F.exists("cats", lambda c: ~c.isin(*vocabulary)), "invalid").when(F.size("cats") > 1, "ambiguous").otherwise("called")
    return g.select(key, "drug", F.when(state == "called", F.col("cats")[0]).alias("category"), state.alias("state"))


def genotypes(fields: DataFrame, key: str, text: str, states: Sequence[str]) -> DataFrame:
    """(key, gene, variant, state, known) of `gene=STATE,...`: a residue change after an underscore or colon is the variant; words outside `states` are not known.

    The text may also be a JSON array of such entries.
    """
    pieces = F.explode(split_by_rule(F.col(text)))
    p = fields.where(F.col(text).isNotNull()).select(key, pieces.alias("p"))
    symbol = F.trim(F.substring_index("p", "=", 1))
    state = F.when(F.instr("p", "=") > 0, F.trim(F.substring_index("p", "=", -1)))
    pattern = r"^(.+?)[_:]([A-Z][0-9]+[A-Z*])$"
    hit = symbol.rlike(pattern)
    return p.select(
        key, F.when(hit, F.regexp_extract(symbol, pattern, 1)).otherwise(symbol).alias("gene"), F.when(hit, F.regexp_extract(symbol, pattern, 2)).alias("variant"),
        state.alias("state"), F.coalesce(state.isin(*states), state.isNull()).alias("known"),
    )


def wide_presence(wide: DataFrame, gene: str, samples: Sequence[str]) -> DataFrame:
    """(gene, sample_id) of a wide table: a cell that is filled and not `0` is presence."""
    long = wide.unpivot([gene], list(samples), "sample_id", "cell")
    return long.where(F.coalesce(~F.btrim("cell").isin("", "0"), F.lit(False))).select(F.col(gene).alias("gene"), "sample_id")


def parse_newick(text: str) -> list[tuple[int, int | None, str | None, float | None, bool]]:
    """(node, parent, label, length, is_tip) of one tree, nodes numbered in preorder; quoted labels may hold any sign."""
    nodes: list[list] = [[0, None, None, None]]
    at, i, n, depth = 0, 0, len(text), 0
    while i < n:
        ch = text[i]
        if ch == "(":
            nodes.append([len(nodes), at, None, None])
            at, depth, i = len(nodes) - 1, depth + 1, i + 1
        elif ch in ",)":
            if depth == 0:
                raise ContractError(f"tree: unexpected {ch!r} at {i}")
            parent = nodes[at][1]
            if ch == ",":
                nodes.append([len(nodes), parent, None, None])
                at = len(nodes) - 1
            else:
                at, depth = parent, depth - 1
            i += 1
        elif ch == ";":
            break
        elif ch == "[":
            i = text.find("]", i) + 1 or n
        elif ch == ":":
            j = i + 1
            while j < n and text[j] not in ",();[":
                j += 1
            try:
                nodes[at][3] = float(text[i + 1 : j])
            except ValueError:
                raise ContractError(f"tree: bad length {text[i + 1 : j]!r}") from None
            i = j
        elif ch.isspace():
            i += 1
        elif ch == "'":
            j = i + 1
            while j < n and (text[j] != "'" or text[j + 1 : j + 2] == "'"):
                j += 2 if text[j] == "'" else 1
            nodes[at][2], i = text[i + 1 : j].replace("''", "'"), j + 1
        else:
            j = i
            while j < n and text[j] not in ",():;[":
                j += 1
            nodes[at][2], i = text[i:j].strip(), j
    else:
        raise ContractError("tree: no closing semicolon")
    if depth:
        raise ContractError("tree: brackets do not close")
    inner = {p for _, p, _, _ in nodes}
    return [(k, p, label, length, k not in inner) for k, p, label, length in nodes]


def trees(texts: DataFrame, key: str = "tree_id", text: str = "newick") -> DataFrame:
    """Node table (tree_id, node, parent, label, length, is_tip) of one tree a row."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *node) for k, t in zip(pdf[key], pdf[text]) if t for node in parse_newick(t)]
            out = pd.DataFrame(rows, columns=["tree_id", "node", "parent", "label", "length", "is_tip"])
            out["parent"] = out["parent"].astype("Int64")
            yield out

    return texts.select(key, text).mapInPandas(parse, "tree_id string, node long, parent long, label string, length double, is_tip boolean")


#: The leading columns of a legacy typing table, and its word for an allele that was not matched.
LEGACY_COLUMNS, UNMATCHED = ("FILE", "SCHEME", "ST"), "-"


def legacy_typing(lines: DataFrame, samples: DataFrame, path: str = "table") -> DataFrame:
    """(sample_id, found, scheme, st, alleles, partial) of a legacy typing table (column value: a header, then a row a file).

    A row belongs to the sample its FILE is named after, whatever the order. A header alone means that nothing was typed (found is false for all). Refused:
    no line, a leading column or all loci missing, rows but none for a sample. An unmatched allele is left out, `?` is kept and named in `partial`.
    """
    lines = lines.where(F.trim("value") != "")
    head = lines.where(F.col("value").startswith("FILE\t") | (F.col("value") == "FILE")).agg(F.max("value")).first()[0]
    if head is None:
        raise ContractError(f"{path}: no header row")
    header = [h.strip() for h in head.split("\t")]
    if lost := [c for c in LEGACY_COLUMNS if c not in header]:
        raise ContractError(f"{path}: missing columns {lost}")
    loci = [h for h in header if h not in LEGACY_COLUMNS]
    if not loci:
        raise ContractError(f"{path}: no loci")
    cells = F.split("value", "\t")
    cell = lambda h: F.trim(F.coalesce(F.get(cells, F.lit(header.index(h))), F.lit("")))
    stem = F.regexp_replace(F.element_at(F.split(cell("FILE"), "/"), -1), r"\.[^.]*$", "")
    named = F.array(*[F.struct(F.lit(h).alias("k"), cell(h).alias("v")) for h in loci])
    rows = lines.where(F.col("value") != head).select(
        stem.alias("sample_id"), F.nullif(cell("SCHEME"), F.lit("")).alias("scheme"), F.when(~cell("ST").isin("", UNMATCHED), cell("ST")).alias("st"),
        F.map_from_entries(F.filter(named, lambda e: ~e["v"].isin("", UNMATCHED))).alias("alleles"), F.transform(F.filter(named, lambda e: e["v"] == "?"), lambda e: e["k"]).alias("partial"),
    )
    rows = rows.dropDuplicates(["sample_id"])
    out = samples.select("sample_id").distinct().join(rows.withColumn("found", F.lit(True)), "sample_id", "left")
    if not rows.isEmpty():
        gone = out.where("found IS NULL").orderBy("sample_id").limit(10).collect()
        if gone:
            raise ContractError(f"{path}: no row for {[r.sample_id for r in gone]}")
    return out.select("sample_id", F.coalesce("found", F.lit(False)).alias("found"), "scheme", "st", "alleles", "partial")


def project_tree(text: str) -> list[tuple[int, int | None, list[int], str | None, float | None, bool]]:
    """(node_id, parent_id, children, label, length, is_tip) of one tree for display: nodes numbered in postorder, parents before their children."""
    nodes = parse_newick(text)
    children: dict[int | None, list[int]] = {}
    for k, p, *_ in nodes:
        children.setdefault(p, []).append(k)
    number: dict[int, int] = {}
    stack = [(children[None][0], False)]
    while stack:
        k, done = stack.pop()
        if done or k not in children:
            number[k] = len(number)
        else:
            stack.append((k, True))
            stack += [(c, False) for c in reversed(children[k])]
    return [(number[k], None if p is None else number[p], [number[c] for c in children.get(k, [])], label, length, tip) for k, p, label, length, tip in nodes]


def tree_projection(texts: DataFrame, key: str = "tree_id", text: str = "newick") -> DataFrame:
    """Display nodes of one tree a row: (tree_id, node_id, parent_id, children, label, length, is_tip), children as a list in order."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *node) for k, t in zip(pdf[key], pdf[text]) if t for node in project_tree(t)]
            out = pd.DataFrame(rows, columns=["tree_id", "node_id", "parent_id", "children", "label", "length", "is_tip"])
            out["parent_id"] = out["parent_id"].astype("Int64")
            yield out

    return texts.select(key, text).mapInPandas(parse, "tree_id string, node_id long, parent_id long, children array<long>, label string, length double, is_tip boolean")
