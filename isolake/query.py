"""The query layer: filter, search, project, sort and page any table from plain request parameters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isolake.errors import UnknownNameError

MAX_LIMIT, DEFAULT_LIMIT = 1000, 200
OPERATORS = ("eq", "ne", "in", "null", "min")


@dataclass(frozen=True)
class Clause:
    column: str
    op: str
    value: str | Sequence[str] = ""


@dataclass(frozen=True)
class PageRequest:
    clauses: Sequence[Clause] = field(default_factory=tuple)
    q: str = ""
    searchable: Sequence[str] | None = None
    columns: Sequence[str] | None = None
    sort: str = ""
    offset: int = 0
    limit: int = DEFAULT_LIMIT


def _known(df: DataFrame, column: str) -> str:
    if column not in df.columns:
        raise UnknownNameError(f"unknown column {column!r}")
    return column


def _loose_eq(df: DataFrame, column: str, value: str) -> Column:
    """List membership, truth words, numbers, or trimmed text, by the column's type."""
    kind = df.schema[column].dataType.simpleString()
    c, value = F.col(f"`{column}`"), value.strip()
    if kind.startswith("array"):
        return F.coalesce(F.array_contains(c.cast("array<string>"), value), F.lit(False))
    if kind == "boolean":
        return F.coalesce(c.cast("string") == value.lower(), F.lit(False))
    text = F.btrim(c.cast("string"))
    try:
        number = float(value)
    except ValueError:
        return F.coalesce(text == value, F.lit(False))
    return F.coalesce((text == value) | (text.try_cast("double") == number), F.lit(False))


def condition(df: DataFrame, clause: Clause) -> Column:
    column = _known(df, clause.column)
    c = F.col(f"`{column}`")
    if clause.op == "eq":
        return _loose_eq(df, column, str(clause.value))
    if clause.op == "ne":
        return ~_loose_eq(df, column, str(clause.value))
    if clause.op == "in":
        words = clause.value.split(",") if isinstance(clause.value, str) else list(clause.value)
        out = F.lit(False)
        for w in words:
            out = out | _loose_eq(df, column, w)
        return out
    if clause.op == "null":
        return c.isNull() if str(clause.value).lower() in ("", "1", "true") else c.isNotNull()
    if clause.op == "min":
        if df.schema[column].dataType.simpleString() == "string":
            return F.coalesce(F.lit(False) & c.isNotNull(), F.lit(False))
        return F.coalesce(c.cast("double") >= float(clause.value), F.lit(False))
    raise UnknownNameError(f"unknown operator {clause.op!r}")


def search(df: DataFrame, q: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with the text, in any case, in one of the columns (default: all)."""
    if not q.strip():
        return df
    hit = F.lit(False)
    for c in columns or df.columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(f"`{_known(df, c)}`").cast("string")), F.lit(q.strip().lower())), F.lit(False))
    return df.where(hit)


def ordering(df: DataFrame, sort: str) -> list[Column]:
    """`column` or `-column`: numbers before text and nulls last; descending is the reverse, so nulls come first."""
    if not sort:
        return []
    c = F.col(f"`{_known(df, sort.lstrip('-'))}`").cast("string")
    number = c.try_cast("double")
    keys = [c.isNull().cast("int"), number.isNull().cast("int"), number, c]
    return [k.desc() for k in keys] if sort.startswith("-") else [k.asc() for k in keys]


def select_rows(df: DataFrame, request: PageRequest) -> DataFrame:
    """All rows that meet the request, before paging."""
    for clause in request.clauses:
        df = df.where(condition(df, clause))
    return search(df, request.q, request.searchable)


def page(df: DataFrame, request: PageRequest, tie: Sequence[str] = ()) -> DataFrame:
    """One page of rows; the limit is cut to MAX_LIMIT. `tie` columns make the order total."""
    rows = select_rows(df, request)
    keys = [*ordering(rows, request.sort), *[F.col(f"`{_known(rows, t)}`").asc_nulls_last() for t in tie]]
    if keys:
        rows = rows.orderBy(*keys)
    rows = rows.offset(max(0, request.offset)).limit(max(0, min(request.limit, MAX_LIMIT)))
    return rows.select(*[F.col(f"`{_known(df, c)}`") for c in request.columns]) if request.columns else rows


def basis(df: DataFrame, request: PageRequest, small: int = 10) -> dict:
    """What a response says of its rows: totals before and after filtering, the limit applied, and whether there are few."""
    total, kept = df.count(), select_rows(df, request).count()
    return {"rows_total": total, "rows": kept, "filtered": kept != total, "limit_applied": min(request.limit, MAX_LIMIT), "underpowered": kept < small}
