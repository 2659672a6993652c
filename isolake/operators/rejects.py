"""Load delimited records, setting aside those that cannot be read together with the reason.

Workers hand the records of each file to DuckDB's CSV reader with its reject tables on. The reader sees an anonymous
in-memory file (no disk, no shared folder) per source file and Arrow batch, so memory is bounded by the batch and no file, however large, has to fit in one task. Accepted rows come back as columns; reject-table errors are joined
to the raw records by a row number carried as the first column, and their types give the reason: an unquoted value (or a guard, see below,
that was swallowed) is broken quoting, and else too many or missing columns are a wrong count. The reader lists every error of a record, so
the reason that comes first is known. Only a record refused for another reason, such as a bound of the reader, is split by hand; `decided_by` tells.

Two provisions keep one broken record from damaging its neighbours. Characters the reader treats specially inside a
record (blanks, line breaks, NUL) are exchanged for code points that do not occur in the batch and restored
afterwards, so a record is always one line. A record that opens a quote is followed by a guard line: if the quote never
closes, the guard closes it and betrays the record by its column count; if it does close, the guard is a row of its own. Every line ends
with a mark of its own column, since the reader forgives empty columns in excess.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AMR_COLUMNS = (
    "sample_id", "antibiotic", "determinant", "gene", "variant", "determinant_type", "mechanism", "evidence_source",
    "database", "database_version", "confidence", "claim_status", "identity_pct", "coverage_pct",
)
REASONS = ("quoting", "column_count", "determinant", "identity_pct", "coverage_pct")
BLANKS = " \t\r\n"
_PERCENT = re.compile(r"0*(?:100(?:\.0+)?|[0-9]{1,2}(?:\.[0-9]+)?)", re.ASCII)
_END = "$"
_OPENS = re.compile(r'(?:^|\t)"')
_HEADER = re.compile(r'(?:[ \r\n]*sample_id[ \r\n]*|"[ \t\r\n]*sample_id[ \t\r\n]*")(?=\t|\Z)')


def skipped(raw: str | None) -> bool:
    """Comment, blank (or null) and header records are neither valid nor failed."""
    return raw is None or raw.startswith("#") or not raw.strip(BLANKS) or bool(_HEADER.match(raw))


def split_values(raw: str) -> list[str] | None:
    """The values of one record, or None if its quoting is broken: the record rule by hand."""
    out, i, n = [], 0, len(raw)
    while True:
        if i < n and raw[i] == '"':
            j, parts = i + 1, []
            while True:
                k = raw.find('"', j)
                if k < 0:
                    return None
                parts.append(raw[j:k])
                if raw[k + 1 : k + 2] != '"':
                    break
                parts.append('"')
                j = k + 2
            out.append("".join(parts))
            i = k + 1
            if i < n and raw[i] != "\t":
                return None
        else:
            k = raw.find("\t", i)
            k = n if k < 0 else k
            out.append(raw[i:k])
            i = k
        if i >= n:
            return out
        i += 1


def clean(value: str) -> str | None:
    value = value.strip(BLANKS)
    return None if value in ("", ".") else value


def value_fault(values: list[str | None]) -> str | None:
    """The first column that holds an impossible value, of cleaned values in column order."""
    if values[2] is None:
        return "determinant"
    for i in (12, 13):
        if values[i] is not None and not _PERCENT.fullmatch(values[i]):
            return AMR_COLUMNS[i]
    return None


def _stand_ins(text: str, wanted: str) -> dict[str, str]:
    """For each character of `wanted` a private-use code point that `text` does not hold."""
    free = (chr(c) for c in range(0xE000, 0xF8FF))
    used = {c for c in set(text) if "" <= c <= ""}
    return {c: next(x for x in free if x not in used) for c in wanted}


@contextmanager
def _as_files(con, files: list[list[tuple[int, str]]]) -> Iterator[tuple[str, str, str]]:
    """(table function over the records, one line each, and the stand-ins in it with their originals)."""
    swap = _stand_ins("".join(raw for records in files for _, raw in records), " \r\n\x00\x01")
    there = str.maketrans(swap)
    guard = '\x01"' + f"\t{_END}" * (len(AMR_COLUMNS) + 1) + "\n"
    fds, longest = [], 0
    try:
        for records in files:
            lines = []
            for k, raw in records:
                line = f"{k}\t{raw.translate(there)}\t{_END}\n"
                longest = max(longest, 4 * len(line))
                lines.append(line)
                if _OPENS.search(raw):
                    lines.append(guard)
            fds.append(os.memfd_create("records"))
            with os.fdopen(os.dup(fds[-1]), "wb") as f:
                f.write("".join(lines).encode())
        paths = ", ".join(f"'/proc/{os.getpid()}/fd/{fd}'" for fd in fds)
        columns = ", ".join(f"'c{i}': 'VARCHAR'" for i in range(len(AMR_COLUMNS) + 2))
        size = max(2 << 20, longest + 1024)
        yield (
            f"""read_csv([{paths}], columns={{{columns}}}, auto_detect=false, header=false, delim='\t', quote='"', escape='"',
            comment='', strict_mode=true, null_padding=false, store_rejects=true, rejects_limit=0, parallel=false,
            max_line_size={size}, buffer_size={16 * size if size < 8 << 20 else 2 * size})""",
            "".join(swap.values()),
            "".join(swap),
        )
        con.execute("DROP TABLE IF EXISTS reject_errors; DROP TABLE IF EXISTS reject_scans")
    finally:
        for fd in fds:
            os.close(fd)


def accepted_values(con, files: list[list[tuple[int, str]]]) -> dict[int, list[str]]:
    """What the reader alone accepts: number -> values as they stand, of numbered records in some files."""
    with _as_files(con, files) as (source, stand_ins, originals):
        back = str.maketrans(dict(zip(stand_ins, originals)))
        rows = con.execute(f"SELECT * FROM {source}").fetchall()
    return {int(r[0]): ["" if x is None else x.translate(back) for x in r[1:-1]] for r in rows if r[-1] == _END and r[0] and r[0].isdigit()}


def reason_of(errors: set[str]) -> str | None:
    """The reason that comes first of the reader's error types of one record; None if they do not tell."""
    if "UNQUOTED VALUE" in errors:
        return "quoting"
    return "column_count" if errors and errors <= {"TOO MANY COLUMNS", "MISSING COLUMNS"} else None


def reject_errors(con) -> dict[int, set[str]]:
    """Record number -> error types of the last scan, from its reject table. A line that holds the guard's mark did not close its quote."""
    out: dict[int, set[str]] = {}
    for number, kind in con.execute(
        """SELECT TRY_CAST(split_part(csv_line, chr(9), 1) AS BIGINT) AS k, CASE WHEN contains(csv_line, chr(1)) THEN 'UNQUOTED VALUE' ELSE error_type::VARCHAR END
        FROM reject_errors WHERE k IS NOT NULL"""
    ).fetchall():
        out.setdefault(number, set()).add(kind)
    return out


def check_records(con, files: list[list[tuple[int, str]]]) -> tuple[pa.Table, dict[int, tuple[str | None, list[str | None] | None, str]]]:
    """(accepted, rejected) of the numbered records of some files, read in one scan.

    `accepted` has the number, the first value fault or null, and typed columns; `rejected` maps each other record's number to its
    reason, its cleaned values if it has no fault, and what decided.
    """
    names = [f"c{i}" for i in range(1, len(AMR_COLUMNS) + 1)]
    with _as_files(con, files) as (source, stand_ins, originals):
        cleaned = ", ".join(f"nullif(nullif(trim(translate({c}, $from, $to), $blanks), ''), '.') AS {n}" for c, n in zip(names, AMR_COLUMNS))
        good = con.sql(
            f"""WITH r AS (SELECT c0, {cleaned} FROM {source} WHERE c{len(AMR_COLUMNS) + 1} = $last AND regexp_full_match(c0, '[0-9]+')),
            f AS (SELECT *, CASE WHEN determinant IS NULL THEN 'determinant'
                WHEN NOT regexp_full_match(coalesce(identity_pct, '0'), $pct) THEN 'identity_pct'
                WHEN NOT regexp_full_match(coalesce(coverage_pct, '0'), $pct) THEN 'coverage_pct' END AS reason FROM r)
            SELECT CAST(c0 AS BIGINT) AS k, reason, {", ".join(AMR_COLUMNS[:-2])},
                CASE WHEN reason IS NULL THEN CAST(identity_pct AS DOUBLE) END AS identity_pct, CASE WHEN reason IS NULL THEN CAST(coverage_pct AS DOUBLE) END AS coverage_pct FROM f""",
            params={"from": stand_ins, "to": originals, "blanks": BLANKS, "last": _END, "pct": _PERCENT.pattern},
        ).to_arrow_table()
        errors = reject_errors(con)
    by_number = {k: raw for records in files for k, raw in records}
    rejected: dict[int, tuple[str | None, list[str | None] | None, str]] = {}
    for k in by_number.keys() - set(good.column("k").to_pylist()):
        reason = reason_of(errors.get(k, set()))
        rejected[k] = (reason, None, "reject_errors") if reason else (*_by_hand(by_number[k]), "raw_text")
    return good, rejected


def _by_hand(raw: str) -> tuple[str | None, list[str | None] | None]:
    values = split_values(raw)
    if values is None:
        return "quoting", None
    return _typed(values) if len(values) == len(AMR_COLUMNS) else ("column_count", None)


def _typed(values: list[str]) -> tuple[str | None, list[str | None] | None]:
    cleaned = [clean(v) for v in values]
    fault = value_fault(cleaned)
    return fault, None if fault else cleaned


SCHEMA = T.StructType(
    [T.StructField("line_id", T.LongType()), T.StructField("file_name", T.StringType()), T.StructField("line_no", T.IntegerType()), T.StructField("reason", T.StringType()), T.StructField("decided_by", T.StringType()), T.StructField("raw", T.StringType())]
    + [T.StructField(c, T.DoubleType() if c.endswith("_pct") else T.StringType()) for c in AMR_COLUMNS]
)


def _check_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import duckdb
    import pyarrow.compute as pc
    from pyspark.sql.pandas.types import to_arrow_schema

    con = duckdb.connect(":memory:", config={"threads": 1})
    schema = to_arrow_schema(SCHEMA)
    for batch in batches:
        files, raws = batch.column("file_name").to_pylist(), batch.column("raw").to_pylist()
        by_file: dict[str | None, list[tuple[int, str]]] = {}
        for k, raw in enumerate(raws):
            if not skipped(raw):
                by_file.setdefault(files[k], []).append((k, raw))
        if not by_file:
            continue
        good, rejected = check_records(con, list(by_file.values()))
        rest = []
        for k, (reason, values, by) in rejected.items():
            row = dict(zip(AMR_COLUMNS, values)) if values else {}
            rest.append({"k": k, "reason": reason, "decided_by": by, **{c: float(v) if c.endswith("_pct") and v is not None else v for c, v in row.items()}})
        types = pa.schema([("k", pa.int64()), ("reason", pa.string()), ("decided_by", pa.string()), *[(f.name, f.type) for f in schema if f.name in AMR_COLUMNS]])
        good = good.add_column(2, "decided_by", pa.array(["reader"] * good.num_rows, pa.string()))
        out = pa.concat_tables([good.cast(types), pa.Table.from_pylist(rest, types)]).combine_chunks()
        k, failed = out.column("k").combine_chunks(), pc.is_valid(out.column("reason").combine_chunks())
        none = pa.scalar(None, pa.string())
        columns = {c: batch.column(c).take(k) for c in ("line_id", "file_name", "line_no")}
        columns |= {"reason": out.column("reason").combine_chunks(), "decided_by": out.column("decided_by").combine_chunks(), "raw": pc.if_else(failed, batch.column("raw").take(k), none)}
        for c in AMR_COLUMNS:
            columns[c] = pc.if_else(failed, pa.scalar(None, types.field(c).type), out.column(c).combine_chunks())
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name]) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in schema], schema=schema)
    con.close()


def read_records(records: DataFrame, lines_per_chunk: int = 8192) -> DataFrame:
    """Every record that is not a comment, header or blank one: typed columns where valid, else reason and raw text.

    `decided_by` is reader (accepted, its values judged), reject_errors (refused, the error types told why) or raw_text.

    `records` has line_id, file_name, line_no and raw; other columns are ignored. A null raw is blank; null file names
    form one file. Whole-row copies are read once. An empty table gives an empty result.
    """
    r = records.select("line_id", "file_name", "line_no", "raw")
    # a chunk of a file's lines meets in one task: copies go without another shuffle, and a batch holds few files
    r = r.withColumn("chunk", F.floor(F.coalesce("line_no", F.lit(0)) / lines_per_chunk))
    r = r.repartition("file_name", "chunk").dropDuplicates().sortWithinPartitions("file_name", "line_no").drop("chunk")
    return r.mapInArrow(_check_batches, SCHEMA)


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where("reason IS NULL").drop("reason", "decided_by", "raw")


def failed_rows(checked: DataFrame) -> DataFrame:
    """One row for each line_id that fails; of contradicting records under one line_id the least reason is kept."""
    rank = F.array_position(F.array(*[F.lit(x) for x in REASONS]), F.col("reason"))
    bad = checked.where("reason IS NOT NULL").groupBy("line_id").agg(F.min(rank).alias("rank"))
    return bad.select("line_id", F.element_at(F.array(*[F.lit(x) for x in REASONS]), F.col("rank").cast("int")).alias("reason"))
