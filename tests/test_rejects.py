import random

import duckdb
import pytest

from isolake.operators import rejects as R
from tests.conftest import rows

SCHEMA = "line_id long, file_name string, line_no int, raw string, reason string"
GOOD = ["S1", "amikacin", "g~1", "g", "1", "point", "enzyme", "finder", "db", "v1", "high", "DETECTED", "99.5", "100"]


def expected(raw):
    if R.skipped(raw):
        return "skipped"
    v = R.split_values(raw)
    if v is None:
        return "quoting"
    if len(v) != 14:
        return "column_count"
    return R.value_fault([R.clean(x) for x in v])


@pytest.mark.parametrize(
    "raw,reason",
    [
        ("\t".join(GOOD), None),
        ("\t".join(GOOD[:-1]), "column_count"),
        ("\t".join([*GOOD, ""]), "column_count"),
        ("\t".join([*GOOD[:6], '"a\tb\nc ""q"""', *GOOD[7:]]), None),
        ("\t".join([*GOOD[:6], '"open', *GOOD[7:]]), "quoting"),
        ("\t".join([*GOOD[:6], '"shut" x', *GOOD[7:]]), "quoting"),
        ("\t".join([*GOOD[:6], 'in"side"', *GOOD[7:]]), None),
        ("\t".join([*GOOD[:2], " . ", *GOOD[3:]]), "determinant"),
        ("\t".join([*GOOD[:12], "100.001", "5"]), "identity_pct"),
        ("\t".join([*GOOD[:12], "1e1", "5"]), "identity_pct"),
        ("\t".join([*GOOD[:12], ".", "-1"]), "coverage_pct"),
        ("\t".join([*GOOD[:12], " 100.000 ", '"7"']), None),
        ("\t".join([*GOOD[:2], ".", *GOOD[3:12], "x", "y"]), "determinant"),
        ("# a comment", "skipped"),
        (" \t\r\n", "skipped"),
        (None, "skipped"),
        ("sample_id\tx", "skipped"),
        ('" sample_id "', "skipped"),
    ],
)
def test_reasons(spark, raw, reason):
    assert expected(raw) == reason
    df = spark.createDataFrame([(1, "f", 1, raw, "clash")], SCHEMA)
    got = R.read_records(df).collect()
    if reason == "skipped":
        assert got == []
    else:
        assert [r.reason for r in got] == [reason]
        assert (got[0].raw == raw) == (reason is not None)


def test_a_broken_record_does_not_damage_its_neighbours(spark):
    rnd = random.Random(3)
    pieces = ["a", "", ".", '"b"', '"b""c"', 'x"y', '"t\tu"', '"n\nl"', "5", "99.5", '"q', '"z"x', '""', "101", "\r", "\x00", ""]
    recs = []
    for k in range(600):
        n = rnd.choice([13, 14, 14, 14, 15])
        recs.append((k, f"f{k % 7}" if k % 11 else None, k, "\t".join(rnd.choice(pieces) if rnd.random() < 0.3 else "50" for _ in range(n)), "x"))
    recs += recs[:50]
    want = {k: expected(raw) for k, _, _, raw, _ in recs}
    got = R.read_records(spark.createDataFrame(recs, SCHEMA)).select("line_id", "reason").collect()
    assert len(got) == len({r.line_id for r in got}) == 600
    assert {r.line_id: r.reason for r in got} == want


def test_typed_rows_and_failed_rows(spark):
    df = spark.createDataFrame([(1, "f", 1, "\t".join(GOOD), ""), (2, "f", 2, "x", ""), (2, "f", 2, "x", "")], SCHEMA)
    checked = R.read_records(df)
    assert rows(R.failed_rows(checked)) == [(2, "column_count")]
    good = R.valid_rows(checked).collect()[0]
    assert (good.identity_pct, good.coverage_pct, good.mechanism) == (99.5, 100.0, "enzyme")


def test_very_long_values_and_empty_tables(spark):
    long = "\t".join([*GOOD[:6], '"' + "é\t" * 1_500_000 + '"', *GOOD[7:]])
    got = R.read_records(spark.createDataFrame([(1, "f", 1, long, ""), (2, "f", 2, "\t".join(GOOD), "")], SCHEMA)).collect()
    assert sorted((r.line_id, r.reason, len(r.mechanism)) for r in got) == [(1, None, 2_999_999), (2, None, 6)]
    assert R.read_records(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_reader_alone_agrees_with_the_rule():
    rnd = random.Random(8)
    con = duckdb.connect()
    for _ in range(15):
        recs = [(k, "".join(rnd.choice('ab\t\t\t"" \n\r.,') for _ in range(rnd.randrange(40)))) for k in range(150)]
        recs = [x for x in recs if not R.skipped(x[1])]
        assert R.accepted_values(con, [recs[:70], recs[70:]]) == {k: v for k, raw in recs if (v := R.split_values(raw)) is not None and len(v) == 14}


def test_reasons_come_from_the_reject_table(monkeypatch):
    """No rejected record is split by hand, and without the reject table no reason is known."""
    rnd = random.Random(4)
    con = duckdb.connect()
    monkeypatch.setattr(R, "_by_hand", lambda raw: (_ for _ in ()).throw(AssertionError(raw)))
    seen = set()
    for _ in range(12):
        recs = [(k, "\t".join(rnd.choice(['"q', '"z"x', '"b"', '"t\tu"', "", '"n\nl"', 'x"y']) if rnd.random() < 0.2 else "5" for _ in range(rnd.choice([12, 13, 14, 14, 15, 16])))) for k in range(200)]
        recs = [x for x in recs if not R.skipped(x[1])]
        _, rejected = R.check_records(con, [recs[:90], recs[90:]])
        assert {k: r[0] for k, r in rejected.items()} == {k: e for k, raw in recs if (e := expected(raw)) in ("quoting", "column_count")}
        seen |= {r[0] for r in rejected.values()}
    assert seen == {"quoting", "column_count"}
    monkeypatch.setattr(R, "reject_errors", lambda con: {})
    with pytest.raises(AssertionError):
        R.check_records(con, [[(0, "a\tb")]])


def test_a_refusal_the_errors_do_not_explain_is_split_by_hand():
    assert R.reason_of({"LINE SIZE OVER MAXIMUM"}) is None and R.reason_of(set()) is None
    assert R._by_hand("a") == ("column_count", None) and R._by_hand('"a') == ("quoting", None)
    assert R._by_hand("\t".join(GOOD))[0] is None
