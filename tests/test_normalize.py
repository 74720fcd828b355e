import datetime as dt
from decimal import Decimal

import pytest

from logweir.operators.normalize import accepted, normalize, parse_lines, rejected

H = "@@@[2031/11/23 04:56:07.089]"

# line, outcome, value, content; None as outcome means a plain line, OK a record.
VECTORS = [
    ("", None, None, None),
    (None, None, None, None),
    ("[2031/11/23 04:56:07.089] INFO up", None, None, None),
    ("@@ @@", None, None, None),
    (H + "[정보][A]|x", "R1", None, None),
    (H + "[정보][A]|x|@@@ " + H + "[정보][B]|y|@@@", "R2", None, None),
    (H + "[정보][A]|x|@@@ @@@", "R2", None, None),
    ("@@@@@@", "R3", None, None),
    ("@@@@@@@@", "R3", None, None),
    ("@@@@@@@@@", "R2", None, None),
    ("@@@@@", "R1", None, None),
    ("@@@[2031/11/23 04:56:07.08][정보][A]|x|@@@", "R3", None, None),
    ("@@@ [2031/11/23 04:56:07.089][정보][A]|x|@@@", "R3", None, None),
    (H + "[정보]|x|@@@", "R3", None, None),
    (H + "[][A]|x|@@@", "R3", None, None),
    (H + "[정보][]|x|@@@", "R3", None, None),
    (H + "[정보] [A]|x|@@@", "R3", None, None),
    (H + "[정보][A]x|y|@@@", "R4", None, None),
    (H + "[정보][A]@@@", "R4", None, None),
    (H + "[정보][A]|x@@@", "R5", None, None),
    (H + "[정보][A]|x|y|@@@", "R6", None, None),
    (H + "[수치][A]|x|$1$ 건@@@", "R7", None, None),
    (H + "[기타][A]|x|@@@", "R8", None, None),
    (H + "[[정보][A]|x|@@@", "R8", None, None),
    (H + "[기타][a]|x|건@@@", "R7", None, None),
    (H + "[기타][a]|x|@@@", "R8", None, None),
    (H + "[수치][" + "Z" * 31 + "]|x|$3$@@@", "R9", None, None),
    (H + "[수치][" + "Z" * 30 + "]|x|$3$@@@", "OK", "3", "x"),
    ("@@@[2031/13/23 04:56:07.089][존재][B]|x|@@@", "R10", None, None),
    (H + "[수치][A]|x|@@@", "R11", None, None),
    (H + "[수치][A]|x|$04:10$@@@", "R12", None, None),
    (H + "[수치][A]|x|$1,000$@@@", "R13", None, None),
    (H + "[수치][A]|x|$0x1F$@@@", "R13", None, None),
    (H + "[수치][A]|x|$1f$@@@", "R13", None, None),
    (H + "[수치][A]|x|$NaN$@@@", "R13", None, None),
    (H + "[수치][A]|x|$ $@@@", "R13", None, None),
    (H + "[수치][A]|x|$ -1.5e2 $@@@", "OK", "-150", "x"),
    (H + "[수치][A]|x|$.5$@@@", "OK", "0.5", "x"),
    (H + "[수치][A]|x|$1.$@@@", "OK", "1", "x"),
    (H + "[비교][A]|x $1$|@@@", "R14", None, None),
    (H + "[비교][A]|x $1$ $04:10$|@@@", "R15", None, None),
    (H + "[비교][A]|x $abc$ y|$1$@@@", "OK", None, "x $abc$ y"),
    (H + "[시간][A]|$04:10$ $22:59$|@@@", "R16", None, None),
    (H + "[시간][A]|x|@@@", "R16", None, None),
    (H + "[시간][A]|$930$|@@@", "R17", None, None),
    (H + "[시간][A]|x|$$@@@", "R7", None, None),
    (H + "[존재][B-2]|z|@@@", "R9", None, None),
    (H + "[날짜][ A]|z|@@@", "R9", None, None),
    (H + "[시간][A]|$24:00$|@@@", "R18", None, None),
    (H + "[시간][A]|$12:60$|@@@", "R18", None, None),
    (H + "[시간][A]|$4:10$|@@@", "R18", None, None),
    (H + "[시간][A]|$04:10:00$|@@@", "R18", None, None),
    (H + "[시간][A]|$+4:10$|@@@", "OK", "250", "$+4:10$"),
    (H + "[시간][A]|$ 04:10 $|@@@", "OK", "250", "$ 04:10 $"),
    (H + "[정보][A]|x|$0$@@@", "R19", None, None),
    ("noise " + H + "[정보][A]|x|@@@ more", "OK", None, "x"),
    (H + "[정보][A]||@@@", "OK", None, ""),
    (H + "[정보][A]| x  y |@@@", "OK", None, " x  y "),
    (H + "[정보][A]|x] y|\t@@@", "OK", None, "x] y"),
    (H + "[수치][A]|a  $1$  b|@@@", "OK", "1", "a b"),
    (H + "[수치][A]|a\tb $1$|@@@", "OK", "1", "a\tb"),
    (H + "[수치][A]|$$5$|@@@", "OK", "5", "$"),
    (H + "[수치][A]|$1$2$|@@@", "OK", "1", "2$"),
]


def test_vectors(spark):
    lines = spark.createDataFrame(
        [(i, v[0]) for i, v in enumerate(VECTORS)], "line_number bigint, line string"
    )
    logs, rejects = normalize(lines)
    got = {r.line_number: ("OK", r.log_value, r.log_content, r.raw_log) for r in logs.collect()}
    got.update({r.line_number: (r.reason_code, None, None, None) for r in rejects.collect()})
    for i, (line, outcome, value, content) in enumerate(VECTORS):
        if outcome is None:
            assert i not in got, line
            continue
        assert got[i][0] == outcome, (line, got[i])
        if outcome == "OK":
            assert got[i][1] == (None if value is None else Decimal(value)), line
            assert got[i][2] == content, line
            assert got[i][3].startswith("@@@[") and got[i][3].endswith("@@@")
            assert "noise" not in got[i][3]


@pytest.mark.parametrize(
    "text, stamp",
    [
        ("2026/02/30 10:00:00.123", dt.datetime(2026, 2, 28, 10, 0, 0, 123000)),
        ("2024/02/31 10:00:00.000", dt.datetime(2024, 2, 29, 10)),
        ("1900/02/29 10:00:00.000", dt.datetime(1900, 2, 28, 10)),
        ("2000/02/30 10:00:00.000", dt.datetime(2000, 2, 29, 10)),
        ("2026/04/31 01:02:03.004", dt.datetime(2026, 4, 30, 1, 2, 3, 4000)),
        ("2026/06/11 24:00:00.000", dt.datetime(2026, 6, 12)),
        ("2026/12/31 24:00:00.000", dt.datetime(2027, 1, 1)),
        ("2026/06/11 23:59:59.999", dt.datetime(2026, 6, 11, 23, 59, 59, 999000)),
        ("2026/06/11 24:00:00.001", None),
        ("0000/06/11 09:00:00.123", None),
        ("2026/13/01 09:00:00.123", None),
        ("2026/00/01 09:00:00.123", None),
        ("2026/06/00 09:00:00.123", None),
        ("2026/06/32 09:00:00.123", None),
        ("2026/06/11 23:59:60.000", None),
        ("2026/06/11 23:60:00.000", None),
        ("2026/06/11 25:00:00.000", None),
    ],
)
def test_timestamps(spark, text, stamp):
    lines = spark.createDataFrame([(f"@@@[{text}][정보][A]|x|@@@",)], "line string")
    row = parse_lines(lines).first()
    assert row.log_timestamp == stamp
    assert row.reason_code == ("R10" if stamp is None else None)


def test_number_too_large_is_kept(spark):
    lines = spark.createDataFrame([(H + "[수치][A]|x|$" + "9" * 40 + "$@@@",)], "line string")
    row = parse_lines(lines).first()
    assert row.reason_code is None
    assert (row.log_value, row.log_value_text, row.value_overflow) == (None, "9" * 40, True)


@pytest.mark.parametrize(
    "text, exact",
    [
        ("1", True), ("0.1234567891", True), ("0.12345678910", True), ("0.12345678912", False),
        ("1e-10", True), ("1e-11", False), ("10e-11", True), ("1e-20", False), ("0e-99", True),
        ("0.00000000000", True), ("0.00000000001", False), ("1.123456789012", False),
        ("-1.5e2", True), ("1.50000000000e-9", True), ("1.25e-9", False), ("1e27", True),
        ("1e28", False), ("1e-99999999999", False), ("+.5", True), ("5.", True),
    ],
)
def test_rounded_numbers_are_flagged(spark, text, exact):
    line = H + f"[수치][A]|x|${text}$@@@"
    row = parse_lines(spark.createDataFrame([(line,)], "line string")).first()
    assert row.reason_code is None
    assert (row.value_overflow, row.log_value_text) == (not exact, text)
    if exact:
        assert row.log_value == Decimal(text)


def test_reasons_alone_compute_no_values(spark):
    lines = spark.range(10).selectExpr("id as line_number", "cast(id as string) as line")
    reasons = rejected(parse_lines(lines)).groupBy("reason_code").count()
    plan = reasons._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(38,10)" not in plan
    assert "\\s{2,}" not in plan


def test_parse_runs_once_and_without_shuffle(spark):
    lines = spark.range(10).selectExpr("id as line_number", "cast(id as string) as line")
    logs = accepted(parse_lines(lines))
    plan = logs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # The token pattern stands once for the content and once for the tail.
    assert plan.count("regexp_extract_all") == 2
