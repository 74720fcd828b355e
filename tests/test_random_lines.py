"""Random lines through the Spark parse and through the DuckDB statement."""

import random

import duckdb
import pandas as pd
import pytest

from checks.oracle import DETAIL, _parsed
from logweir.operators.normalize import parse_lines

PIECES = [
    "@@@", "@@", "@", "[", "]", "|", "||", "$", "$$", ":", " ", "  ", "\t", "\x01", "x", "가", "é", "😀",
    "[2026/05/01 04:56:07.089]", "[2026/02/30 24:00:00.000]", "[2026/13/01 04:56:07.089]",
    "[0000/01/01 00:00:00.000]", "[2026/05/01 09:00:01.12]",
    "[수치]", "[비교]", "[시간]", "[정보]", "[문구]", "[기타]", "[A_1]", "[a]", "[" + "Z" * 31 + "]",
    "$1$", "$-1.5e2$", "$ 7 $", "$+.5$", "$1,0$", "$07:35$", "$+7:05$", "$24:00$", "$1:2:3$", "$" + "9" * 40 + "$",
]
TIMES = ["2026/05/01 04:56:07.089"] * 8 + ["2026/04/31 24:00:00.000", "2026/13/01 04:56:07.089"]
HEADS = [f"@@@[{t}][{k}][A_1]|" for t in TIMES for k in ("수치", "비교", "시간", "정보")]


def _line(rng: random.Random) -> str:
    """Half plain noise, half records with noise in content, tail or header."""
    def noise(n):
        return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, n)))

    if rng.random() < 0.4:
        return noise(12)
    head = rng.choice(HEADS)
    if rng.random() < 0.3:
        at = rng.randrange(len(head))
        head = head[:at] + noise(1) + head[at + rng.randint(0, 1):]
    inner = [p for p in PIECES if "@" not in p and "|" not in p]
    content = "".join(rng.choice(inner) for _ in range(rng.randint(0, 5)))
    tail = "".join(rng.choice(inner) for _ in range(rng.choice([0, 0, 1, 2])))
    return noise(1) + head + content + "|" + tail + "@@@" + noise(1)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_lines(spark, seed):
    rng = random.Random(seed)
    texts = pd.DataFrame({"n": range(6000), "line": [_line(rng) for _ in range(6000)]})
    columns = "n, log_type, log_id, log_timestamp, log_content, log_value, raw_log, reason_code, detail"
    ours = parse_lines(spark.createDataFrame(texts, "n bigint, line string"))
    good = "CASE WHEN reason_code IS NULL THEN {0} END AS {0}"
    names = columns.split(", ")
    shown = [n if n in ("n", "raw_log", "reason_code", "detail") else good.format(n) for n in names]
    got = {r.n: tuple(r) for r in ours.selectExpr(*shown).collect()}
    con = duckdb.connect()
    con.register("texts", texts)
    expected = con.sql(
        f"WITH {_parsed('SELECT n, line FROM texts')}, "
        f"detailed AS (SELECT *, {DETAIL} AS detail FROM parsed) SELECT {', '.join(shown)} FROM detailed"
    ).fetchall()
    assert len(got) == len(expected) > 3000
    assert len({r[-2] for r in expected}) >= 17
    for row in expected:
        assert got[row[0]] == row, texts.line[row[0]]
