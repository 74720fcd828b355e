import math
import os

import duckdb
import pytest
from compare import difference
from rows import docs

from logweir.llm.mixing import ORACLE_SQL, mixed
from logweir.llm.queries import op9_mixing

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not at hand")
def test_against_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert difference(op9_mixing(spark, SF), db.sql(ORACLE_SQL)) is None


def test_copies_follow_the_poisson_distribution(spark):
    rows = [(i, "x" * 10, "en", "hot" if i % 3 else "cold") for i in range(6000)]
    weights = spark.createDataFrame([("hot", 1.0), ("cold", 3.0)], "source string, weight double")
    found = mixed(docs(spark, rows), weights).collect()
    copies = {}
    for r in found:
        copies.setdefault(r.doc_id, []).append(r.copy)
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in copies.values())
    for source, rate in (("hot", 0.375), ("cold", 2.25)):
        own = [len(copies.get(i, [])) for i, _, _, s in rows if s == source]
        assert {r.rate for r in found if r.source == source} == {rate}
        for k in range(4):
            share = own.count(k) / len(own)
            expected = math.exp(-rate) * rate**k / math.factorial(k)
            assert abs(share - expected) < 0.035
    assert abs(len(found) - 6000) < 300


def test_large_rates_and_order(spark):
    rows = [(1, "a", "en", "tiny"), (2, "b" * 3000, "en", "big")]
    weights = spark.createDataFrame([("tiny", 1.0), ("big", 1.0)], "source string, weight double")
    found = mixed(docs(spark, rows), weights).collect()
    tiny = [r for r in found if r.source == "tiny"]
    assert tiny[0].rate == 1500.5 and abs(len(tiny) - 1500.5) < 200
    parts = mixed(docs(spark, rows), weights).rdd.glom().map(lambda p: [r.shuffle_key for r in p])
    assert all(keys == sorted(keys) for keys in parts.collect())


def test_defined_results(spark):
    rows = [(i, "text", "en", None) for i in range(50)] + [(i, None, "en", "void") for i in range(50, 90)]
    rows += [(None, "text", "en", "n"), (None, "text", "en", "n"), (7, "text", "en", None)]
    df = docs(spark, rows, clashes=True)
    found = mixed(df).collect()
    assert {r.source for r in found} >= {None, "void"}
    assert {r.rate for r in found if r.source == "void"} == {1.0}
    assert sorted(found[0].asDict()) == sorted(df.columns)
    seven = [r for r in found if r.doc_id == 7]
    assert len(seven) % 2 == 0
    assert len([r for r in found if r.doc_id is None]) % 2 == 0
    none = spark.createDataFrame([("void", 1.0)], "source string, weight double")
    assert {r.source for r in mixed(df, none).collect()} <= {"void"}
    assert mixed(docs(spark, [])).collect() == []
