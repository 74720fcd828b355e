"""Run a registered query and its SQL side by side."""

import glob
import os

import duckdb


def duckdb_on(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def difference(spark_df, relation):
    """None if both hold the same rows, else a short account of the difference."""
    names = sorted(spark_df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} / {sorted(relation.columns)}"
    ours = sorted((tuple(r) for r in spark_df.select(*names).collect()), key=repr)
    theirs = relation.project(", ".join(f'"{n}"' for n in names)).fetchall()
    theirs = sorted(theirs, key=repr)
    if ours == theirs:
        return None
    a, b = {repr(r) for r in ours}, {repr(r) for r in theirs}
    return (
        f"{len(ours)} / {len(theirs)} rows {names}\n only Spark: {sorted(a - b)[:3]}\n"
        f" only DuckDB: {sorted(b - a)[:3]}"
    )


def types(spark_df, relation):
    """Pairs of column types, for a look at the schemas."""
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    return {f.name: (f.dataType.simpleString(), theirs[f.name]) for f in spark_df.schema.fields}
