"""Finished columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finish(df: DataFrame, carried: list[str], *columns: Column) -> DataFrame:
    """Select `columns` as finished values, beside the `carried` ones.

    They leave through an `inline` of one struct. A later filter on them then reads their values;
    after a plain select the optimizer would copy their expressions into the filter, below the
    select, and work them out twice. Generated code also starts a new method there.
    """
    return df.select(*carried, F.inline(F.array(F.struct(*columns))))
