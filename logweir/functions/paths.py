"""Path templates of schedules."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweir.model import DATE_PLACEHOLDER, NO_RESET_SUFFIX


def keeps_position(template: Column) -> Column:
    """A trailing plus sign: go on reading where the last run stopped, even on another day."""
    return F.endswith(template, F.lit(NO_RESET_SUFFIX))


def resolved_path(template: Column, collect_date: Column) -> Column:
    """Path without one trailing plus sign, every date placeholder replaced."""
    bare = F.left(template, F.length(template) - 1)
    path = F.when(keeps_position(template), bare).otherwise(template)
    return F.replace(path, F.lit(DATE_PLACEHOLDER), collect_date)
