"""Labels of user attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels that reports show.
UNDER_20 = "20岁以下"
FROM_20_TO_30 = "20岁到30岁"
FROM_30 = "30岁以上"
FEMALE = "女"
MALE = "男"
SECRET = "保密"


def age_group(age: Column) -> Column:
    """Age band; null where the age is unknown."""
    return F.when(age < 20, UNDER_20).when(age < 30, FROM_20_TO_30).when(age >= 30, FROM_30)


def gender_label(gender: Column) -> Column:
    """Label of a gender code; everything but F and M, null included, is kept secret."""
    return F.when(gender == "F", FEMALE).when(gender == "M", MALE).otherwise(SECRET)
