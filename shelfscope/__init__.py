"""shelfscope: a Spark-native store-performance data mart.

Every operator is a function from DataFrames to a DataFrame; nothing runs
until an action is taken on the final mart (or on an intermediate stage that
``plans.stages`` decides to materialise).
"""

from shelfscope.params import MartParams  # noqa: F401
from shelfscope.session import get_spark  # noqa: F401
