"""cairn: Spark-native dimensional and fact modelling operators.

Every operator is a function from DataFrame(s) to a DataFrame; it plans
with the DataFrame API so Catalyst can prune, push down and pick joins.
"""

__version__ = "0.1.0"
