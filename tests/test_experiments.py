"""Experiment assignment is deterministic and follows the cell shares; the
readout and z statistic match hand calculations."""

import math

from pyspark.sql import functions as F

from cairn.operators import experiments


def test_assignment_deterministic_and_balanced(spark):
    users = spark.range(20000).select(F.col("id").alias("user_id"))
    a = experiments.assign(users, "exp_salt")
    b = experiments.assign(users, "exp_salt")
    assert a.exceptAll(b).count() == 0
    shares = {r.cell: r.n for r in a.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(shares) == {"control", "treatment"}
    assert abs(shares["control"] / 20000 - 0.5) < 0.02
    other = experiments.assign(users, "other_salt")
    moved = a.join(other.withColumnRenamed("cell", "c2"), "user_id").where("cell != c2").count()
    assert moved > 0  # a new salt reshuffles users


def test_readout_and_z(spark):
    assignment = spark.createDataFrame(
        [(1, 10, "control"), (2, 20, "control"), (3, 60, "treatment"), (4, 70, "treatment")],
        "user_id long, bucket int, cell string",
    )
    events = spark.createDataFrame(
        [(1, "view", 1.50), (1, "purchase", 2.25), (2, "view", 0.75), (3, "purchase", 4.00), (4, "purchase", 1.00)],
        "user_id long, event_type string, value double",
    )
    r = {row.cell: row for row in experiments.readout(assignment, events, "purchase").collect()}
    assert (r["control"].users, r["control"].converters) == (2, 1)
    assert (r["treatment"].users, r["treatment"].converters) == (2, 2)
    assert r["control"].mean_value == (3.75 + 0.75) / 2
    assert abs(r["control"].var_value - ((3.75 - 2.25) ** 2 + (0.75 - 2.25) ** 2)) < 1e-12
    z = experiments.z_test(experiments.readout(assignment, events, "purchase")).first()
    p = 3 / 4
    want = (1.0 - 0.5) / math.sqrt(p * (1 - p) * (1 / 2 + 1 / 2))
    assert abs(z.z - want) < 1e-12
