"""What the one-bit codes prune, and their bounds."""

import random

import numpy as np
from pyspark.sql import functions as F

from carledger.llm import neighbours

SCHEMA = "vec_id long, embedding array<double>"


def test_bounds_hold_and_estimates_are_close():
    rng = np.random.default_rng(1)
    for size in (3, 64, 300):
        x, q, centre, turn = rng.normal(size=(2000, size)), rng.normal(size=(20, size)), np.zeros(size), neighbours.rotation(size)
        codes, r, f = neighbours.encode(x, centre, turn)
        words, of = codes.view(np.uint64), neighbours.planes(q - centre, turn)
        above, error = 0, []
        for i in range(len(q)):
            guess, low = neighbours.bounds(words, r, f, of, i)
            true = ((x - q[i]) ** 2).sum(1)
            above += (low > true).sum()
            error += ((guess - true) / (2 * r * np.linalg.norm(q[i]))).tolist()
        assert above <= 0.005 * 20 * 2000
        assert abs(np.mean(error)) < 0.02 and np.std(error) < 1.3 / np.sqrt(neighbours.code_width(size))


def test_codes_leave_less_than_a_third_to_be_measured(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    found = neighbours.index(rows, 10)
    asked = found.classes.where("node % 10 = 0").select("node", "vector")
    near = neighbours.pairs(found, neighbours.probes(found, asked.withColumn("bound", F.lit(0.0)), True), 44)
    bound = neighbours.measured(found, near, 11).groupBy("query").agg(F.max("score").alias("bound")).withColumnRenamed("query", "node")
    chosen = neighbours.pairs(found, neighbours.probes(found, asked.join(bound, "node"), False), None)
    n_asked, n_rows = asked.count(), found.classes.count()
    share = chosen.where("query is not null").agg(F.sum(F.size("nodes"))).first()[0] / (n_asked * n_rows)
    assert share < 1 / 3, share
    kinds = dict(chosen.dtypes)
    assert "vector" not in kinds  # codes alone decide


def test_vectors_of_several_lengths(spark):
    draw = random.Random(2)
    rows = [(i, [draw.gauss(0, 1) for _ in range(draw.choice([4, 4, 4, 2, 7]))]) for i in range(400)]
    rows += [(400, [0.0, 0.0, 0.0, 0.0, 9.0]), (401, [0.5]), (402, None), (403, [0.0]), (404, [float("nan")] * 4)]
    found = neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0)
    got = [tuple(r) for r in found.orderBy("query_id", "rank").collect()]
    full = {i: np.array(v + [0.0] * (7 - len(v))) for i, v in rows[:402]}
    want = []
    for q in range(0, 401, 100):
        near = sorted((float(np.sqrt(((full[i] - full[q]) ** 2).sum())), i) for i in full if i != q)[:10]
        want += [(q, k + 1, i, d) for k, (d, i) in enumerate(near)]
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12)
