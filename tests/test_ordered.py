import numpy as np
from pyspark.sql import functions as F

from keepwell.operators.ordered import exact_quantiles, ordered_prefix


def test_prefix_matches_global_order_with_many_buckets(spark):
    df = spark.range(0, 3000).select(F.col("id"), ((F.col("id") * 7919) % 97).cast("double").alias("v"))
    for ranges in (None, 5, 40):
        out = ordered_prefix(df, [("v", False), ("id", True)], sums={"cum": F.col("v")}, ranges=ranges,
                             rank_col="r").toPandas().sort_values("r")
        pdf = df.toPandas().sort_values(["v", "id"], ascending=[False, True])
        assert list(out["id"]) == list(pdf["id"])
        assert np.allclose(out["cum"].values, np.cumsum(pdf["v"].values))


def test_prefix_partition_count_independent(spark):
    df = spark.range(0, 500).select("id", (F.col("id") % 13).alias("g"), ((F.col("id") * 31) % 101).alias("v"))
    results = []
    for parts in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        results.append(sorted(tuple(r) for r in ordered_prefix(
            df, [("v", True), ("id", True)], by=["g"], rank_col="r").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_exact_quantiles_match_numpy(spark):
    vals = [float(x) for x in np.random.default_rng(1).integers(0, 50, 400)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0, 0.1, 0.25, 0.5, 0.9, 1]
    got = [r["quantile"] for r in exact_quantiles(df, "x", probs).orderBy("q_index").collect()]
    assert np.allclose(got, np.quantile(vals, probs))


def test_no_single_partition_exchange(spark):
    df = spark.range(0, 100).select("id", (F.col("id") % 7).cast("double").alias("v"))
    plan = ordered_prefix(df, [("v", False), ("id", True)])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_totals_and_null_sums_per_group(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, None), ("b", 3, None)], "g string, id int, x double")
    rows = {r["id"]: r for r in ordered_prefix(df, [("id", True)], sums={"s": F.col("x")}, by=["g"], rank_col="r",
                                               totals=True, ranges=3).collect()}
    assert [(rows[i]["r"], rows[i]["r_total"], rows[i]["s"], rows[i]["s_total"]) for i in (1, 2, 3)] == [
        (1, 2, 2.0, 2.0), (2, 2, 2.0, 2.0), (1, 1, None, None)]


def test_tiny_buckets_and_empty_input(spark):
    df = spark.range(0, 3000).select(F.col("id"), ((F.col("id") * 7919) % 97).cast("double").alias("v"))
    q = exact_quantiles(df, "v", [0.5, 0.9]).orderBy("q_index").toPandas()
    assert np.allclose(q["quantile"], np.quantile(df.toPandas()["v"].values, [0.5, 0.9]))
    assert ordered_prefix(df.where("false"), [("id", True)], sums={"s": F.col("v")}, totals=True).count() == 0
    assert exact_quantiles(df.where("false"), "v", [0.5]).count() == 0


def test_bits_rank_as_the_doubles(spark):
    import math
    from keepwell.operators.ordered import ordered_bits
    vals = [-math.inf, -1.7e308, -3.5, -1.0, -5e-324, -0.0, 0.0, 5e-324, 2.2e-308, 1.0, 1.0000000000000002, 9e15, math.inf]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    bits = [r[0] for r in df.orderBy("i").select(ordered_bits(F.col("v"))).collect()]
    assert bits == sorted(bits) and bits[5] == bits[6] and len(set(bits)) == len(vals) - 1


def test_quantiles_of_every_kind_of_number(spark):
    rng = np.random.default_rng(5)
    columns = {"wide": rng.normal(size=300) * 10.0 ** rng.integers(-200, 200, 300), "near": 1.0 + rng.integers(0, 50, 300) * 2.0 ** -52,
               "hot": np.where(rng.random(300) < .6, 7.0, rng.normal(size=300)), "one": np.array([3.25]), "two": np.array([-1.0, 4.0])}
    rows = [(g, float(v)) for g, vs in columns.items() for v in vs] + [("wide", None), ("hot", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    probs = [0.0, 0.013, 0.25, 0.5, 0.77, 1.0]
    got = {(r["g"], r["q_index"]): r["quantile"] for r in exact_quantiles(df, "x", probs, by=["g"]).collect()}
    assert {g for g, _ in got} == set(columns) and len(got) == len(probs) * len(columns)
    for g, vs in columns.items():
        assert [got[g, i] for i in range(len(probs))] == list(np.quantile(vs, probs))


def test_quantiles_sort_no_values(spark, tmp_path):
    """Sorts in the plan are those of digits and groups; the input is a scan and is not written again."""
    spark.range(1000).select((F.col("id") % 77).cast("double").alias("x")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = exact_quantiles(df, "x", [0.5])._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert sorts and all("_d2" in line or "_d3" in line or "_d1" in line for line in sorts) and "_v#" not in "".join(
        line.split("Sort [")[1].split("]")[0] for line in sorts)
    from keepwell.scratch import settled
    assert settled(df.where("x > 3").select("x"), "t") is not None and settled(df, "t") is df
    assert settled(df.distinct(), "t") is not df
