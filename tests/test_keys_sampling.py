"""Dense ids, composite ids and stable sampling (FIXTURES.md F6)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from citeweave.functions.keys import mention_id, unit_hash
from citeweave.operators import sampling
from citeweave.operators.keys import dense_ids


def test_mention_id_format(spark):
    df = spark.createDataFrame([(42, "pdf", 7)], "p long, t string, i int")
    assert df.select(mention_id("p", "t", "i")).first()[0] == "        42.pdf.00007"


def test_dense_ids_equal_row_number_for_any_partitioning(spark):
    base = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("u"),
                                    F.col("id").alias("k"))
    want = {r.k: r.rn for r in base.select(
        "k", F.row_number().over(Window.orderBy("u", "k")).alias("rn")).collect()}
    for parts in (1, 4, 16):
        got = {r.k: r.pid for r in dense_ids(base.repartition(parts), ["u", "k"], "pid",
                                             num_partitions=parts + 3).collect()}
        assert got == want


def test_dense_ids_skewed_leading_key(spark):
    # a third of the rows share the leading key: ids stay dense and unique
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("aa"))
                                  .otherwise(F.col("id").cast("string")).alias("b"),
                                  F.col("id").alias("k"))
    ids = sorted(r.i for r in dense_ids(df, ["b", "k"], "i", num_partitions=8).collect())
    assert ids == list(range(1, 3001))


def test_samples_disjoint_eligible_and_stable(spark):
    papers = spark.range(20000).select(F.col("id").alias("paper_id"),
                                       (F.col("id") % 4 != 0).alias("has_mentions"))
    a = {r.paper_id: r.sample for r in
         sampling.assign_samples(papers, "paper_id", 7, (0.1, 0.2)).collect()}
    b = {r.paper_id: r.sample for r in
         sampling.assign_samples(papers.repartition(13), "paper_id", 7, (0.1, 0.2)).collect()}
    assert a == b                                          # independent of partitioning
    assert all(k % 4 != 0 for k in a)                      # only eligible papers
    n0 = sum(1 for s in a.values() if s == 0)
    n1 = sum(1 for s in a.values() if s == 1)
    assert 1200 < n0 < 1800 and 2600 < n1 < 3400           # 10 % and 20 % of 15,000
    u = {r.paper_id: r.u for r in papers.select("paper_id", unit_hash(7, "paper_id")
                                                .alias("u")).collect()}
    assert all((u[k] < 0.1) == (s == 0) and u[k] < 0.3 for k, s in a.items())
    children = spark.range(40000).select((F.col("id") % 20000).alias("paper_id"))
    routed = sampling.route_children(children, "paper_id", 7, (0.1, 0.2),
                                     eligible_parents=papers.where("has_mentions"))
    assert {(r.paper_id, r.sample) for r in routed.collect()} == set(a.items())


def test_thresholds_validated():
    assert sampling.cumulative_thresholds([0.01, 0.05])[1 ] == 0.01 + 0.05
    for bad in ([0.5, 0.6], [0.0], []):
        try:
            sampling.cumulative_thresholds(bad)
        except ValueError:
            continue
        raise AssertionError(bad)


def test_null_values_preserved_in_samples(spark):
    papers = spark.createDataFrame([(i, None, True) for i in range(2000)],
                                   "paper_id long, title string, has_mentions boolean")
    got = sampling.assign_samples(papers, "paper_id", 1, (0.5,)).collect()
    assert got and all(r.title is None for r in got)


def test_dense_ids_with_payload_and_without_exchange_reuse(spark):
    rows = spark.range(20000).select(F.md5(F.col("id").cast("string")).alias("u"),
                                     F.repeat(F.col("id").cast("string"), 5).alias("payload"))
    want = {r.u: r.rn for r in rows.select("u", F.row_number().over(Window.orderBy("u"))
                                           .alias("rn")).collect()}
    before = spark.conf.get("spark.sql.exchange.reuse")
    try:
        for reuse in ("true", "false"):
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            for n in (1, 3, 7):
                got = dense_ids(rows, ["u"], num_partitions=n).collect()
                assert len(got) == 20000 and all(
                    want[r.u] == r.paper_id and r.payload for r in got)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)


def test_lookup_keeps_the_last_of_repeated_keys(spark):
    from citeweave.operators import tables

    mapping = spark.createDataFrame([("u", 1), ("u", 2), ("v", 3)], "k string, id long")
    probe = spark.createDataFrame([("u",), ("v",)], "k string")
    got = tables.strict_lookup(probe, mapping, "k", "id").collect()
    assert sorted(tuple(r) for r in got) == [("u", 2), ("v", 3)]
    assert [tuple(r) for r in tables.repeated_keys(mapping, "k").collect()] == [("u", 2)]
