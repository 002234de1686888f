import pytest
from pyspark.sql import functions as F

from orderflow.functions import values as V
from orderflow.operators import audit, config, generate, requests


@pytest.fixture(scope="module")
def tables(spark):
    return generate.generate(spark, 1, seed=3, c_last=100)


def test_sizes(tables):
    want = {"item": 100_000, "warehouse": 1, "district": 10, "stock": 100_000, "customer": 30_000,
            "history": 30_000, "oorder": 30_000, "new_order": 9_000, "config": 4}
    assert {n: tables[n].count() for n in want} == want


def test_sound_after_load(tables):
    assert audit.passed(tables, optional=True)


def test_faults_are_found(tables):
    broken = {**tables, "new_order": tables["new_order"].filter("not (no_d_id = 4 and no_o_id = 2500)")}
    found = {r.check_id for r in audit.run_checks(broken).collect()}
    assert found == {"no_gaps"}
    broken = {**tables, "warehouse": tables["warehouse"].withColumn("w_ytd", F.col("w_ytd") + 1)}
    assert {r.check_id for r in audit.run_checks(broken).collect()} == {"ytd_forward", "ytd_reverse"}
    assert not audit.passed(broken)


def test_customers_are_permuted(tables):
    per = tables["oorder"].groupBy("o_d_id").agg(
        F.countDistinct("o_c_id").alias("n"),
        F.min("o_c_id").alias("lo"),
        F.max("o_c_id").alias("hi"),
        F.corr("o_id", "o_c_id").alias("r"),
    )
    for row in per.collect():
        assert (row.n, row.lo, row.hi) == (3000, 1, 3000) and abs(row.r) < 0.08


def test_partitions_do_not_matter(spark):
    ids = generate.row_ids(spark, "customer", 1).filter("id < 500")
    one = generate.gen_customer(ids.coalesce(1)).exceptAll(generate.gen_customer(ids.repartition(7)))
    assert one.count() == 0


def test_text_shapes(spark, tables):
    c = tables["customer"].filter("c_id <= 200")
    assert c.filter(~F.col("c_first").rlike("^[A-Za-z][A-Za-z0-9]{7,15}$")).count() == 0
    assert c.filter(~F.col("c_data").rlike("^[A-Za-z][A-Za-z0-9]{299,499}$")).count() == 0
    assert c.filter(~F.col("c_zip").rlike("^[0-9]{4}11111$")).count() == 0
    assert c.filter(~F.col("c_phone").rlike("^[0-9]{16}$")).count() == 0
    assert c.filter("c_id = 1").first().c_last == "BARBARBAR"
    data = tables["item"].select("i_data").limit(20_000)
    lengths = data.agg(F.min(F.length("i_data")), F.max(F.length("i_data"))).first()
    assert tuple(lengths) == (26, 50)
    marked = data.filter(F.col("i_data").contains(V.MARK)).count()
    assert 1_800 < marked < 2_200


def test_letters_are_even(spark):
    text = spark.range(20_000).select(V.a_string(24, 24, "t", F.col("id")).alias("s"))
    counts = text.select(F.explode(F.split(F.substring("s", 2, 23), "")).alias("c")).groupBy("c").count()
    seen = {r.c: r["count"] for r in counts.collect() if r.c}
    mean = 20_000 * 23 / 62
    assert len(seen) == 62 and all(abs(n - mean) < 0.1 * mean for n in seen.values())


def test_last_name_constants():
    V.check_last_name_constants(100, 180)
    for run in (100, 164, 220, 196, 212):
        with pytest.raises(ValueError):
            V.check_last_name_constants(100, run)


def test_config(tables):
    assert config.get_config(tables["config"], "warehouses") == "1"
    with pytest.raises(KeyError):
        config.get_config(tables["config"], "nothing")


def test_mix(spark):
    ids = spark.range(40_000).withColumnRenamed("id", "req_seq")
    mix = requests.gen_requests(ids, 7, {"PAYMENT": 43, "STOCK_LEVEL": 4, "ORDER_STATUS": 4, "DELIVERY": 4})
    share = {r.ttype: r["count"] / 40_000 for r in mix.groupBy("ttype").count().collect()}
    for name, want in (("NEW_ORDER", 0.45), ("PAYMENT", 0.43), ("DELIVERY", 0.04)):
        assert abs(share[name] - want) < 0.01
    for bad in ({"PAYMENT": -1}, {"PAYMENT": 0}, {"PAYMENT": 60, "DELIVERY": 60}):
        with pytest.raises(ValueError):
            requests.gen_requests(ids, 7, bad)


def test_homes(spark):
    homes = requests.gen_homes(requests.all_places(spark, 3), 12).collect()
    assert len({(r.w_id, r.d_id) for r in homes}) == 12 == len(homes)
    assert sorted(r.terminal for r in homes) == list(range(1, 13))
    ids = spark.range(100).withColumnRenamed("id", "req_seq")
    dealt = requests.gen_requests(
        ids, 3, homes=requests.gen_homes(requests.all_places(spark, 3), 12), terminals=12
    )
    assert {(r.w_id, r.home_d_id) for r in dealt.collect()} == {(r.w_id, r.d_id) for r in homes}


def test_payment_requests(spark):
    ids = spark.range(4_000).withColumnRenamed("id", "req_seq")
    pay = requests.gen_payment_req(requests.gen_requests(ids, 4), 4, 5, 6)
    far = pay.filter("c_w_id <> w_id").count()
    assert 500 < far < 700
    assert pay.filter("(c_id is null) = (c_last is null)").count() == 0
    alone = requests.gen_payment_req(requests.gen_requests(ids, 1), 1, 5, 6)
    assert alone.filter("c_w_id <> 1").count() == 0
