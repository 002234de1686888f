import pytest
from pyspark.sql import functions as F

from orderflow.operators import analytics, audit, delivery, errors, new_order, stock_level
from orderflow.sources import csvfiles, jdbc, layout, logs, schemas
from orderflow.sources.versions import TableVersions
from orderflow.streaming import apply, feed, live, watch
from tests import small as S
from tests.test_reads_and_delivery import orders

AT = "2024-02-01 00:00:00"


@pytest.fixture
def db(spark):
    schemas.create_tables(spark, "shop", partitioned=True)
    yield "shop"
    schemas.drop_tables(spark, "shop")
    spark.sql("DROP DATABASE shop")


def test_tables_come_and_go(spark, db):
    rows = {"customer": S.rows(spark, "customer", S.customer(1, c_state="AB")), "item": S.rows(spark, "item", S.item(1))}
    csvfiles.insert_tables(rows, db)
    assert spark.table(f"{db}.customer").filter("c_state = 'AB'").count() == 1
    assert spark.table(f"{db}.item").first().i_name == "item1"
    with pytest.raises(Exception):
        csvfiles.insert_tables({"item": S.rows(spark, "item", S.item(2, i_name="x" * 25))}, db)
    spark.sql(f"INSERT INTO {db}.config VALUES ('warehouses', '1')")
    schemas.truncate_tables(spark, db)
    assert spark.table(f"{db}.item").count() == 0 and spark.table(f"{db}.config").count() == 1


@pytest.mark.parametrize("null", ["", "NULL"])
def test_csv_keeps_nulls_and_commas_out(spark, tmp_path, null):
    t = {n: orders(spark)[n] for n in ("oorder", "order_line")}
    csvfiles.write_csv(t, str(tmp_path), null)
    back = csvfiles.load_csv(spark, str(tmp_path), t, null)
    for n in t:
        assert back[n].exceptAll(t[n]).count() == 0 and back[n].count() == t[n].count()
    first = spark.read.text(str(tmp_path / "order.csv")).orderBy("value").first().value
    assert first == "1,1,1,2,5,2,1,2024-01-01 00:00:00.000"


def test_csv_quotes_and_rejects(spark, tmp_path):
    people = S.rows(
        spark, "customer", S.customer(1, c_data='a, b and "c"'), S.customer(2, c_data="", c_street_1=None), S.customer(3)
    )
    csvfiles.write_csv({"customer": people}, str(tmp_path))
    back = csvfiles.load_csv(spark, str(tmp_path), ["customer"])["customer"]
    assert back.exceptAll(people).count() == 0 and back.count() == 3
    (tmp_path / "new-order.csv").mkdir()
    lines = ["1,2,3", "1,x,3", "4,5", "1,2,3,4", "6,7,8", ",,", "9,9,99999999999"]
    (tmp_path / "new-order.csv" / "part.csv").write_text("\n".join(lines) + "\n")
    good, bad = csvfiles.load_csv_apart(spark, str(tmp_path), "new_order")
    assert sorted(tuple(r) for r in good.collect() if r.no_w_id) == [(1, 2, 3), (6, 7, 8)] and good.count() == 3
    assert sorted(r.line for r in bad.collect()) == ["1,2,3,4", "1,x,3", "4,5", "9,9,99999999999"]
    assert {r.file.rsplit("/", 1)[1] for r in bad.collect()} == {"part.csv"}
    assert good.select("no_d_id").count() == 3 and good.count() + bad.count() == len(lines)
    with pytest.raises(Exception):
        csvfiles.load_csv(spark, str(tmp_path), ["new_order"])["new_order"].collect()


def test_clustered_files_hold_ranges(spark, tmp_path):
    people = spark.range(1000).select(
        (F.col("id") % 10).alias("c_w_id"), F.lit(1).alias("c_d_id"), F.lit("A").alias("c_last"),
        F.col("id").cast("string").alias("c_first"),
    )
    layout.write_clustered(people, str(tmp_path / "c"), layout.BY_NAME, partitions=5)
    files = spark.read.parquet(str(tmp_path / "c")).groupBy(F.input_file_name().alias("f")).agg(
        F.min("c_w_id").alias("lo"), F.max("c_w_id").alias("hi")
    ).orderBy("lo").collect()
    assert len(files) == 5 and all(a.hi <= b.lo for a, b in zip(files, files[1:]))


def nodes(plan, upto_joins=False):
    """The operators of an executed plan, through stages that ran on their own."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return nodes(plan.executedPlan(), upto_joins)
    if "QueryStage" in name:
        return nodes(plan.plan(), upto_joins)
    if upto_joins and "Join" in name:
        return []
    under = plan.children()
    return [plan, *[n for i in range(under.size()) for n in nodes(under.apply(i), upto_joins)]]


def shuffled(plan, table):
    """Whether the scan of `table` is shuffled before it is joined, in the plan that ran."""
    moved = [n for n in nodes(plan) if n.nodeName() == "Exchange"]
    return any(f".{table}" in n.nodeName() for m in moved for n in nodes(m, upto_joins=True))


def test_layout_for_joins_and_scans(spark, tmp_path):
    # 2 districts of 1,000 orders with 2 lines each; 500 items in stock.
    t = {
        "district": S.rows(spark, "district", S.district(1, d_next_o_id=1001), S.district(2, d_next_o_id=1001)),
        "stock": spark.range(500).select(
            F.lit(1).alias("s_w_id"), F.col("id").cast("int").alias("s_i_id"), (F.col("id") % 20).cast("int").alias("s_quantity"),
            F.lit("x").alias("s_data"), *[F.concat(F.lit(f"d{n}-"), "id").alias(f"s_dist_{n:02d}") for n in range(1, 11)],
        ),
        "order_line": spark.range(4000).selectExpr(
            "1 as ol_w_id", "cast(id % 2 + 1 as int) as ol_d_id", "cast(id div 4 + 1 as int) as ol_o_id",
            "cast(id div 2 % 2 + 1 as int) as ol_number", "cast(id * 7 % 500 as int) as ol_i_id",
        ),
    }
    level = S.requests(spark, "stock_level", *[{"req_seq": n, "w_id": 1, "d_id": n, "threshold": 12} for n in (1, 2, 3)])
    # Ids wider than those of the table, one beyond them.
    asked = spark.createDataFrame(
        [(1, 1, 1, 7), (2, 1, 2, 499), (3, 2, 3, 7), (4, 1, 4, 1 << 40)],
        "req_seq bigint, d_id int, ol_number int, ol_i_id bigint",
    ).withColumn("ol_supply_w_id", F.col("d_id").cast("bigint"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    layout.save_layout(t, "laid", str(tmp_path / "laid"), buckets=4, files=10)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        saved = layout.open_layout(spark, "laid", t)
        got, want = (stock_level.stock_level(x, level) for x in (saved, t))
        assert sorted(got.collect()) == sorted(want.collect())
        plan = got._jdf.queryExecution().executedPlan()
        assert shuffled(plan, "order_line") and not shuffled(plan, "stock")
        (lines,) = [n for n in nodes(plan) if "order_line" in n.nodeName()]
        # The last twenty orders lie in one of ten files.
        assert lines.metrics().apply("numOutputRows").value() <= 2 * 4000 / 10
        got, want = (new_order.lookup_stock(asked, x["stock"]) for x in (saved, t))
        assert sorted(got.collect()) == sorted(want.collect())
        assert [(r.req_seq, r.ol_i_id, r.ol_dist_info) for r in sorted(got.collect())] == [
            (1, 7, "d1-7"), (2, 499, "d1-499"), (3, 7, None), (4, 1 << 40, None)
        ]
        plan = got._jdf.queryExecution().executedPlan()
        assert not shuffled(plan, "stock") and [n for n in nodes(plan) if n.nodeName() == "Exchange"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP DATABASE laid CASCADE")


def test_jdbc_column_types():
    assert jdbc.column_types("new_order") == "NO_W_ID INTEGER, NO_D_ID INTEGER, NO_O_ID INTEGER"
    assert "C_DATA VARCHAR(500)" in jdbc.column_types("customer")


def test_logs(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, 5, 3, 3, "NEW_ORDER", 0, 0, 0)],
        "run int, elapsed bigint, latency bigint, dblatency bigint, ttype string, rbk int, dskipped int, error int",
    )
    logs.write_log(rows, "result", str(tmp_path / "r"))
    assert logs.read_result(spark, str(tmp_path / "r")).collect() == rows.collect()


def test_machine_feed(spark, tmp_path):
    first = ["blk,1,60000,sda,1.5,0,2,0,0,0", "net,1,60000,eth0,1,2,3,4", "gpu,1,60000,9", "blk,1,60000,sdb,1"]
    second = ["blk,1,120000,sdb,7,0,2,0,0,0", "net,1,x,eth0,1,2,3,4", "", "net,1,120000,eth/1,1,2,3,"]
    inn, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()
    for at, lines in enumerate((first, second, [])):
        (tmp_path / "in" / f"{at}.txt").write_text("".join(f"{x}\n" for x in lines))
        feed.stream_os_feed(spark, inn, out, cp, interval=None).awaitTermination()
    blk = logs.read_os_metrics(spark, f"{out}/blk", "blk")
    assert [tuple(r)[:4] for r in blk.orderBy("elapsed").collect()] == [(1, 60000, "sda", 1.5), (1, 120000, "sdb", 7.0)]
    net = logs.read_os_metrics(spark, f"{out}/net", "net").orderBy("elapsed").collect()
    assert [tuple(r) for r in net] == [(1, 60000, "eth0", 1.0, 2.0, 3.0, 4.0), (1, 120000, "eth/1", 1.0, 2.0, 3.0, None)]
    assert logs.read_os_metrics(spark, f"{out}/sys_info", "sys_info").count() == 0
    bad = sorted(r.value for r in spark.read.text(f"{out}/{feed.REJECTED}").collect())
    assert bad == ["", "blk,1,60000,sdb,1", "gpu,1,60000,9", "net,1,x,eth0,1,2,3,4"]


def test_error_log(spark, tmp_path):
    found = spark.createDataFrame([(1, 9999, "no row"), (2, 1062, "twice")], "req_seq bigint, code int, message string")
    assert {r.error_class for r in errors.classify_errors(found, []).collect()} == {"UNEXPECTED"}
    classed = errors.classify_errors(found, ["9999"])
    assert [r.error_class for r in classed.orderBy("req_seq").collect()] == ["EXPECTED", "UNEXPECTED"]
    errors.log_lines(classed, "TT_PAYMENT").write.text(str(tmp_path / "bad"))
    errors.log_lines(classed.filter("code = 9999"), "TT_PAYMENT").write.text(str(tmp_path / "good"))
    assert not errors.verify_log(spark, str(tmp_path / "bad"))
    assert errors.verify_log(spark, str(tmp_path / "good"))


def test_versions(spark, tmp_path):
    v = TableVersions(spark, str(tmp_path))
    one, two = spark.range(1), spark.range(2)
    v.write(0, {"a": one, "b": one})
    v.stage(1, {"a": two})
    assert v.read(["a"])["a"].count() == 1
    v.finish(1)
    assert v.read(["a", "b"])["a"].count() == 2 and v.read(["a"], before=1)["a"].count() == 1
    v.write(1, {"a": spark.range(9)})
    assert v.read(["a"])["a"].count() == 2 and v.complete() == [1, 0]
    with pytest.raises(FileNotFoundError):
        v.read(["c"])


def test_queue_applies_each_request_once(spark, tmp_path):
    root, queue, cp = (str(tmp_path / n) for n in ("tables", "queue", "cp"))
    v = TableVersions(spark, f"{root}/batches")
    start = orders(spark)
    laid = apply.start_tables(spark, root, start)
    req = S.requests(spark, "delivery", *[{"req_seq": n, "w_id": 1, "o_carrier_id": n} for n in (1, 2, 3)])
    answer = apply.enqueue_deliveries(req.filter("req_seq < 3"), queue, AT)
    assert {r.execution_status for r in answer.collect()} == {"Delivery has been queued"}
    apply.drain_deliveries(spark, queue, root, cp, AT).awaitTermination()
    apply.enqueue_deliveries(req.filter("req_seq = 3"), queue, AT)
    apply.drain_deliveries(spark, queue, root, cp, AT).awaitTermination()
    # A second look at the same queue with a new checkpoint finds its versions complete.
    apply.drain_deliveries(spark, queue, root, str(tmp_path / "cp2"), AT).awaitTermination()
    whole = delivery.delivery(start, req, AT)
    got = {r.req_seq: r.delivered_o_id for r in v.results("result_delivery").collect()}
    assert got == {r.req_seq: r.delivered_o_id for r in whole.result.collect()}
    for name in apply.REWRITTEN | {"customer"}:
        now = laid.read([name])[name]
        assert now.exceptAll(whole.tables[name].select(now.columns)).count() == 0
        assert now.count() == whole.tables[name].count()


def test_new_checkpoints_lose_and_repeat_nothing(spark, tmp_path):
    root, queue = str(tmp_path / "tables"), str(tmp_path / "queue")
    v = TableVersions(spark, f"{root}/batches")
    apply.start_tables(spark, root, orders(spark))
    for n in (1, 2):
        req = S.requests(spark, "delivery", {"req_seq": n, "w_id": 1, "o_carrier_id": n})
        apply.enqueue_deliveries(req, queue, AT)
        apply.drain_deliveries(spark, queue, root, str(tmp_path / f"cp{n}"), AT).awaitTermination()
    assert sorted(r.req_seq for r in v.results("result_delivery").collect()) == [1, 2]
    assert v.complete() == [1, 0]


def test_unknown_request_types_are_errors(spark):
    types = ["NEW_ORDER", "PAYMENT", "DELIVERY", "ORDER_STATUS", "STOCK_LEVEL", "NONE", "DONE", None]
    batch = spark.createDataFrame(list(enumerate(types)), "req_seq bigint, ttype string")
    assert {r.req_seq for r in apply.unknown_types(batch).collect()} == {5, 6, 7}


def test_append_mode_holds_back_the_open_window(spark, tmp_path):
    rows = [(1, m * 60_000, 10 * m, 10 * m, "NEW_ORDER" if m % 2 else "DELIVERY_BG", 0, 0, 0) for m in range(300)]
    log = spark.createDataFrame(
        rows,
        "run int, elapsed bigint, latency bigint, dblatency bigint, ttype string, rbk int, dskipped int, error int",
    )
    logs.write_log(log, "result", str(tmp_path / "in"))
    timed = live.with_time(live.read_result_stream(spark, str(tmp_path / "in")), "2024-01-01")
    live.run_available(live.stream_tpm(timed), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = live.stream_tpm(live.with_time(log, "2024-01-01"))
    # The last row is at 299 minutes, so windows ending by 239 minutes are out.
    assert got.count() == 23
    assert got.exceptAll(batch).count() == 0


def files_of(root):
    return {str(p.relative_to(root)) for p in root.rglob("*.parquet")}


def test_a_batch_leaves_other_warehouses_alone(spark, tmp_path):
    start = orders(spark)
    far = {"oorder": "o_w_id", "order_line": "ol_w_id", "new_order": "no_w_id", "customer": "c_w_id"}
    start = {n: df.unionByName(df.withColumn(far[n], F.lit(2))) for n, df in start.items()}
    laid = apply.start_tables(spark, str(tmp_path / "t"), start)
    data = tmp_path / "t" / "tables" / "data"
    before = files_of(data)
    req = S.requests(spark, "delivery", {"req_seq": 1, "w_id": 1, "o_carrier_id": 3})
    apply.enqueue_deliveries(req, str(tmp_path / "queue"), AT)
    apply.drain_deliveries(spark, str(tmp_path / "queue"), str(tmp_path / "t"), str(tmp_path / "cp"), AT).awaitTermination()
    after = files_of(data)
    assert {f for f in before if "x_part=2" in f} == {f for f in after if "x_part=2" in f}
    assert not {f for f in before if "x_part=1/" in f} & after
    whole = delivery.delivery(start, req, AT).tables
    for name in far:
        now = laid.read([name])[name]
        assert now.exceptAll(whole[name].select(now.columns)).count() == 0 and now.count() == whole[name].count()


def test_a_batch_staged_whole_is_installed_once(spark, tmp_path):
    """A driver lost between staging and installing, or while installing: the next batch catches up."""
    start = orders(spark)
    root = str(tmp_path / "t")
    laid = apply.start_tables(spark, root, start)
    versions = TableVersions(spark, f"{root}/batches")
    req = S.requests(spark, "delivery", *[{"req_seq": n, "w_id": 1, "o_carrier_id": n} for n in (1, 2, 3)])
    tables = laid.open(start, [1])
    done = delivery.delivery(tables, req, AT)
    laid.stage(versions, 0, done.tables, tables, apply.REWRITTEN)
    rows = [(n, n in apply.REWRITTEN, [1]) for n in start]
    versions.stage(0, {"replaced": spark.createDataFrame(rows, "name string, rewritten boolean, parts array<int>")})
    assert laid.read(["new_order"])["new_order"].count() == 5
    laid.recover(versions)
    assert laid.read(["new_order"])["new_order"].count() == 5  # staged, but not marked whole
    versions.finish(0)
    laid.replace("oorder", spark.read.parquet(f"{root}/batches/v=0/table_oorder"))  # as far as the driver came
    laid.recover(versions)
    laid.recover(versions)
    # All pending orders are gone, and with them the last folder.
    assert laid.read(["new_order"])["new_order"].count() == 0
    for name in ("oorder", "order_line", "customer"):
        now = laid.read([name])[name]
        assert now.count() == start[name].count()
        assert now.exceptAll(delivery.delivery(start, req, AT).tables[name].select(now.columns)).count() == 0


def test_installing_a_batch_moves_its_files_and_writes_no_row_again(spark, tmp_path):
    start = orders(spark)
    root = tmp_path / "t"
    laid = apply.start_tables(spark, str(root), start)
    versions = TableVersions(spark, f"{root}/batches")
    req = S.requests(spark, "delivery", {"req_seq": 1, "w_id": 1, "o_carrier_id": 3})
    tables = laid.open(start, [1])
    done = delivery.delivery(tables, req, AT)
    wanted = {n: df.collect() for n, df in laid.stage(versions, 0, done.tables, tables, apply.REWRITTEN).items()}
    staged = {p.name for p in (root / "batches").rglob("part-*.parquet")}
    rows = [(n, n in apply.REWRITTEN, [1]) for n in start]
    versions.stage(0, {"replaced": spark.createDataFrame(rows, "name string, rewritten boolean, parts array<int>")})
    versions.finish(0)
    # As far as a driver came that was lost while it moved folders.
    folder = next((root / "batches" / "v=0" / "table_customer").glob("x_part=*/x_batch=*"))
    target = root / "tables" / "data" / "customer" / folder.relative_to(root / "batches" / "v=0" / "table_customer")
    laid._move(versions.files(), versions, versions.path("v=0", "table_customer"), f"{root}/tables/data/customer")
    assert target.exists() and not folder.exists()
    laid.recover(versions)
    found = {p.name for p in (root / "tables" / "data").rglob("part-*.parquet")}
    assert staged and staged <= found
    for name, df in laid.open(start).items():
        assert sorted(map(repr, df.select(*wanted[name][0].__fields__).collect())) == sorted(map(repr, wanted[name]))


def test_live_rates_of_two_runs(spark, tmp_path):
    schema = "run int, elapsed bigint, latency bigint, dblatency bigint, ttype string, rbk int, dskipped int, error int"
    rows = [(1 + n % 2, (n * 7919) % 60_000, 5, 5, "NEW_ORDER" if n % 3 else "PAYMENT", 0, 0, 0) for n in range(900)]
    rows += [(1, 5, 1, 1, "DELIVERY_BG", 0, 0, 0)]
    for at in range(3):  # later files hold rows of earlier seconds
        part = spark.createDataFrame(rows[at::3], schema)
        logs.write_log(part.coalesce(1), "result", str(tmp_path / "in"))
        stream = live.read_result_stream(spark, str(tmp_path / "in"))
        query = live.stream_rates(stream, str(tmp_path / "out"), str(tmp_path / "cp"), interval=None)
        query.awaitTermination()
        got = live.last_batch(spark, str(tmp_path / "out"), query)
        known = [r for k in range(at + 1) for r in rows[k::3]]
        want = analytics.running_tpm(spark.createDataFrame(known, schema))
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_later_looks_read_only_what_changed(spark, tmp_path):
    from orderflow.operators.generate import generate

    tables = {n: df for n, df in generate(spark, 1, seed=3).items() if n in watch.NEEDED}
    versions = TableVersions(spark, str(tmp_path / "t"))
    versions.write(0, tables)
    versions.write(1, {"stock": tables["stock"].union(tables["stock"].filter("s_i_id % 9999 = 0"))})
    versions.write(2, {"oorder": tables["oorder"].filter("o_id <> 77")})
    for version in (0, 1, 2):
        facts = watch.facts_of(versions, version, str(tmp_path / "f"))
        want = audit.run_checks(versions.read(watch.NEEDED, before=version + 1), True)
        found = audit.judge_facts(facts, True)
        assert found.exceptAll(want).count() == 0 and found.count() == want.count()
        assert (found.count() > 0) == (version > 0)
    kept = TableVersions(spark, str(tmp_path / "f"))
    held = {n for n in watch.NEEDED for v in (1, 2) if kept.holds(f"v={v}", n)}
    assert held == {"stock", "oorder"}


def test_stock_is_made_in_as_many_tasks_as_a_shuffle_has(spark, tmp_path):
    from orderflow.sources.bridge import Bridge

    spark.range(20).selectExpr("id as p_partkey").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    stock = Bridge(spark, str(tmp_path)).stock()
    assert stock.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert stock.count() == 100


def test_a_table_is_computed_once_to_be_laid_out(spark, tmp_path):
    import uuid

    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def told(d):
        seen.add(1)
        return d

    district = S.rows(spark, "district", *[S.district(d) for d in range(1, 6)])
    db = f"once_{uuid.uuid4().hex}"
    layout.save_layout({"district": district.withColumn("d_id", told.asNondeterministic()("d_id"))}, db, str(tmp_path / "db"))
    assert seen.value == 5
    assert layout.open_layout(spark, db, ["district"])["district"].count() == 5
    spark.sql(f"DROP DATABASE {db} CASCADE")
