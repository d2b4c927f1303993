"""Sources, sinks, runs, access and retrieval: the corners that the base tables do not reach."""

import json
import uuid
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import records as M
from tallyloom.functions import text as T
from tallyloom.operators import relational as R
from tallyloom.operators import scd, search
from tallyloom.plans import access
from tallyloom.plans.filters import RESERVED, FilterError, compile_filter
from tallyloom.session import Files, shared_folder
from tallyloom.sources import sinks, vendor
from tallyloom.sources.contract import Unavailable
from tallyloom.streaming import ingest, runner


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_stable_ids_are_version_five(spark):
    df = spark.createDataFrame([("a",), ("é 1",), (None,)], "x string")
    got = [r[0] for r in df.select(M.stable_uuid(F.col("x"))).collect()]
    assert got == [str(uuid.uuid5(M.NAMESPACE, "a")), str(uuid.uuid5(M.NAMESPACE, "é 1")), None]


def test_epochs_and_noise(spark):
    df = spark.createDataFrame([("1704067200",), ("1704067200000",), ("2024-01-01T00:00:00Z",), ("-1",), ("soon",), (None,), ("",)], "x string")
    got = [r[0] for r in df.select(F.unix_seconds(M.epoch_time(F.col("x")))).collect()]
    assert got == [1704067200, 1704067200, 1704067200, -1, None, None, None]


def test_records_lose_nothing_in_the_split(spark):
    df = spark.createDataFrame([(1, '{"a":1,"b":"x","c":{"d":[1,2]}}'), (2, '{"a":"no number","z":null}'), (3, "no json"), (4, None)], "k int, r string")
    got = rows(M.split_record(df, "r", {"a": "bigint", "b": "string"}, keep=["k"]), "k")
    assert got == [(1, 1, "x", '{"c":{"d":[1,2]}}'), (2, None, None, '{"a":"no number","z":null}'), (3, None, None, None), (4, None, None, None)]


def test_merged_json_keeps_types_and_refuses_what_is_no_object(spark):
    df = spark.createDataFrame([('{"a":1,"b":{"c":2}}', '{"d":true,"a":"x"}'), ("no json", '{"a":1}'), ("[1]", "{}"), (None, '{"a":null}'), (None, None)], "l string, r string")
    assert [r[0] for r in df.select(T.merge_json(F.col("l"), F.col("r"))).collect()] == ['{"a":"x","b":{"c":2},"d":true}', None, None, '{"a":null}', "{}"]
    one = spark.createDataFrame([('{"b": {"z":1, "y": [1, 2.50]}, "a": "1"}',), ("x",)], "j string")
    assert [r[0] for r in one.select(T.canonical_json(F.col("j"))).collect()] == ['{"a":"1","b":{"y":[1,2.5],"z":1}}', None]


def test_referrals(spark):
    df = spark.createDataFrame([(x,) for x in ("North-Star", " north star ", "NS", "n/a", "", None, "In House", "zzz")], "x string")
    partner, reason = M.referral(F.col("x"), {"northstar": ["north star", "ns"]}, houses=["in house"])
    got = [tuple(r) for r in df.select(partner, reason).collect()]
    assert got == [("northstar", None)] * 3 + [(None, "no referral")] * 3 + [(None, "own house"), (None, "unknown tag")]


def test_enums(spark):
    value, rejected = M.coerce(F.col("x"), ["open", "closed"], {"done": "closed"})
    df = spark.createDataFrame([(" Open ",), ("DONE",), ("maybe",), ("",), (None,)], "x string")
    assert [tuple(r) for r in df.select(value, rejected).collect()] == [("open", False), ("closed", False), (None, True), (None, False), (None, False)]


# ---------------------------------------------------------------- as-of, rates, allocation, merge


def test_as_of_over_many_months_and_null_keys(spark):
    t = lambda m, d=1, y=2024: datetime(y, m, d, tzinfo=timezone.utc)
    left = spark.createDataFrame([("a", t(1)), ("a", t(3, 15)), ("a", t(12)), ("b", t(6)), (None, t(6)), ("a", None), ("a", t(1, 1, 2030))], "k string, at timestamp")
    right = spark.createDataFrame([("a", t(1, 2), 1), ("a", t(3, 15), 2), ("a", t(3, 20), 3), ("a", t(5), None), (None, t(1), 9), ("b", t(7), 7)], "k string, since timestamp, v int")
    got = R.as_of_join(left, right, ["k"], "at", "since", ["v", "since"]).select("k", "at", "v", F.month("since").alias("m"))
    want = {("a", t(1)): (None, None), ("a", t(3, 15)): (2, 3), ("a", t(12)): (None, 5), ("b", t(6)): (None, None), (None, t(6)): (None, None), ("a", None): (None, None), ("a", t(1, 1, 2030)): (None, 5)}
    assert {(r.k, r["at"].replace(tzinfo=timezone.utc) if r["at"] else None): (r.v, r.m) for r in got.collect()} == want


def test_allocation_in_cents(spark):
    parts = spark.createDataFrame([(1, "x", 0.1), (1, "y", 0.2), (1, "z", 0.3), (2, "x", 0.0)], "inv int, cell string, gross double")
    totals = spark.createDataFrame([(1, 0.05), (2, 1.0)], "inv int, refund double")
    assert [(c, float(a)) for c, a in rows(R.allocate(parts, totals, "inv", "gross", "refund").select("cell", "allocated"), "cell")] == [("x", 0.01), ("y", 0.02), ("z", 0.03)]


def test_rates_of_null_keys_stay(spark):
    rates = spark.createDataFrame([(None, 0.05, 1, None), ("p", 0.1, 1, None)], "party string, rate double, valid_from int, valid_to int")
    got = scd.set_rate(rates, {"party": "p"}, 0.3, F.lit(5))
    assert rows(got, "party", "valid_from") == [(None, 0.05, 1, None), ("p", 0.1, 1, 5), ("p", 0.3, 5, None)]


def test_drift_is_an_error_and_silent_columns_are_no_change(spark):
    now = spark.createDataFrame([(1, "a", 5, 1)], "id int, name string, seq int, refreshed_at long")
    with pytest.raises(ValueError, match="extra"):
        scd.merge(now, spark.createDataFrame([(1, "a", 1)], "id int, name string, extra int"), ["id"], F.lit(2).cast("long"))
    m = scd.merge(now, spark.createDataFrame([(1, "a", 9)], "id int, name string, seq int"), ["id"], F.lit(2).cast("long"), silent=["seq"])
    assert m.history.count() == 0 and rows(m.current, "id") == [(1, "a", 9, 2)]


# ---------------------------------------------------------------- streams and runs


def test_the_sink_goes_on_after_a_restart_and_late_rows_change_nothing(spark):
    start = spark.createDataFrame([], "k int, v string, seq int, refreshed_at long")
    path = shared_folder(spark, "sink")
    make = lambda: ingest.ScdSink(spark, path, ["k"], ["seq"], start, buckets=4)
    batch = lambda *x: spark.createDataFrame(list(x), "k int, v string, seq int")
    make()(batch((1, "a", 1), (1, "b", 2), (2, "x", 1)), 0)
    assert rows(make().current().select("k", "v", "seq"), "k") == [(1, "b", 2), (2, "x", 1)]
    make()(batch((1, "old", 1), (3, "n", 1)), 1)  # row 1 is late
    make()(batch((2, "y", 5)), 2)
    make()(batch((2, "y", 5)), 2)  # the same batch once more
    sink = make()
    assert rows(sink.current().select("k", "v", "seq"), "k") == [(1, "b", 2), (2, "y", 5), (3, "n", 1)]
    assert rows(sink.history().select("k", "v"), "k") == [(2, "x")]
    make()(batch(), 3)
    assert rows(make().current().select("k", "v"), "k") == [(1, "b"), (2, "y"), (3, "n")]
    assert len(Files(spark, path).names("current")) <= 4


def test_one_run_at_a_time(spark):
    root = shared_folder(spark, "locks")
    with runner.exclusive(spark, root, "t", "desk"):
        with pytest.raises(runner.Busy):
            with runner.exclusive(spark, root, "t", "desk"):
                pass
        with runner.exclusive(spark, root, "t", "crm"):
            pass
        with runner.exclusive(spark, root, "t", "desk", clock=lambda: 1e12):  # the first one's lock is stale by then
            pass
    with runner.exclusive(spark, root, "t", "desk"):
        pass


def test_a_run_stops_after_three_failures_in_a_row_and_retries_what_is_busy(spark):
    table, calls = runner.RunTable(spark, shared_folder(spark, "runs")), []
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")

    def put(batch, k):
        calls.append(k)
        if k in (1, 2, 3):
            raise ValueError("broken")
        if k == 0 and calls.count(0) < 3:
            raise Unavailable(429)
        return {"seen": batch.count(), "created": 1}

    bad = []
    run = runner.run(table, "t", "desk", [df] * 6, put, {"v": F.col("v").isNotNull()}, lambda b, k: bad.append(rows(b.select("k", "faults"), "k")), sleep=lambda _: None)
    assert (run.status, run.seen, run.rejected, run.failed_batches, calls) == ("partial", 1, 1, 3, [0, 0, 0, 1, 2, 3])
    assert bad == [[(2, ["v"])]] and run.error == "ValueError: broken"
    assert table.last_success("t", "desk").first()["since"] is None
    good = runner.run(table, "t", "desk", [df], lambda b, k: {"updated": 2})
    assert good.status == "success" and abs(table.last_success("t", "desk").first()["since"] - good.started) < 1e-6
    assert rows(table.read().select("status", "updated"), "status") == [("partial", 0), ("success", 2)]


def test_metadata_faults_are_fatal(spark):
    df = spark.createDataFrame([("t", "2024-01-01T00:00:00Z", "some text"), (" ", "2024-01-01T00:00:00Z", "x")], "tenant string, at string, text string")
    meta = lambda at: F.struct(F.col("tenant").alias("tenant_id"), F.lit(1).alias("source_id"), F.lit("k").alias("kind"), F.lit("t").alias("title"), at.alias("updated_at"))
    texts = F.array(F.struct(F.lit(0).alias("part"), F.col("text").alias("text")))
    assert runner.knowledge_texts(df.where("tenant = 't'"), texts, meta(F.col("at"))).select("text").first()[0] == "some text"
    for bad in (runner.knowledge_texts(df, texts, meta(F.col("at"))), runner.knowledge_texts(df.where("tenant = 't'"), texts, meta(F.lit("2024-01-01T00:00:00")))):
        with pytest.raises(Exception, match="incomplete"):
            bad.select("text").collect()


def test_a_stream_of_objects_goes_on_inside_a_page():
    store = [{"id": i} for i in range(4)]

    def transport(kind, after):
        at = int(after or 0)
        return {"results": store[at : at + 3]} | ({"after": str(at + 3)} if at + 3 < len(store) else {})

    stream = vendor.ObjectStream(transport, ["x"])
    read = lambda a, b: [r[1] for p in stream.partitions(a, b) for r in stream.read(p)]
    first = stream.latestOffset()
    assert read(stream.initialOffset(), first) == ["0", "1", "2", "3"]
    store.extend({"id": i} for i in range(4, 9))
    second = stream.latestOffset()
    assert read(first, second) == ["4", "5", "6", "7", "8"] and read(stream.initialOffset(), first) == ["0", "1", "2", "3"]
    assert read(second, stream.latestOffset()) == []


def test_pages_by_time():
    asked = []

    def transport(kind, since):
        asked.append(since)
        rows = [t for t in (1, 1, 1, 2, 5) if t >= since][:3]
        return {"results": rows, "end_time": rows[-1] if rows else since}

    assert [len(p) for p in vendor.time_pages(transport, "x", 0, 3)] == [3, 3, 2] or asked[:2] == [0, 1]
    assert asked[-1] > 1


def test_shapes_and_discovery(spark):
    raw = spark.createDataFrame([("charge", "c1", json.dumps({"amount": 1234, "customer": "u", "paid": True, "created": 1704067200})), ("charge", "c2", json.dumps({"amount": "x"}))], "object string, id string, record string")
    got = rows(vendor.shaped(raw, "charge").select("id", F.col("amount").cast("string"), "customer", "paid", F.unix_seconds("created")), "id")
    assert got == [("c1", "12.34", "u", True, 1704067200), ("c2", None, None, None, None)]
    assert rows(vendor.discovered(raw, ["fixed"]), "object", "property")[0] == ("*", "fixed", 0)


# ---------------------------------------------------------------- sinks, access, retrieval


def test_an_append_only_table_cannot_be_changed(spark):
    table = sinks.AppendOnly(spark, shared_folder(spark, "log"), "k int")
    assert table.read().count() == 0
    assert table.append(spark.range(3).select(F.col("id").cast("int").alias("k")), "a") and not table.append(spark.range(9).select(F.col("id").cast("int").alias("k")), "a")
    assert table.read().count() == 3
    for forbidden in (table.overwrite, table.update, table.delete):
        with pytest.raises(PermissionError):
            forbidden()


def test_a_flag_once_set_stays(spark):
    was = spark.createDataFrame([("a", "t", True), ("b", "t", False)], "name string, kind string, is_custom boolean")
    seen = spark.createDataFrame([("a", "u", False), ("c", "t", True)], "name string, kind string, is_custom boolean")
    assert rows(sinks.upsert_registry(was, seen, ["name"]), "name") == [("a", "u", True), ("b", "t", False), ("c", "t", True)]


def test_reports(spark):
    df = spark.createDataFrame([(1, 'a|"b",c'), (2, None)], "k int, v string").orderBy("k")
    assert sinks.report(df, "T").splitlines() == ["# T", "", "2 rows", "", "| k | v |", "|-|-|", '| 1 | a\\|"b",c |', "| 2 |  |"]
    assert sinks.report(df, "T", "csv") == 'k,v\n1,"a|""b"",c"\n2,\n'
    with pytest.raises(ValueError):
        sinks.report(spark.range(sinks.MOST_ROWS + 1), "T")


def test_vectors_go_out_by_namespace_and_failures_are_counted(spark):
    df = spark.createDataFrame([(i, [1.0], "A b", "c" if i % 2 else None) for i in range(5)], "vec_id long, embedding array<double>, t string, c string")

    def put(name, some):
        if name.endswith("__c"):
            raise ConnectionError

    got = rows(sinks.write_vectors(df, put, "t", "c"), "namespace")
    assert got == [("vec__a-b___tenant", 3, 0), ("vec__a-b__c", 0, 2)]


def test_roles(spark):
    tables = {"brand": spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k int, name string, data string")}
    gate = access.Gate(tables, {"lens_brand": lambda t: t["brand"].select("k", "name")})
    reader = access.Role("reader").grant("lens_brand").grant_update("brand", "data")
    assert gate.select(reader, "lens_brand").columns == ["k", "name"]
    for name in ("brand", "lens_other"):
        with pytest.raises(PermissionError):
            gate.select(reader, name)
    with pytest.raises(PermissionError):
        gate.select(access.Role("nobody"), "lens_brand")
    with pytest.raises(PermissionError):
        gate.update(reader, "brand", F.lit(True), {"data": F.lit("y"), "name": F.lit("z")})
    assert rows(gate.update(reader, "brand", F.col("data").isNull(), {"data": F.lit("y")}), "k") == [(1, "a", "x"), (2, "b", "y")]


def test_reserved_names_and_the_lint():
    assert len(RESERVED) == 21
    for name in RESERVED:
        with pytest.raises(FilterError):
            compile_filter({name: 1}, {name})
    assert access.lint_joins("SELECT 1 FROM a JOIN deals_legacy d ON a.k = d.k") and access.lint_joins("SELECT * FROM a JOIN b ON 1 = 1")
    assert not access.lint_joins("SELECT 'join x_legacy' FROM a JOIN b ON a.k = b.k -- join y_legacy")


def test_embedding_in_order_with_a_retry(spark):
    df = spark.createDataFrame([(i, f"word{i} again" if i % 3 else None) for i in range(10)], "i int, x string").coalesce(1)
    got = df.select("i", search.embedder(size=2)("x").alias("e")).collect()
    want = search.hash_embedding([f"word{i} again" for i in range(10)])
    assert all((r.e is None) if r.i % 3 == 0 else r.e == want[r.i] for r in got)


def test_metadata_contract(spark):
    df = spark.createDataFrame([("t", None)], "tenant_id string, kind string")
    with pytest.raises(ValueError, match="title"):
        search.with_metadata(df, ["tenant_id", "title"])
    with pytest.raises(Exception, match="kind is null"):
        search.with_metadata(df, ["tenant_id", "kind"]).collect()
