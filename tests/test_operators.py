"""Hand-computed cases for operators whose corners the base tables do not reach."""

from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import money as M
from tallyloom.functions import text as T
from tallyloom.operators import relational as R
from tallyloom.operators import scd, search
from tallyloom.plans.filters import FilterError, Lens, Tenant, association, compile_filter
from tallyloom.sources import contract as C
from tallyloom.sources import files


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_as_of_takes_the_last_rate_at_or_before(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9), ("c", 3)], "k string, t int")
    right = spark.createDataFrame([("a", 2, 0.1), ("a", 5, 0.2), ("b", 10, 0.3)], "k string, since int, rate double")
    got = R.as_of_join(left, right, ["k"], "t", "since", ["rate"])
    assert rows(got, "k", "t") == [("a", 1, None), ("a", 5, 0.2), ("b", 9, None), ("c", 3, None)]


def test_refund_shares_are_capped(spark):
    parts = spark.createDataFrame([(1, "x", 100.0), (1, "y", 300.0)], "inv int, cell string, gross double")
    totals = spark.createDataFrame([(1, 400.0)], "inv int, refund double")
    assert rows(R.allocate(parts, totals, "inv", "gross", "refund").select("cell", "allocated"), "cell") == [("x", 100.0), ("y", 300.0)]


def test_linkage_grades(spark):
    left = spark.createDataFrame([(1, "a@x"), (2, "info@x"), (3, "b@x"), (4, "no@x")], "l int, key string")
    right = spark.createDataFrame([(10, "a@x"), (20, "info@x"), (30, "b@x"), (31, "b@x"), (40, "no@x")], "r int, key string")
    got = R.link(left, right, "l", "r", "key", F.col("key").startswith("info"), F.col("key") == "no@x")
    assert rows(got, "l", "r") == [(1, 10, 1.0), (2, 20, 0.9), (3, 30, 0.5), (3, 31, 0.5)]


def test_merge_omitted_is_no_change_and_null_is(spark):
    now = spark.createDataFrame([(1, "a", 1.0, "keep", 1), (2, "b", 2.0, "keep", 1), (3, "c", 3.0, "keep", 1)], "id int, name string, amount double, note string, refreshed_at long")
    new = spark.createDataFrame([(1, "a", 1), (2, None, 2), (4, "d", 4)], "id int, name string, amount int")
    m = scd.merge(now, new, ["id"], F.lit(2).cast("long"))
    assert rows(m.current, "id") == [(1, "a", 1.0, "keep", 2), (2, None, 2.0, "keep", 2), (3, "c", 3.0, "keep", 1), (4, "d", 4.0, None, 2)]
    assert rows(m.history.select("id", "name", "valid_from", "valid_to"), "id") == [(2, "b", 1, 2)]
    assert [(r.id, r.outcome, r.changed) for r in m.changes.orderBy("id").collect()] == [(1, "unchanged", None), (2, "updated", ["name"]), (3, "absent", None), (4, "created", None)]


def test_second_merge_of_the_same_batch_changes_nothing(spark):
    now = spark.createDataFrame([(1, "a", 1)], "id int, name string, refreshed_at long")
    new = spark.createDataFrame([(1, "b")], "id int, name string")
    once = scd.merge(now, new, ["id"], F.lit(2).cast("long"))
    assert scd.merge(once.current, new, ["id"], F.lit(3).cast("long")).history.count() == 0


def test_intervals_close_where_the_next_begins(spark):
    df = spark.createDataFrame([(1, 1), (1, 6), (1, 12)], "id int, at int")
    assert rows(scd.intervals(df, ["id"], "at").select("valid_from", "valid_to"), "valid_from") == [(1, 6), (6, 12), (12, None)]


def test_rates_close_and_open(spark):
    rates = spark.createDataFrame([("p", 0.1, 1, None), ("q", 0.2, 1, None)], "party string, rate double, valid_from int, valid_to int")
    got = scd.set_rate(rates, {"party": "p"}, 0.3, F.lit(5))
    assert rows(got, "party", "valid_from") == [("p", 0.1, 1, 5), ("p", 0.3, 5, None), ("q", 0.2, 1, None)]
    with pytest.raises(ValueError):
        scd.set_rate(rates, {"party": "p"}, 2, F.lit(5))


def test_empty_fields_do_not_take_the_next_line(spark):
    text = "*Name*: Some Brand\n*Phone*:\n*Mail*: <mailto:a@b.c|a@b.c>"
    df = spark.createDataFrame([(text,)], "x string")
    got = df.select(T.labelled_field(F.col("x"), "Name"), T.labelled_field(F.col("x"), "Phone"), T.unwrap_links(T.labelled_field(F.col("x"), "Mail"))).first()
    assert tuple(got) == ("Some Brand", None, "a@b.c")


def test_text_parsers(spark):
    df = spark.createDataFrame([("net 30", "$1,234.50", "2024-02-01", "Ann Lee Ray"), ("30", "NA", "01/02/2024", "Ann"), ("soon", "1.2.3", "x", " ")], "t string, m string, d string, n string")
    first, rest = T.split_name(F.col("n"))
    got = df.select(T.payment_terms(F.col("t")), T.parse_money(F.col("m")).cast("string"), T.parse_date(F.col("d"), "yyyy-MM-dd", "dd/MM/yyyy").cast("string"), first, rest).collect()
    assert [tuple(r) for r in got] == [(30, "1234.50", "2024-02-01", "Ann", "Lee Ray"), (30, "0.00", "2024-02-01", "Ann", None), (None, None, None, None, None)]


@given(st.text(alphabet="ab .\n", max_size=9000))
@settings(max_examples=40, deadline=None)
def test_chunks_cover_the_text(text):
    parts, at = T.cut_text(text), 0
    for p in parts:
        assert 0 < len(p) <= 2560
        found = text.find(p, max(0, at - 1100))
        assert found >= 0 and not text[at:found].strip()
        at = max(at, found + len(p))
    assert not text[at:].strip()


def test_json_right_wins(spark):
    df = spark.createDataFrame([('{"a":"1","b":"2"}', '{"b":"3"}'), (None, '{"z":"1","y":"2"}')], "l string, r string")
    assert [r[0] for r in df.select(T.merge_json(F.col("l"), F.col("r"))).collect()] == ['{"a":"1","b":"3"}', '{"y":"2","z":"1"}']


def test_cosine_of_nothing_is_null_and_the_shorter_one_counts(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 2.0]), ([], [])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(M.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, None, 1.0, None]


def test_index_skips_what_it_has(spark):
    texts = spark.createDataFrame([(1, "one text"), (2, "other"), (3, None)], "source_id int, text string")
    known = search.index_texts(texts)
    assert known.count() == 2
    changed = spark.createDataFrame([(1, "one text"), (2, "changed")], "source_id int, text string")
    assert [r.source_id for r in search.index_texts(changed, known).collect()] == [2]
    assert search.stale(changed.where("source_id = 1"), known).count() == 1


COLUMNS = {"region", "name", "amount"}


@given(st.dictionaries(st.one_of(st.sampled_from(["region", "name", "tenant_id", "$or", "x"]), st.text(max_size=5)), st.one_of(st.none(), st.integers(-5, 5), st.text(max_size=3), st.lists(st.integers(), max_size=1)), max_size=4))
@settings(max_examples=60, deadline=None)
def test_filters_compile_or_are_refused(spark, config):
    try:
        compile_filter(config, COLUMNS)
    except FilterError:
        assert any(k not in COLUMNS or isinstance(v, list) for k, v in config.items())
    else:
        assert set(config) <= COLUMNS


def test_filter_limits(spark):
    with pytest.raises(FilterError):
        compile_filter({f"c{i}": 1 for i in range(33)}, {f"c{i}" for i in range(33)})
    with pytest.raises(FilterError):
        association("crm", "deal", "moon")


def test_tenants(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("a", 3, None)], "tenant_id string, id int, region string")
    assert Tenant(None).read(df).count() == 0 and Tenant("").read(df).count() == 0
    assert rows(Tenant("a").apply(Lens("l", "t", "a", {"region": None}), {"t": df}, ["id"]), "id") == [(3,)]
    with pytest.raises(PermissionError):
        Tenant("b").apply(Lens("l", "t", "a"), {"t": df})
    with pytest.raises(Exception, match="another tenant"):
        Tenant("a").check(df).collect()


class Good:
    cursor_safety_window_seconds = 300

    def authenticate(self): ...
    def stream_records(self, cursor, batch_size):
        yield {}

    def describe_schema(self): ...
    def incremental_key(self, record): ...


def test_contract():
    assert C.validate(Good()) == []
    assert len(C.validate(object())) == 5
    with pytest.raises(ValueError):
        C.aware(datetime(2026, 1, 1))
    assert C.aware(datetime(2026, 1, 1, tzinfo=timezone.utc))


def test_pacing_and_retry():
    now, waits = [0.0], []

    def sleep(s):
        waits.append(round(s, 3))
        now[0] += s

    b = C.TokenBucket(2, 2, lambda: now[0], sleep)
    for _ in range(4):
        b.acquire()
    assert waits == [0.5, 0.5]
    tries, waited = [C.Unavailable(429, 1000), C.Unavailable(503), None], []

    def call():
        if (e := tries.pop(0)) is not None:
            raise e
        return "ok"

    assert C.retried(call, sleep=waited.append) == "ok" and waited == [300.0, 2.0]
    with pytest.raises(C.Unavailable):
        C.retried(lambda: (_ for _ in ()).throw(C.Unavailable(404)), sleep=waited.append)


def test_corpus_is_the_same_each_time(spark):
    spark.dataSource.register(C.CorpusSource)
    read = lambda **o: spark.read.format("tallyloom_corpus").options(**o).load()
    one, two = rows(read(size="compact"), "source_id", "kind"), rows(read(size="compact"), "source_id", "kind")
    assert one == two and len(one) == 115
    assert read(size="standard").count() == 1150 and read(size="smoke").count() == 10
    assert read(size="smoke", since="2026-02-11T20:00:00+00:00").count() == 5


def test_reports(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("Invoice No.,Total Due,TOTAL due,Odd\n1,$2.00,3,x\n")
    df, unknown = files.read_report(spark, str(p), {"invoice": {"invoice no"}, "total": {"total due"}}, {"invoice"})
    assert df.columns == ["invoice", "total", "total_2"] and unknown == ["Odd"]
    with pytest.raises(ValueError):
        files.read_report(spark, str(p), {"invoice": {"invoice no"}}, {"payer"})


def test_keyed_sinks(spark):
    now = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, name string, at int")
    new = spark.createDataFrame([(2, "x", 2), (2, "y", 3), (3, "z", 2)], "id int, name string, at int")
    assert rows(files.upsert(now, new, ["id"], "at"), "id") == [(1, "a", 1), (2, "y", 3), (3, "z", 2)]
    assert rows(files.upsert(now, new, ["id"], "at", ["at"]), "id") == [(1, "a", 1), (2, "b", 3), (3, "z", 2)]
    assert rows(files.insert_ignore(now, new, ["id"]).select("id"), "id") == [(3,)]
    other = spark.createDataFrame([(1, "n")], "id int, name string")
    gaps = spark.createDataFrame([(1, None), (2, "k")], "id int, name string")
    assert rows(files.fill_missing(gaps, other, "id", "name"), "id") == [(1, "n"), (2, "k")]


def test_bands_and_ladder(spark):
    df = spark.createDataFrame([(10,), (31,), (99,), (None,)], "x int")
    assert [r[0] for r in df.select(M.band(F.col("x"), [30, 60], ["a", "b", "c"])).collect()] == ["a", "b", "c", None]
    df = spark.createDataFrame([("2025-12-01", "2024-12-01"), ("2025-11-01", "2024-12-01"), ("2030-01-01", "2024-12-01"), ("2025-01-01", None)], "m string, a string")
    rate = M.tiered_rate(F.col("m").cast("date"), F.col("a").cast("date"), [(12, 0.1), (18, 0.06)], 0.03, 0.1)
    assert [r[0] for r in df.select(rate).collect()] == [0.06, 0.1, 0.03, 0.1]
