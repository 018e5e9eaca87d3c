"""Streams: landing edge cases, late data, fan-in, incremental history, the pipeline in two runs."""

import datetime as dt
import json
import os
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests_helpers import expected_history
from tradeloom.operators.quality import dropped_in_stream
from tradeloom.schemas import BRONZE, FACTS, LANDING_ENTITIES, ORDERS_RAW, Table
from tradeloom.session import COUNTED, SPREAD, setting, shuffles_dropped, state_partitions
from tradeloom.sources.admission import Admission
from tradeloom.sources.documents import _documents, _rows, write_landing
from tradeloom.sources.landing import parse_documents, split_documents
from tradeloom.sources.star import RAW, Star
from tradeloom.streaming import counts, pipeline, sinks
from tradeloom.streaming.dedup import dedup_stream
from tradeloom.streaming.key_index import KeyIndex, append_unique
from tradeloom.streaming.pipeline import Store
from tradeloom.streaming.scd2 import read_current, read_history, scd2_apply
from tradeloom.streaming.segments import Segments

T0 = dt.datetime(2026, 4, 1)


def land(folder, name, document):
    path = Path(folder)
    path.mkdir(parents=True, exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, indent=2)
    (path / f"{name}.json").write_text(text)


def order(i, amount=10.0, lines=1, status="CREATED", date="2026-04-07T11:39:29.094284Z"):
    return {"order_id": i, "order_date": date, "customer_id": "c1", "dc_id": "d1",
            "order_status": status, "order_total_amount": amount,
            "lines": [{"line_id": str(n + 1), "product_id": "p1", "ordered_qty_packs": 2,
                       "confirmed_qty_packs": 1, "line_amount": amount / lines}
                      for n in range(lines)]}


def ingest(spark, folder, store, **options):
    sinks.finish([pipeline.ingest_landing(spark, folder, store, **options)])
    return sinks.read_table(spark, store.table("landing"), BRONZE)


def test_landing_documents(spark, folder):
    landing, store = f"{folder}/in", Store(f"{folder}/store")
    land(landing, "envelope", {"key": "k", "value": {"sales_orders": [order("o1")], "returns": []}})
    land(landing, "flat", {"sales_orders": [order("o2"), order("o3")], "extra": {"a": [1]}})
    land(landing, "unknown", {"key": "u", "sent_by": "crm", "value": {
        "batch": 7, "customers": [{"customer_id": "c1", "tier": "gold"}, {"customer_id": "c2"}]}})
    land(landing, "broken", '{"key": "b", "value": ')
    land(landing, "other", {"key": "x"})
    rows = {Path(r._source_file).stem: r for r in ingest(spark, landing, store).collect()}
    assert len(rows) == 5
    assert rows["envelope"].key == "k" and rows["envelope"]._rescued_data is None
    assert rows["envelope"].value.returns == [] and rows["envelope"].value.customers is None
    assert [o.order_id for o in rows["flat"].value.sales_orders] == ["o2", "o3"]
    assert rows["flat"].key is None
    assert json.loads(rows["flat"]._rescued_data) == {"extra": '{"a":[1]}'}
    assert json.loads(rows["unknown"]._rescued_data) == {
        "sent_by": "crm", "value.batch": "7", "value.customers": '[{"tier":"gold"}]'}
    assert rows["broken"].key is None and rows["broken"].value is None
    assert json.loads(rows["broken"]._rescued_data) == {"_corrupt_record": '{"key": "b", "value": '}
    assert rows["other"].value is None and rows["other"]._rescued_data is None
    assert rows["other"]._ingest_date == rows["other"]._ingested_at.date()


def test_landing_without_rescue_reads_arrays_and_lines(spark, folder):
    documents = [{"key": str(n), "value": {"sales_orders": [order(f"o{n}")]}} for n in range(3)]
    land(f"{folder}/arrays", "all", documents)
    land(f"{folder}/lines", "all", "\n".join(json.dumps(d) for d in documents))
    arrays = ingest(spark, f"{folder}/arrays", Store(f"{folder}/a"), rescue=False)
    lines = ingest(spark, f"{folder}/lines", Store(f"{folder}/l"), rescue=False, multi_line=False)
    for got in (arrays, lines):
        assert sorted(r.value.sales_orders[0].order_id for r in got.collect()) == ["o0", "o1", "o2"]


def test_rescue_reads_every_shape_and_stops_at_none(spark, folder):
    documents = [{"key": str(n), "value": {"sales_orders": [order(f"o{n}")], "new": n}} for n in range(3)]
    rows = [json.dumps(d) for d in documents]
    shapes = {"array": json.dumps(documents, indent=1), "lines": "\n".join(rows) + "\n\n",
              "pretty": "\n".join(json.dumps(d, indent=2) for d in documents)}
    for name, text in shapes.items():
        land(f"{folder}/{name}", "all", text)
        store = Store(f"{folder}/store-{name}")
        got = sorted(ingest(spark, f"{folder}/{name}", store).collect(), key=lambda r: r.key)
        assert [(r.key, r.value.sales_orders[0].order_id, r._rescued_data) for r in got] == [
            (str(n), f"o{n}", f'{{"value.new":"{n}"}}') for n in range(3)], name
    got = ingest(spark, f"{folder}/lines", Store(f"{folder}/by-line"), multi_line=False).collect()
    assert sorted(r.key for r in got) == ["0", "1", "2"]


def test_poison_documents_are_kept_and_the_stream_goes_on(spark, folder):
    landing, store = f"{folder}/in", Store(f"{folder}/store")
    land(landing, "twice", '{"z": 1, "z": 2, "value": {"y": 1, "y": 2, "customers": [{"x": 1, "x": 2}]}}')
    land(landing, "rest", '{"key": "a"} and more')
    land(landing, "bracket", '{"key": "a"}] and more')
    land(landing, "brace", json.dumps({"key": "}\n{ [", "more": "}\r\n{"}))
    land(landing, "text", '["abc", {"key": "in array"}]')
    land(landing, "empty", "")
    ingest(spark, landing, store)
    land(landing, "later", {"key": "later"})  # a restart
    rows = {}
    for r in ingest(spark, landing, store).collect():
        rows.setdefault(Path(r._source_file).stem, []).append(r)
    assert rows["twice"][0]._rescued_data == (
        '{"z":"1","z":"2","value.y":"1","value.y":"2","value.customers":"[{\\"x\\":\\"1\\",\\"x\\":\\"2\\"}]"}')
    for name in ("rest", "bracket"):
        text = Path(landing, f"{name}.json").read_text()
        assert [json.loads(r._rescued_data) for r in rows[name]] == [{"_corrupt_record": text}], name
    assert [(r.key, json.loads(r._rescued_data)) for r in rows["brace"]] == [("}\n{ [", {"more": "}\r\n{"})]
    assert sorted(str(r.key) for r in rows["text"]) == ["None", "in array"]
    assert "abc" in str([r._rescued_data for r in rows["text"]])
    assert [r.key for r in rows["later"]] == ["later"] and "empty" not in rows


def run_dedup(spark, folder, batches, **options):
    """De-duplicate rows (key, value, arrival) given batch by batch, one file each."""
    table = Table({"k": "STRING", "v": "STRING", "_ingested_at": "TIMESTAMP"})
    sinks.create_table(spark, f"{folder}/in", table)
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, table.ddl).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = dedup_stream(sinks.stream_table(spark, f"{folder}/in", table), ["k"], **options)
        sinks.finish([sinks.append_stream(stream, f"{folder}/out", table, f"{folder}/check")])
    return sorted((r.k, r.v) for r in sinks.read_table(spark, f"{folder}/out", table).collect())


def test_first_arrival_wins_and_late_rows_drop(spark, folder):
    day = dt.timedelta(days=1)
    got = run_dedup(spark, folder, [
        [("a", "a1", T0), ("b", "b1", T0), ("b", "b1", T0)],
        [("a", "a2", T0 + day), ("c", "c1", T0 + 30 * day)],
        [("late", "x", T0 + 22 * day), ("ok", "y", T0 + 24 * day), ("b", "b3", T0 + 30 * day)]])
    assert got == [("a", "a1"), ("b", "b1"), ("c", "c1"), ("ok", "y")]


def test_bounded_dedup_lets_old_keys_in_again(spark, folder):
    day = dt.timedelta(days=1)
    batches = [[("a", "a1", T0)], [("b", "b1", T0 + 30 * day)], [("c", "c1", T0 + 31 * day)],
               [("a", "a2", T0 + 31 * day)]]
    assert run_dedup(spark, f"{folder}/bounded", batches, bounded=True) == [
        ("a", "a1"), ("a", "a2"), ("b", "b1"), ("c", "c1")]
    assert run_dedup(spark, f"{folder}/kept", batches) == [("a", "a1"), ("b", "b1"), ("c", "c1")]


def test_fan_in_keeps_both_flows_and_silver_keeps_one(spark, folder):
    landing, backfill, store = f"{folder}/live", f"{folder}/old", Store(f"{folder}/store")
    land(landing, "a", {"key": "k", "value": {"sales_orders": [
        order("o1", lines=2), order(" o1 "), order(""), order(None), order("o2")]}})
    land(landing, "b", {"key": "no orders", "value": {"returns": []}})
    land(backfill, "c", {"key": "h", "value": {"sales_orders": [order("o1", lines=2), order("o9")],
                                               "customers": [{"customer_id": "ignored"}]}})
    ingest(spark, landing, store)
    sinks.finish([pipeline.ingest_orders(spark, store),
                  pipeline.ingest_order_backfill(spark, backfill, store)])
    raw = sinks.read_flows(spark, store.table("sales_orders_raw"), ORDERS_RAW, pipeline.FLOWS)
    assert sorted((r.flow, r.order_id) for r in raw.collect()) == [
        ("historical", "o1"), ("historical", "o9"), ("live", ""), ("live", "o1"), ("live", "o2")]
    queries = [pipeline.load_order_fact(spark, store, t)
               for t in ("fct_sales_orders", "fct_sales_order_lines")]
    sinks.finish(queries)
    orders = sinks.read_table(spark, store.table("fct_sales_orders"), FACTS["fct_sales_orders"])
    assert sorted(r.order_id for r in orders.collect()) == ["o1", "o2", "o9"]
    assert dropped_in_stream(queries[0], "fct_sales_orders") == {
        "rows": 5, "valid_order_id_not_null": 0, "valid_order_id_not_empty": 1}
    lines = sinks.read_table(spark, store.table("fct_sales_order_lines"),
                             FACTS["fct_sales_order_lines"])
    # whichever copy of o1 came first, its line 1 appears once; "" is a legal key of a line
    assert sorted((r.order_id, r.line_id) for r in lines.collect() if r.line_id == "1") == [
        ("", "1"), ("o1", "1"), ("o2", "1"), ("o9", "1")]


def test_a_repeated_batch_of_a_flow_replaces_itself(spark, folder):
    table = Table({"k": "STRING"})
    source, out = f"{folder}/in", f"{folder}/out"
    spark.createDataFrame([("a",), ("b",)], table.ddl).coalesce(1).write.parquet(source)
    for attempt in ("first", "again"):  # a lost checkpoint repeats batch 0
        stream = sinks.stream_table(spark, source, table)
        sinks.finish([sinks.append_flow(stream, out, table, "live", f"{folder}/check-{attempt}")])
    assert sorted(r.k for r in sinks.read_flows(spark, out, table, ["live"]).collect()) == ["a", "b"]


def test_readers_of_flows_see_committed_batches_once(spark, folder):
    """Files of an attempt that failed lie in the flow's folder while a downstream stream reads."""
    table = Table({"k": "STRING"})
    source, flows, out = f"{folder}/in", f"{folder}/flows", f"{folder}/out"
    for n, keys in enumerate((["a", "b"], ["c"])):
        spark.createDataFrame([(k,) for k in keys], table.ddl).coalesce(1).write.mode("append").parquet(source)
        sinks.finish([sinks.append_flow(sinks.stream_table(spark, source, table), flows, table, "live", f"{folder}/check")])
        stray = Path(flows, "flow=live", f"part-0000{n}-stray.parquet")
        stray.write_bytes(next(p for p in Path(source).glob("*.parquet")).read_bytes())
        for _ in range(2):
            both = sinks.stream_flows(spark, flows, table, ["live", "old"])
            sinks.finish([sinks.append_stream(both, out, table, f"{folder}/down")])
    assert sorted(r.k for r in sinks.read_table(spark, out, table).collect()) == ["a", "b", "c"]
    assert sorted(r.k for r in sinks.read_flows(spark, flows, table, ["live", "old"]).collect()) == ["a", "b", "c"]


def test_history_by_batches_equals_history_at_once(spark, folder):
    rng = random.Random(11)
    records = [("hot" if rng.random() < 0.34 else f"k{rng.randrange(8)}",
                T0 + dt.timedelta(hours=rng.randrange(0, 96)), rng.choice("xy"), rng.choice([None, ["A"]]))
               for _ in range(150)]
    table = Table({"k": "STRING", "at": "TIMESTAMP", "a": "STRING", "zones": "ARRAY<STRING>"})
    sinks.create_table(spark, f"{folder}/in", table)
    done = []
    newer = [(k, T0 + dt.timedelta(days=9, hours=n % 5), a, z) for n, (k, _, a, z) in enumerate(records[:40])]
    unknown = [("new", T0, "x", None), ("k1", T0 + dt.timedelta(days=20), "y", None)]
    # late records, one record, only newer records, an unknown key, copies of old records
    for part in (records[:60], records[60:61], records[61:], newer, unknown, records[:30]):
        done += part
        spark.createDataFrame(part, table.ddl).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        sinks.finish([scd2_apply(sinks.stream_table(spark, f"{folder}/in", table), ["k"], "at",
                                 ["a", "zones"], f"{folder}/out", f"{folder}/check", parts=4)])
        got = sorted((tuple(r) for r in read_history(spark, f"{folder}/out", ["k"]).collect()), key=repr)
        assert got == expected_history(done)
        current = sorted(tuple(r) for r in read_current(spark, f"{folder}/out").select("k", "a").collect())
        assert current == sorted((k, a) for k, a, _, _, end in expected_history(done) if end is None)


def test_pipeline_in_two_runs(spark, folder):
    landing, store = f"{folder}/in", Store(f"{folder}/store")
    customer = {"customer_id": "c1", "customer_name": "One", "region": "NORTH", "credit_limit": 1.0}
    land(landing, "1", {"key": "1", "value": {
        "customers": [customer, {"customer_id": " "}],
        "products": [{"product_id": "p1", "manufacturer_id": "m1", "product_name": "Pill"}],
        "manufacturers": [{"manufacturer_id": "m1"}], "distribution_centers": [{"dc_id": "d1"}],
        "sales_orders": [order("o1", 20.0, 2)],
        "shipments": [{"shipment_id": "s1", "order_id": "o1", "ship_date": "2026-04-08"}],
        "returns": [{"return_id": "r1", "return_date": "nonsense", "credit_amount": 5.0}],
        "inventory_snapshots": [{"snapshot_id": "i1", "snapshot_ts": "2026-04-07", "on_hand_packs": 4}]}})
    pipeline.run_pipeline(spark, landing, None, store, parts=2)
    land(landing, "2", {"key": "2", "value": {
        "customers": [{**customer, "region": "INLAND", "credit_limit": 720.25}],
        "sales_orders": [order("o1", 99.0, 1, "SHIPPED"), order("o2", 5.0)]}})
    tables = pipeline.run_pipeline(spark, landing, None, store, parts=2, admission=Admission(files=1))
    counts = {(r.flow, r.rule): r.rows for r in tables.pop("drop_counts").collect()}
    assert counts["fct_returns", "rows"] == counts["fct_returns", "malformed_return_date"] == 1
    assert counts["sales_orders_raw_live", "copies"] == 1 and counts["fct_sales_orders", "rows"] == 2
    assert {t: df.count() for t, df in tables.items()} == {
        "fct_sales_orders": 2, "fct_sales_order_lines": 3, "fct_inventory_snapshots": 1,
        "fct_shipments": 1, "fct_returns": 1, "dim_customers_hist": 2, "dim_customers_current": 1,
        "dim_products": 1, "dim_products_current": 1, "dim_manufacturers": 1,
        "dim_manufacturers_current": 1, "dim_distribution_centers": 1,
        "dim_distribution_centers_current": 1}
    status = {r.order_id: r.order_status for r in tables["fct_sales_orders"].collect()}
    assert status == {"o1": "CREATED", "o2": "CREATED"}  # the first arrival stays
    assert tables["fct_returns"].first().return_date is None
    old, new = sorted(tables["dim_customers_hist"].collect(), key=lambda r: r["__START_AT"])
    assert (old.region, new.region) == ("NORTH", "INLAND")
    assert old["__END_AT"] == new["__START_AT"] and new["__END_AT"] is None
    assert tables["dim_customers_current"].first().credit_limit == 720.25


@pytest.mark.parametrize("cluster", [(), ("d", "k")])
def test_publish_replaces(spark, folder, cluster):
    rows = spark.range(100).select((F.col("id") % 5).alias("d"), F.col("id").alias("k"))
    for n in (100, 40):
        sinks.publish(rows.limit(n), f"{folder}/t", cluster)
        assert spark.read.parquet(f"{folder}/t").count() == n


def test_tables_in_buckets_join_without_a_shuffle(spark):
    for name in ("bucketed_orders", "bucketed_lines"):
        sinks.publish_bucketed(spark.range(200).withColumnRenamed("id", "order_id"), name,
                               ["order_id"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_orders").join(spark.table("bucketed_lines"), "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_newest_of_one_arrival_is_current(spark, folder):
    """Two files between two runs, two documents in a file, two rows in a document: the last one counts."""
    landing, store = f"{folder}/in", Store(f"{folder}/store")

    def customers(*regions):
        return {"value": {"customers": [{"customer_id": c, "region": r} for c, r in regions]}}

    land(landing, "z-older", customers(("a", "NORTH"), ("b", "WEST"), ("b", "EAST")))
    land(landing, "a-newer", [customers(("a", "WEST"), ("c", "WEST")), customers(("a", "EAST"), ("c", "EAST"))])
    os.utime(f"{landing}/z-older.json", (1_700_000_000, 1_700_000_000))
    for _ in range(2):
        ingest(spark, landing, store)
        sinks.finish([pipeline.load_dimension(spark, store, "customers", parts=2)])
        current = read_current(spark, store.table("dim_customers_hist"))
        got = {r.customer_id: r.region for r in current.collect()}
        versions = store.table("dim_customers_hist") + "/versions"  # a batch that is not written to its end
        spark.read.parquet(f"{versions}/{_}-{_}").withColumn("__END_AT", F.col("__START_AT")).write.parquet(
            f"{versions}/{_ + 7}-{_ + 7}")
        history = read_history(spark, store.table("dim_customers_hist"), ["customer_id"])
        assert history.filter("__END_AT IS NULL").count() == 3 and history.count() == 3 + _
        assert got == ({"a": "EAST", "b": "EAST", "c": "EAST"} if _ == 0 else
                       {"a": "SOUTH", "b": "EAST", "c": "EAST"})
        land(landing, "last", customers(("a", "WEST"), ("a", "SOUTH")))


KEYED = Table({"k": "STRING", "v": "STRING", "_ingested_at": "TIMESTAMP"})


def run_unique(spark, folder, batches, **options):
    """As `run_dedup`, into a table with a key index; one stream per batch. Returns rows and the state's sizes."""
    sinks.create_table(spark, f"{folder}/in", KEYED)
    sizes = []
    for rows in batches:
        spark.createDataFrame(rows, KEYED.ddl).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = dedup_stream(sinks.stream_table(spark, f"{folder}/in", KEYED), ["k"], bounded=True)
        query = append_unique(stream, f"{folder}/out", KEYED, ["k"], f"{folder}/index", f"{folder}/check", **options)
        sinks.finish([query])
        sizes.append(query.lastProgress.stateOperators[0].numRowsTotal)
    return sorted((r.k, r.v) for r in sinks.read_table(spark, f"{folder}/out", KEYED).collect()), sizes


def test_registered_streams_leave_their_state_uncounted(spark, folder):
    """Its rows are the same, and afterwards the session counts as before."""
    rows = [("a", "1", T0), ("a", "2", T0), ("b", "3", T0)]
    assert run_unique(spark, f"{folder}/counted", [rows[:1]])[1][0] > 0
    before = spark.conf.get(COUNTED, None)
    with state_partitions(spark, 2):
        got, sizes = run_unique(spark, f"{folder}/uncounted", [rows[:1], rows[1:]])
    assert got == [("a", "1"), ("b", "3")] and sizes == [0, 0]
    assert spark.conf.get(COUNTED, None) == before


def test_bounded_state_and_a_copy_after_the_watermark(spark, folder):
    """Twelve batches, ten days apart: the state does not grow, copies of every age are dropped, segments merge."""
    day = dt.timedelta(days=1)
    batches, want = [], {}
    for n in range(12):
        now = T0 + 10 * n * day
        rows = [(f"k{n}-{i}", f"v{n}", now) for i in range(20)] + [("always", f"a{n}", now)]
        rows += [(f"k{n - back}-{i}", "copy", now) for back in (1, 2, 5, 11) if back <= n for i in (3, 7)]
        batches.append(rows)
        for k, v, _ in rows:
            want.setdefault(k, v)
    got, sizes = run_unique(spark, folder, batches, buckets=16, fan=3)
    assert got == sorted(want.items())
    assert max(sizes) <= 2 * max(len(b) for b in batches)  # this batch and the one before it
    version = Segments(spark, f"{folder}/index").version()
    assert len(version.segments["keys"]) <= 6 and version.segments["keys"] == version.segments["filter"]
    assert sum(1 for _ in Path(f"{folder}/index/keys").iterdir()) <= 6 + 3 * 3
    index = KeyIndex(spark, f"{folder}/index", ["k"], 16, 3)
    keys = index.store.read("keys", version)
    assert keys.count() == len(want)
    from tradeloom.streaming.key_index import _hashed
    strange = _hashed(spark.range(5000).select(F.concat(F.lit("other"), "id").alias("k")), ["k"], 16)
    assert index.perhaps_known(keys, version).count() == len(want)  # no key is ruled out
    assert index.perhaps_known(strange, version).count() < 5000 * 0.05 * len(version.segments["filter"])


def test_a_repeated_batch_of_the_key_index(spark, folder):
    """A batch that failed after its rows were written, or after its keys were committed, writes the same rows again."""
    index = KeyIndex(spark, f"{folder}/index", ["k"], 8)
    written = []

    def write(rows):
        rows.write.mode("overwrite").parquet(f"{folder}/out")
        written.append(sorted(str(r.k) for r in spark.read.parquet(f"{folder}/out").collect()))
        return spark.read.parquet(f"{folder}/out")

    def failing(rows):
        write(rows)
        raise RuntimeError("lost")

    first, second, none = (spark.createDataFrame([(k,) for k in ks], "k STRING")
                           for ks in (["a", "b", None], ["b", "c", None], []))
    KeyIndex(spark, f"{folder}/empty", ["k"], 8).admit(none, 0, write)
    KeyIndex(spark, f"{folder}/empty", ["k"], 8).admit(none, 1, write)
    written.clear()
    index.admit(first, 0, write)
    with pytest.raises(RuntimeError):
        index.admit(second, 1, failing)
    index.admit(second, 1, write)
    index.admit(second, 1, write)
    index.admit(second, 2, write)
    assert written[1:] == [["c"], ["c"], ["c"], []]
    with pytest.raises(ValueError):
        index.admit(second, 0, write)  # a lost checkpoint
    with pytest.raises(ValueError):
        KeyIndex(spark, f"{folder}/index", ["k"], 9).admit(second, 3, write)


def test_counts_of_late_rows_and_copies(spark, folder):
    day = dt.timedelta(days=1)
    sinks.create_table(spark, f"{folder}/in", KEYED)
    store = Store(f"{folder}/store")
    for rows in ([("a", "1", T0), ("a", "2", T0)], [("b", "1", T0 + 30 * day)], [("late", "1", T0), ("b", "2", T0 + 30 * day)]):
        spark.createDataFrame(rows, KEYED.ddl).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        with pipeline.counting(spark, store) as run:
            stream = sinks.stream_table(spark, f"{folder}/in", KEYED).observe("keyed", F.count(F.lit(1)).alias("rows"))
            run([sinks.append_stream(dedup_stream(stream, ["k"]), f"{folder}/out", KEYED, f"{folder}/check")])
    path = store.table("drop_counts")
    got = {r.rule: r.rows for r in counts.drop_counts(spark, path).collect()}
    assert got == {"rows": 5, "late": 1, "copies": 2}
    # a report that comes again does not count twice
    spark.read.parquet(path).write.mode("append").parquet(path)
    assert {r.rule: r.rows for r in counts.drop_counts(spark, path).collect()} == got


def test_a_failed_run_stores_its_counts(spark, folder):
    store = Store(f"{folder}/store")
    land(f"{folder}/in", "a", {"key": "k", "value": {"sales_orders": [order("o1"), order(None), order("o2", date="never")]}})
    land(f"{folder}/in", "b", {"key": "none", "value": {"sales_orders": [], "returns": []}})
    with pytest.raises(RuntimeError), pipeline.counting(spark, store) as run:
        run([pipeline.ingest_landing(spark, f"{folder}/in", store)])
        run([pipeline.ingest_orders(spark, store)])
        raise RuntimeError("the driver goes on")
    got = {(r.flow, r.rule): r.rows for r in counts.drop_counts(spark, store.table("drop_counts")).collect()}
    assert got == {("sales_orders_raw_live", r): n for r, n in {
        "rows": 3, "order_id_not_null": 1, "malformed_order_date": 1, "late": 0, "copies": 0}.items()}


def test_every_hop_admits_by_files(spark, folder):
    """A backlog of ten files: each hop takes several batches, the result is that of one batch."""
    for n in range(10):
        land(f"{folder}/in", f"{n}", {"key": f"{n}", "value": {
            "sales_orders": [order(f"o{n}"), order(f"o{n // 2}")], "customers": [{"customer_id": f"c{n % 3}", "region": f"r{n}"}],
            "returns": [{"return_id": f"r{n}"}], "manufacturers": [{"manufacturer_id": "m"}],
            "products": [{"product_id": f"p{n}", "manufacturer_id": "m"}], "distribution_centers": [{"dc_id": "d"}]}})
    got = {}
    for name, options in {"whole": {}, "files": {"admission": Admission(files=2)}, "bytes": {"admission": Admission(size=1)},
                          "bounded": {"admission": Admission(files=2), "bounded": True}}.items():
        store = Store(f"{folder}/{name}")
        tables = pipeline.run_pipeline(spark, f"{folder}/in", None, store, parts=2, **options)
        got[name] = ({t: sorted(map(repr, (r[0] for r in tables[t].collect()))) for t in FACTS},
                     sorted(r.customer_id for r in tables["dim_customers_current"].collect()))
        batches = counts.counts_by_batch(spark, store.table("drop_counts")).filter("rule = 'rows' AND rows > 0")
        per_flow = {r.flow: r.n for r in batches.groupBy("flow").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert set(per_flow) >= {"sales_orders_raw_live", "fct_sales_orders", "fct_sales_order_lines", "fct_returns"}
        assert all(n == 1 if name == "whole" else n >= 4 for n in per_flow.values()), (name, per_flow)
    assert got["whole"] == got["files"] == got["bytes"] == got["bounded"]
    with pytest.raises(ValueError):
        Admission(files=1, size=1).on(spark.readStream)


def test_history_of_many_batches_has_few_files(spark, folder):
    """Forty batches with late records, merged four by four: few folders, the same history; other parts are refused."""
    rng = random.Random(3)
    table = Table({"k": "STRING", "at": "TIMESTAMP", "a": "STRING", "zones": "ARRAY<STRING>"})
    done = []
    for n in range(40):
        part = [(f"k{rng.randrange(6)}", T0 + dt.timedelta(hours=n + rng.choice([0, 0, -5])), rng.choice("xyz"), None)
                for _ in range(3)]
        done += part
        spark.createDataFrame(part, table.ddl).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def apply(**options):
        changes = sinks.stream_table(spark, f"{folder}/in", table, Admission(files=1))
        sinks.finish([scd2_apply(changes, ["k"], "at", ["a", "zones"], f"{folder}/out", f"{folder}/check", **options)])

    apply(parts=2, fan=4)
    got = sorted((tuple(r) for r in read_history(spark, f"{folder}/out", ["k"]).collect()), key=repr)
    assert got == expected_history(done)
    version = Segments(spark, f"{folder}/out").version()
    assert version.number == 39 and all(len(s) <= 9 for s in version.segments.values())
    for name in ("log", "versions", "late"):
        assert sum(1 for _ in Path(f"{folder}/out/{name}").iterdir()) <= 9 + 4 * 4
    assert sum(1 for _ in Path(f"{folder}/out/manifest").glob("version=*")) <= 6
    spark.createDataFrame(done[:1], table.ddl).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    with pytest.raises(Exception, match="parts=2"):
        apply(parts=3)
    apply(parts=2, fan=4)  # the batch that was refused is taken
    assert sorted((tuple(r) for r in read_history(spark, f"{folder}/out", ["k"]).collect()), key=repr) == expected_history(done)


def test_backfill_takes_every_shape(spark, folder):
    documents = [{"key": str(n), "value": {"sales_orders": [order(f"o{n}")], "customers": [{"customer_id": "known"}]}} for n in range(4)]
    land(f"{folder}/in", "array", documents[:2])
    land(f"{folder}/in", "lines", "\n".join(json.dumps({**d, "new": 1}) for d in documents[2:]))
    land(f"{folder}/in", "broken", '{"key": "b", "value": ')
    store = Store(f"{folder}/store")
    sinks.finish([pipeline.ingest_order_backfill(spark, f"{folder}/in", store),
                  pipeline.ingest_backfill_rejects(spark, f"{folder}/in", store)])
    raw = sinks.read_flows(spark, store.table("sales_orders_raw"), ORDERS_RAW, pipeline.FLOWS)
    assert sorted((r.flow, r.order_id) for r in raw.collect()) == [("historical", f"o{n}") for n in range(4)]
    rejects = sinks.read_table(spark, store.table("backfill_rejects"), pipeline.BACKFILL_REJECTS).collect()
    assert sorted((r.key or "", r._rescued_data) for r in rejects) == [
        ("", '{"_corrupt_record":"{\\"key\\": \\"b\\", \\"value\\": "}'), ("2", '{"new":"1"}'), ("3", '{"new":"1"}')]


def test_texts_are_taken_apart_once(spark, folder):
    land(folder, "a", [{"key": "1"}])
    documents = split_documents(spark.read.text(folder, wholetext=True))
    plan = documents._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType(StringType") == 2  # the text, and an array found in it
    empty = spark.createDataFrame([("[]",), (" ",), ('{"a": 1}\r\n{"a": 2}',)], "value STRING")
    assert [(r._document, r.value) for r in split_documents(empty).collect()] == [(0, '{"a":1}'), (1, '{"a":2}')]


def test_files_of_the_test_feed_follow_its_tasks(spark, folder):
    write_landing(Star(spark, "/root/testdata/sf0.01"), f"{folder}/in")
    texts = spark.read.text(f"{folder}/in")
    documents, files = texts.count(), len(texts.inputFiles())
    assert documents > 100 and files < documents / 2
    got = ingest(spark, f"{folder}/in", Store(f"{folder}/store"), multi_line=False)
    assert got.count() == documents and got.filter("value IS NULL").isEmpty()


def test_texts_of_the_test_feed_are_compressed_and_lines_shuffled_once(spark, folder):
    star = Star(spark, "/root/testdata/sf0.001")
    write_landing(star, f"{folder}/in")
    files = [p for p in Path(folder).rglob("part-*")]
    assert files and all(p.parent.name == "in" and p.name.endswith(".txt.gz") for p in files)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), setting(spark, SPREAD, "false"):
        for entity, shuffles in {"sales_orders": 2, "shipments": 2, "returns": 2, "inventory_snapshots": 1}.items():
            plan = _documents(_rows(star, entity), entity)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == shuffles, entity


def test_orders_of_the_test_feed_with_odd_keys(spark, folder):
    """Orders without a key, without lines, twice; lines without an order, without a number, twice."""
    day = dt.datetime(2026, 4, 1)
    orders = [(1, 10, "F", 5.0, day, "HIGH"), (1, 10, "F", 5.0, day, "HIGH"), (2, 10, "O", 6.0, day, None), (None, 11, "O", 7.0, day, "LOW")]
    lines = [(1, 20, 31, 2, 4.0, 8.0, 0.5, 0.0, "R", "F", day), (1, 20, 30, 1, 4.0, 8.0, 0.5, 0.0, "R", "F", day),
             (1, 20, 30, 1, 4.0, 8.0, 0.5, 0.0, "R", "F", day), (1, 20, 32, None, 4.0, 8.0, 0.5, 0.0, "R", "F", day),
             (None, 20, 29, 1, 4.0, 8.0, 0.5, 0.0, "R", "F", day), (900, 20, 29, 1, 4.0, 8.0, 0.5, 0.0, "R", "F", day)]
    spark.createDataFrame(orders, RAW["orders"]).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, RAW["lineitem"]).write.parquet(f"{folder}/lineitem.parquet")
    star = Star(spark, folder)

    def rows(entity):
        return {(r.chunk, e[0]): (n, e) for r in _rows(star, entity).groupBy("chunk", "row").count().collect() for n, e in [(r["count"], r.row)]}
    found = rows("sales_orders")
    assert {k: n for k, (n, _) in found.items()} == {("0", "1"): 2, ("0", "2"): 1, (None, None): 1}
    assert [e.line_id for e in found["0", "1"][1].lines] == [None, "1", "2"] and found["0", "1"][1].dc_id == "30"
    assert found["0", "2"][1].lines is None and found[None, None][1].lines is None
    assert {k: n for k, (n, _) in rows("shipments").items()} == {("0", "S1-1"): 2, ("0", "S1-2"): 2, ("0", "S1"): 2}
    assert {k: n for k, (n, _) in rows("returns").items()} == {("0", "R1-1"): 2, ("0", "R1-2"): 2, ("0", "R1"): 2}


def test_shuffle_files_go_and_tables_are_stored_compressed(spark, folder):
    def shuffled():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}
    table = Table({"n": "BIGINT", "_ingested_at": "TIMESTAMP"})
    spark.range(100).select(F.col("id").alias("n"), F.lit(T0).alias("_ingested_at")).write.parquet(f"{folder}/from")
    before = shuffled()
    with state_partitions(spark, 2), shuffles_dropped(spark):
        spark.range(100).repartition(3, "id").write.parquet(f"{folder}/batch")
        rows = dedup_stream(sinks.stream_table(spark, f"{folder}/from", table), ["n"])
        sinks.finish([sinks.append_stream(rows, f"{folder}/to", table, f"{folder}/checkpoint")])
    Segments(spark, f"{folder}/segments").write(spark.range(5), "keys", 0)
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before
    assert sinks.read_table(spark, f"{folder}/to", table).count() == 100
    for root in ("to", "segments/keys"):
        assert any(p.name.endswith(".zstd.parquet") for p in Path(folder, root).rglob("part-*"))


def test_texts_of_known_members_are_parsed_once_and_equal_the_long_way(spark):
    row = '{"customer_id":"1","region":"E: \'x\'","address":{"city":"c"}}'
    known = ['{"key":"a","value":{"customers":[%s,%s]}}' % (row, row), '{"customers":[%s]}' % row, "{}",
             '{"key":"b"},{"key":"c"}', '{"key":"d"}\n{"key":"e"}', '{"key":"a\\nb","value":{"returns":[]}}']
    others = ['{"key":"a","more":1}', '{"key":"a","value":{"more":{}}}', '{"key":"a","value":{"customers":[{"more":1}]}}',
              '{"key":"a","value":{"customers":[{"city":"c"}]}}', '{"customers":[{"customer_id":"1","address":{"more":"c"}}]}',
              '{"key":"a","more" :1}', "{'key':\"a\",'more':1}", '{"key":"a","key":"b"}', '{"key":null,"more":1}',
              '{"key":"a","x\\"key":1}', '{"key":"a","\\u006bey2":1}', '{"key":"say \\"key\\":"}', "null", "3", "[null]",
              '[{"key":"a"}]', '{"key":"a"},null', '{"key":"a"}],"documents":[{"key":"b"}', '{"key":"a"},{"key":',
              '{"key":"a"}]}', '{"customers":[{"credit_limit":"x"}]}', '{"customers":[3]}', '{"key":"a"} {"key":"b"}',
              '{"key":"end of documents"},', '{"_corrupt_record":"x"}', '{"key":"a","value":null}', " "]
    entities = tuple(LANDING_ENTITIES)
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(known + others)], "id INT, value STRING")
    found = split_documents(texts, entities)
    read = {r.id for r in found.filter("_known IS NOT NULL").collect()}
    assert read == set(range(len(known)))

    def rows(documents):
        return sorted(str(r) for r in parse_documents(documents, entities).collect())
    assert rows(found) == rows(split_documents(texts))
