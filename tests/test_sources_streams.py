"""Files, tables, documents and streams in a temporary folder."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pricetrail import schemas
from pricetrail.plans import QUERIES
from pricetrail.session import shared_root, work_path
from plans import files_read, scans
from pricetrail.sources import datasets, readers, store, writers
from pricetrail.streaming import jobs


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def document(version="2.1.0", **rows_):
    return json.dumps({"meta": {"schema_version": version}, "providers": [], "pricing": [{"pricing_id": k, "input_price": v} for k, v in rows_.items()]}, indent=1)


def test_history_scan_skips_malformed_files(spark, tmp_path, rows):
    write(tmp_path / "h/2026-08-21.json", document(a=1, b=2))
    write(tmp_path / "h/2026-08-22.json", '{"meta": {')
    write(tmp_path / "h/2026-08-23.json", json.dumps({"meta": {"schema_version": "1.2"}}))
    docs = readers.read_documents(spark, str(tmp_path / "h"))
    assert [str(r["date"]) for r in rows(readers.rejected_documents(docs.cache()))] == ["2026-08-22"]
    got = rows(readers.document_rows(readers.good_documents(docs)).orderBy("pricing_id"))
    assert [(str(r["date"]), r["pricing_id"], r["input_price"]) for r in got] == [("2026-08-21", "a", 1.0), ("2026-08-21", "b", 2.0)]
    assert {str(r["date"]): r["schema_version"] for r in rows(readers.schema_by_date(readers.good_documents(docs)))} == {"2026-08-21": "2.1.0", "2026-08-23": "1.2"}


def test_live_document_and_row_artifacts(spark, tmp_path, rows):
    assert readers.read_live(spark, str(tmp_path / "none.json")).count() == 0
    write(tmp_path / "live.json", document(a=1))
    assert readers.read_live(spark, str(tmp_path / "live.json")).count() == 1
    write(tmp_path / "r/bare.json", '[{"a": 1}, {"a": 2}]')
    write(tmp_path / "r/wrapped.json", '{"rows": [{"a": 3}]}')
    write(tmp_path / "r/empty.json", "{}")
    assert sorted(r["a"] for r in rows(readers.read_row_artifact(spark, str(tmp_path / "r"), "struct<a: int>"))) == [1, 2, 3]


def test_csv_is_text_until_cast(spark, tmp_path, rows):
    names = list(schemas.DONOR_CASTS)
    write(tmp_path / "d.csv", ",".join(names) + "\nD1,individual,openai,49.96,0.8,0.3,2025-01-26,monthly,030,2026-01-21,2026-02-20,1\n")
    text = readers.read_csv_strings(spark, str(tmp_path / "d.csv"), names)
    assert rows(text)[0]["billing_cycle_days"] == "030"
    (r,) = rows(readers.cast_columns(text, schemas.DONOR_CASTS))
    assert (float(r["monthly_budget"]), r["billing_cycle_days"], r["subscription_start_date"]) == (49.96, 30, dt.date(2025, 1, 26))
    bad = text.withColumn("monthly_budget", F.lit("x"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rows(readers.cast_columns(bad, schemas.DONOR_CASTS))
    assert rows(readers.cast_columns(bad, schemas.DONOR_CASTS, lenient=True))[0]["monthly_budget"] is None


def test_a_broken_dataset_leaves_the_others(spark, tmp_path, rows):
    """One scan loads all; a missing one, one with an unreadable file and an empty one are told apart."""
    schema, target = spark.range(1).schema, str(tmp_path / "out")
    paths = {n: str(tmp_path / n) for n in ("a", "b", "c", "d", "none", "gone")}
    for n, size in zip(("a", "b", "c", "d"), (3, 4, 5, 6)):
        spark.range(size).write.parquet(paths[n])
    spark.range(0).write.parquet(paths["none"])
    write(tmp_path / "c/part-broken.parquet", "no parquet file at all")
    got = {r["dataset_id"]: (r["status"], r["n_rows"]) for r in rows(datasets.load_datasets(spark, paths, target, schema))}
    assert got == {
        "a": ("loaded", 3), "b": ("loaded", 4), "c": ("FAILED_READ_FILE", 0), "d": ("loaded", 6),
        "none": ("loaded", 0), "gone": ("PATH_NOT_FOUND", 0)}
    seen = lambda: {r["dataset_id"]: r["count"] for r in rows(datasets.read_committed(spark, target, schema).groupBy("dataset_id").count())}
    assert seen() == {"a": 3, "b": 4, "d": 6}
    # A later load replaces a dataset; one that breaks now keeps its last good load.
    spark.range(9).write.mode("overwrite").parquet(paths["a"])
    write(tmp_path / "b/part-broken.parquet", "x")
    datasets.load_datasets(spark, {n: paths[n] for n in ("a", "b")}, target, schema)
    assert seen() == {"a": 9, "b": 4, "d": 6}


def test_malformed_records_break_their_dataset_only(spark, tmp_path, rows):
    schema = spark.createDataFrame([], "id int, name string").schema
    write(tmp_path / "good.json", '{"id": 1, "name": "x"}\n{"id": 2}\n')
    write(tmp_path / "bad.json", '{"id": 1}\n{"id": \n')
    paths = {n: str(tmp_path / f"{n}.json") for n in ("good", "bad")}
    report = {r["dataset_id"]: r["status"] for r in rows(datasets.load_datasets(spark, paths, str(tmp_path / "out"), schema, "json"))}
    assert report["good"] == "loaded" and report["bad"] != "loaded"
    assert sorted((r["dataset_id"], r["id"]) for r in rows(datasets.read_committed(spark, str(tmp_path / "out"), schema))) == [("good", 1), ("good", 2)]


def test_usage_staging(spark, rows):
    doc = {"session_id": "s", "start_time": "2026-01-01T10:00:00Z", "messages": [1, 2], "stats": {"input_tokens": 5}}
    raw = spark.createDataFrame([("d", json.dumps(doc)), (None, json.dumps(doc))], "dataset_id string, payload string")
    (r,) = rows(readers.stage_usage(raw).withColumn("messages", F.to_json("messages")))
    assert (r["start_time"], r["input_tokens"], r["output_tokens"], r["messages"]) == (dt.datetime(2026, 1, 1, 10), 5, None, "[1,2]")
    readers.staging_views(spark.range(2), readers.stage_usage(raw))
    assert spark.sql("SELECT count(*) AS n FROM stg_usage WHERE session_id IS NOT NULL").first().n == 1


def payloads(spark, *pairs):
    df = spark.createDataFrame(list(pairs), "ord int, payload string")
    return df.select(writers.content_hash(F.col("payload")).alias("content_sha256"), "ord", "payload")


def test_insert_if_absent_is_idempotent(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = payloads(spark, (3, "a"), (1, "a"), (2, "b"))
    for _ in range(2):
        writers.insert_if_absent(first, path, "ord")
    writers.insert_if_absent(payloads(spark, (0, "a"), (9, "c")), path, "ord")
    assert sorted((r["ord"], r["payload"]) for r in rows(spark.read.parquet(path))) == [(1, "a"), (2, "b"), (9, "c")]


def test_insert_if_absent_takes_a_null_payload_once(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for _ in range(3):
        writers.insert_if_absent(payloads(spark, (2, None), (1, None), (3, "a")), path, "ord")
    assert sorted((r["ord"], r["payload"]) for r in rows(spark.read.parquet(path))) == [(1, None), (3, "a")]


def test_a_small_batch_reads_only_its_hash_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    many = payloads(spark, *[(i, f"text {i}") for i in range(2000)])
    writers.insert_if_absent(many, path, "ord")
    whole = files_read(writers.known_hashes(many, path))
    batch = payloads(spark, (5, "text 5"), (9001, "new"), (9002, "newer"))
    few = files_read(writers.known_hashes(batch, path))
    assert whole >= 256 and few <= 3 * whole / 256 + 3
    for _ in range(2):
        writers.insert_if_absent(batch, path, "ord")
    assert spark.read.parquet(path).count() == 2002
    # Digits that look like a number stay text.
    assert all(r["prefix"].startswith("h") for r in spark.read.parquet(path).select("prefix").distinct().collect())


def test_history_reads_only_the_days_it_needs(spark, rows):
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 20).cast("int"))
    path, schema = store.stored(spark.range(200).select(day.alias("date"), "id"))
    every = store.read_history(spark, path, schema)
    assert files_read(every) == 20
    assert scans(store.read_history(spark, path, schema, "2026-01-15", "2026-01-16")) == [(2, 20)]
    days = spark.range(3).select(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") * 2).cast("int")).alias("date"))
    assert scans(store.rows_on_days(every, days)) == [(3, 30)]
    assert [len(rows(d)) for d in store.last_days(spark, path, schema, 2)] == [10, 10]
    assert [str(d) for d in store.history_days(spark, path, schema)][-1] == "2026-01-20"
    short = store.last_days(spark, str(path) + "-none", schema, 2)
    assert [d.count() for d in short] == [0, 0]


def test_upserts_read_only_the_days_of_a_batch(spark):
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 20).cast("int"))
    path, schema = store.stored(spark.range(200).select(day.alias("date"), "id"))
    batch = spark.range(2).select(day.alias("date"), "id")
    assert sum(f for f, _ in scans(jobs._rows_of_days(store.read_history(spark, path, schema), batch, "date"))) == 2


def test_log_appends_with_new_ids(spark, tmp_path, rows):
    docs = spark.createDataFrame([("x", "2026-01-01T00:00:00Z"), ("x", None)], "payload string, scraped_at string")
    for run in ("r1", None):
        writers.append_log(docs, str(tmp_path / "log"), run)
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 4 and log.select("snapshot_id").distinct().count() == 4 and log.select("content_sha256").distinct().count() == 1
    assert log.filter("scraped_at IS NULL").count() == 0


def test_replace_days_leaves_others(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    kind = "date date, pricing_id string, v int"
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    writers.replace_days(spark.createDataFrame([(d1, "a", 1), (d2, "a", 2), (d2, "b", 3)], kind), path)
    for _ in range(2):
        writers.replace_days(spark.createDataFrame([(d2, "a", 9)], kind), path)
    assert sorted((r["date"], r["pricing_id"], r["v"]) for r in rows(spark.read.parquet(path))) == [(d1, "a", 1), (d2, "a", 9)]


def test_document_parts_and_fingerprints(spark, tmp_path, rows):
    df = spark.range(250).select(
        F.lit("2026-01-01").cast("date").alias("date"), F.format_string("p%03d", "id").alias("pricing_id"), F.col("id").cast("double").alias("input_price"))
    meta = writers.document_meta(F.lit("2026-01-01T00:00:00Z"))
    providers = F.array(F.struct(*[F.lit("x").alias(n) for n in schemas.PROVIDER.names]))
    docs = writers.build_documents(df, meta, providers, "pricing_id", rows_per_part=100)
    sizes = [len(r["pricing"]) for r in rows(docs)]
    assert sum(sizes) == 250 and len(sizes) == 3
    assert all([p["pricing_id"] for p in r["pricing"]] == sorted(p["pricing_id"] for p in r["pricing"]) for r in rows(docs))
    writers.write_documents(docs, str(tmp_path / "docs"))
    back = readers.document_rows(readers.good_documents(readers.read_document_lines(spark, str(tmp_path / "docs"))))
    assert back.count() == 250 and back.agg(F.sum("input_price")).first()[0] == sum(range(250))
    days = df.unionByName(df.withColumn("date", F.lit("2026-01-02").cast("date")).orderBy(F.rand(1))).unionByName(
        df.withColumn("date", F.lit("2026-01-03").cast("date")).withColumn("input_price", F.when(F.col("pricing_id") == "p007", 7.5).otherwise(F.col("input_price"))))
    out = writers.snapshots_to_write(writers.fingerprints(days, ["pricing_id", "input_price"])).orderBy("date")
    assert [r["changed"] for r in rows(out)] == [True, False, True]


def test_document_prints_name_the_provider_that_changed(spark, rows):
    days = [dt.date(2026, 1, d) for d in (1, 2, 3, 5)]
    price = lambda d, p, i, v: (days[d], p, i, v)
    pricing = spark.createDataFrame([
        price(0, "a", "x", 1.0), price(0, "a", "y", 2.0), price(0, "b", "z", 3.0),
        price(1, "a", "y", 2.0), price(1, "a", "x", 1.0), price(1, "b", "z", 3.0),
        price(2, "a", "x", 1.0), price(2, "a", "y", 9.0), price(2, "b", "z", 3.0), price(2, "c", "n", None),
        price(3, "a", "x", 1.0), price(3, "a", "y", 9.0), price(3, "c", "n", None),
    ], "date date, provider_id string, pricing_id string, input_price double")
    names = [(d, p, "B2" if (p, d) == ("b", days[2]) else p) for d in days for p in "abc" if p != "b" or d != days[3]]
    providers = spark.createDataFrame([n for n in names if n[1] != "c" or n[0] >= days[2]], "date date, provider_id string, name string")
    prints = writers.document_prints(pricing, ["pricing_id", "input_price"], providers, ["provider_id", "name"])
    got = {(r["date"], r["provider_id"]): r["change"] for r in rows(writers.provider_changes(prints))}
    assert got == {
        (days[0], "a"): "added", (days[0], "b"): "added", (days[1], "a"): "same", (days[1], "b"): "same",
        (days[2], "a"): "changed", (days[2], "b"): "changed", (days[2], "c"): "added",
        (days[3], "a"): "same", (days[3], "b"): "removed", (days[3], "c"): "same"}
    assert [r["changed"] for r in rows(writers.snapshots_to_write(prints).orderBy("date"))] == [True, False, True, True]


def test_incidents_move_between_days(spark, tmp_path, rows):
    kind, path = "run_id string, status string, finished_at string", str(tmp_path / "i")
    held = lambda: sorted((r["run_id"], r["status"], r["day"]) for r in rows(spark.read.schema(kind + ", day string").json(path)))
    df = spark.createDataFrame([("a", "failed", "2026-01-01T10"), ("b", "success", "2026-01-01T11"), ("c", "escalated", "2026-01-02T10"), ("a", "degraded", "2026-01-01T09")], kind)
    for _ in range(2):
        writers.incidents_by_day(df, path)
    assert held() == [("a", "failed", "2026-01-01"), ("c", "escalated", "2026-01-02")]
    writers.incidents_by_day(df.filter("run_id = 'b'").withColumn("status", F.lit("degraded")), path)
    assert ("b", "degraded", "2026-01-01") in held()
    # Run again on another day: c moves, a ends well and leaves; no day keeps the old rows.
    later = spark.createDataFrame([("c", "failed", "2026-01-04T10"), ("a", "success", "2026-01-03T10")], kind)
    for _ in range(2):
        writers.incidents_by_day(later, path)
    assert held() == [("b", "degraded", "2026-01-01"), ("c", "failed", "2026-01-04")]
    assert [r["run_id"] for r in rows(writers.latest_incident(df))] == ["c"] and rows(writers.latest_incident(df.limit(0))) == []


def test_latest_version_of_a_day(spark, rows):
    v = spark.createDataFrame([("v1", dt.datetime(2026, 1, 1, 9)), ("v2", dt.datetime(2026, 1, 1, 23)), ("v3", dt.datetime(2026, 1, 2, 1))], "id string, at timestamp")
    assert sorted(r["id"] for r in rows(writers.latest_per_day(v, "at", ["id"], ["id"]))) == ["v2", "v3"]


def test_shared_folder_comes_from_the_session(spark):
    root = shared_root(spark)
    assert work_path(spark, "x").startswith(root) and work_path(spark, "x") != work_path(spark, "x")


def events(spark, path, *batches):
    kind = "pricing_id string, ts timestamp, ord int, value double"
    for b in batches:
        data = [(p, dt.datetime.fromisoformat(t), o, v) for p, t, o, v in b]
        spark.createDataFrame(data, kind).coalesce(1).write.mode("append").parquet(str(path))
    return jobs.read_files(jobs.streaming_session(spark), str(path), spark.read.parquet(str(path)).schema, files_per_batch=1)


def test_streamed_ingest_equals_batch(spark, tmp_path, rows):
    for batch in ([(1, "a"), (2, "b")], [(3, "a"), (4, "c")]):
        payloads(spark, *batch).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.read_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, files_per_batch=1)
    for _ in range(2):
        jobs.finish(jobs.ingest_once(stream, str(tmp_path / "out"), "ord", str(tmp_path / "ck")))
    assert sorted(r["payload"] for r in rows(spark.read.parquet(str(tmp_path / "out")))) == ["a", "b", "c"]


def test_streamed_upsert_touches_only_its_days(spark, tmp_path, rows):
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    kind = "date date, k string, ord int, v int"
    for batch in ([(d1, "a", 0, 1), (d1, "b", 1, 2), (d2, "a", 2, 3)], [(d1, "b", 3, 20), (d1, "b", 4, 30), (d1, "c", 5, 4)]):
        spark.createDataFrame(batch, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.read_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, files_per_batch=1)
    jobs.finish(jobs.upsert_days(stream, str(tmp_path / "out"), ["date", "k"], ["ord"], str(tmp_path / "ck")))
    got = {(r["date"], r["k"]): r["v"] for r in rows(spark.read.parquet(str(tmp_path / "out")))}
    assert got[(d1, "a")] == 1 and got[(d2, "a")] == 3 and got[(d1, "c")] == 4 and got[(d1, "b")] in (2, 20, 30) and len(got) == 4


def test_streamed_upsert_keeps_stored_rows_without_a_day(spark, tmp_path, rows):
    kind, day = "date date, k string, ord int, v int", dt.date(2026, 1, 1)
    writers.replace_days(spark.createDataFrame([(None, "a", 0, 1), (None, "b", 1, 2), (day, "c", 2, 3)], kind), str(tmp_path / "out"))
    spark.createDataFrame([(None, "a", 5, 10)], kind).write.parquet(str(tmp_path / "in"))
    stream = jobs.read_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    for n in range(2):
        jobs.finish(jobs.upsert_days(stream, str(tmp_path / "out"), ["date", "k"], ["ord"], str(tmp_path / f"ck{n}")))
    got = {(r["date"], r["k"]): r["v"] for r in rows(spark.read.schema(kind).parquet(str(tmp_path / "out")))}
    assert got == {(None, "a"): 10, (None, "b"): 2, (day, "c"): 3}


def test_a_day_in_two_batches_keeps_both_parts(spark, tmp_path, rows):
    kind, day = "date date, k string, ord int, v int", dt.date(2026, 1, 1)
    for batch in ([(day, "a", 0, 1), (day, "b", 1, 2)], [(day, "c", 2, 3)]):
        spark.createDataFrame(batch, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    stream = jobs.read_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, files_per_batch=1)
    jobs.finish(jobs.replace_days(stream, out, ["date", "k"], ["ord"], ck))
    assert sorted(r["k"] for r in rows(spark.read.parquet(out))) == ["a", "b", "c"]
    # A later run brings the day anew and replaces it.
    spark.createDataFrame([(day, "d", 9, 9)], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    jobs.finish(jobs.replace_days(stream, out, ["date", "k"], ["ord"], ck))
    assert [r["k"] for r in rows(spark.read.parquet(out))] == ["d"]


def test_a_stream_goes_on_after_a_day_is_closed(spark, tmp_path, rows):
    """Days are reported when closed, the next day joins on the same checkpoint, late rows go aside."""
    session = jobs.streaming_session(spark)
    kind = "pricing_id string, ts timestamp, ord int, value double"
    schema = session.createDataFrame([], kind).schema
    at = {n: str(tmp_path / n) for n in ("in", "closing", "ontime", "late", "split", "out", "state")}
    session.createDataFrame([], kind).write.parquet(at["in"])
    whole = jobs.closable(jobs.read_files(session, at["in"], schema), at["closing"])
    hour = dt.timedelta(hours=1)

    def step(*data, close=None):
        made = [(p, dt.datetime.fromisoformat(t), o, v) for p, t, o, v in data]
        session.createDataFrame(made, kind).coalesce(1).write.mode("append").parquet(at["in"])
        if close:
            jobs.close_day(session, at["closing"], schema, "ts", dt.date.fromisoformat(close), hour)
        jobs.finish(jobs.split_late(whole, "ts", hour, at["ontime"], at["late"], at["split"]))
        on_time = jobs.read_on_time(session, at["ontime"], whole.schema)
        query = jobs.to_table(jobs.price_alerts(on_time, "1 hour"), at["out"], at["state"])
        jobs.finish(query)
        assert jobs.late_rows(query) == 0
        out = rows(spark.read.schema(jobs.ALERTS).parquet(at["out"]))
        return sorted((r["pricing_id"], str(r["date"]), r["from_value"], r["to_value"]) for r in out)

    assert step(("a", "2026-01-01T01:00", 0, 1.0), ("a", "2026-01-02T23:59", 1, 2.0), ("b", "2026-01-02T05:00", 2, 5.0)) == []
    first = [("a", "2026-01-02", 1.0, 2.0)]
    assert step(close="2026-01-02") == first
    # The next day begins at once; a row of a closed day, however new, is put aside.
    assert step(("a", "2026-01-03T00:00", 3, 3.0), ("a", "2026-01-02T23:59", 4, 9.0), ("b", "2026-01-03T01:00", 5, 5.0)) == first
    assert [(r["pricing_id"], r["value"]) for r in rows(jobs.read_late(session, at["late"], whole.schema))] == [("a", 9.0)]
    # A row of the open day that is behind others of it is in time.
    assert step(("b", "2026-01-03T00:10", 6, 4.0), ("b", "2026-01-03T02:00", 7, 6.0), close="2026-01-03") == [
        *first, ("a", "2026-01-03", 2.0, 3.0), ("b", "2026-01-03", 5.0, 6.0)]
    assert len(rows(jobs.read_late(session, at["late"], whole.schema))) == 1


def test_alerts_keep_state_between_batches_and_drop_late_days(spark, tmp_path, rows):
    stream = events(
        spark, tmp_path / "in",
        [("a", "2026-01-01T01:00", 0, 1.0), ("a", "2026-01-01T02:00", 1, 2.0), ("b", "2026-01-02T01:00", 2, 5.0)],
        [("a", "2026-01-03T01:00", 3, 4.0), ("a", "2026-01-03T01:00", 4, 3.0), ("b", "2026-01-03T02:00", 5, 5.0)],
        [("z", "2026-01-09T01:00", 6, 0.0)],
    )
    jobs.finish(jobs.to_table(jobs.price_alerts(stream, "0 seconds"), str(tmp_path / "out"), str(tmp_path / "ck")))
    out = rows(spark.read.schema(jobs.ALERTS).parquet(str(tmp_path / "out")))
    assert [(r["pricing_id"], str(r["prev_date"]), str(r["date"]), r["from_value"], r["to_value"]) for r in out] == [
        ("a", "2026-01-01", "2026-01-03", 2.0, 3.0)]


def test_bounded_ingest_drops_copies_in_the_watermark(spark, tmp_path, rows):
    stream = events(spark, tmp_path / "in", [("a", "2026-01-01T01:00", 0, 1.0), ("a", "2026-01-01T01:01", 1, 1.0), ("b", "2026-01-01T01:02", 2, 1.0)])
    hashed = stream.withColumn("content_sha256", F.sha2("pricing_id", 256))
    jobs.finish(jobs.to_table(jobs.ingest_once_bounded(hashed, "ts", "1 hour"), str(tmp_path / "out"), str(tmp_path / "ck")))
    assert sorted(r["pricing_id"] for r in rows(spark.read.parquet(str(tmp_path / "out")))) == ["a", "b"]


@pytest.mark.parametrize("name", ["stream_insert_if_absent", "stream_replace_day", "stream_upsert"])
def test_streams_read_tables_of_one_file_and_of_part_files(spark, tmp_path, name):
    at = dt.datetime(2026, 1, 1)
    documents = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(8)], "doc_id long, text string")
    events = spark.createDataFrame(
        [(i, at + dt.timedelta(hours=i), i % 2, "view", float(i)) for i in range(8)],
        "event_id long, ts timestamp, user_id long, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    found = {}
    for kind, files in (("one", 1), ("parts", 3), ("empty", 1)):
        for table, df in (("documents", documents), ("events", events)):
            path = tmp_path / kind / f"{table}.parquet"
            (df.filter("false") if kind == "empty" else df.repartition(files)).write.parquet(str(path if kind != "one" else f"{path}-parts"))
            if kind == "one":
                (part,) = (tmp_path / kind / f"{table}.parquet-parts").glob("part-*.parquet")
                part.rename(path)
        found[kind] = sorted(map(tuple, QUERIES[name](spark, str(tmp_path / kind)).collect()))
    assert len(found["one"]) == 2 and found["parts"] == found["one"] and found["empty"] == []


def test_moves_meet_the_values_held_and_can_be_written_again(spark, tmp_path, rows):
    target, ck = str(tmp_path / "out"), tmp_path / "ck"
    kind = "pricing_id string, date date, value double"

    def step(*data):
        made = [(p, dt.date.fromisoformat(d), v) for p, d, v in data]
        spark.createDataFrame(made, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run()
        return read()

    def run():
        stream = jobs.read_files(jobs.streaming_session(spark), str(tmp_path / "in"), spark.createDataFrame([], kind).schema)
        jobs.finish(jobs.write_moves(stream, target, str(ck)))

    def read():
        out = rows(jobs.read_moves(spark, target))
        return sorted((r["pricing_id"], str(r["prev_date"]), str(r["date"]), r["from_value"], r["to_value"]) for r in out)

    assert step(("a", "2026-01-01", 1.0)) == []
    first = [("a", "2026-01-02", "2026-01-03", 1.0, 2.0)]
    assert step(("a", "2026-01-02", 1.0), ("a", "2026-01-03", 2.0), ("b", "2026-01-03", 5.0), ("c", "2026-01-03", None)) == first
    # Days not after the one held are ignored, and ids that a batch lacks are kept.
    assert step(("a", "2026-01-03", 9.0), ("a", "2026-01-02", 8.0), ("c", "2026-01-04", 1.0)) == first
    both = [*first, ("a", "2026-01-03", "2026-01-05", 2.0, 4.0), ("b", "2026-01-03", "2026-01-06", 5.0, 6.0)]
    assert step(("a", "2026-01-05", 4.0), ("b", "2026-01-06", 6.0), ("c", "2026-01-06", 1.0)) == both
    assert len(list((tmp_path / "ck-held").glob("batch=*"))) == 2
    # A batch whose end was not recorded is run again.
    for name in ("3", ".3.crc"):
        (ck / "commits" / name).unlink(missing_ok=True)
    run()
    assert read() == both
    assert step(("a", "2026-01-07", 4.0), ("b", "2026-01-07", 7.0)) == [*both, ("b", "2026-01-06", "2026-01-07", 6.0, 7.0)]
