"""Runs that follow one another: resumed publishing, merged responses, streams, long galleries, look-ups."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from excursio.operators import gallery_rows, publish, records, responses
from excursio.settings import Settings
from excursio.sources.sinks import look_up, write_clustered
from excursio.streaming import responses as streams
from excursio.workload.records import S, raw_from_orders

SF = "/root/testdata/sf0.001"
LATER = Settings(provider="Demo", run_ts=datetime(2027, 1, 1))
CAPTURED = "page_id bigint, seq bigint, url string, status int, content_type string, body string, captured_at timestamp"


def requests(spark, settings=S):
    raw = raw_from_orders(spark, SF).where("page_id < 40")
    return publish.outbox(records.bundle(raw, settings), "https://api.example.com/")


def test_outbox_bodies_are_whole_records(spark):
    raw = raw_from_orders(spark, SF).where("page_id < 40")
    b = records.bundle(raw, S)
    got = {(r.page_id, r.stage, r.n): r for r in publish.outbox(b).collect()}
    options = "map('timestampFormat', \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\", 'timeZone', 'UTC', 'ignoreNullFields', 'false')"
    rows = b.selectExpr(
        "page_id", f"to_json(activity, {options}) AS a", f"transform(plans, p -> to_json(p, {options})) AS p",
        f"transform(gallery, g -> to_json(g, {options})) AS g").collect()
    want = {}
    for r in rows:
        for stage, bodies in ((1, [r.a]), (2, r.p), (3, r.g)):
            want.update({(r.page_id, stage, n): body for n, body in enumerate(bodies, 1)})
    assert {k: r.body for k, r in got.items()} == want
    assert all(("created_at" in json.loads(r.body)) == (r.stage != 2) for r in got.values())


def test_outbox_works_bundles_out_once(spark):
    plan = requests(spark)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_outbox_without_lists(spark):
    b = records.bundle(raw_from_orders(spark, SF).where("page_id < 10"), S)
    kinds = {f.name: f.dataType.simpleString() for f in b.schema.fields}
    bare = b.withColumn("plans", F.expr(f"CAST(NULL AS {kinds['plans']})")).withColumn("gallery", F.expr(f"CAST(array() AS {kinds['gallery']})"))
    assert {r.stage for r in publish.outbox(bare).collect()} == {1}
    assert publish.outbox(b.limit(0)).count() == 0


def test_digest_is_free_of_the_run(spark):
    now, later = ({(r.page_id, r.stage, r.n): r for r in requests(spark, s).collect()} for s in (S, LATER))
    assert {k: r.digest for k, r in now.items()} == {k: r.digest for k, r in later.items()}
    assert any(now[k].body != later[k].body for k in now)


@pytest.mark.parametrize("results, left", [
    ([], 3),
    ([("s", 1, 1, 200, "a", 1)], 2),
    ([("s", 1, 1, 500, "a", 1)], 3),
    ([("s", 1, 1, 500, "a", 1), ("s", 1, 1, 201, "a", 2)], 2),
    ([("s", 1, 1, 201, "a", 1), ("s", 1, 1, 500, "a", 2)], 3),
    ([("s", 1, 1, 201, "a", 1), ("s", 1, 1, 201, "b", 2)], 3),  # changed and changed back
    ([("s", 1, 1, 201, "a", 1), ("s", 1, 1, 500, "a", 1)], 3),  # at the same time
    ([("s", 1, 1, None, "a", 1)], 3),
    ([(None, 2, 1, 200, "c", 1)], 2),
    ([("s", 1, 1, 200, "a", 1), ("s", 1, 2, 299, "b", 1), (None, 2, 1, 200, "c", 1), ("t", 1, 1, 200, "x", 1)], 0),
])
def test_pending(spark, results, left):
    box = spark.createDataFrame(
        [("s", 1, 1, "a", 7), ("s", 1, 2, "b", 7), (None, 2, 1, "c", 8)], "slug string, stage int, n int, digest string, page_id bigint")
    done = spark.createDataFrame(results, "slug string, stage int, n int, status int, digest string, at int")
    assert publish.pending(box, done).count() == left
    twice = publish.pending(box.union(box), done)
    assert twice.count() == 2 * left and twice.columns == box.columns


def test_pending_writes_and_moves_no_bodies(spark, monkeypatch):
    from excursio.workload import runs

    monkeypatch.setattr(runs, "kept", lambda *a: pytest.fail("requests are written"))
    assert runs.publish_pending(spark, SF).count() > 0


def test_pending_sends_no_results_to_the_driver(spark):
    from excursio.workload import runs

    df = runs.publish_pending(spark, SF)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") not in ("-1", "-1b")
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    box = spark.range(3).selectExpr("'s' AS slug", "1 AS stage", "id AS n", "'a' AS digest", "id AS page_id")
    left = publish.pending(box, box.selectExpr("slug", "stage", "n", "digest", "IF(n = 2, 500, 200) AS status", "1 AS at"))
    assert [r.page_id for r in left.collect()] == [2]
    assert "Broadcast" not in left._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("body", [False, True])
def test_pending_of_null_keys_and_digests(spark, body):
    box = spark.createDataFrame([(None, None, 1, None, 7), ("s", 1, 1, "a", 8)], "slug string, stage int, n int, digest string, page_id bigint")
    box = box.withColumn("body", F.lit("{}")) if body else box
    done = spark.createDataFrame([(None, None, 1, 200, None, 1)], "slug string, stage int, n int, status int, digest string, at int")
    assert [r.page_id for r in publish.pending(box, done).collect()] == [8]


def capture(page, seq, hour, body='{"data":[{"date":"d1","minPrice":5,"capacity":2}]}', url="https://h/api/bookabledates?id=1"):
    return (page, seq, url, 200, "application/json", body, datetime(2026, 1, 1, hour))


def test_merged_latest_in_any_order_and_twice(spark, tmp_path):
    rows = [(1, s, f"https://h/{s % 2}", 200, "application/json", f'{{"n":{s}}}') for s in range(6)] + [(2, 9, "https://h/x", 200, "application/json", "[]")]
    df = spark.createDataFrame(rows, streams.RESPONSES)
    latest = lambda d: responses.api_latest(responses.api_keep(d))
    shown = lambda d: sorted(d.selectExpr("page_id", "key", "pos", "seq", "to_json(data)").collect())
    at = str(tmp_path / "t")
    assert streams.latest_table(spark, at).count() == 0
    streams.merge_latest(latest(df.limit(0)), at, 4)
    assert streams.latest_table(spark, at).count() == 0
    for part in ("seq > 3", "seq < 2", "seq BETWEEN 2 AND 3", "seq > 3"):
        streams.merge_latest(latest(df.where(part)), at)
    assert shown(streams.latest_table(spark, at)) == shown(latest(df))


def test_priced_stream_equals_batch(spark, tmp_path):
    """Pages get the pricing of their own load; those without come out once the watermark has passed them."""
    captured = [
        capture(1, 1, 1, '{"data":[{"date":"old","minPrice":1}]}'), capture(1, 2, 1), capture(1, 3, 1, '{"data":[]}', "https://h/api/bookabledates?id=2"),
        capture(2, 4, 1, "{bad"), capture(3, 5, 2, '{"data":[{"date":"x","minPrice":"9"}]}'), capture(1, 6, 4, '{"data":[{"date":"d2","minPrice":8}]}'),
        capture(9, 7, 20),
    ]
    pages = [(1, "u1", datetime(2026, 1, 1, 1)), (2, "u2", datetime(2026, 1, 1, 1)), (3, "u3", datetime(2026, 1, 1, 2)),
             (1, "u1", datetime(2026, 1, 1, 4)), (4, "u4", datetime(2026, 1, 1, 5)), (9, "u9", datetime(2026, 1, 1, 20))]
    for name, rows, schema in (("r", captured, CAPTURED), ("p", pages, "page_id bigint, url string, captured_at timestamp")):
        for hour in sorted({r[-1] for r in rows}):
            spark.createDataFrame([r for r in rows if r[-1] == hour], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    page_rows = spark.readStream.schema("page_id bigint, url string, captured_at timestamp").parquet(str(tmp_path / "p"))
    out = streams.priced_stream(page_rows, streams.pricing_stream(streams.response_stream(spark, str(tmp_path / "r"), timed=True)))
    place = str(tmp_path / "out")
    for _ in range(3):  # further starts, to let the watermark pass through the steps
        q = out.writeStream.format("parquet").option("path", place).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination(240)
    got = {(r.page_id, r.captured_at.hour): r._pricing and (r._pricing.minPrice, r._pricing.bookableDates[0].date) for r in spark.read.parquet(place).collect()}
    want = {(1, 1): (5.0, "d1"), (2, 1): None, (3, 2): (None, "x"), (1, 4): (8.0, "d2"), (4, 5): None}
    assert {k: v for k, v in got.items() if k[0] != 9} == want
    for hour in (1, 2, 4):
        df = spark.createDataFrame([r for r in captured if r[-1].hour == hour], CAPTURED).drop("captured_at")
        batch = responses.api_pricing(responses.api_latest(responses.api_keep(df))).collect()
        assert {r.page_id: (r.minPrice, r.bookableDates[0].date) for r in batch} == {p: v for (p, h), v in want.items() if h == hour and v}


def test_long_gallery_of_one_large_page(spark):
    raw = raw_from_orders(spark, SF).where("page_id < 10")
    facts, small = gallery_rows.page_facts(raw, S), gallery_rows.page_images(raw)
    many = spark.range(5000).selectExpr(
        "1L AS page_id", "3 AS part", "1000 + id AS pos", "concat('https://c.example.com/', id % 4000, '.jpg') AS url",
        "CAST(NULL AS STRING) AS alt", "'T' AS title", "CAST(NULL AS STRING) AS caption", "CAST(NULL AS STRING) AS type")
    got = gallery_rows.gallery_of(small.union(many), facts, block=64)
    plain = records.gallery(raw, S)
    rows = [r for r in got.collect() if r.page_id == 1]
    before = plain.where("page_id = 1").count()
    assert sorted(r.order for r in rows) == list(range(1, before + 4001))
    tail = sorted((r.order, r.url) for r in rows)[before:]
    assert [u for _, u in tail] == [f"https://c.example.com/{k}.jpg" for k in range(4000)]
    others = lambda d: sorted(map(str, d.where("page_id <> 1").select(*plain.columns).withColumns({c: F.col(c).cast("bigint") for c in ("id", "order")}).collect()))
    assert others(got) == others(plain)
    assert gallery_rows.gallery_of(small.limit(0), facts).count() == 0


def scanned_rows(df):
    """Rows that the scan of a frame gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_look_up_reads_little(spark, tmp_path):
    rows = spark.range(80_000).selectExpr("id AS page_id", "concat('s', lpad(id % 8000, 6, '0')) AS slug").union(
        spark.range(20_000).selectExpr("id + 1000000 AS page_id", "'hot' AS slug"))
    at = str(tmp_path / "t")
    write_clustered(rows, at, "slug", 20)
    table = spark.read.parquet(at)
    wanted = spark.createDataFrame([("s000007",), ("s000009",), ("none",), (None,)], "slug string")
    few = look_up(table, wanted, "slug")
    assert few.count() == 20
    assert scanned_rows(few) <= 15_000
    # the slug that a fifth of all rows share lies in several files
    assert table.where("slug = 'hot'").select(F.input_file_name()).distinct().count() >= 3
    every = table.select("slug").distinct()
    assert look_up(table, every, "slug").count() == 100_000
    assert look_up(table, wanted.limit(0), "slug").count() == 0


def test_look_up_of_many_values_is_a_join(spark, monkeypatch):
    from excursio.sources import sinks

    monkeypatch.setattr(sinks, "LISTED", 2)
    rows = spark.range(50).selectExpr("id AS page_id", "id % 10 AS slug")
    got = look_up(rows, spark.range(3), "slug")
    assert got.count() == 15 and got.columns == ["page_id", "slug"]


def test_images_of_raw_records_are_read_in_one_pass(spark, tmp_path):
    """Also of records without lists, of missing images in a list and of a list without any."""
    kind = "page_id bigint, hero {H}, gallery array<{I}>"
    image = "struct<url: string, alt: string, title: string, caption: string, type: string>"
    kind = kind.format(H=f"struct<coverImage: string, heroImage: string, images: array<{image}>>", I=image)
    a, b = ("u", "x", None, "c", "t"), ("v", None, "y", None, None)
    rows = [(1, ("c", "h", [a, None]), [b, a]), (2, None, None), (3, (None, "h", []), [None])]
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "raw"))
    images = gallery_rows.page_images(spark.read.parquet(str(tmp_path / "raw")))
    none = (None,) * 5
    want = [(1, 0, 0, "c", *none[1:]), (1, 1, 0, "h", *none[1:]), (1, 2, 0, *a), (1, 2, 1, *none), (1, 3, 0, *b), (1, 3, 1, *a),
            (2, 0, 0, *none), (2, 1, 0, *none), (3, 0, 0, *none), (3, 1, 0, "h", *none[1:]), (3, 3, 0, *none)]
    assert sorted(map(repr, map(tuple, images.collect()))) == sorted(map(repr, want))
    assert images.dtypes[:3] == [("page_id", "bigint"), ("part", "int"), ("pos", "bigint")]
    plan = images._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Union" not in plan
