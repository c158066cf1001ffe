"""Raw records to linked records, JSON sources, sinks and jobs."""

import json
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from excursio.functions.text import clean
from excursio.operators import linkage, publish, records, responses
from excursio.operators.unique_ids import changed_ids, resolved_ids
from excursio.plans.catalogue import build_catalogue
from excursio.settings import CATEGORY_RULES, Settings
from excursio.sources.records import json_text_rejects, raw_from_json_text, read_bundles, read_raw_json
from excursio.sources.sinks import merge_bundles, merged_bundles, open_bucketed, save_bucketed, write_bundles, write_table
from excursio.streaming.catalogue import page_stream, record_stream, write_stream

PAGES = "/root/testdata/sf0.001/pages.parquet"
MUSEUM = {
    "url": "https://x.example/kolkata/culture-and-heritage/city-museum", "slug": "city-museum",
    "hero": {"name": " City   Museum ", "city": "Kolkata", "category": "Culture And Heritage",
             "coverImage": "https://cdn/a.jpg", "heroImage": "https://cdn/b.jpg",
             "images": [{"url": "https://cdn/b.jpg", "alt": "B"}]},
    "gallery": [{"url": "https://cdn/b.jpg", "alt": "", "caption": ""}, {"url": "https://cdn/logo.png"},
                {"url": "https://cdn/arrow-down.png", "alt": "D"},
                {"url": "https://cdn/c.jpg", "alt": "", "caption": "C cap"}, "https://cdn/z.jpg"],
    "description": {"full": "Short text."}, "terms": ["Non-Refundable ticket", "Carry ID"],
    "highlights": ["H1"], "inclusions": ["I1"], "exclusions": [],
    "ticketPrices": {"prices": ["₹ 1,200"], "currency": "INR", "packageName": "Entry Ticket"},
    "location": {"address": "Main Road, Kolkata", "latitude": 22.5, "longitude": 88.3},
    "nearbyAttractions": [{"name": "Zoo", "url": "u", "image": "i"}, {"name": "", "url": "v"}],
    "timings": {"closedDays": "Monday"},
    "seo": {"title": "", "metaDescription": "", "openGraph": {"og:image": "https://cdn/a.jpg"}},
}


def bundles(spark, *recs, **kw):
    lines = spark.createDataFrame(
        [(i, json.dumps(r)) for i, r in enumerate(recs)], "page_id bigint, value string"
    )
    return records.bundle(raw_from_json_text(lines), **kw).orderBy("page_id")


def test_museum(spark):
    b = bundles(spark, MUSEUM, settings=Settings(provider="P")).first()
    a, p = b.activity, b.plans[0]
    assert (a.name, a.category, a.info, a.city_code) == ("City Museum", ["museums"], "Short text....", "KOL")
    assert a.listing_price.final_price == 1200 and a.cancellation_policy.refundable is False
    assert a.pois == ["Zoo"] and a.image_url == "https://cdn/b.jpg"
    assert p.id == a.id + 100 and p.activity_id == a.id and p.slug == "city-museum-entry-ticket"
    mon, tues = p.week_opening_info.Mon, p.week_opening_info.Tues
    assert not mon.is_Open and mon.timing_Slot_List == [] and mon.price_PerPerson.Adult.Male == 1200
    assert tues.is_Open and (tues.opening_Time, tues.closing_Time) == ("10:00 AM", "06:00 PM")
    assert [(g.url[12:], g.type, g.order) for g in b.gallery] == [
        ("a.jpg", "cover", 1), ("b.jpg", "hero", 2), ("arrow-down.png", "gallery", 3),
        ("c.jpg", "gallery", 4), ("z.jpg", "gallery", 5)]
    assert b.gallery[3].title == "C cap" and b.metadata.provider == "P"


@pytest.mark.parametrize("rec,activity,plan", [
    ({}, 0, 50), ({"ticketPrices": {"minPrice": 0}}, 0, 0), ({"ticketPrices": {"minPrice": "75"}}, 0, 50),
    ({"ticketPrices": {"prices": ["₹ 1.2.3"]}}, 1.2, 1.2), ({"ticketPrices": {"minPrice": 7.5, "prices": ["9"]}}, 7.5, 7.5),
])
def test_prices(spark, rec, activity, plan):
    b = bundles(spark, rec).first()
    assert b.activity.listing_price.final_price == activity
    assert b.plans[0].listing_price.final_price == plan


def test_defaults(spark):
    b = bundles(spark, {}).first()
    assert b.activity.category == ["attractions"] and b.activity.city == "Kolkata"
    assert b.plans[0].name == "Entry Ticket - Experience" and b.gallery == []
    assert b.metadata.scraped_at == Settings().run_iso


@pytest.mark.parametrize("name,category", [
    ("Airport Transport", "sports"), ("Airport Taxi", "transportation"), ("Comfort Stay", "historical-monuments"),
    ("Theme of the park", "theme-parks"), ("Sparkle", "parks"), ("Dinner", "attractions"),
])
def test_categories(spark, name, category):
    assert bundles(spark, {"hero": {"name": name}}).first().activity.category == [category]


@pytest.mark.parametrize("closed,days", [
    ("until sunset", ["Sun"]), ("Mon-Wed", ["Mon"]), ("wed", []), ("WEDNESDAY, Sat", ["Weds", "Sat"]), ("", []),
])
def test_closed_days(spark, closed, days):
    week = bundles(spark, {"timings": {"closedDays": closed}}).first().plans[0].week_opening_info
    assert [d for d in week.__fields__ if not week[d].is_Open] == days
    assert all(bool(week[d].timing_Slot_List) == week[d].is_Open for d in week.__fields__)


def test_rules_and_alt(spark):
    b = bundles(spark, {"rules": [], "terms": ["a"], "hero": {"name": "N"},
                        "gallery": [{"url": "https://c/x.jpg", "alt": " "}]}).first()
    assert b.activity.general_policy.rules == [] and b.activity.must_know == ["a"]
    assert b.gallery[0].title == "N"


def test_split_bundles_equals_the_single_tables(spark):
    lines = spark.createDataFrame([(1, json.dumps(MUSEUM)), (2, "{}")], "page_id bigint, value string")
    raw = raw_from_json_text(lines)
    for name, df in records.split_bundles(records.bundle(raw)).items():
        alone = getattr(records, name)(raw)
        assert df.columns == alone.columns
        as_text = "to_json(struct(*)) j"
        assert sorted(df.selectExpr(as_text).collect()) == sorted(alone.selectExpr(as_text).collect())


def test_caller_id(spark):
    assert bundles(spark, {}, custom_id="42").first().plans[0].id == 142
    generated = bundles(spark, {}).first().activity.id
    assert bundles(spark, {}, custom_id="0").first().activity.id == generated
    assert 1_000_000 <= generated <= 1_000_999_999


@given(st.text(alphabet="ab \t\n\u00a0\u2003\ufeff\u0085", max_size=30))
@settings(max_examples=25, deadline=None)
def test_clean(spark, s):
    got = spark.createDataFrame([(s,)], "x string").select(
        F.expr(clean("x")).alias("c")).select("c", F.expr(clean("c")).alias("cc")).first()
    plain = "".join(" " if ch in " \t\n\u00a0\u2003\ufeff" else ch for ch in s)
    assert got.c == " ".join(w for w in plain.split(" ") if w) and got.cc == got.c


def test_every_rule_word_reaches_a_category(spark):
    words = [(w if isinstance(w, str) else " ".join(w), to) for to, ws in CATEGORY_RULES for w in ws]
    got = bundles(spark, *[{"hero": {"name": w}} for w, _ in words]).select(
        F.col("activity.category")[0].alias("c")).collect()
    wrong = {w for (w, to), r in zip(words, got) if r.c != to}
    assert wrong == {"transport"}


RESPONSES = [
    (1, 1, "https://h/api/bookabledates?id=1", 200, "application/json",
     '{"data":[{"date":"2026-07-22","minPrice":80,"capacity":5},{"date":"2026-07-23","minPrice":60,"capacity":9}]}'),
    (1, 2, "https://h/data.json", 200, "application/json", "{}"),
    (1, 3, "https://h/api/x", 200, "text/html", None),
    (1, 4, "https://h/api/y", 200, "application/json; charset=utf-8", "{bad"),
    (1, 5, "https://h/track/event", 200, "application/json", "{}"),
    (1, 6, "https://other/api/bookabledates?id=1", 200, "application/json",
     '{"data":[{"date":"2026-07-24","minPrice":70,"capacity":1}]}'),
]


def test_responses(spark):
    df = spark.createDataFrame(
        RESPONSES, "page_id bigint, seq bigint, url string, status int, content_type string, body string")
    latest = responses.api_latest(responses.api_keep(df))
    assert {(r.key, r.pos, r.seq) for r in latest.collect()} == {
        ("/api/bookabledates?id=1", 1, 6), ("/track/event", 5, 5)}
    assert [r.seq for r in responses.api_strip(latest).collect()] == [6]
    p = responses.api_pricing(latest).first()
    assert (p.minPrice, p.capacity, len(p.bookableDates)) == (70, 1, 1)
    first = responses.api_pricing(responses.api_latest(responses.api_keep(df.filter("seq = 1")))).first()
    assert first.minPrice == 80


@pytest.mark.parametrize("results,want", [
    ([(1, 201), (2, 201), (3, 201)], (True, True, True, 1, 1, True)),
    ([(1, 409), (2, 201), (3, 201), (3, 201)], (False, True, True, 2, 2, False)),
    ([(1, 201), (3, 201), (3, 500)], (True, True, False, 1, 2, False)),
])
def test_outcome(spark, results, want):
    df = spark.createDataFrame(
        [("s", st_, i, code, "{}") for i, (st_, code) in enumerate(results)],
        "slug string, stage int, n int, status int, body string")
    assert tuple(publish.outcome(df).first())[1:] == want


def test_join_keeps_parents_without_children_and_deals_large_ones(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "page_id bigint, name string")
    g = spark.range(1000).selectExpr("CASE WHEN id < 900 THEN 1L ELSE 2L END AS page_id", "id")
    for how, extra in (("inner", 0), ("left", 1)):
        rows = linkage.join_children(a, g, ["page_id"], F.col("id"), how, small_group=50).collect()
        assert len(rows) == 1000 + extra
        assert {r.id for r in rows if r.page_id == 1} == set(range(900))
        assert [r.id for r in rows if r.page_id == 3] == [None] * extra


def test_raw_json_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(MUSEUM, indent=2))
    (tmp_path / "b.json").write_text(json.dumps({"activity": {}, "plans": []}))
    (tmp_path / "c.json").write_text("{damaged")
    (tmp_path / "d.json").write_text(json.dumps({**MUSEUM, "apiResponses": {"/a": {"url": "u", "status": 200, "data": {"x": 1}}}}))
    good, answers, bad = read_raw_json(spark, str(tmp_path))
    assert [r.slug for r in good.collect()] == ["city-museum"] * 2 and len({r.page_id for r in good.collect()}) == 2
    assert sorted(r.reason for r in bad.collect()) == ["no hero and no slug", "not JSON"]
    assert [(r.key, r.url, r.status) for r in answers.collect()] == [("/a", "u", 200)]
    good = good.limit(1)
    assert len(records.gallery(good).collect()) == 5


def test_no_json_file_is_lost(spark, tmp_path):
    off = {
        "a": ({"slug": "a", "hero": {}, "metadata": {"totalImages": "3"}}, None), "b": ({"slug": "b", "ticketPrices": {"prices": "5"}}, None),
        "c": ({"slug": "c", "hero": {"tags": "solo"}}, "hero.tags is not a list"), "d": ({"slug": "d"}, None),
        "e": ({"slug": "e", "gallery": [None]}, "gallery holds null"), "f": ([], "not an object"), "g": ([1], "not an object"),
        "h": ({}, "no hero and no slug"), "i": ({"slug": "i", "terms": [1]}, "terms holds what is no text"),
    }
    for name, (value, _) in off.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value, indent=1))
    (tmp_path / "z.json").write_text("\n")
    good, _, bad = read_raw_json(spark, str(tmp_path), str(tmp_path / "kept"))
    assert sorted(r.slug for r in good.collect()) == [n for n, (_, reason) in off.items() if reason is None]
    got = {(Path(r.file).stem, r.reason) for r in bad.collect()}
    assert got == {(n, reason) for n, (_, reason) in off.items() if reason} | {("z", "not JSON")}


def test_texts_that_are_no_record(spark):
    lines = spark.createDataFrame([(1, "not json"), (2, "[1]"), (3, "{}"), (4, None), (5, '{"hero": 5}')], "page_id long, value string")
    assert {(r.page_id, r.reason) for r in json_text_rejects(lines).collect()} == {
        (1, "not JSON"), (2, "not an object"), (4, "not JSON")}
    assert {r.page_id for r in raw_from_json_text(lines).collect()} == {3, 5}


def test_merge_keeps_the_slugs_of_other_runs(spark, tmp_path):
    at = str(tmp_path / "merged")

    def run(*recs):
        merge_bundles(bundles(spark, *recs), at, None if Path(at).exists() else 4)
        return {r.slug: r.scraped_at for r in merged_bundles(spark, at).collect()}

    def rec(slug, when):
        return {"slug": slug, "metadata": {"scrapedAt": when}}

    assert run(rec("a", "2026"), rec("b", "2026"), rec("c", "2026")) == {"a": "2026", "b": "2026", "c": "2026"}
    files = {f: f.stat().st_mtime_ns for f in Path(at).rglob("*.parquet")}
    assert run(rec("a", "2027"), rec("b", "2025")) == {"a": "2027", "b": "2026", "c": "2026"}
    touched = {f.parent for f in files if not f.exists()}
    assert all(f.stat().st_mtime_ns == t for f, t in files.items() if f.parent not in touched)
    assert run() == {"a": "2027", "b": "2026", "c": "2026"}
    with pytest.raises(ValueError):
        merge_bundles(bundles(spark, rec("a", "2028")), at, 8)


def test_pages_and_pricing_in_buckets_join_where_they_lie(spark, tmp_path):
    from excursio.operators.page_fields import extract
    from excursio.sources.pages import page_nodes

    pages = spark.read.parquet(PAGES).select("page_id", "url", "html")
    pricing = pages.where("page_id % 2 = 0").selectExpr(
        "page_id", "1.5D AS minPrice", "2D AS capacity", "array(named_struct('date', 'd', 'minPrice', 1.5D, 'capacity', 2D)) AS bookableDates")
    a = save_bucketed(pages, "test_pages", str(tmp_path / "pages"), 4)
    b = save_bucketed(pricing, "test_pricing", str(tmp_path / "pricing"), 4)
    priced = responses.price_pages(a, b)
    plan = priced._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ShuffledHashJoin" in plan
    want = responses.merge_pricing(extract(page_nodes(pages)), pricing)
    as_text = "to_json(struct(*)) j"
    assert sorted(extract(page_nodes(priced)).selectExpr(as_text).collect()) == sorted(want.selectExpr(as_text).collect())
    spark.sql("DROP TABLE test_pages")
    again = open_bucketed(spark, "test_pages", str(tmp_path / "pages"), 4)
    assert "Exchange" not in responses.price_pages(again, b)._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE test_pages")
    spark.sql("DROP TABLE test_pricing")


def test_resolved_ids_against_rounds_in_python(spark):
    import hashlib

    rows = [(i, "same" if i % 3 == 0 else f"u{i % 90}") for i in range(400)]
    span = 4000
    taken, want, todo, attempt = set(), {}, dict(rows), 0
    while todo:
        proposals = {}
        for page, key in todo.items():
            text = key if attempt == 0 else f"{key}#{page}#{attempt}"
            proposals[page] = 1_000_000 + int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % span
        first = {}
        for page in sorted(proposals):
            for slot in (proposals[page], proposals[page] + 100):
                first.setdefault(slot, page)
        won = {p: i for p, i in proposals.items() if all(s not in taken and first[s] == p for s in (i, i + 100))}
        for page, i in won.items():
            want[page] = (i, i + 100, attempt)
            taken |= {i, i + 100}
        todo = {p: k for p, k in todo.items() if p not in won}
        attempt += 1
    df = spark.createDataFrame(rows + rows[:5] + [(None, "x")], "page_id long, url string")
    resolved = resolved_ids(df, span=span)
    got = {r.page_id: (r.activity_id, r.plan_id, r.attempt) for r in resolved.collect()}
    assert got == want and attempt > 3
    ids = [i for a, p, _ in got.values() for i in (a, p)]
    assert len(ids) == len(set(ids)) == 800
    assert {r.page_id for r in changed_ids(resolved).collect()} == {p for p, (_, _, n) in want.items() if n}
    assert resolved_ids(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        resolved_ids(df, span=50, rounds=3)


def test_resolved_ids_of_more_records_than_the_range_holds(spark):
    df = spark.range(600).selectExpr("id AS page_id", "concat('u', id) AS url")
    got = resolved_ids(df, span=1000).collect()
    ids = [i for r in got for i in (r.activity_id, r.plan_id)]
    assert {r.page_id for r in got} == set(range(600)) and len(set(ids)) == 1200
    assert all(r.activity_id < 1_001_000 for r in got if r.attempt < 6) and max(r.attempt for r in got) < 12


@pytest.mark.parametrize("listed", [10_000, 1])
def test_latest_per_slug_by_filter_and_by_join(spark, monkeypatch, listed):
    """Ties, null times and pages, repeated rows; bundles are worked out for the last ones only."""
    from excursio.sources import sinks

    monkeypatch.setattr(sinks, "LISTED", listed)
    b = bundles(spark, *[{**MUSEUM, "slug": s} for s in ("a", "a", "b", "", "c", "c")])
    times = "CASE page_id WHEN 0 THEN '2' WHEN 1 THEN '2' WHEN 4 THEN '1' END"
    b = b.withColumn("metadata", F.col("metadata").withField("scraped_at", F.expr(times)))
    b = b.withColumn("page_id", F.expr("CASE WHEN page_id <> 2 THEN page_id END")).union(b.where("page_id = 1"))
    calls = spark.sparkContext.accumulator(0)

    def seen(x):
        calls.add(1)
        return x

    b = b.withColumn("plans", F.when(F.udf(seen, "bigint")(F.coalesce("page_id", F.lit(0))) >= 0, F.col("plans")))
    got = sinks.latest_per_slug(b)
    assert calls.value == 0  # the last bundle of a slug is found without its contents
    rows = {r.slug: r for r in got.collect()}
    assert {s: r.page_id for s, r in rows.items()} == {"a": 1, "b": None, "output": 3, "c": 4}
    assert all(r.activity.name == "City Museum" and len(r.plans) == 1 for r in rows.values())


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from excursio.sources.scratch import scratch_folder

    def session(master, **conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: conf.get("folder", d), set=lambda k, v: None), sparkContext=SimpleNamespace(master=master))

    assert scratch_folder(session("yarn", folder="s3a://b/x/")) == "s3a://b/x"
    assert scratch_folder(session("local[2]"))
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            scratch_folder(session(master))


def test_bundle_files_round_trip(spark, tmp_path):
    b = bundles(spark, MUSEUM, {"hero": {"name": "x"}}, {"slug": "city-museum", "metadata": {"scrapedAt": "2027"}})
    write_bundles(b, str(tmp_path / "lines"))
    texts = [r.value for r in spark.read.text(str(tmp_path / "lines")).collect()]
    assert len(texts) == 2
    kept = {json.loads(x)["metadata"]["slug"]: json.loads(x) for x in texts}
    assert kept["city-museum"]["metadata"]["scraped_at"] == "2027"
    assert kept["city-museum"]["activity"]["created_at"] == "2026-01-01T00:00:00.000Z"
    assert kept["city-museum"]["activity"]["refund_policy"] == {}

    place = tmp_path / "slugs"
    write_bundles(b, str(place), directories=True)
    assert {p.name for p in place.iterdir() if p.is_dir()} == {"slug=city-museum", "slug=output"}
    write_bundles(b.filter("page_id = 1"), str(place), directories=True)
    assert (place / "slug=city-museum").exists()

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(texts[0])
    (tmp_path / "in" / "b.json").write_text('{"plans": []}')
    schema = b.select("activity", "plans", "gallery", "metadata").schema
    good, bad = read_bundles(spark, str(tmp_path / "in"), schema)
    assert good.count() == 1 and bad.count() == 1
    assert publish.outbox(good.withColumn("page_id", F.lit(1))).count() >= 2


def test_json_tables(spark, tmp_path):
    write_table(bundles(spark, MUSEUM).select("activity"), str(tmp_path / "j"), "json")
    line = json.loads(spark.read.text(str(tmp_path / "j")).first().value)
    assert line["activity"]["name"] == "City Museum" and list(line["activity"])[:3] == ["id", "unique_id", "slug"]


def test_whole_job(spark, tmp_path):
    responses_at = str(tmp_path / "responses")
    spark.createDataFrame(
        RESPONSES, "page_id bigint, seq bigint, url string, status int, content_type string, body string"
    ).write.parquet(responses_at)
    out = str(tmp_path / "out")
    build_catalogue(spark, PAGES, out, responses_at)
    n = spark.read.parquet(PAGES).count()
    for name in ("raw", "activity", "plan", "bundle", "report"):
        assert spark.read.parquet(f"{out}/{name}").count() == n, name
    assert spark.read.parquet(f"{out}/activity").filter("page_id = 1").first().listing_price.final_price == 70
    assert spark.read.parquet(f"{out}/outbox").count() == 2 * n
    assert spark.read.parquet(f"{out}/page_rejects").count() == 0
    totals = spark.read.parquet(f"{out}/totals").filter("level = 3").first()
    assert totals.pages == n
    assert spark.read.parquet(f"{out}/report").filter("n_responses = 1").count() == 1
    assert Path(out, "bundle_json").exists()


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "pages"
    spark.read.parquet(PAGES).select("page_id", "url", "html").repartition(3).write.parquet(str(source))
    from excursio.operators.page_fields import extract
    from excursio.sources.pages import page_nodes

    batch = extract(page_nodes(spark.read.parquet(str(source))))
    for kind in ("activity", "gallery", "bundle"):
        stream = record_stream(page_stream(spark, str(source), 1), kind)
        q = write_stream(stream, str(tmp_path / kind), kind, str(tmp_path / f"{kind}_state"))
        q.awaitTermination(120)
        got = spark.read.parquet(str(tmp_path / kind)).selectExpr("to_json(struct(*)) j").collect()
        want = getattr(records, kind)(batch).selectExpr("to_json(struct(*)) j").collect()
        assert sorted(got) == sorted(want)


def test_stream_needs_a_checkpoint_place(spark):
    if spark.conf.get("spark.checkpoint.dir", None):
        pytest.skip("the session names a shared place")
    with pytest.raises(ValueError):
        write_stream(record_stream(page_stream(spark, PAGES), "plan"), "/tmp/none", "n")


def test_joins_and_job_run_nothing_while_they_are_built(spark):
    a = spark.range(5).withColumnRenamed("id", "page_id")
    g = spark.range(10).selectExpr("id % 5 AS page_id", "id")
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job may run")
    linkage.join_children(a, g, ["page_id"], F.col("id"), "left")
    assert list(status.getJobIdsForGroup("building")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_category_is_in_generated_code(spark):
    words = spark.range(3).selectExpr("concat('Old temple ', id) AS sought")
    rows = words.select(F.expr(records.map_category("sought", CATEGORY_RULES)).alias("c"))
    assert "transform" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert {r.c for r in rows.collect()} == {"religious-sites"}


def test_responses_are_worked_out_once(spark, tmp_path, monkeypatch):
    from excursio.operators import responses

    calls = []
    whole = responses.api_latest
    monkeypatch.setattr(responses, "api_latest", lambda kept: calls.append(1) or whole(kept))
    at = str(tmp_path / "responses")
    spark.createDataFrame(
        RESPONSES, "page_id bigint, seq bigint, url string, status int, content_type string, body string").write.parquet(at)
    build_catalogue(spark, PAGES, str(tmp_path / "out"), at)
    assert calls == [1]
    assert spark.read.parquet(str(tmp_path / "out" / "api_rejects")).count() == 1


def test_bundle_metadata_makes_no_plans_and_images(spark):
    """Counts come from what is captured; records nobody reads are not made."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    plan = bundles(spark, MUSEUM).select("metadata")._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "gallery:" not in plan and "-entry-ticket" not in plan


def test_json_text_is_parsed_once(spark):
    """Neither the fields nor the filter on the reason parse it anew."""
    lines = spark.createDataFrame([(json.dumps(MUSEUM),)], "value string")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    plan = raw_from_json_text(lines)._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("parseJson") == 1


def test_json_fields_that_do_not_fit_leave_the_rest(spark):
    """Wherever they stand: in the record, in an object of it, in a list, in an image."""
    rec = {"slug": 7, "hero": {"name": ["x"], "rating": 4, "images": [{"url": 5, "width": "12", "height": "x"}, "u"]},
           "seo": "none", "location": {"latitude": "1", "longitude": 2.5}, "faq": [{"question": 1, "answer": {"a": 1}}, 3]}
    got = raw_from_json_text(spark.createDataFrame([(json.dumps(rec),)], "value string")).first()
    assert (got.slug, got.hero.name, got.hero.rating, got.seo) == ("7", None, "4", None)
    assert [(i.url, i.width, i.height) for i in got.hero.images] == [(None, 12, None), ("u", None, None)]
    assert (got.location.latitude, got.location.longitude) == (None, 2.5)
    assert [f and (f.question, f.answer) for f in got.faq] == [("1", None), None]


def test_request_bodies_are_cut_by_bytes(spark):
    """Stamps are put behind what a body says, whatever characters it ends in; nothing counts its characters."""
    import re

    box = publish.outbox(bundles(spark, {**MUSEUM, "hero": {**MUSEUM["hero"], "name": "Café 漢字 😀"}}))
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    plan = box._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert not re.search(r"(?<!octet_)length\(said", plan)
    bodies = {(r.stage, r.n): json.loads(r.body) for r in box.collect()}
    assert bodies[1, 1]["name"] == "Café 漢字 😀" and list(bodies[1, 1])[-2:] == ["created_at", "updated_at"]
    assert bodies[3, 1]["title"] == "Café 漢字 😀 - Cover" and "created_at" not in bodies[2, 1]
