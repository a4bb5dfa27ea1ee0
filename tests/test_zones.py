"""Zones, registry, state tables and the whole run."""

import datetime
import gzip
import json

from pyspark.sql import functions as F

from gristmill import schemas
from gristmill.operators import quality
from gristmill.operators.extract import PageError
from gristmill.plans.site_run import SiteError, run_batch
from gristmill.sources import registry, zones

import pytest

T0 = datetime.datetime(2026, 1, 1)
DAY = datetime.timedelta(days=1)


def article(n, price="£10.00"):
    return (
        f'<article class="product_pod"><h3><a href="b{n}/i.html" title="Book {n}">x</a></h3>'
        f'<p class="price_color">{price}</p><p class="instock availability">In stock</p></article>'
    )


def listing(spark, run, day, *bodies, site="books_sandbox", status=200):
    rows = [
        (site, run, i, f"https://x.example/page-{i}.html", status, {}, body.encode(), day, "text/html")
        for i, body in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, schemas.RAW_PAGES)


def runs(spark, *rows):
    return spark.createDataFrame([(r, s, t, "sha", "local") for r, s, t in rows], schemas.RUNS)


def curated(spark, root):
    schema = "title string, domain string, dt date, run string"
    return zones.read_zone(spark, root, "curated", schema)


def test_whole_run(spark, tmp_path):
    root = str(tmp_path)
    bodies = [article(2 * i) + article(2 * i + 1, "£11.00") for i in range(25)]
    out = run_batch(
        spark,
        listing(spark, "r1", T0, *bodies),
        runs(spark, ("r1", "books_sandbox", T0)),
        registry.default_registry(spark),
        root,
    )
    summary = out.summary.first()
    assert (summary.record_count, summary.quarantined_count, summary.gate_status) == (50, 0, "pass")
    assert zones.read_raw(spark, root).count() == 25
    assert curated(spark, root).count() == 50
    staged = zones.read_zone(spark, root, "staging")
    assert set(schemas.RECORD_COLUMNS) - {"attributes"} < set(staged.columns)
    assert json.loads(staged.first().attributes_json) == {"rating": None, "image_url": None}
    manifest = zones.read_manifests(spark, root).first()
    assert manifest.site_counts == {"books_sandbox": 50} and manifest.git_sha == "sha"
    keys = [r.key for r in zones.inventory(spark, root, "curated/").collect()]
    assert keys and all(k.startswith("curated/domain=books_sandbox/dt=2026-01-01/run=r1/") for k in keys)


def test_runs_one_after_another(spark, tmp_path):
    """A static site scraped again keeps nothing, fails, and comes back after expiry."""
    root = str(tmp_path)
    sites = registry.default_registry(spark)
    body = article(1) + article(2)
    counts = []
    for batch, (run, day) in enumerate([("r1", T0), ("r2", T0 + DAY), ("r3", T0 + 90 * DAY)]):
        out = run_batch(
            spark, listing(spark, run, day, body), runs(spark, (run, "books_sandbox", day)), sites, root,
            batch=batch,
        )
        summary = out.summary.first()
        counts.append((summary.record_count, summary.gate_status))
        # the same batch again changes nothing
        if batch == 1:
            again = run_batch(
                spark, listing(spark, run, day, body), runs(spark, (run, "books_sandbox", day)), sites,
                root, batch=batch,
            )
            assert again.summary.first().record_count == 0
    assert counts == [(2, "pass"), (0, "fail"), (2, "pass")]
    assert curated(spark, root).count() == 4
    reports = zones.read_zone(spark, root, "reports")
    assert zones.latest_reports(reports).first().run_id == "r3"
    assert reports.count() == 3


def test_many_runs_at_once_equal_one_by_one(spark, tmp_path):
    body = article(1) + article(2)
    days = [("r1", T0), ("r2", T0 + DAY), ("r3", T0 + 90 * DAY)]
    pages = listing(spark, *days[0], body)
    for run, day in days[1:]:
        pages = pages.unionByName(listing(spark, run, day, body))
    out = run_batch(
        spark, pages, runs(spark, *[(r, "books_sandbox", t) for r, t in days]),
        registry.default_registry(spark), str(tmp_path),
    )
    assert {r.run_id: r.record_count for r in out.summary.collect()} == {"r1": 2, "r2": 0, "r3": 2}


def test_failed_batch_marks_its_hashes(spark, tmp_path):
    """Hashes are marked before the gate, so what a failed batch held stays out until expiry."""
    sites = registry.default_registry(spark)
    bad = article(1) + article(2, "£0")
    for before_gate, expected in ((True, 0), (False, 1)):
        root = str(tmp_path / str(before_gate))
        for batch, (run, day, body) in enumerate([("r1", T0, bad), ("r2", T0 + DAY, article(1))]):
            out = run_batch(
                spark, listing(spark, run, day, body), runs(spark, (run, "books_sandbox", day)), sites,
                root, batch=batch, mark_before_gate=before_gate,
            )
        assert out.summary.first().record_count == expected
        assert curated(spark, root).filter("run = 'r1'").count() == 0


def test_quarantine_keeps_both_runs_of_a_day(spark, tmp_path):
    root, sites = str(tmp_path), registry.default_registry(spark)
    for batch, run in enumerate(["r1", "r2"]):
        out = run_batch(
            spark, listing(spark, run, T0, article(batch) + article(9, "free")),
            runs(spark, (run, "books_sandbox", T0)), sites, root, batch=batch,
        )
        assert out.rejects.first().reason == "cannot parse price from 'free'"
    rejected = spark.read.json(f"{root}/quarantine")
    assert sorted(r.run for r in rejected.collect()) == ["r1", "r2"]
    rolled = quality.quarantine_rollup(out.rejects).filter("site_id is null").first()
    assert rolled.rejected == 1


def test_failed_pages_are_stored_and_reported(spark, tmp_path):
    sites, root = registry.default_registry(spark), str(tmp_path)
    pages = listing(spark, "r1", T0, article(1), status=503)
    args = (spark, pages, runs(spark, ("r1", "books_sandbox", T0)), sites, root)
    out = run_batch(*args)
    assert out.page_errors.count() == 1 and out.summary.first().gate_status == "fail"
    assert zones.read_raw(spark, root).first().status_code == 503
    with pytest.raises(PageError):
        run_batch(*args, fail_fast=True)


def test_raw_files_are_unpacked(spark, tmp_path):
    folder = tmp_path / "raw/site=s/dt=2026-01-01/run=r1"
    folder.mkdir(parents=True)
    (folder / "00ff.html.gz").write_bytes(gzip.compress(b"<p>x</p>"))
    row = zones.read_raw_files(spark, str(tmp_path / "raw")).first()
    assert (row.site, row.run, row.url_hash, bytes(row.body)) == ("s", "r1", "00ff", b"<p>x</p>")
    assert row.dt == datetime.date(2026, 1, 1)


def test_raw_files_keep_names_and_open_what_is_asked_for(spark, tmp_path):
    root = str(tmp_path / "files")
    odd = "a/b=c: 50%"
    pages = spark.createDataFrame(
        [("007", "01", 0, "u1", b"<p>\xff</p>"), (odd, "01", 1, "u2", b""), ("007", "2", 2, "u3", None),
         ("007", "01", 5, "u1", b"later")],
        "site_id string, run_id string, page_ord int, url string, body binary",
    ).withColumn("fetched_at", F.lit(T0))
    for _ in range(2):  # a repeat writes the same objects
        stored = zones.write_raw_files(pages, root).collect()
    assert len(stored) == len({r.key for r in stored}) == 3
    assert sorted(p.suffix for p in (tmp_path / "files").rglob("*.*") if p.is_file() and p.name[0] != ".") == [".gz"] * 3
    read = zones.read_raw_files(spark, root)
    got = {(r.site, r.run): bytes(r.body) for r in read.collect()}
    assert got == {("007", "01"): b"later", (odd, "01"): b"", ("007", "2"): b""}
    # what does not match is not opened: here it cannot be unpacked
    bad = tmp_path / "files/site=bad/dt=2026-01-01/run=01"
    bad.mkdir(parents=True)
    (bad / "0.html.gz").write_bytes(b"not gzip")
    assert read.sparkSession is spark and zones.read_raw_files(spark, root).where("site = '007'").count() == 2
    one = zones.read_raw_files(spark, root).where("site = '007' and run = '01'")
    assert [bytes(r.body) for r in one.collect()] == [b"later"]
    assert "PartitionFilters: [isnotnull(site" in one._jdf.queryExecution().toString()
    assert {r.length for r in zones.read_raw_files(spark, root).select("site", "length").where("length < 10").collect()} == {8}


def test_state_reads_snapshot_and_later_changes(spark, tmp_path):
    path = str(tmp_path / "state")
    schema = "k string, v int"
    for batch in range(8):
        changes = spark.createDataFrame([("a", batch), (f"b{batch}", batch)], schema)
        for _ in range(2 if batch in (3, 6) else 1):  # a retried batch leaves one copy
            zones.save_state(changes, path, schema, "k", batch, every=3)
    for before in range(9):
        state = zones.load_state(spark, path, schema, "k", before=before, every=3).collect()
        got = {r.k: r.v for r in state}
        expected = {f"b{b}": b for b in range(before)}
        assert got == (expected | {"a": before - 1} if before else {})
    files = zones.load_changes(spark, path, schema, before=8, every=3).inputFiles()
    assert zones.load_changes(spark, path, schema, before=8, every=3).filter("batch < 6").count() == 0, files


def test_state_survives_gaps_in_batch_numbers(spark, tmp_path):
    path = str(tmp_path / "gaps")
    schema = "k string, v int"
    batches = [0, 1, 2, 3, 5, 8, 9, 30]  # 4 would have stored a snapshot; 8 does
    for batch in batches:
        changes = spark.createDataFrame([("a", batch), (f"b{batch}", batch)], schema)
        zones.save_state(changes, path, schema, "k", batch, every=4)
    for before in (6, 8, 9, 31):
        got = {r.k: r.v for r in zones.load_state(spark, path, schema, "k", before=before).collect()}
        seen = [b for b in batches if b < before]
        assert got == {f"b{b}": b for b in seen} | {"a": seen[-1]}


def test_upsert(spark):
    table = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    changed = zones.upsert(table, spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"), "k")
    assert sorted(tuple(r) for r in changed.collect()) == [("a", 1), ("b", 2), ("c", 2)]


def test_site_state_point_read(spark, tmp_path):
    root = str(tmp_path)
    for batch, failures in enumerate([0, 5]):
        states = spark.createDataFrame([("s", T0, failures, failures > 4)], schemas.SITE_STATE)
        zones.save_site_state(states, root, batch)
    row = zones.read_site_state(spark, root, before=2).filter("site_id = 's'").first()
    assert row.consecutive_failures == 5 and row.breaker_open
    assert zones.read_site_state(spark, root, before=2).filter("site_id = 'x'").count() == 0


def test_registry_lookup_tells_unknown_from_disabled(spark):
    sites = registry.default_registry(spark).withColumn("enabled", F.col("id") != "quotes_js")
    wanted = spark.createDataFrame([("books_sandbox",), ("quotes_js",), ("nope",)], "site_id string")
    errors = {r.site_id: r.error for r in registry.resolve_sites(wanted, sites).collect()}
    assert errors == {
        "books_sandbox": None,
        "quotes_js": "site 'quotes_js' is registered but disabled",
        "nope": "site 'nope' is not registered",
    }


def test_registry_validation(spark):
    rows = [
        ("a", "m", True, "0 2 * * *", "http", (1.0, 1, True), "strict"),
        ("b", "m", True, "0 2 * * *", "quantum", (1.0, 1, True), "strict"),
        (None, "m", None, "0 2 * * *", "http", (None, 1, True), None),
        ("d", "m", True, "0 2 * * *", "http", None, "strict"),
    ]
    checked = registry.validate_registry(spark.createDataFrame(rows, schemas.SITE_REGISTRY)).collect()
    assert [r.errors for r in checked] == [
        [],
        ["unknown strategy: quantum"],
        ["missing id", "missing enabled", "missing dq_profile", "missing rate_limit.rps"],
        ["missing rate_limit"],
    ]


def test_inventory_lists_the_folder_of_its_prefix(spark, tmp_path):
    for key in ("raw/site=a/x", "raw/site=ab/y", "raw/site=a/deep/z", "curated/q", "raw/s{1}/w"):
        (tmp_path / key).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / key).write_text("1")

    def keys(prefix):
        return sorted(r.key for r in zones.inventory(spark, str(tmp_path), prefix).collect())

    assert keys("raw/site=a") == ["raw/site=a/deep/z", "raw/site=a/x", "raw/site=ab/y"]
    assert keys("raw/site=a/") == ["raw/site=a/deep/z", "raw/site=a/x"]
    assert keys("raw/site=a/d") == ["raw/site=a/deep/z"]
    assert keys("raw/s{1}/") == ["raw/s{1}/w"] and keys("nothing/here") == [] and len(keys("")) == 5
    listed = zones.inventory(spark, str(tmp_path), "raw/site=ab/")
    assert [f.rsplit("/", 1)[1] for f in listed.inputFiles()] == ["y"]


def test_sites_that_cannot_run_are_reported(spark, tmp_path):
    root = str(tmp_path)
    sites = registry.default_registry(spark)
    pages = listing(spark, "r1", T0, article(1)).unionByName(listing(spark, "r1", T0, article(2), site="nowhere"))
    pages = pages.unionByName(listing(spark, None, T0, article(3), site=None))
    job = runs(spark, ("r1", "books_sandbox", T0), ("r1", "nowhere", T0))
    out = run_batch(spark, pages, job, sites, root)
    got = {(r.site_id, r.run_id, r.pages, r.error) for r in out.site_errors.collect()}
    assert got == {("nowhere", "r1", 1, "site 'nowhere' is not registered"), (None, None, 1, "page without a site")}
    assert zones.read_site_errors(spark, root).count() == 2
    run_batch(spark, listing(spark, "r1", T0, article(1)), job.where("site_id = 'books_sandbox'"), sites, root)
    assert zones.read_site_errors(spark, root).count() == 0  # the repeat had none
    with pytest.raises(SiteError, match="not registered"):
        run_batch(spark, pages.where("site_id is not null"), job, sites, str(tmp_path / "strict"), fail_fast=True)
    assert not (tmp_path / "strict").exists()
