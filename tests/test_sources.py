"""Sources: raw records, pages, exports, paging, streams."""

import json

import pytest

from girder.operators import upsert
from girder.sources import files, pages, paging, records
from girder.streaming import incremental, progress

PAGE = """<html><body><h1>Contractor's License Detail for License # 100</h1>
<td id="MainContent_BusInfo">ACE &amp; SONS<br/>1 MAIN ST<br>LOS ANGELES, CA 90001-1234<br/>Business Phone Number:(213) 555-0100</td>
<td id="MainContent_Entity">Ltd Liability</td><td id="MainContent_ExpDt" class="x"> 05/31/2028 </td>
<td id="MainContent_Status"><span><strong>This license is current and active.</strong></span></td>
<td id="MainContent_ClassCellTable"><a href="#">B - GENERAL BUILDING</a><a>C10</a></td>
<td id="MainContent_BondingCellTable"><p><strong>Bond Amount: </strong>$25,000</p><p><strong>Bond Amount: </strong>$1</p></td>
<td id="MainContent_WCStatus"><p>insurance with the <a>PIE (THE)</a></p><strong>Expire Date:</strong> 02/03/2027<br /></td></body></html>"""


def test_license_pages(spark):
    rows = [
        ("100", PAGE),
        ("101", '<h1>License Detail</h1><td id="MainContent_BusInfo">X</td><td id="MainContent_Status">not current</td>'),
        ("102", 'Enter the contractor license number to check <h1>License Detail</h1>'),
        ("103", "<p>nothing</p>"),
        ("104", None),
    ]
    got = {r.cslb_license: r for r in pages.parse_license_pages(spark.createDataFrame(rows, "license string, html string")).collect()}
    assert set(got) == {"100", "101"}
    one = got["100"]
    assert (one.business_name, one.address_street, one.address_city, one.address_zip) == ("ACE & SONS", "1 MAIN ST", "LOS ANGELES", "90001-1234")
    assert (one.phone, one.license_class, one.license_status, one.license_expiry) == ("2135550100", "B - GENERAL BUILDING", "active", "05/31/2028")
    assert (one.bond_amount_cents, one.worker_comp_insurer, one.worker_comp_expiry, one.has_active_license) == (2500000, "PIE (THE)", "02/03/2027", True)
    assert (got["101"].license_status, got["101"].has_active_license, got["101"].phone) == ("inactive", False, None)


def test_records(spark, tmp_path):
    raw = [
        {"pcis_permit": " P-1 ", "address_start": "1", "street_name": "MAIN", "zip_code": "", "valuation": "$1,234.56", "of_stories": "2.5", "issue_date": "01/02/2024", "license": "100", ":updated_at": "u"},
        {"pcis_permit": " "},
        {},
    ]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, raw)))
    got = records.permits(files.landing(spark, f"file://{tmp_path}/p.json", records.RAW_PERMIT)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.permit_number, r.address, r.address_zip, r.valuation_usd, r.number_of_stories, r.issued_date) == ("P-1", "1 MAIN", "", 1235, 2, "2024-01-02")
    assert json.loads(r.raw_source)["license"] == "100"
    seen = [
        {"permit": "P 1", "inspection_date": "2024-01-02T00:00:00", "inspection": " ", "lat_lon": {"latitude": "34.05", "longitude": "x"}},
        {"permit": "P 1"},
    ]
    (tmp_path / "i.json").write_text("\n".join(map(json.dumps, seen)))
    got = records.inspections(files.landing(spark, f"file://{tmp_path}/i.json", records.RAW_INSPECTION)).collect()
    assert [(r.inspection_date, r.inspection_type, r.lat, r.lng) for r in got] == [("2024-01-02", "Unknown", 34.05, None)]


@pytest.mark.parametrize("paged", [True, False])
def test_export_and_legacy(spark, tmp_path, paged):
    people = [
        {"cslb_license_number": "7", "company_name": "Ace", "address": "1 Main, LA", "license_status": "Not Renewed", "icp_score": "75", "permit_total_valuation": "10.5", "social_links": "{bad"},
        {"cslb_license_number": "8"},
    ]
    (tmp_path / "c.json").write_text(json.dumps([{"results": people}] if paged else people))
    raw = files.export(spark, f"file://{tmp_path}/c.json", records.LEGACY_CONTRACTOR)
    good, bad = records.split_valid(raw, ["cslb_license_number", "company_name"])
    assert (good.count(), bad.count()) == (1, 1)
    (r,) = records.legacy_contractors(raw).collect()
    assert (r.address_street, r.license_status, r.icp_tier, r.total_valuation_cents, r.social_links) == ("1 Main", "inactive", "A", 1050, None)


def test_candidates_and_status(spark):
    assert files.next_range(95, 10, 0, 100) == [(95, 100), (0, 5)]
    assert files.next_range(0, 10, 50, 100) == [(50, 60)]
    assert [r.license for r in files.license_candidates(spark, 3, 5).collect()] == ["3", "4"]
    df = spark.createDataFrame([("1", "x", None), ("2", " ", None), ("3", None, "boom")], "license string, html string, error string")
    assert {r.status: r.n for r in files.fetch_status(df).collect()} == {"result": 1, "not_found": 1, "error": 1}


def fetch(offset, limit):
    return [{"a": str(i), "b": None} for i in range(offset, min(offset + limit, 25))]


def test_paged_source(spark):
    spark.dataSource.register(paging.PagedSource)
    df = spark.read.format("paged").schema("a string, b string").option("fetch", "tests.test_sources:fetch").option("pagesize", 4).option("readers", 3).load()
    assert sorted(int(r.a) for r in df.collect()) == list(range(25))


def fetch_since(offset, limit, where=None, order=None):
    column, _, cursor = where.partition(" > ")
    rows = [{"a": str(i), "b": f"{column} {order}"} for i in range(25) if f"{i:02d}" > cursor.strip("'")]
    return rows[offset : offset + limit]


def test_paged_source_asks_for_the_delta_only(spark):
    spark.dataSource.register(paging.PagedSource)
    reader = spark.read.format("paged").schema("a string, b string").option("fetch", "tests.test_sources:fetch_since")
    df = reader.option("pagesize", 4).option("cursorcolumn", ":updated_at").option("cursor", "17").load()
    got = df.collect()
    assert sorted(int(r.a) for r in got) == list(range(18, 25)) and {r.b for r in got} == {":updated_at :id"}
    assert paging.changed_since("c", "o'clock") == {"where": "c > 'o''clock'", "order": ":id"}
    assert paging.changed_since("c", None) == {}


def test_fetched_pages_and_their_failures(spark):
    def ask(license):
        if license == "4":
            raise ValueError("no such page")
        return None if license == "5" else f"<p>{license}</p>"

    got = files.fetched(files.license_candidates(spark, 3, 7), ask, delay_seconds=0)
    assert {r.license: (r.html, r.error) for r in got.collect()} == {
        "3": ("<p>3</p>", None), "4": (None, "no such page"), "5": (None, None), "6": ("<p>6</p>", None)
    }
    assert {r.status: r.n for r in files.fetch_status(got).collect()} == {"result": 2, "error": 1, "not_found": 1}


def parts(path):
    return {p for p in path.rglob("*.parquet")}


def test_batches_write_their_own_rows_only(spark, tmp_path):
    source, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    schema = "k int, v string, seq int"
    written = []
    for turn in range(3):
        rows = [(k, f"v{turn}", turn) for k in range(turn * 10, turn * 10 + 12)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = incremental.landed(spark, source, spark.read.parquet(source).schema)
        incremental.append_once(stream, target, f"file://{tmp_path}/ck", ["k"], ["seq"]).awaitTermination()
        written.append(parts(tmp_path / "out"))
    new = [b - a for a, b in zip([set(), *written], written)]
    assert [sum(spark.read.parquet(f"file://{p}").count() for p in ps) for ps in new] == [12, 10, 10]
    got = {r.k: r.v for r in upsert.Table(spark, target).read().collect()}
    assert got == {k: f"v{max(0, (k - 2) // 10)}" for k in range(32)}


def test_merges_write_touched_buckets_only(spark, tmp_path):
    table = upsert.Table(spark, f"file://{tmp_path}/t")
    policy = upsert.Policy(("k",), ("v",))
    frame = lambda rows: spark.createDataFrame(rows, "k int, v string")
    assert table.merge(frame([(k, "a") for k in range(100)]), policy, buckets=8) == list(range(8))
    before = parts(tmp_path / "t")
    (touched,) = table.merge(frame([(5, "b")]), policy, buckets=8)
    new = parts(tmp_path / "t") - before
    assert all(f"_bucket={touched}" in str(p) for p in new)
    assert sum(spark.read.parquet(f"file://{p}").count() for p in new) < 40
    assert {r.k: r.v for r in table.read().collect()} == {k: "b" if k == 5 else "a" for k in range(100)}
    with pytest.raises(ValueError):
        table.append(frame([(1, "x")]))


def test_two_writers(spark, tmp_path):
    a, b = (upsert.Table(spark, f"file://{tmp_path}/t") for _ in range(2))
    a.replace(spark.range(2).toDF("x"))
    number, _ = b.manifest()
    a.append(spark.range(2, 3).toDF("x"))
    with pytest.raises(upsert.Conflict):
        b.append(spark.range(3, 4).toDF("x"), number)
    upsert.again(lambda: b.append(spark.range(3, 4).toDF("x")))
    (tmp_path / "t" / "_current" / "00000009").touch()  # a writer that died
    assert sorted(r.x for r in a.read().collect()) == [0, 1, 2, 3]
    a.append(spark.range(4, 5).toDF("x"))
    assert sorted(r.x for r in b.read().collect()) == [0, 1, 2, 3, 4]


def test_resumed_batches(spark, tmp_path):
    rows, path = spark.range(1, 24).toDF("id"), f"file://{tmp_path}/state"
    seen = []

    def sink(batch, number):
        ids = [r.id for r in batch.collect()]
        if ids[0] == 11 and len(seen) == 2:
            seen.append("failed")
            raise RuntimeError
        seen.append(ids)

    with pytest.raises(RuntimeError):
        progress.resumed(rows, "id", 5, sink, path, "p")
    saved = progress.state(spark, path, "p")
    assert (saved["last_cursor"], saved["last_offset"], saved["status"]) == ("10", 10, "error")
    assert progress.resumed(rows, "id", 5, sink, path, "p") == 3
    assert seen == [[1, 2, 3, 4, 5], [6, 7, 8, 9, 10], "failed", [11, 12, 13, 14, 15], [16, 17, 18, 19, 20], [21, 22, 23]]
    saved = progress.state(spark, path, "p")
    assert (saved["last_cursor"], saved["last_offset"], saved["status"]) == (None, 23, "idle")
    assert progress.resumed(rows.limit(0), "id", 5, sink, path, "other") == 0


def test_retries():
    calls, waits = [], []

    def flaky(offset, limit):
        calls.append(offset)
        if len(calls) < 3:
            raise paging.ServerError
        return [{}]

    assert paging.tried(flaky, 5, 1, sleep=waits.append) == [{}] and waits == [5, 10]
    with pytest.raises(ValueError):
        paging.tried(lambda *_: (_ for _ in ()).throw(ValueError), 0, 1)


def test_streams(spark, tmp_path):
    source, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    policy = upsert.Policy(("k",), ("v",))
    for turn, rows in enumerate(([(1, "a", 1), (1, "b", 2)], [(2, "c", 1), (1, "d", 3)])):
        spark.createDataFrame(rows, "k int, v string, seq int").write.mode("append").parquet(source)
        stream = incremental.landed(spark, source, spark.read.parquet(source).schema)
        incremental.merge_stream(stream, target, f"file://{tmp_path}/ck", policy, "seq").awaitTermination()
        incremental.append_once(stream, f"{target}-once", f"file://{tmp_path}/ck2", ["k"], ["seq"]).awaitTermination()
    assert {r.k: r.v for r in upsert.Table(spark, target).read().collect()} == {1: "d", 2: "c"}
    assert {r.k: r.v for r in upsert.Table(spark, f"{target}-once").read().collect()} == {1: "a", 2: "c"}


def test_snapshots(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    for day, n in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3)):
        files.append_snapshot(spark.createDataFrame([(day, n, n)], "snapshot_date string, created_at int, n int"), path)
    assert files.latest_snapshot(spark.read.parquet(path)).first().n == 3
