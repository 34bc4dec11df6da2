import json

import pytest
from pyspark.sql import functions as F

from vigil.operators import normalize as N
from vigil.sources import landed as LD
from tests.helpers import cve


def _pages(spark, bodies):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "page int, body string")


BIT = LD.POSITION_BITS


def _body(*ids):
    return json.dumps({"vulnerabilities": [cve(id=i) for i in ids]})


def test_cve_pages_stop_and_bound(spark):
    pages = _pages(spark, [_body("a", "b"), _body("c"), json.dumps({"other": 1}), _body("d")])
    got = [r.seq for r in LD.cve_pages_to_records(pages).orderBy("seq").collect()]
    assert got == [0, 1, 1 << BIT]                          # stops at the first empty page
    assert LD.cve_pages_to_records(pages, max_pages=1).count() == 2
    many = _pages(spark, [_body(f"p{i}") for i in range(5)])
    assert LD.cve_pages_to_records(many).count() == 5       # no default bound


def test_corrupt_page_is_kept_apart_and_does_not_end_the_feed(spark):
    pages = _pages(spark, [_body("a"), '{"vulnerabilities": [', _body("b"), _body("c")])
    recs = LD.cve_pages_to_records(pages)
    assert sorted(r.id for r in N.normalize_cve(recs).collect()) == ["a", "b", "c"]
    assert [tuple(r) for r in LD.corrupt_pages(pages).collect()] == [(1, 1, "corrupt_page")]
    with pytest.raises(ValueError):
        LD.cve_pages_to_records(pages, strict=True)
    with pytest.raises(ValueError):
        LD.ip_pages_to_records(pages, strict=True)


def test_positions_are_unique_for_any_page_size(spark):
    pages = _pages(spark, [_body(*[f"a{i}" for i in range(300)]), _body(*[f"b{i}" for i in range(300)])])
    got = [r.seq for r in LD.cve_pages_to_records(pages).collect()]
    assert len(got) == len(set(got)) == 600
    ips = _pages(spark, [json.dumps({"data": [{"ipAddress": "1.1.1.1", "abuseConfidenceScore": 99}]})])
    assert LD.ip_pages_to_records(ips).first().seq not in got


def test_ip_floor_and_cap(spark):
    data = [{"ipAddress": f"1.1.1.{i}", "abuseConfidenceScore": i * 10} for i in range(10)]
    pages = _pages(spark, [json.dumps({"data": data})])
    top = LD.ip_pages_to_records(pages, limit=3).collect()
    assert [r.confidence for r in top] == [90.0, 80.0, 70.0]
    assert LD.ip_pages_to_records(pages, 60).count() == 4
    assert LD.ip_pages_to_records(pages, 0).count() == 10          # 0 keeps all


def test_landed_files_roundtrip(spark, tmpdir_path):
    raw = spark.createDataFrame([(i, json.dumps(cve(id=f"c{i}"))) for i in range(5)],
                                "seq bigint, raw string")
    pages = LD.envelope(raw, "vulnerabilities", lambda s: F.floor(s / 2))
    LD.write_pages(pages, tmpdir_path + "/cve")
    back = LD.cve_pages_to_records(LD.read_pages(spark, tmpdir_path + "/cve"))
    ids = sorted(r.id for r in N.normalize_cve(back.select("seq", "raw")).collect())
    assert ids == [f"c{i}" for i in range(5)]


def test_read_pages_from_flat_file_names(spark, tmpdir_path):
    import os
    d = tmpdir_path + "/flat"
    os.makedirs(d)
    for n, ids in ((0, ["a", "b"]), (1, ["c"]), (3, ["d"])):
        with open(f"{d}/page-{n:05d}.json", "w") as f:
            json.dump({"vulnerabilities": [cve(id=i) for i in ids]}, f)
    pages = LD.read_pages(spark, d)
    assert sorted(r.page for r in pages.collect()) == [0, 1, 3]
    # page 2 is absent (not empty), so all landed pages are read
    assert sorted(r.seq for r in LD.cve_pages_to_records(pages).collect()) == [0, 1, 1 << BIT, 2 << BIT]


def test_page_number_comes_from_the_base_name(spark, tmpdir_path):
    import os
    for folder, name in (("f2", "alpha.json"), ("parts", "part-00000-3a-c000.json")):
        d = f"{tmpdir_path}/{folder}"
        os.makedirs(d)
        with open(f"{d}/{name}", "w") as f:
            f.write(_body("a"))
        with pytest.raises(Exception, match="no page number"):
            LD.read_pages(spark, d).collect()
    for folder in ("x1", "x2"):
        os.makedirs(f"{tmpdir_path}/two/{folder}")
        with open(f"{tmpdir_path}/two/{folder}/page-7.json", "w") as f:
            f.write(_body(folder))
    pages = LD.read_pages(spark, f"{tmpdir_path}/two/*")
    assert sorted((r.page, r.order) for r in pages.collect()) == [(7, 0), (7, 1)]
    assert LD.cve_pages_to_records(pages).select("seq").distinct().count() == 2
