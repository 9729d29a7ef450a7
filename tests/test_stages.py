import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from caseloom.operators import review
from caseloom.plans import stages
from caseloom.sources import acquire, release


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_normalized_tables(spark):
    meta = spark.createDataFrame([("A1", ("Title", "CC0", None)), ("A2", (None, None, "http://x"))], "article_id string, article_metadata struct<title:string,license:string,link:string>")
    arts = stages.articles(meta)
    assert rows(arts.select("article_id", "title", "license", "source_url")) == [("A1", "Title", "CC0", ""), ("A2", "", "", "http://x")]
    recs = spark.createDataFrame([("A1", [("A1_01", "text", 3.0), ("A1_02", "", None)]), (None, [("A2_01", "t", 1.0)])], "article_id string, cases array<struct<case_id:string,case_text:string,age:double>>")
    cs = stages.cases(recs, arts)
    assert rows(cs.select("case_id", "article_id", "raw_case_text", "age")) == [("A1_01", "A1", "text", 3.0), ("A1_02", "A1", "", None), ("A2_01", "A2", "t", 1.0)]
    with pytest.raises(ValueError, match="without an article"):
        stages.cases(recs, arts.where("article_id = 'A1'"))
    nested = spark.createDataFrame([("A1", [("A1_01", [("m1",), ("m2",)])])], "article_id string, case_images array<struct<case_id:string,case_image_list:array<struct<main_image:string>>>>")
    rel = stages.image_relations(nested)
    assert rows(rel) == [("m1", "A1_01"), ("m2", "A1_01")]
    caps = spark.createDataFrame([("i1", "m1", "A1_01", "A1", None, " ", "PMC12.jpg"), ("i2", "m9", "A1_01", "A1", "c", "CC", "x.jpg"), ("i3", "m1", "zz", "A1", "c", "CC", "y.jpg")], "image_id string, main_image string, case_id string, article_id string, caption string, license string, file string")
    good, bad = stages.images(caps, cs, rel, arts)
    assert rows(good) == [("i1", "A1_01", "A1", "", "images/PMC1/PMC12/PMC12.jpg", "CC0")]
    assert rows(bad) == [("i2", "A1_01", "UNVERIFIED"), ("i3", "zz", "ORPHAN")]


TEXT = "PCR confirmed dengue. Dengue again."
GOOD = {"decision": "accept", "diagnosis_status": "confirmed", "evidence_quote": "PCR confirmed dengue.", "confidence": "high", "other_target_diseases": [], "reason": ""}


def test_reviews(spark):
    src = spark.createDataFrame([("c1", TEXT), ("c2", "other text"), ("c3", "boom")], "case_id string, t string")
    jobs = review.requests(src, "label", {"text": F.col("t"), "case": F.col("case_id")}, "m", "v1")
    again = review.requests(src, "label", {"case": F.col("case_id"), "text": F.col("t")}, "m", "v1")
    assert rows(jobs.select("request_sha256")) == rows(again.select("request_sha256")) != rows(review.requests(src, "label", {"text": F.col("t"), "case": F.col("case_id")}, "m", "v2").select("request_sha256"))

    def reviewer(payload, attempt, wrong):
        if "boom" in payload:
            raise RuntimeError("down")
        return json.dumps(GOOD) if attempt and "PCR" in payload else "nonsense"

    def check(payload, answer):
        return None if answer.startswith("{") else "MALFORMED"

    out = review.run_reviews(jobs, reviewer, check)
    got = {r["case_id"]: r for r in jobs.join(out, "request_sha256").collect()}
    assert json.loads(got["c1"]["result_json"])["decision"] == "accept" and len(json.loads(got["c1"]["attempts_json"])) == 2
    assert got["c2"]["terminal"] and got["c2"]["problem"] == "MALFORMED" and not got["c3"]["terminal"] and "down" in got["c3"]["problem"]
    cache = spark.createDataFrame([(r["request_sha256"], r["result_json"]) for r in got.values() if r["result_json"]], "request_sha256 string, result_json string")
    fails = spark.createDataFrame([(r["request_sha256"], r["attempts_json"], r["terminal"]) for r in got.values() if not r["result_json"]], "request_sha256 string, attempts_json string, terminal boolean")
    assert [r["case_id"] for r in review.due(jobs, cache, fails).collect()] == ["c3"]
    stored = fails.limit(0).unionByName(spark.createDataFrame([(got["c1"]["request_sha256"], json.dumps(["x", json.dumps(GOOD), "{}"]), True), ("stale", json.dumps([json.dumps(GOOD)]), True)], fails.schema))
    assert rows(review.recover(stored, jobs, "t")) == [(got["c1"]["request_sha256"], json.dumps(GOOD))]
    key = got["c1"]["request_sha256"]
    line = lambda k, r: spark.createDataFrame([(k, json.dumps(r))], "request_sha256 string, result_json string")
    none = cache.limit(0)
    assert review.import_results(line(key, GOOD), jobs, none, "t").count() == 1 and review.import_results(line(key, GOOD), jobs, cache, "t").count() == 0
    for k, r, what in ((key, GOOD | {"evidence_quote": "absent"}, "EVIDENCE"), (key, GOOD | {"evidence_quote": "engue"}, "EVIDENCE"), (key, GOOD | {"diagnosis_status": "probable"}, "ACCEPT_CONTRADICTS"), (key, GOOD | {"decision": "yes"}, "DECISION"), (key, GOOD | {"confidence": None}, "CONFIDENCE"), ("old", GOOD, "STALE")):
        with pytest.raises(ValueError, match=what):
            review.import_results(line(k, r).unionByName(line(key, GOOD)), jobs, none, "t")
    with pytest.raises(ValueError, match="CONFLICT"):
        review.import_results(line(key, GOOD | {"reason": "new"}), jobs, cache, "t")


def test_limited_reviewer(spark):
    jobs = spark.createDataFrame([(f"r{i}", "{}") for i in range(4)], "request_sha256 string, payload_json string").coalesce(1)

    def busy(payload, attempt, problem):
        raise review.TooManyRequests("wait")

    out = review.run_reviews(jobs, review.Limited(busy, per_minute=1e6), lambda p, a: None).collect()
    assert [r["problem"] for r in out].count("STOPPED") == 3 and not any(r["terminal"] for r in out)
    calls = []
    flaky = review.Limited(lambda p, a, w: calls.append(a) or (1 / 0 if len(calls) < 3 else "ok"), per_minute=1e6, pause=0.0)
    assert flaky("x", 0, None) == "ok" and len(calls) == 3
    names = spark.createDataFrame([("a/b-1:2",), ("",), ("x y",), (None,)], "m string")
    assert [r[0] for r in names.select(review.valid_model(F.col("m"))).collect()] == [True, False, False, False]


def test_acquire(tmp_path):
    data = bytes(range(256)) * 50
    hits = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            hits.append(self.headers.get("Range"))
            if len(hits) == 1:
                self.send_error(503)
                return
            at = int(self.headers["Range"][6:-1]) if self.headers.get("Range") else 0
            self.send_response(206 if at else 200)
            self.end_headers()
            self.wfile.write(data[at:])

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/f"
    import hashlib

    item = {"path": "raw/f.bin", "url": url, "size": len(data), "checksum": "md5:" + hashlib.md5(data).hexdigest()}
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/f.bin.part").write_bytes(data[:100])
    lock = acquire.acquire(tmp_path, [item], pause=0.01)
    assert (tmp_path / "raw/f.bin").read_bytes() == data and hits[1] == "bytes=100-" and lock["raw/f.bin"]["bytes"] == len(data)
    n = len(hits)
    assert acquire.acquire(tmp_path, [item]) == lock and len(hits) == n
    with pytest.raises(ValueError, match="pinned"):
        acquire.acquire(tmp_path, [item | {"checksum": "md5:0"}])
    with pytest.raises(ValueError):
        acquire.fetch(url, tmp_path / "g", 5, tries=2, pause=0.01)
    assert acquire.differs_from_latest({"id": 1, "version": "a"}, {"id": 1, "version": "b"}) == ["version"]
    server.shutdown()


def test_release(spark, tmp_path):
    m = spark.createDataFrame([("s1", "a1", "train"), ("s2", "a2", "test")], "sample_id string, article_id string, part string")
    src = tmp_path / "img.bin"
    src.write_bytes(b"image")
    sha = acquire.file_digest(src)
    bad = release.overlap_problems(m.unionByName(spark.createDataFrame([("s3", "a1", "test")], m.schema)), ["article_id"], "part")
    with pytest.raises(ValueError, match="gate"):
        release.publish(tmp_path / "rel", "v1", {"manifest": m}, {}, problems=bad)
    with pytest.raises(ValueError, match="changed"):
        release.publish(tmp_path / "rel", "v1", {"manifest": m}, {}, files=[(str(src), "images/i.bin", "0" * 64)])
    assert not list((tmp_path / "rel").iterdir())
    out = release.publish(tmp_path / "rel", "v1", {"manifest": m}, {"name": "v1"}, {"licences": m.select("article_id")}, [(str(src), "images/i.bin", sha)], release.overlap_problems(m, ["article_id"], "part"))
    assert release.verify_release(spark, out) == []
    with pytest.raises(FileExistsError):
        release.publish(tmp_path / "rel", "v1", {"manifest": m}, {})
    (out / "card.json").write_text("{}")
    (out / "images/i.bin").unlink()
    assert release.verify_release(spark, out) == ["images/i.bin is missing", "card.json has changed"]


def test_command_line(capsys):
    from caseloom.__main__ import main

    assert main(["list"]) == 0 and "norm_cases" in capsys.readouterr().out


def test_stages_of_the_command_line(spark, capsys, tmp_path):
    from pathlib import Path

    from caseloom.__main__ import STAGES, main

    assert {q for names in STAGES.values() for q in names} <= set(__import__("__spark_entry__").queries())
    assert main(["stages"]) == 0 and set(json.loads(capsys.readouterr().out)) == set(STAGES)
    assert main(["stage", "no such", "--data", "x", "--out", str(tmp_path)]) == 2
    (tmp_path / "a.txt").write_text("x")
    sha = acquire.file_digest(tmp_path / "a.txt")
    for size, want in ((1, 0), (2, 2)):
        (tmp_path / "lock.json").write_text(json.dumps([{"name": "a.txt", "bytes": size, "sha256": sha}]))
        assert main(["verify-files", str(tmp_path), str(tmp_path / "lock.json")]) == want
    (tmp_path / "list.json").write_text(json.dumps({"files": [{"path": "b.txt", "url": (tmp_path / "a.txt").as_uri(), "size": 1, "checksum": f"sha256:{sha}"}]}))
    assert main(["acquire", str(tmp_path / "list.json"), "--root", str(tmp_path / "root")]) == 0
    capsys.readouterr()
    if not Path("/root/testdata/sf0.001").exists():
        pytest.skip("no test tables")
    assert main(["stage", "taxonomy", "--data", "/root/testdata/sf0.001", "--out", str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out/taxonomy.parquet")).columns == ["concept_id", "aliases"]
