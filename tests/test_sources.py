import zipfile

import pytest
from pyspark.sql import functions as F

from caseloom.sources import catalog, files
from caseloom.streaming import latest


def test_safe_path(tmp_path):
    assert catalog.safe_path(tmp_path, "a/b.json") == (tmp_path / "a/b.json").resolve()
    for bad in ("../x", "/etc/x", "C:\\x", "a/../../x", ""):
        with pytest.raises(ValueError):
            catalog.safe_path(tmp_path, bad)


def test_catalog(spark, tmp_path):
    c = catalog.Catalog(spark, tmp_path, {"t/x": "a int, b string"})
    assert c.read("t/x", optional=True).columns == ["a", "b"] and c.read("t/x", optional=True).count() == 0
    with pytest.raises(FileNotFoundError):
        c.read("t/x")
    c.write("t/x", spark.createDataFrame([(1, "u", True)], "a long, b string, extra boolean"))
    c.write("t/x", spark.createDataFrame([(2, "v")], "a int, b string"))
    assert [tuple(r) for r in c.read("t/x").collect()] == [(2, "v")] and c.read("t/x", ["b"]).columns == ["b"]
    with pytest.raises(FileExistsError):
        c.write("t/x", spark.createDataFrame([(3, "w")], "a int, b string"), once=True)
    c.write_json("r/j.json", {"b": 1, "a": "é"}, once=True)
    c.write_json("r/j.json", {"a": "é", "b": 1}, once=True)
    assert c.read_json("r/j.json") == {"a": "é", "b": 1}
    with pytest.raises(FileExistsError):
        c.write_json("r/j.json", {}, once=True)


def test_checksums(spark, tmp_path):
    (tmp_path / "f1.bin").write_bytes(b"abc")
    (tmp_path / "f2.bin").write_bytes(b"")
    found = catalog.checksums(spark, str(tmp_path), "*.bin")
    lock = spark.createDataFrame([tuple(r) for r in found.collect() if r["name"] == "f1.bin"] + [("f2.bin", 0, "x"), ("f3.bin", 1, "y")], found.schema)
    assert sorted(tuple(r) for r in catalog.verify_files(found, lock).collect()) == [("f2.bin", "DIGEST"), ("f3.bin", "MISSING")]


def test_jsonl_csv_zip(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1, "b": "x"}\n\n{"a": 2}\nnot json\n')
    got = [tuple(r) for r in files.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int, b string").collect()]
    assert got == [(1, "x", None), (2, None, "FIELDS"), (None, None, "MALFORMED")]
    files.write_jsonl(spark.createDataFrame([(1, None)], "a int, b string").coalesce(1), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first()[0] == '{"a":1,"b":null}'
    (tmp_path / "x.csv").write_bytes(b'\xef\xbb\xbfid,caption\n1,"two\nlines, ""quoted"""\n')
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "x.csv")).collect()] == [("1", 'two\nlines, "quoted"')]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/one.txt", "1")
    assert [(r["path"], bytes(r["content"])) for r in files.read_zip(spark, str(tmp_path / "a.zip")).collect()] == [("d/one.txt", b"1")]
    assert files.extract_checked(str(tmp_path / "a.zip"), str(tmp_path / "x")) == ["d/one.txt"] and files.extract_checked(str(tmp_path / "a.zip"), str(tmp_path / "x")) == []
    (tmp_path / "x/d/one.txt").write_text("2")
    with pytest.raises(ValueError, match="other content"):
        files.extract_checked(str(tmp_path / "a.zip"), str(tmp_path / "x"))
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("../evil", "1")
    with pytest.raises(Exception, match="unsafe"):
        files.read_zip(spark, str(tmp_path / "bad.zip")).collect()


def test_streaming(spark, tmp_path):
    src, out, state = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = "k string, n int, ts timestamp"
    spark.sql("select 'a' k, 1 n, timestamp'2024-01-01 00:00:00' ts union all select 'b', 5, timestamp'2024-01-01 00:01:00'").write.parquet(src)
    run = lambda: latest.maintain_latest(spark.readStream.schema(schema).parquet(src), out, state, ["k"], ["n"])
    run()
    spark.sql("select 'a' k, 3 n, timestamp'2024-01-01 00:02:00' ts union all select 'b', 4, timestamp'2024-01-01 00:03:00'").write.mode("append").parquet(src)
    run()
    run()
    assert sorted((r["k"], r["n"]) for r in latest.read_latest(spark, out).collect()) == [("a", 3), ("b", 5)]
    stream = latest.windowed_counts(latest.deduplicated(spark.readStream.schema(schema).parquet(src), ["k", "n"], "ts", "1 hour"), "ts", "1 minute", "1 hour", ["k"])
    assert stream.isStreaming


def test_config(tmp_path):
    from caseloom.sources.config import read_config

    (tmp_path / "a.json").write_text('{"seed": 1}')
    (tmp_path / "b.json").write_text("[]")
    assert read_config(tmp_path, "a") == {"seed": 1}
    for name, error in (("b", ValueError), ("c", FileNotFoundError), ("../a", ValueError)):
        with pytest.raises(error):
            read_config(tmp_path, name)
    pytest.importorskip("yaml")
    (tmp_path / "d.yaml").write_text("folds: 5\nroots: [x, y]\n")
    assert read_config(tmp_path, "d") == {"folds": 5, "roots": ["x", "y"]}


def test_card_and_commit(spark, tmp_path):
    from caseloom.sources import acquire, release

    df = spark.createDataFrame([("l1", "CC0", "dev"), ("l1", "CC0", "test"), ("l2", None, "dev")], "label string, licence string, part string")
    assert release.build_card(df, "v1", "label", "licence", "part") == {"version": "v1", "rows": 3, "classes": {"l1": 2, "l2": 1}, "licences": ["CC0", "None"], "parts": {"dev": 2, "test": 1}}
    with pytest.raises(ValueError, match="commit"):
        acquire.fetch_at_commit("file:///{commit}", "main", tmp_path / "x")
    assert acquire.probe("http://127.0.0.1:9/", timeout=2)["reachable"] is False
