import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from papyrine.functions.patterns import yaml_list, yaml_str
from papyrine.plans import pipeline
from papyrine.session import broadcast_if_small, checkpoint
from papyrine.sinks import files as sinks
from papyrine.sources import files
from papyrine.streaming.incremental import process_new

PNG = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (640).to_bytes(4) + (480).to_bytes(4) + b"\0" * 9
JPEG = b"\xff\xd8\xff\xe0\0\x04ab\xff\xc0\0\x11\x08" + (300).to_bytes(2) + (400).to_bytes(2) + b"\0" * 12


def test_sources(spark, tmp_path):
    for name, content in {"a b.pdf": b"x", "sub/c.pdf": b"y", "sub/_raw/source.pdf": b"z", "d.md": b"a\r\nb", "w/marker_out/s/_p.png": PNG, "w/marker_out/s/q.jpeg": JPEG, "w/docling_out/docling_pictures/bad.png": b"no", "w/other/x.png": PNG}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    found = files.pdfs(spark, str(tmp_path), contents=True)
    assert sorted(r["stem"].replace("%20", "_") for r in found.collect()) == ["a_b", "c"]
    assert [r["md"] for r in files.markdown(spark, str(tmp_path)).collect()] == ["a\nb"]
    assert sorted((r["source"], r["rank"], r["w"], r["h"], r["error"]) for r in files.images(spark, str(tmp_path / "w")).collect() if r["w"]) == [("marker", 1, 400, 300, None), ("marker", 3, 640, 480, None)]

    os.symlink(tmp_path / "a b.pdf", tmp_path / "sub/link.pdf")
    assert files.pdfs(spark, str(tmp_path)).count() == 2

    def marker(path, content, batch_size):
        if content == b"y":
            raise ValueError("broken")
        if batch_size is None:
            raise ValueError("AcceleratorError in the layout")
        return f"# md {batch_size}", "{}"

    def docling(path, content):
        if content == b"x":
            raise ValueError("no second output")
        return "{}"

    got = files.extract(found, marker, docling).collect()
    assert sorted((r["marker_md"] or "", r["docling_json"] or "", r["error"] or "") for r in got) == [("", "{}", "extract_failed: broken"), ("# md 1", "", "")]
    for wrong in ((None, None), (marker, "docling")):
        with pytest.raises(ValueError):
            files.check_extractors(*wrong)


PAPER = "# A study of receptor traffic in cells\n\n## Abstract\n\n" + "We saw it.<sup>1</sup> " * 20 + "\n\n## Methods\n\nAs before.\n\nFigure 1. The one figure. More.\n\n![](_page_0_Figure_1.jpeg)\n\n## Results\n\n| a | b | c |\n|---|---|---|\n| 1 | 2 | 3 |\n| 2 | 2 | 3 |\n| 3 | 2 | 3 |\n\n## References\n\n1. Smith J (2020) One.\n2. Doe A (2021) Two.\n"


def test_pipeline(spark, tmp_path, capsys, monkeypatch):
    plug = tmp_path / "plugged_marker.py"
    plug.write_text(f"def marker(path, content, batch_size):\n    if content == b'bad':\n        raise ValueError('broken')\n    return {PAPER!r}, '{{}}'\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(plug))
    src, out, work = tmp_path / "in", tmp_path / "out", tmp_path / "work"
    picture = work / "2024-01_Cell_x_PMID7/marker_out/s/_page_0_Figure_1.jpeg"
    picture.parent.mkdir(parents=True)
    picture.write_bytes(JPEG)
    src.mkdir()
    out.mkdir()
    (src / "2024-01_Cell_x_PMID7.pdf").write_bytes(b"good")
    call = [str(src), str(out), "--marker", "plugged_marker:marker", "--images", str(work), "--require-caption"]
    assert pipeline.main(call, spark) == 0 and "1/1" in capsys.readouterr().out
    paper = out / "2024-01_Cell_x_PMID7"
    names = {str(p.relative_to(paper)) for p in paper.rglob("*.*") if not p.name.endswith(".crc")}
    assert {"meta.json", "README.md", "references.md", "figures/figure_01.jpeg", "figures/figure_01.md", "tables/table_01.md", "_raw/source.pdf", "_raw/marker.md", "_raw/table_audit.json", "_raw/figure_audit.json"} <= names
    assert sum(n.startswith("sections/") for n in names) == json.loads((paper / "meta.json").read_text())["n_sections"] > 2
    assert (paper / "figures/figure_01.jpeg").read_bytes() == JPEG and (paper / "_raw/source.pdf").read_bytes() == b"good" and "The one figure" in (paper / "figures/figure_01.md").read_text()
    assert json.loads((paper / "_raw/table_audit.json").read_text())[0]["verdict"] == "data"
    (src / "bad.pdf").write_bytes(b"bad")
    assert pipeline.main(call, spark) == 1 and "1/2" in capsys.readouterr().out
    log = [json.loads(r["value"]) for r in spark.read.text(str(out / "_log")).collect()]
    assert sorted(r["status"] for r in log) == ["extract_failed", "ok", "skipped"]
    assert pipeline.main([str(tmp_path / "none"), str(out), "--marker", "plugged_marker:marker"], spark) == 1
    assert pipeline.main([str(src), str(out), "--marker", "plugged_marker:nothing"], spark) == pipeline.main([], spark) == 2


def test_yaml(spark):
    row = spark.createDataFrame([('a "b"', ["x", "y"], ""), (None, [], None)], "s string, l array<string>, e string").select(yaml_str(F.col("s")), yaml_list(F.col("l")), yaml_str(F.col("e"))).collect()
    assert [tuple(r) for r in row] == [('"a \\"b\\""', '\n  - "x"\n  - "y"', "null"), ("null", "null", "null")]


def test_size_after_large_segments(spark, tmp_path):
    (tmp_path / "marker_out/s").mkdir(parents=True)
    (tmp_path / "marker_out/s/a.jpg").write_bytes(JPEG[:2] + (b"\xff\xe2" + (65535).to_bytes(2) + b"x" * 65533) * 2 + JPEG[2:])
    (tmp_path / "marker_out/s/b.jpg").write_bytes(b"no" * 70000)
    assert sorted((r["path"][-5:], r["w"], r["h"], r["error"]) for r in files.images(spark, str(tmp_path)).collect()) == [("a.jpg", 400, 300, None), ("b.jpg", None, None, "not an image")]


def test_parsers(spark):
    df = spark.createDataFrame([("a=1\nb=x=y\nno\na=2", '{"title": "t", "headings": [{"level": 1, "text": "h"}]}', '{"page_stats": [1, 2]}'), (None, "{", '{"page_stats": {"n_pages": 7}}')], "kv string, meta string, marker string")
    got = df.select(files.key_values(F.col("kv")), files.docling_meta(F.col("meta"))["title"], files.page_count(F.col("marker"))).collect()
    assert tuple(got[0]) == ({"a": "2", "b": "x=y"}, "t", 2) and tuple(got[1]) == (None, None, 7)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s", "sections/01_a.md", "# A\n"), ("s", "meta.json", None)], "stem string, name string, content string")
    sinks.write_files(df, str(tmp_path))
    sinks.write_files(df, str(tmp_path))
    assert (tmp_path / "s/sections/01_a.md").read_text() == "# A\n" and sorted(os.listdir(tmp_path / "s")) == ["meta.json", "sections"]
    for _ in range(2):
        sinks.append_log(df.select("stem", "content").where("content is null"), str(tmp_path / "log"))
    assert [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "log")).collect()] == [{"stem": "s"}] * 2


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / f"in/2025-0{k + 1}_Cell_x_PMID{k}.md").write_text("a<br>b [1]")
        process_new(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("name.pmid", "text", "citation_style")) == [("0", "a b [1]\n", "bracketed"), ("1", "a b [1]\n", "bracketed")]


def test_session(spark):
    df = spark.range(10)
    assert checkpoint(df).count() == 10
    assert "broadcast" in broadcast_if_small(df, 10)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in broadcast_if_small(df, 9)._jdf.queryExecution().logical().toString().lower()
