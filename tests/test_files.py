import os

import pytest
from pyspark.sql import functions as F

from corpuscope.config import EngineConfig
from corpuscope.model import doc
from corpuscope.plans.ingest import (
    FALLBACK,
    Processor,
    default_processors,
    ingest,
    ingest_repository,
    ingest_warnings,
)
from corpuscope.sources.repo_files import list_repository, read_repository


def put(root, name, data):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode("utf-8"))
    return path


def test_repository_walk(spark, tmp_path):
    root = str(tmp_path)
    put(root, "a/b/one.yaml", "x: 1\r\ny: 2\r")
    put(root, ".hidden/two.json", "{}")
    put(root, "_private/three.sql", "select 1")
    put(root, "empty.py", "")
    put(root, "bad.yaml", b"\xff\xfe")
    put(root, "UPPER.YAML", "x: 1")
    put(root, "skip.txt", "no")
    put(root, "z/.yaml", "just text")
    files = read_repository(spark, root, EngineConfig().extensions)
    rows = {os.path.relpath(r.path, root): r for r in files.collect()}
    assert set(rows) == {
        "a/b/one.yaml", ".hidden/two.json", "_private/three.sql", "empty.py", "bad.yaml", "z/.yaml",
    }
    assert rows["a/b/one.yaml"].content == "x: 1\ny: 2\n"
    assert rows["empty.py"].content == "" and rows["empty.py"].status == "ok"
    assert rows["bad.yaml"].content is None and rows["bad.yaml"].status == "unexpected"
    assert rows["z/.yaml"].ext == "" and rows["a/b/one.yaml"].ext == ".yaml"

    result = ingest_repository(spark, root)
    kinds = {
        (os.path.relpath(r.source, root), r.kind) for r in result.select("source", "kind").collect()
    }
    assert ("bad.yaml", "warning") in kinds and ("bad.yaml", "raw") not in kinds
    assert ("z/.yaml", "chunk") in kinds and ("empty.py", "python_summary") in kinds


def test_linked_folders_are_not_entered(spark, tmp_path):
    put(str(tmp_path), "r/a.md", "x")
    os.symlink(str(tmp_path), str(tmp_path / "r" / "loop"))
    assert list_repository(spark, str(tmp_path / "r"), (".md",)).count() == 1


def test_many_folders_are_listed_in_parallel(spark, tmp_path):
    for i in range(150):
        put(str(tmp_path), f"d{i % 75}/e{i}/f.md", str(i))
    listing = list_repository(spark, str(tmp_path), (".md",))
    assert listing.rdd.getNumPartitions() > 4
    assert listing.count() == 150


def test_file_that_vanished_is_a_warning(spark, tmp_path):
    from corpuscope.sources.repo_files import read_contents

    listing = spark.createDataFrame(
        [(str(tmp_path / "gone.yaml"), 3), (str(tmp_path / "gone.md"), 3)],
        "path string, n_bytes long",
    )
    rows = ingest(read_contents(listing, str(tmp_path)))
    assert [r["class"] for r in ingest_warnings(rows).collect()] == ["io"]


def test_own_processor(spark):
    files = spark.createDataFrame([("/a.ini", "K=V"), ("/b.md", "text")], "path string, content string")
    upper = Processor(
        lambda path, content, parsed: F.array(doc(kind=F.lit("ini"), page_content=F.upper(content)))
    )
    config = EngineConfig(extensions=(".ini", ".md"))
    rows = ingest(files, config, default_processors(config) | {".ini": upper}).collect()
    assert {(r.kind, r.page_content) for r in rows} == {("ini", "K=V"), ("chunk", "text")}


def test_extension_without_processor_is_chunked(spark):
    files = spark.createDataFrame([("/a.yaml", "dag: {}")], "path string, content string")
    only_text = {FALLBACK: default_processors()[FALLBACK]}
    assert [r.kind for r in ingest(files, processors=only_text).collect()] == ["chunk"]


def test_unknown_document_field():
    with pytest.raises(ValueError):
        doc(nonsense=None)


def test_table_functions_are_processors(spark, tmp_path):
    from corpuscope.queries import SettingsSections

    put(str(tmp_path), "a.ini", "[one]\nx = 1\ny=2\n[two]\n")
    put(str(tmp_path), "b.ini", "[one]\nx = 1\n[two]\nbroken\n")
    put(str(tmp_path), "c.ini", b"\xff\xfe")
    put(str(tmp_path), "d.md", "some text")
    put(str(tmp_path), "e.ini", "")
    config = EngineConfig(extensions=(".ini", ".md"))
    both = {".ini": SettingsSections, FALLBACK: default_processors()[FALLBACK]}
    rows = ingest_repository(spark, str(tmp_path), config, both).collect()
    got = {(os.path.basename(r.source), r.ordinal, r.kind): (r.doc_id, r.content_type) for r in rows}
    assert got == {
        ("a.ini", 0, "section"): ("one", None), ("a.ini", 1, "section"): ("two", None),
        ("b.ini", 0, "section"): ("one", None), ("b.ini", 1, "warning"): (None, "unexpected"),
        ("c.ini", 0, "warning"): (None, "unexpected"), ("d.md", 0, "chunk"): (None, None),
    }
    assert len({r.row_id for r in rows}) == len(rows)

    class Wrong(SettingsSections):
        @staticmethod
        def analyze(path, content):
            from pyspark.sql import types as T
            from pyspark.sql.udtf import AnalyzeResult

            return AnalyzeResult(T.StructType([T.StructField("colour", T.StringType())]))

    with pytest.raises(Exception, match="no document fields"):
        ingest_repository(spark, str(tmp_path), config, {".ini": Wrong}).collect()


def test_deep_and_broad_trees_are_listed_in_rounds(spark, tmp_path, monkeypatch):
    from corpuscope.sources import repo_files

    root = str(tmp_path)
    monkeypatch.setattr(repo_files, "_MOST_ENTRIES", 300)
    os.makedirs(os.path.join(root, "broad"))
    for k in range(3000):
        open(os.path.join(root, "broad", f"f{k}.md"), "w").close()
    deep = root
    for k in range(400):
        deep = os.path.join(deep, "d")
        os.mkdir(deep)
        if k % 10 == 0:
            open(os.path.join(deep, "x.sql"), "w").close()
    for k in range(200):
        put(root, f"many/{k % 50}/{k}/a.py", "")

    found = list_repository(spark, root, (".md", ".sql", ".py")).collect()
    assert len(found) == len({r.path for r in found}) == 3000 + 40 + 200
    # What one task walks below a folder is bounded, whatever hangs below it.
    filesystem, top = repo_files._open(root)
    part = list(repo_files._walked(filesystem, os.path.join(top, "many"), 64))
    assert 0 < sum(1 for p in part if not p[2]) < 200 and any(p[2] for p in part)


def test_links_that_lead_nowhere_are_warnings(spark, tmp_path):
    root = str(tmp_path)
    put(root, "a.md", "text")
    put(root, "real.yaml", "dag: {dag_id: x}")
    os.symlink(os.path.join(root, "gone.yaml"), os.path.join(root, "lost.yaml"))
    os.symlink(os.path.join(root, "real.yaml"), os.path.join(root, "same.yaml"))
    rows = ingest_repository(spark, root).collect()
    found = {(os.path.basename(r.source), r.kind, r.content_type) for r in rows}
    assert ("lost.yaml", "warning", "io") in found
    assert ("same.yaml", "dag_summary", None) in found and ("real.yaml", "raw", None) in found
    assert not any(n == "lost.yaml" and k != "warning" for n, k, _ in found)
