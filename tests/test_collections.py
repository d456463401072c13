import json
import os

import pytest
from pyspark.sql import functions as F

from corpuscope.config import EVAL_TOP_K, EngineConfig
from corpuscope.operators import evaluation
from corpuscope.operators.filters import to_json
from corpuscope.plans.ask import ask, retrieve
from corpuscope.plans.index import index_repository, update_collection, write_collection
from corpuscope.plans.ingest import ingest
from corpuscope.sources.collections import latest_warnings, open_collection
from corpuscope.sources.golden import read_golden


def dag(name, owner, schedule):
    return (
        f'dag: {{dag_id: {name}, schedule_interval: "{schedule}", description: "{name} job", '
        f"default_args: {{owner: {owner}}}}}\n"
        f"tasks: {{extract_{name}: {{operator: ecs, file: src/{name}.py}}}}\n"
    )


@pytest.fixture(scope="module")
def repository(tmp_path_factory):
    root = tmp_path_factory.mktemp("repo")
    (root / "dags").mkdir()
    for name, owner, day in (("sales", "ana", 1), ("stock", "bob", 2), ("score", "ana", 1)):
        (root / "dags" / f"{name}.yaml").write_text(dag(name, owner, f"0 5 * * {day}"))
    (root / "broken.yaml").write_text("depth: [1, 2")
    (root / "dim.json").write_text(
        json.dumps(
            {
                "schema": "harbour", "table": "berths", "table_description": "Berths and piers",
                "column_types": {"id": {"description": "Berth number"}},
            }
        )
    )
    (root / "q.sql").write_text("select * from harbour.berths")
    (root / "u.py").write_text('def util():\n    """Cleans phone numbers."""\n')
    (root / "n.md").write_text("Notes about phone numbers")
    return str(root)


@pytest.fixture(scope="module")
def collection(spark, repository, tmp_path_factory):
    return index_repository(spark, repository, str(tmp_path_factory.mktemp("store")))


def questions(spark, *rows):
    return spark.createDataFrame(list(rows), "query_id string, question string, filter string, limit int")


def test_index_and_ask(spark, collection, repository):
    assert collection.documents.count() == collection.vectors.count() == 19
    assert [os.path.basename(r.path) for r in collection.warnings.collect()] == ["broken.yaml"]
    asked = questions(
        spark,
        ("owner", "Who is the owner of the DAG 'sales'?", to_json({"eq": ["dag_id", "sales"]}), 1),
        ("purpose", "What is the purpose of the util function?", None, None),
        ("reads", "Which SQL scripts read from the table harbour.berths?", None, 1),
        ("blank", " \n", None, None),
    )
    answers = {r.query_id: r for r in ask(collection, asked, k=3).collect()}
    assert set(answers) == {"owner", "purpose", "reads"}
    assert "owner is 'ana'" in answers["owner"].context and answers["owner"].n_rows == 1
    assert "Cleans phone numbers" in answers["purpose"].context
    assert answers["reads"].sources == [f"{repository}/q.sql"]
    assert answers["purpose"].sources == sorted(set(answers["purpose"].sources))


def test_filter_for_all_questions(spark, collection):
    """Which DAGs run on the schedule '0 5 * * 1'?"""
    spec = {"and": [{"eq": ["schedule", "0 5 * * 1"]}, {"eq": ["kind", "dag_summary"]}]}
    found = retrieve(
        collection, questions(spark, ("s", "DAG schedule", None, None)), k=10, where=spec
    ).join(collection.documents.select("row_id", "dag_id"), "row_id")
    assert {r.dag_id for r in found.collect()} <= {"sales", "score"}
    with pytest.raises(ValueError):
        retrieve(collection, questions(spark), where={"eq": ["page_content", "x"]})


def test_diverse_retrieval_finds_the_table(spark, collection):
    asked = questions(spark, ("t", "describes the table 'berths'", None, None))
    found = retrieve(collection, asked, k=8, diverse=True).join(collection.documents, "row_id")
    assert "table" in {r.kind for r in found.collect()}


def test_own_vectoriser(spark, repository, tmp_path):
    def letters(df):
        text = F.lower("page_content")
        return df.withColumn(
            "embedding",
            F.array(*[F.regexp_count(text, F.lit(c)).cast("float") for c in "abcdefghij"]),
        )

    stored = index_repository(spark, repository, str(tmp_path), vectoriser=letters)
    text = stored.documents.where("kind = 'function'").first()
    asked = questions(spark, ("f", text.page_content, None, None))
    assert retrieve(stored, asked, k=1, vectoriser=letters).first().row_id == text.row_id


def test_collections_are_separate_and_overwritten(spark, tmp_path):
    def rows(*texts):
        data = [(f"/{i}.md", t) for i, t in enumerate(texts)]
        return ingest(spark.createDataFrame(data, "path string, content string"))

    root = str(tmp_path)
    other = EngineConfig(collection="other")
    assert write_collection(rows("one", "two"), root)
    assert write_collection(rows("three"), root, other)
    assert write_collection(rows("four"), root)
    texts = lambda n: [r.page_content for r in open_collection(spark, root, n).documents.collect()]
    assert texts("default") == ["four"] and texts("other") == ["three"]
    assert not write_collection(rows("five").where("false"), root, other)
    broken = ingest(spark.createDataFrame([("/b.json", "{")], "path string, content string"))
    assert not write_collection(broken.where("kind = 'warning'"), root, other)
    assert [r.path for r in latest_warnings(spark, root, "other").collect()] == ["/b.json"]
    assert texts("other") == ["three"]
    with pytest.raises(FileNotFoundError):
        open_collection(spark, root, "absent")
    with pytest.raises(ValueError):
        open_collection(spark, root, "../x")


def test_empty_repository(spark, tmp_path):
    assert index_repository(spark, str(tmp_path), str(tmp_path / "store")) is None


def test_golden_questions(spark, tmp_path):
    """Each of three questions has its expected row first among four."""
    path = str(tmp_path / "golden.json")
    items = [
        ("Where are tide gauges calibrated?", "tides:calibrate"),
        ("Who publishes the mooring fees?", "fees:publish"),
        ("Which job archives pilot logbooks at midnight?", "pilots:archive"),
    ]
    with open(path, "w") as f:
        json.dump(
            [{"question": q, "expected_ids": [i], "type": "single_must_find"} for q, i in items], f
        )
    golden = read_golden(spark, path)
    assert golden.count() == 3
    docs = [
        ("1", "tides:calibrate", "Tide gauges are calibrated at the north pier"),
        ("2", "fees:publish", "Mooring fees are published by the harbour office"),
        ("3", "pilots:archive", "Pilot logbooks go to the archive at midnight"),
        ("4", "lamps:replace", "Lamps of the beacon are replaced in spring"),
    ]
    rows = ingest(spark.createDataFrame([], "path string, content string"))
    data = spark.createDataFrame(docs, "row_id string, doc_id string, page_content string")
    rows = rows.unionByName(data.withColumn("kind", F.lit("raw")), allowMissingColumns=True)
    write_collection(rows, str(tmp_path / "store"))
    stored = open_collection(spark, str(tmp_path / "store"), "default")
    results = retrieve(stored, golden, k=EVAL_TOP_K).join(
        stored.documents.select("row_id", "doc_id"), "row_id"
    )
    assert all(r.found_all for r in evaluation.containment(results, golden).collect())
    row = evaluation.summary(
        evaluation.per_question(evaluation.mark_expected(results, golden))
    ).first()
    assert row.hit_rate_ok and row.mrr_ok


def test_an_update_equals_a_full_index(spark, tmp_path):
    def files(texts):
        return spark.createDataFrame(list(texts.items()), "path string, content string")

    first = {f"/p/{k}.py": f"import lib_{k % 5}\n\n\ndef f{k}():\n    '''Does {k % 7} things.'''\n" for k in range(60)}
    first |= {"/bad.py": "def (:", "/d.yaml": dag("sales", "ana", "0 5 * * 1"), "/skip.txt": "no"}
    then = {p: t for p, t in first.items() if p not in ("/p/3.py", "/p/4.py")}
    then |= {"/p/7.py": "import other\n", "/bad.py": "import fixed\n", "/p/9.py": "def (:", "/new.md": "lib_1 is new"}
    root, whole = str(tmp_path / "inc"), str(tmp_path / "full")
    assert update_collection(files(first), root)
    assert update_collection(files(then), root)
    write_collection(ingest(files(then)), whole)
    a, b = (open_collection(spark, r, "default") for r in (root, whole))
    key = lambda df: sorted(map(str, (r.asDict(True) for r in df.collect())))
    assert key(a.documents) == key(b.documents)
    assert key(a.warnings) == key(b.warnings) and a.warnings.count() == 1
    assert key(a.vocabulary.table) == key(b.vocabulary.table)
    assert (a.vocabulary.n_docs, a.vocabulary.n_terms, a.vocabulary.n_pairs) == (
        b.vocabulary.n_docs, b.vocabulary.n_terms, b.vocabulary.n_pairs
    )
    columns = b.vectors.columns
    assert key(a.vectors.select(columns)) == key(b.vectors)
    # Nothing differs: nothing is parsed, and the collection stays what it is.
    assert update_collection(files(then), root)
    assert key(open_collection(spark, root, "default").vectors.select(columns)) == key(b.vectors)
    assert not update_collection(files({"/x.txt": "none"}), root)
    assert open_collection(spark, root, "default").documents.count() == b.documents.count()


def test_only_changed_files_are_parsed(spark, tmp_path):
    """A processor that fails on any content it has been given before."""
    from corpuscope.functions.parsing import Parser
    from corpuscope.model import doc
    from corpuscope.plans.ingest import Processor
    from pyspark.sql import types as T

    folder = tmp_path / "seen"
    folder.mkdir()

    def parse(text):
        # One empty file per parse of a text.
        name = str(len(text)) + "-" + text.strip().replace(" ", "_")
        open(os.path.join(str(folder), f"{name}-{os.getpid()}-{os.urandom(4).hex()}"), "w").close()
        return text

    one = Processor(
        lambda path, content, parsed: F.array(doc(kind=F.lit("note"), page_content=parsed)),
        parser=Parser(parse, T.StringType()),
    )
    files = lambda texts: spark.createDataFrame(list(texts.items()), "path string, content string")
    config = EngineConfig(extensions=(".note",))
    texts = {f"/{k}.note": f"note {k}" for k in range(30)}
    update_collection(files(texts), str(tmp_path / "s"), config, {".note": one})
    before = len(os.listdir(folder))
    texts["/3.note"] = "note changed"
    update_collection(files(texts), str(tmp_path / "s"), config, {".note": one})
    new = os.listdir(folder)
    assert len(new) - before <= 2 and any("note_changed" in n for n in new)
    found = open_collection(spark, str(tmp_path / "s"), "default")
    assert found.documents.count() == 30


def test_documents_are_counted_by_their_write(spark, tmp_path):
    texts = {f"/{k}.md": f"text {k}" for k in range(25)} | {"/bad.py": "def (:"}
    files = spark.createDataFrame(list(texts.items()), "path string, content string")
    assert write_collection(ingest(files), str(tmp_path))
    stored = open_collection(spark, str(tmp_path), "default")
    assert stored.vocabulary.n_docs == stored.documents.count() == 26
    assert stored.warnings.count() == 1
