import json

from pyspark.sql import functions as F

from corpuscope.functions.parsing import with_parsed
from corpuscope.operators import dictionary
from corpuscope.plans.ingest import with_extension

COLUMNS = {
    "zone_id": {
        "column_type": "int", "max_length": "None", "description": "Berth number.",
        "pii_confidentiality_impact_level": None,
    },
    "alpha": {
        "column_type": "string", "max_length": "64", "description": "Name of the pier.",
        "pii_confidentiality_impact_level": "restricted",
    },
    "missing": {},
    "null": {"description": None},
}
TABLE = {
    "schema": "harbour", "table": "dim", "table_description": "Berths and piers.",
    "source": ["lake.a", "lake.b"], "column_types": COLUMNS, "table_id": ["id", "id2"],
}


def test_table_and_columns_in_file_order(ingest_texts):
    text = json.dumps(TABLE, ensure_ascii=False, indent=4)
    docs, warnings = ingest_texts({"/d.json": text})
    assert not warnings
    assert [d.kind for d in docs] == ["raw", "table"] + ["column"] * 4
    assert docs[0].page_content == text and docs[0].doc_id is None
    assert docs[1].page_content == (
        "This document describes the table 'dim' in the schema 'harbour'. "
        "Description: Berths and piers."
    )
    assert [d.column for d in docs[2:]] == list(COLUMNS)
    assert [d.page_content.rsplit(": ", 1)[1] for d in docs[2:]] == [
        "Berth number.", "Name of the pier.", "N/A", "None",
    ]
    assert docs[2].page_content.startswith("In table 'dim', column 'zone_id' has the description: ")
    assert (docs[2].schema, docs[2].table) == ("harbour", "dim")


def test_not_a_dictionary(ingest_texts):
    texts = {
        "/1.json": '{"schema": "s"}', "/2.json": "[1]", "/3.json": "3", "/4.json": '{"a": 1} x',
        "/5.json": "{'a': 1}", "/6.json": '["schema", "table"]', "/7.json": "",
    }
    docs, warnings = ingest_texts(texts)
    assert [d.kind for d in docs] == ["raw"] * 7
    assert {w.source: w.content_type for w in warnings} == {
        "/3.json": "unexpected", "/4.json": "invalid_syntax", "/5.json": "invalid_syntax",
        "/6.json": "unexpected", "/7.json": "invalid_syntax",
    }


def test_columns_before_a_faulty_one_stay(ingest_texts):
    head = '{"schema": null, "table": true, "column_types": '
    docs, warnings = ingest_texts(
        {
            "/a.json": head + '{"x": {}, "y": "text", "z": {}}}',
            "/b.json": head + "null}",
            "/c.json": '{"schema": 1, "table": "t"}',
            "/d.json": head + '{"x": {"description": "1"}, "y": {}, "x": {"description": "2"}}}',
        }
    )
    of = lambda p: [(d.kind, d.column) for d in docs if d.source == p][1:]
    assert of("/a.json") == [("table", None), ("column", "x")]
    assert of("/b.json") == [("table", None)]
    assert of("/c.json") == [("table", None)]
    assert of("/d.json") == [("table", None), ("column", "x"), ("column", "y")]
    assert [d.page_content[-1] for d in docs if d.source == "/d.json" and d.column == "x"] == ["2"]
    assert "table 'True' in the schema 'None'" in docs[1].page_content
    assert {w.source for w in warnings} == {"/a.json", "/b.json"}


def test_rich_texts(spark):
    files = spark.createDataFrame([("/d.json", json.dumps(TABLE))], "path string, content string")
    parsed = with_parsed(with_extension(files, (".json",)), {".json": dictionary.PARSER})
    docs = parsed.select(
        F.explode(dictionary.derived_documents(F.col("parsed.p0"), rich=True)).alias("d")
    ).select("d.*").collect()
    assert docs[0].table == "harbour.dim"
    for part in (
        "describes the table 'harbour.dim'", "Description: Berths and piers.",
        "primary key(s) are: id, id2", "sourced from the following locations: lake.a, lake.b",
    ):
        assert part in docs[0].page_content
    assert "In table 'harbour.dim', the column 'zone_id'" in docs[1].page_content
    assert "type 'int'" in docs[1].page_content and "PII" not in docs[1].page_content
    assert "max length of '64'" in docs[2].page_content
    assert "impact level of 'restricted'" in docs[2].page_content
