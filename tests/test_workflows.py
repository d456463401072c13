FORKED = """
dag:
  dag_id: tide_tables
  schedule_interval: "30 2 * * *"
  description: "Tides per harbour"
  default_args: {owner: "mara"}
tasks:
  gauges: {operator: sensor, file: jobs/gauges.py}
  north: {operator: batch, file: jobs/north.py}
  south: {operator: batch}
  publish: {operator: upload, file: jobs/publish.py}
execution:
  - "gauges >> north >> publish"
  - "gauges >> south >> publish"
  - "gauges >> north"
"""


def tasks(docs):
    return {d.task_name: d for d in docs if d.kind == "dag_task"}


def test_fork_and_join(ingest_texts):
    docs, warnings = ingest_texts({"/w/tides.yaml": FORKED})
    assert [d.kind for d in docs] == ["raw", "dag_summary"] + ["dag_task"] * 4
    assert [d.ordinal for d in docs] == list(range(6)) and not warnings
    assert docs[0].page_content == FORKED and docs[0].doc_id == "raw:/w/tides.yaml"
    assert docs[1].doc_id == "tide_tables:__DAG_SUMMARY__"
    assert docs[1].page_content == (
        "This document describes the DAG configuration with ID 'tide_tables'. "
        "The owner is 'mara', it runs on schedule: '30 2 * * *', "
        "and its description is: 'Tides per harbour'."
    )
    found = tasks(docs)
    assert "script 'jobs/gauges.py'" in found["gauges"].page_content
    assert "after" not in found["gauges"].page_content
    assert "script 'not specified'" in found["south"].page_content
    # Neighbours stand in the order of the flows; an edge that is written twice counts twice.
    ends = {
        "gauges": "It runs before the following task(s): north, south, north.",
        "north": "It runs after the following task(s): gauges, gauges. "
        "It runs before the following task(s): publish.",
        "south": "It runs after the following task(s): gauges. "
        "It runs before the following task(s): publish.",
        "publish": "It runs after the following task(s): north, south.",
    }
    assert all(found[t].page_content.endswith(f"'. {end}") for t, end in ends.items())
    north = found["north"]
    assert (north.dag_id, north.owner, north.operator) == ("tide_tables", "mara", "batch")
    assert (north.schedule, north.script_file) == ("30 2 * * *", "jobs/north.py")
    assert len({d.row_id for d in docs}) == 6


def test_no_dag_empty_and_invalid(ingest_texts):
    broken = 'dag:\n  tasks:\n    t: operator: "x"\n'
    docs, warnings = ingest_texts(
        {"/a.yaml": "config:\n  a: 1\n", "/b.yaml": "", "/c.yaml": broken, "/d.yaml": "- 1\n"}
    )
    assert [(d.source, d.kind) for d in docs] == [
        (p, "raw") for p in ("/a.yaml", "/b.yaml", "/c.yaml", "/d.yaml")
    ]
    assert docs[1].page_content == "" and docs[2].page_content == broken
    assert [(w.source, w.content_type) for w in warnings] == [("/c.yaml", "invalid_syntax")]


def test_several_dags_do_not_mix(ingest_texts):
    text = "\n---\n".join(
        f"dag:\n  dag_id: {n}\n  default_args: {{owner: {n}_owner}}\n"
        f"tasks:\n  {n}_1: {{operator: o}}\n  {n}_2: {{operator: o}}\n"
        f'execution: ["{n}_1 >> {n}_2"]\n'
        for n in ("alpha", "beta")
    )
    docs, _ = ingest_texts({"/m.yaml": text})
    assert len(docs) == 7 and [d.ordinal for d in docs] == list(range(7))
    assert {(d.dag_id, d.owner) for d in docs[1:]} == {
        ("alpha", "alpha_owner"), ("beta", "beta_owner"),
    }
    assert "after the following task(s): beta_1." in tasks(docs)["beta_2"].page_content


def test_rows_before_the_first_faulty_dag_stay(ingest_texts):
    good = "dag: {{dag_id: {0}}}\ntasks: {{t: {{operator: x}}}}\n"
    faults = {
        "tasks_null": "dag: {dag_id: bad}\ntasks:\n",
        "dag_null": "dag:\ntasks: {}\n",
        "args_list": "dag: {default_args: [1]}\n",
        "task_text": "dag: {dag_id: bad}\ntasks: {t: run}\n",
        "flow_number": "dag: {dag_id: bad}\nexecution: [1]\n",
    }
    docs, warnings = ingest_texts(
        {
            f"/{n}.yaml": "---\n".join([good.format("one"), fault, good.format("three")])
            for n, fault in faults.items()
        }
    )
    for name in faults:
        mine = [d for d in docs if d.source == f"/{name}.yaml"]
        assert [d.doc_id for d in mine[1:]] == ["one:__DAG_SUMMARY__", "one:t"], name
    assert {w.source for w in warnings} == {f"/{n}.yaml" for n in faults}
    assert {w.content_type for w in warnings} == {"unexpected"}


def test_missing_and_null_values_differ(ingest_texts):
    missing = "dag: {}\ntasks: {t: {}}\n"
    null = (
        "dag: {dag_id: null, schedule_interval: ~, description: null, default_args: {owner: }}\n"
        "tasks: {t: {operator: null, file: null}}\n"
    )
    docs, _ = ingest_texts({"/m.yaml": missing, "/n.yaml": null})
    _, m_sum, m_task, _, n_sum, n_task = docs
    assert "ID 'N/A'. The owner is 'N/A', it runs on schedule: 'N/A'" in m_sum.page_content
    assert "description is: 'No description provided.'" in m_sum.page_content
    assert "uses the 'unknown' operator and runs the script 'not specified'" in m_task.page_content
    assert "ID 'None'. The owner is 'None', it runs on schedule: 'None'" in n_sum.page_content
    assert "uses the 'None' operator and runs the script 'None'" in n_task.page_content
    assert (m_sum.dag_id, m_task.operator) == ("N/A", "unknown")
    assert (n_sum.dag_id, n_task.operator) == (None, None)
    assert n_task.doc_id == "None:t"


def test_flows(ingest_texts):
    text = """
dag: {dag_id: d}
tasks:
  a: {}
  b: {}
  1: {}
  c: {}
execution:
  - "a >> b"
  - "a>>b >> 1"
  - "  x >>\\ta "
  - "c >> "
  - "c"
"""
    docs, _ = ingest_texts({"/f.yaml": text})
    by_name = tasks(docs)
    assert set(by_name) == {"a", "b", "1", "c"}
    assert by_name["a"].page_content.endswith(
        "It runs after the following task(s): x. It runs before the following task(s): b, b."
    )
    assert by_name["b"].page_content.endswith(
        "It runs after the following task(s): a, a. It runs before the following task(s): 1."
    )
    # A key that is not text is never named by a flow.
    assert by_name["1"].page_content.endswith("the script 'not specified'.")
    assert by_name["c"].page_content.endswith("It runs before the following task(s): .")


def test_execution_that_is_not_a_list_gives_no_edges(ingest_texts):
    docs, warnings = ingest_texts(
        {"/f.yaml": 'dag: {dag_id: d}\ntasks: {a: {}, b: {}}\nexecution: "a >> b"\n'}
    )
    assert not warnings and all("following" not in d.page_content for d in docs[1:])


def test_values_are_rendered_as_text(ingest_texts):
    docs, _ = ingest_texts(
        {"/v.yaml": "dag: {dag_id: 7, description: true, schedule_interval: 2024-01-02}\n"}
    )
    assert "ID '7'" in docs[1].page_content and "is: 'True'" in docs[1].page_content
    assert "schedule: '2024-01-02'" in docs[1].page_content


def test_large_dag_with_hub(ingest_texts):
    n = 3000
    body = "".join(f"  t{i}: {{operator: o}}\n" for i in range(n)) + "  hub: {operator: o}\n"
    flows = "".join(f'  - "t{i} >> hub"\n' for i in range(n))
    docs, _ = ingest_texts({"/h.yaml": f"dag: {{dag_id: d}}\ntasks:\n{body}execution:\n{flows}"})
    hub = tasks(docs)["hub"].page_content
    assert hub.count(", ") == n - 1 + 0 and hub.endswith(f"t{n - 1}.")
    assert tasks(docs)["t7"].page_content.endswith("before the following task(s): hub.")


def bomb(levels):
    lines = ["x0: &x0 [%s]" % ", ".join(["lol"] * 10)]
    for k in range(1, levels):
        lines.append("x%d: &x%d [%s]" % (k, k, ", ".join(["*x%d" % (k - 1)] * 10)))
    return "\n".join(lines) + "\ndag: {dag_id: *x%d}\n" % (levels - 1)


def test_files_beyond_their_budget_are_warnings(ingest_texts):
    texts = {
        "/a.yaml": bomb(9),
        "/b.yaml": "dag: {dag_id: b}\ndeep: " + "[" * 100000,
        "/c.yaml": "dag: {dag_id: c}\nlist:\n" + "- " * 3000 + "x",
        "/d.yaml": "dag: &d {dag_id: d, self: *d}",
        "/e.yaml": "\n".join("  " * k + "k%d:" % k for k in range(600)),
        "/f.yaml": bomb(2),
        "/g.yaml": "base: &b {owner: ana}\ndag: {dag_id: g, default_args: {<<: *b}}",
        "/h.yaml": "dag: {dag_id: h}\nnote: 'a * b & c [ [ ['",
        "/i.yaml": "dag: {dag_id: *nothing}\nx: &y 1",
        "/j.yaml": "big: " + "{a: [1, 2]}, " * 300,
    }
    docs, found = ingest_texts(texts)
    classes = {w.source: w.content_type for w in found}
    assert {p for p, c in classes.items() if c == "too_large"} == {"/a.yaml", "/b.yaml", "/c.yaml", "/d.yaml", "/e.yaml"}
    assert classes["/i.yaml"] == classes["/j.yaml"] == "invalid_syntax"
    summaries = {d.source: d.owner for d in docs if d.kind == "dag_summary"}
    assert set(summaries) == {"/f.yaml", "/g.yaml", "/h.yaml"} and summaries["/g.yaml"] == "ana"
    assert {d.source for d in docs if d.kind == "raw"} == set(texts)
    # The longest name that is written out stays within the budget.
    assert max(len(d.page_content) for d in docs if d.kind != "raw") < 2000


def test_only_what_is_wanted_is_built(spark):
    from corpuscope.plans.ingest import ingest

    late = FORKED + "---\ndag: {dag_id: second}\ntasks: {only: {}}\n---\ndag: 1\n---\n" + FORKED
    files = spark.createDataFrame(
        [("/a.yaml", late), ("/b.yaml", "a: ["), ("/c.py", "def ("), ("/d.md", "text")],
        "path string, content string",
    )
    whole = ingest(files)
    for wanted in ((), ("raw",), ("dag_summary",), ("dag_task", "raw"), ("dag_summary", "dag_task")):
        some = ingest(files, kinds=wanted)
        kept = whole.where(whole.kind.isin(*wanted, "warning"))
        assert sorted(some.collect(), key=str) == sorted(kept.collect(), key=str)
        yaml = ingest(files.where("path like '%.yaml'"), kinds=wanted)
        plan = yaml._jdf.queryExecution().optimizedPlan().toString()
        assert ("contains a task named" in plan) == ("dag_task" in wanted)
        assert ("describes the DAG" in plan) == ("dag_summary" in wanted)
    some = ingest(files, fields=("doc_id", "owner"))
    assert some.columns == ["row_id", "source", "ordinal", "kind", "doc_id", "owner"]
    assert sorted(some.collect(), key=str) == sorted(whole.select(some.columns).collect(), key=str)
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "contains a task named" not in plan
