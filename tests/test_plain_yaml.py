import random

import yaml

from corpuscope.functions import plain_yaml
from corpuscope.operators import workflows

DAG = '''dag:
  dag_id: "order_12"
  schedule_interval: "0 5 * * 3"
  default_args:
    owner: "Customer # 1: 'x' {y}"
tasks:
  "line_1":
    operator: "N"
    file: "part_7.py"
  "line_2":
    operator: "A"
execution:
  - "line_1 >> line_2"
'''
ODD = [
    DAG, DAG + "---\n" + DAG, 'dag:\n  dag_id: "a"\ntasks:\n', "tasks: {}\n", "a:\n- \"x\"\n", "a: \"x\"",
    'no: "x"\n', '"no": "x"\n', 'a: "x"\n a: "y"\n', 'a:\n    b: "x"\n  c: "y"\n', 'a: "x"\n\n', "---\n", "",
    'a: "x"\n---\n', 'a: "\\n"\n', 'a: " x  "\n', 'a: "x"\na: "y"\n', 'a:\n  - "x"\n  b: "y"\n',
    'a: {}\n  b: "x"\n', "\"" + "k" * 1100 + "\": \"x\"\n", 'a: "é"\n', 'a:\t"x"\n', 'a: "x" \n', '- "x"\n',
    'a:\n  - "x"\n  - "y"\nb:\n', ' a: "x"\n', 'a:\n  - "x"\n    - "y"\n', 'a:\n  b:\n  - "y"\n',
]


def _general(text):
    try:
        return list(yaml.load_all(text, Loader=yaml.CSafeLoader))
    except yaml.YAMLError:
        return "error"


def _ordered(value):
    """Also the order of keys counts."""
    if isinstance(value, dict):
        return [(k, _ordered(v)) for k, v in value.items()]
    return [_ordered(v) for v in value] if isinstance(value, list) else value


def test_what_is_read_is_what_the_general_parser_reads():
    random.seed(3)
    texts, marks = list(ODD), ['"', "\n", " ", "  ", ":", "- ", "---\n", "#", "&a ", "*a", "{}", "no", "\\", "'"]
    for _ in range(20_000):
        text = random.choice(ODD)
        for _ in range(random.randint(1, 3)):
            a = random.randint(0, len(text))
            text = text[:a] + random.choice(marks) * random.randint(0, 1) + text[a + random.randint(0, 3):]
        texts.append(text)
    plain = 0
    for text in texts:
        found = plain_yaml.read(text)
        if found is not None:
            plain += 1
            assert _ordered(found) == _ordered(_general(text)), text
    assert plain > 1_000


def test_workflows_of_the_plain_kind_need_no_general_parser(monkeypatch):
    want = workflows.parse(DAG)
    assert want["dags"][0]["dag_id"]["value"] == "order_12" and len(want["dags"][0]["tasks"]) == 2
    monkeypatch.setattr(yaml, "load_all", None)
    assert workflows.parse(DAG) == want
