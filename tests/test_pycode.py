SOURCE = '''
import os, a.b as c
from pkg.sub import x
from . import y
from .rel import z

def outer():
    """Outer
    text."""
    def inner(): pass

async def skipped(): pass

class K:
    def method(self):
        "  "
'''


def test_inventory(ingest_texts):
    docs, warnings = ingest_texts({"/m.py": SOURCE, "/none.py": "x = 1\n"})
    assert not warnings
    mine = [d for d in docs if d.source == "/m.py"]
    assert mine[0].page_content == SOURCE
    assert mine[1].page_content == (
        "This Python script imports the following libraries: a.b, os, pkg.sub, rel."
    )
    assert [d.function_name for d in mine[2:]] == ["outer", "inner", "method"]
    assert [d.page_content for d in mine[2:]] == [
        "Function 'outer': Outer\ntext.",
        "Function 'inner': No docstring provided.",
        "Function 'method': No docstring provided.",
    ]
    assert docs[-1].page_content == "This Python script imports the following libraries: ."


def test_broken_file_keeps_its_raw_row(ingest_texts):
    docs, warnings = ingest_texts({"/b.py": "def (:\n", "/c.py": "x = '\\ud800'\n\0"})
    assert [d.kind for d in docs] == ["raw", "raw"]
    assert [w.content_type for w in warnings] == ["unexpected", "unexpected"]
