import ast
from pathlib import Path

import __spark_entry__


def test_entry_names_a_registered_query():
    tree = ast.parse(Path(__spark_entry__.__file__).read_text())
    entry = next(f for f in tree.body if isinstance(f, ast.FunctionDef) and f.name == "entry")
    named = [n.slice.value for n in ast.walk(entry) if isinstance(n, ast.Subscript)]
    assert named and set(named) <= set(__spark_entry__.queries())
