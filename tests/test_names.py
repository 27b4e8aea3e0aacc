"""No module of the library defines one top-level name twice (a later one would hide the first)."""

import ast
import os
from collections import Counter

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
MODULES = [
    os.path.join(folder, name)
    for top in ("headway", "workload")
    for folder, _, names in os.walk(os.path.join(ROOT, top))
    for name in names
    if name.endswith(".py")
]


@pytest.mark.parametrize("path", MODULES, ids=lambda p: os.path.relpath(p, ROOT))
def test_no_name_defined_twice(path):
    tree = ast.parse(open(path, encoding="utf-8").read())
    names = Counter(
        node.name for node in tree.body if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef))
    )
    assert [n for n, k in names.items() if k > 1] == []
