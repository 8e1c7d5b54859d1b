"""Scanning trees, exclusion and the discovery report."""

import pytest
from helpers import sources

from codeweft.operators.discovery import discovery_report, should_exclude, split_files
from codeweft.plans.analyze import parse
from codeweft.sources.files import scan_tree, single_file, write_tree
from pyspark.sql import functions as F

TREE = {
    "app.py": "def f(x):\n    if x:\n        return 1\n    for i in x:\n        print(i)\n",
    "__init__.py": "",
    "_hidden/_mod.py": "y = 1\n",
    "gen_pb2.py": "z = 1\n",
    "tests/test_app.py": "assert 1\n",
    "notes.txt": "no",
}


def test_scan_finds_names_that_start_with_an_underscore(spark, tmp_path):
    root = tmp_path / "repo"
    for path, text in TREE.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_text(text)
    files = scan_tree(spark, str(root), "r")
    got = {r.path: bytes(r.content).decode() for r in files.collect()}
    assert got == {p: t for p, t in TREE.items() if p.endswith(".py")}
    copy = tmp_path / "copy"
    assert write_tree(files, str(copy)) == 5
    assert {r.path for r in scan_tree(spark, str(copy), "r").collect()} == set(got)


def test_single_file(spark):
    files = sources(spark, TREE)
    assert single_file(files, "tests/../tests/test_app.py").first().path == "tests/test_app.py"
    for bad in ("../app.py", "/app.py", "notes.txt", "missing.py"):
        with pytest.raises(ValueError):
            single_file(files, bad)


@pytest.mark.parametrize(
    ("path", "excluded"),
    [
        ("a/b.py", False), ("Build/x.py", True), ("build.py", False), ("x/generated/y.py", True), ("setup.py", True),
        ("Setup.PY", True), ("test_x.py", True), ("x_test.py", True), ("x_pb2.py", True), ("a/x_pb2_grpc.py", True),
        ("contest.py", False), ("site-packages/x.py", True), ("mytests/x.py", False),
    ],
)
def test_exclusion(spark, path, excluded):
    assert spark.range(1).select(should_exclude(F.lit(path)).alias("x")).first().x is excluded


def test_report(spark):
    files = sources(spark, {p: t for p, t in TREE.items() if p.endswith(".py")} | {"bad.py": "def (\n"})
    included, excluded = split_files(files)
    assert {r.path for r in excluded.collect()} == {"gen_pb2.py", "tests/test_app.py"}
    row = discovery_report(files, parse(included, lossy=True)).first()
    assert (row.raw_python_files, row.processed_python_files, row.excluded_python_files) == (6, 4, 2)
    assert (row.total_lines, row.parseable_files, row.parse_success_rate) == (7, 3, 0.75)
    assert row.has_branch and row.has_loop and row.has_call
