"""Syntax extraction: the one step that runs Python per row.

``ast`` gives the tree of a file; this step only flattens it to rows. Graph
edges, scopes, control and data flow are joins and windows over those rows.
"""

from __future__ import annotations

import ast
import sys
import traceback
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors need not have this package installed: its code travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCOPE_TYPES = ("Module", "FunctionDef", "AsyncFunctionDef", "ClassDef")
FUNCTION_TYPES = ("FunctionDef", "AsyncFunctionDef")
DEFINITION_TYPES = ("FunctionDef", "AsyncFunctionDef", "ClassDef")
LOOP_TYPES = ("For", "AsyncFor", "While")
WITH_TYPES = ("With", "AsyncWith")
ENTRY, EXIT = ".__entry__", ".__exit__"

RAW_FIELDS = [
    ("file_id", "string"),
    ("seq", "int"),
    ("depth", "int"),
    ("path", "string"),
    ("ast_type", "string"),
    ("is_stmt", "boolean"),
    ("line", "int"),
    ("column", "int"),
    ("end_line", "int"),
    ("end_column", "int"),
    ("label", "string"),
    ("value", "string"),
    ("parent_path", "string"),
    ("parent_type", "string"),
    ("field", "string"),
    ("position", "int"),
    ("siblings", "int"),
    ("scope_path", "string"),
    ("owner_path", "string"),
    ("follow", "string"),
    ("loop_path", "string"),
    ("loop_follow", "string"),
    ("starred", "boolean"),
    ("ctx", "string"),
    ("asname", "string"),
    ("callee", "string"),
    ("bare_callee", "boolean"),
    ("body_len", "int"),
    ("orelse_len", "int"),
    ("final_len", "int"),
    ("exception_type", "string"),
    ("message", "string"),
    ("traceback", "string"),
]
RAW_DDL = ", ".join(f"`{name}` {kind}" for name, kind in RAW_FIELDS)
_ARROW = pa.schema(
    [
        (name, {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}[kind])
        for name, kind in RAW_FIELDS
    ]
)
_FLUSH_ROWS = 5_000


def _dotted(func: ast.expr) -> str:
    names: list[str] = []
    while isinstance(func, ast.Attribute):
        names.append(func.attr)
        func = func.value
    if isinstance(func, ast.Name):
        names.append(func.id)
    return ".".join(reversed(names)) or "<dynamic-call>"


def _traits(kind: type[ast.AST]) -> tuple[str, bool, bool, bool, tuple[str, ...], tuple[str, ...]]:
    """Of a node type: name, whether it is a statement, opens a scope and hides its names;
    fields that may label it, and all its fields."""
    name, fields = kind.__name__, kind._fields
    return (
        name,
        issubclass(kind, ast.stmt),
        name in SCOPE_TYPES,
        name in DEFINITION_TYPES or name == "Lambda",
        tuple(key for key in ("name", "id", "arg", "module") if key in fields),
        fields,
    )


_TRAITS: dict[type[ast.AST], tuple] = {}


def _label(node: ast.AST, keys: tuple[str, ...]) -> str:
    for key in keys:
        text = getattr(node, key, None)
        if isinstance(text, str):
            return text
    return ""


def _length(node: ast.AST, field: str) -> int:
    block = getattr(node, field, None)
    return len(block) if isinstance(block, list) else 0


def _onward(node: ast.AST, kind: str, field: str, path: str, beyond: str) -> str:
    """Where control goes after the last statement of a block of ``node``; ``beyond`` is
    where it goes after ``node``."""
    if kind in SCOPE_TYPES:
        return path + EXIT
    if kind in LOOP_TYPES and field == "body":
        return path
    if kind == "Try":
        if field == "body" and node.orelse:
            return f"{path}.orelse[0]"
        if field != "finalbody" and node.finalbody:
            return f"{path}.finalbody[0]"
    return beyond


def _rows(file_id: str, tree: ast.Module) -> Iterator[tuple]:
    # (node, path, parent path, parent type, field, position, siblings, depth, scope,
    #  statement that owns the names, where the block goes on, loop around, where
    #  that loop goes on, inside except*)
    pending = [(tree, "$", "", "", "", -1, 0, 0, "", "", "", "", "", False)]
    seq = 0
    while pending:
        node, path, above, above_type, field, at, of, depth, scope, owner, beyond, loop, after, starred = pending.pop()
        known = _TRAITS.get(type(node))
        if known is None:
            known = _TRAITS[type(node)] = _traits(type(node))
        kind, is_stmt, opens_scope, hides_names, labels, fields = known
        call = kind == "Call"
        follow = ""
        if is_stmt:
            owner = path
            follow = beyond = f"{above}.{field}[{at + 1}]" if at + 1 < of else beyond
        yield (
            file_id,
            seq,
            depth,
            path,
            kind,
            is_stmt,
            getattr(node, "lineno", 0),
            getattr(node, "col_offset", 0),
            getattr(node, "end_lineno", 0) or 0,
            getattr(node, "end_col_offset", 0) or 0,
            _label(node, labels) if labels else "",
            repr(node.value)[:200] if kind == "Constant" else kind if isinstance(node, ast.operator) else "",
            above,
            above_type,
            field,
            at,
            of,
            scope,
            owner,
            follow,
            loop if is_stmt else "",
            after if is_stmt else "",
            starred,
            type(node.ctx).__name__ if kind == "Name" else "",
            node.asname or "" if kind == "alias" else "",
            _dotted(node.func) if call else "",
            call and isinstance(node.func, ast.Name),
            _length(node, "body") if "body" in fields else 0,
            _length(node, "orelse") if "orelse" in fields else 0,
            _length(node, "finalbody") if "finalbody" in fields else 0,
            None,
            None,
            None,
        )
        seq += 1
        if not fields:
            continue
        if hides_names:
            owner = ""
        if opens_scope:
            scope, loop, after = path, "", ""
        starred = not opens_scope and (starred or kind == "TryStar")
        children = []
        for name in fields:
            held = getattr(node, name, None)
            if isinstance(held, ast.AST):
                children.append((held, f"{path}.{name}", path, kind, name, -1, 0, depth + 1, scope, owner, beyond, loop, after, starred))
            elif isinstance(held, list) and held:
                onward = _onward(node, kind, name, path, beyond)
                around = (path, follow) if kind in LOOP_TYPES and name == "body" else (loop, after)
                children += [
                    (child, f"{path}.{name}[{slot}]", path, kind, name, slot, len(held), depth + 1, scope, owner, onward, *around, starred)
                    for slot, child in enumerate(held)
                    if isinstance(child, ast.AST)
                ]
        children.reverse()
        pending += children


def _failure(file_id: str, error: Exception) -> tuple:
    row = dict.fromkeys(name for name, _ in RAW_FIELDS)
    row.update(
        file_id=file_id,
        line=getattr(error, "lineno", 0) or 0,
        column=getattr(error, "offset", 0) or 0,
        exception_type=type(error).__name__,
        message=str(error),
        traceback="".join(traceback.format_exception_only(type(error), error)).strip()[:2000],
    )
    return tuple(row.values())


def analyse(file_id: str, path: str, content: bytes, lossy: bool) -> list[tuple]:
    try:
        text = content.decode("utf-8", errors="replace" if lossy else "strict")
        return list(_rows(file_id, ast.parse(text, filename=path, type_comments=True)))
    except Exception as error:  # any failure becomes a row, never a failed task
        return [_failure(file_id, error)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), _ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def flatten(batches: Iterator[pa.RecordBatch], lossy: bool) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for batch in batches:
        # One file's text at a time: a batch may hold thousands of long ones.
        for file_id, path, content in zip(*batch.columns, strict=True):
            held += analyse(file_id.as_py(), path.as_py(), content.as_py(), lossy)
            while len(held) >= _FLUSH_ROWS:
                yield _batch(held[:_FLUSH_ROWS])
                del held[:_FLUSH_ROWS]
    if held:
        yield _batch(held)


def extract(files: DataFrame, lossy: bool = False) -> DataFrame:
    """One row per syntax node of ``files(file_id, path, content)``.

    A file that does not parse gives one row with ``exception_type`` set. Rows
    leave in bounded batches, however many nodes the files have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return flatten(batches, lossy)

    inputs = files.select("file_id", "path", F.col("content").cast("binary").alias("content"))
    return inputs.mapInArrow(run, RAW_DDL)


def syntax(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("exception_type").isNull())


def failures(raw: DataFrame) -> DataFrame:
    """One row per file that did not parse."""
    return raw.where(F.col("exception_type").isNotNull()).select(
        "file_id",
        "exception_type",
        F.col("message").alias("full_message"),
        F.substring("message", 1, 1000).alias("message"),
        "line",
        "column",
        "traceback",
    )
