"""Plain-Python check of the graph rules, for small inputs.

Control flow asks each statement where it goes on, by walking up from it.
Data flow searches backwards from each use, one variable at a time. Neither
shares code or method with the Spark operators.
"""

from __future__ import annotations

import ast
from collections import defaultdict
from hashlib import sha256

SCOPES = (ast.Module, ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)
DEFS = (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)
LOOPS = (ast.For, ast.AsyncFor, ast.While)


def h(*parts) -> str:
    return sha256("\x1f".join(map(str, parts)).encode()).hexdigest()


class Expected:
    def __init__(self, text: str, fid: str):
        self.fid = fid
        self.tree = ast.parse(text, type_comments=True)
        self.path, self.up, self.order = {}, {}, []
        self.ast_edges = set()
        self._number(self.tree)
        self.scope_of = {}
        for p, (node, _) in self.byp.items():
            self.scope_of[p] = self._scope(p)
        self.cfg = self._cfg()
        self.calls = self._calls()
        self.dfg = self._dfg()

    # paths: everything is keyed by path because ctx nodes are shared objects
    def _number(self, tree):
        self.byp = {"$": (tree, None)}
        stack = ["$"]
        while stack:
            p = stack.pop()
            node = self.byp[p][0]
            for f, v in ast.iter_fields(node):
                for i, c in enumerate(v) if isinstance(v, list) else [(None, v)]:
                    if isinstance(c, ast.AST):
                        q = f"{p}.{f}" + ("" if i is None else f"[{i}]")
                        self.byp[q] = (c, p)
                        self.ast_edges.add((p, q, q[len(p) + 1 :]))
                        stack.append(q)

    def node(self, p):
        return self.byp[p][0]

    def id(self, p):
        kind = {"__entry__": "ScopeEntry", "__exit__": "ScopeExit"}.get(p.rsplit(".", 1)[-1])
        return h(self.fid, p, kind or type(self.node(p)).__name__)

    def _scope(self, p):
        q = self.byp[p][1]
        while q is not None and not isinstance(self.node(q), SCOPES):
            q = self.byp[q][1]
        return q

    def stmt_parent(self, p):
        q = self.byp[p][1]
        while not isinstance(self.node(q), (ast.stmt, ast.Module)):
            q = self.byp[q][1]
        return q

    def follow(self, p):
        owner = self.byp[p][1]
        step = p[len(owner) + 1 :]
        field, i = step[:-1].split("[")
        block = getattr(self.node(owner), field)
        if int(i) + 1 < len(block):
            return f"{owner}.{field}[{int(i) + 1}]"
        o = self.node(owner)
        if isinstance(o, SCOPES):
            return f"{owner}.__exit__"
        if isinstance(o, LOOPS) and field == "body":
            return owner
        if isinstance(o, (ast.Try, ast.ExceptHandler)):
            tp = owner if isinstance(o, ast.Try) else self.byp[owner][1]
            t = self.node(tp)
            if o is t and field == "body" and t.orelse:
                return f"{tp}.orelse[0]"
            if field != "finalbody" and t.finalbody:
                return f"{tp}.finalbody[0]"
            return self.follow(tp)
        return self.follow(owner if isinstance(o, ast.stmt) else self.byp[owner][1])

    def statements(self, scope=None):
        return [
            p
            for p, (n, _) in self.byp.items()
            if isinstance(n, ast.stmt) and (scope is None or self.scope_of[p] == scope)
        ]

    def in_star(self, p):
        q = self.byp[p][1]
        while not isinstance(self.node(q), SCOPES):
            if isinstance(self.node(q), ast.TryStar):
                return True
            q = self.byp[q][1]
        return False

    def loop(self, p):
        while True:
            q = self.byp[p][1]
            if isinstance(self.node(q), SCOPES):
                return None
            if isinstance(self.node(q), LOOPS) and p[len(q) + 1 :].startswith("body["):
                return q
            p = q

    def _cfg(self):
        out = set()
        for p, (n, _) in self.byp.items():
            if isinstance(n, SCOPES):
                out.add((f"{p}.__entry__", f"{p}.body[0]" if n.body else f"{p}.__exit__", "scope-entry"))
        for p in self.statements():
            if self.in_star(p):
                continue
            n, ex = self.node(p), f"{self.scope_of[p]}.__exit__"
            alt = lambda: f"{p}.orelse[0]" if n.orelse else self.follow(p)  # noqa: B023, E731
            match n:
                case ast.If():
                    out |= {(p, f"{p}.body[0]", "if-true"), (p, alt(), "if-false")}
                case ast.For() | ast.AsyncFor() | ast.While():
                    out |= {(p, f"{p}.body[0]", "loop-body"), (p, alt(), "loop-exit")}
                case ast.Return():
                    out.add((p, ex, "return"))
                case ast.Raise():
                    out.add((p, ex, "raise"))
                case ast.Break():
                    lp = self.loop(p)
                    out.add((p, self.follow(lp) if lp else ex, "break"))
                case ast.Continue():
                    out.add((p, self.loop(p) or ex, "continue"))
                case ast.With() | ast.AsyncWith():
                    out.add((p, f"{p}.body[0]", "with-body"))
                case ast.Try():
                    out.add((p, f"{p}.body[0]", "try-body"))
                    for i in range(len(n.handlers)):
                        out.add((p, f"{p}.handlers[{i}].body[0]", f"except-{i}"))
                case ast.Match():
                    for i in range(len(n.cases)):
                        out.add((p, f"{p}.cases[{i}].body[0]", f"match-case-{i}"))
                case _:
                    out.add((p, self.follow(p), "next"))
        return out

    def _calls(self):
        top = {}
        for i, n in enumerate(self.tree.body):
            if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef)):
                top.setdefault(n.name, f"$.body[{i}]")
        out = set()
        for p, (n, _) in self.byp.items():
            if isinstance(n, ast.Call):
                parts, f = [], n.func
                while isinstance(f, ast.Attribute):
                    parts, f = [f.attr, *parts], f.value
                parts = [f.id, *parts] if isinstance(f, ast.Name) else parts
                name = ".".join(parts) or "<dynamic-call>"
                hit = top.get(name) if isinstance(n.func, ast.Name) else None
                out.add((p, hit or f"call:{name}", name, hit is not None))
        return out

    def _events(self, p, root=None):
        """(role, variable, path) of the names that a statement owns."""
        n = self.node(p)
        if isinstance(n, DEFS):
            yield "gen", n.name, p
            return
        if isinstance(n, ast.Lambda):
            return
        if isinstance(n, ast.Name):
            parent = self.byp[p][1]
            if isinstance(n.ctx, ast.Load):
                yield "use", n.id, p
            elif isinstance(n.ctx, ast.Del):
                yield "kill", n.id, p
            else:
                yield "gen", n.id, p
                if isinstance(self.node(parent), ast.AugAssign) and p.endswith(".target"):
                    yield "use", n.id, p
        if isinstance(n, ast.alias):
            first = isinstance(self.node(self.byp[p][1]), ast.Import)
            yield "gen", n.asname or (n.name.split(".")[0] if first else n.name), p
        for c in self.kids[p]:
            yield from self._events(c)

    def _dfg(self):
        self.kids = defaultdict(list)
        for p, (_, q) in self.byp.items():
            if q is not None:
                self.kids[q].append(p)
        out = set()
        for scope, (n, _) in list(self.byp.items()):
            if not isinstance(n, SCOPES):
                continue
            stmts = set(self.statements(scope))
            entry = f"{scope}.__entry__"
            preds = defaultdict(set)
            for a, b, _ in self.cfg:
                if b in stmts and (a in stmts or a == entry):
                    preds[b].add(a)
            gen, kill, use = defaultdict(lambda: defaultdict(set)), defaultdict(set), defaultdict(list)
            for s in stmts:
                for role, v, at in self._events(s):
                    if role == "gen":
                        gen[s][v].add(at)
                    elif role == "kill":
                        kill[s].add(v)
                    else:
                        use[s].append((v, at))
            if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef)):
                for p, (a, q) in self.byp.items():
                    if isinstance(a, ast.arg) and q == f"{scope}.args":
                        gen[entry][a.arg].add(p)
            for s in stmts:
                for v, at in use[s]:
                    seen, todo, defs = set(), list(preds[s] or {entry}), set()
                    while todo:
                        b = todo.pop()
                        if b in seen:
                            continue
                        seen.add(b)
                        if v in gen[b]:
                            defs |= gen[b][v]
                        elif v not in kill[b] and b != entry:
                            todo += preds[b] or {entry}
                    if defs:
                        out |= {(d, at, v, True) for d in defs}
                    else:
                        out.add((f"{scope}.__external__.dfg:{v}", at, v, False))
        return out

    def ext(self, path):
        return h(self.fid, path, "ExternalSymbol")

    def edge_ids(self):
        ids = {h("AST", self.id(a), self.id(b), d) for a, b, d in self.ast_edges}
        ids |= {h("CFG", self.id(a), self.id(b), d) for a, b, d in self.cfg}
        ids |= {
            h("CALL", self.id(a), self.id(b) if ok else self.ext(f"$.__external__.{b}"), d)
            for a, b, d, ok in self.calls
        }
        ids |= {
            h("DFG", self.id(a) if ok else self.ext(a), self.id(b), v) for a, b, v, ok in self.dfg
        }
        return ids

    def node_ids(self):
        ids = {self.id(p) for p in self.byp}
        for p, (n, _) in self.byp.items():
            if isinstance(n, SCOPES):
                ids |= {self.id(f"{p}.__entry__"), self.id(f"{p}.__exit__")}
        ids |= {self.ext(f"$.__external__.{b}") for _, b, _, ok in self.calls if not ok}
        ids |= {self.ext(a) for a, _, _, ok in self.dfg if not ok}
        return ids
