"""Code templates for the part table, and the graph that each must give.

``{K}`` stands for the part key in twelve digits and ``{N}`` for a number in
seven, so that columns do not move. The tables were derived by walking the
parsed templates by hand-written rules, not by the operators under test.
"""

TEMPLATES = [
    """def f_{K}(x):
    if x > {N}:
        return x * 2
    return x
""",
    """def f_{K}(x):
    t = 0
    for i in x:
        if i:
            break
        t += i
    else:
        t = {N}
    return t
""",
    """import m_{K}
try:
    y = m_{K}.f({N})
except OSError:
    print(y)
finally:
    del y
""",
    """def f_{K}(x):
    return x
while f_{K}({N}):
    continue
""",
    """def f_{K}(:
    return {N}
""",
]

# template, path, type, line, column, end line, end column, name, value
NODES = [
    (0, '$', 'Module', 0, 0, 0, 0, '', ''),
    (0, '$.body[0]', 'FunctionDef', 1, 0, 4, 12, 'f_{K}', ''),
    (0, '$.body[0].args', 'arguments', 0, 0, 0, 0, '', ''),
    (0, '$.body[0].args.args[0]', 'arg', 1, 19, 1, 20, 'x', ''),
    (0, '$.body[0].body[0]', 'If', 2, 4, 3, 20, '', ''),
    (0, '$.body[0].body[0].test', 'Compare', 2, 7, 2, 18, '', ''),
    (0, '$.body[0].body[0].test.left', 'Name', 2, 7, 2, 8, 'x', ''),
    (0, '$.body[0].body[0].test.left.ctx', 'Load', 0, 0, 0, 0, '', ''),
    (0, '$.body[0].body[0].test.ops[0]', 'Gt', 0, 0, 0, 0, '', ''),
    (0, '$.body[0].body[0].test.comparators[0]', 'Constant', 2, 11, 2, 18, '', '{N}'),
    (0, '$.body[0].body[0].body[0]', 'Return', 3, 8, 3, 20, '', ''),
    (0, '$.body[0].body[0].body[0].value', 'BinOp', 3, 15, 3, 20, '', ''),
    (0, '$.body[0].body[0].body[0].value.left', 'Name', 3, 15, 3, 16, 'x', ''),
    (0, '$.body[0].body[0].body[0].value.left.ctx', 'Load', 0, 0, 0, 0, '', ''),
    (0, '$.body[0].body[0].body[0].value.op', 'Mult', 0, 0, 0, 0, '', 'Mult'),
    (0, '$.body[0].body[0].body[0].value.right', 'Constant', 3, 19, 3, 20, '', '2'),
    (0, '$.body[0].body[1]', 'Return', 4, 4, 4, 12, '', ''),
    (0, '$.body[0].body[1].value', 'Name', 4, 11, 4, 12, 'x', ''),
    (0, '$.body[0].body[1].value.ctx', 'Load', 0, 0, 0, 0, '', ''),
    (1, '$', 'Module', 0, 0, 0, 0, '', ''),
    (1, '$.body[0]', 'FunctionDef', 1, 0, 9, 12, 'f_{K}', ''),
    (1, '$.body[0].args', 'arguments', 0, 0, 0, 0, '', ''),
    (1, '$.body[0].args.args[0]', 'arg', 1, 19, 1, 20, 'x', ''),
    (1, '$.body[0].body[0]', 'Assign', 2, 4, 2, 9, '', ''),
    (1, '$.body[0].body[0].targets[0]', 'Name', 2, 4, 2, 5, 't', ''),
    (1, '$.body[0].body[0].targets[0].ctx', 'Store', 0, 0, 0, 0, '', ''),
    (1, '$.body[0].body[0].value', 'Constant', 2, 8, 2, 9, '', '0'),
    (1, '$.body[0].body[1]', 'For', 3, 4, 8, 19, '', ''),
    (1, '$.body[0].body[1].target', 'Name', 3, 8, 3, 9, 'i', ''),
    (1, '$.body[0].body[1].target.ctx', 'Store', 0, 0, 0, 0, '', ''),
    (1, '$.body[0].body[1].iter', 'Name', 3, 13, 3, 14, 'x', ''),
    (1, '$.body[0].body[1].iter.ctx', 'Load', 0, 0, 0, 0, '', ''),
    (1, '$.body[0].body[1].body[0]', 'If', 4, 8, 5, 17, '', ''),
    (1, '$.body[0].body[1].body[0].test', 'Name', 4, 11, 4, 12, 'i', ''),
    (1, '$.body[0].body[1].body[0].test.ctx', 'Load', 0, 0, 0, 0, '', ''),
    (1, '$.body[0].body[1].body[0].body[0]', 'Break', 5, 12, 5, 17, '', ''),
    (1, '$.body[0].body[1].body[1]', 'AugAssign', 6, 8, 6, 14, '', ''),
    (1, '$.body[0].body[1].body[1].target', 'Name', 6, 8, 6, 9, 't', ''),
    (1, '$.body[0].body[1].body[1].target.ctx', 'Store', 0, 0, 0, 0, '', ''),
    (1, '$.body[0].body[1].body[1].op', 'Add', 0, 0, 0, 0, '', 'Add'),
    (1, '$.body[0].body[1].body[1].value', 'Name', 6, 13, 6, 14, 'i', ''),
    (1, '$.body[0].body[1].body[1].value.ctx', 'Load', 0, 0, 0, 0, '', ''),
    (1, '$.body[0].body[1].orelse[0]', 'Assign', 8, 8, 8, 19, '', ''),
    (1, '$.body[0].body[1].orelse[0].targets[0]', 'Name', 8, 8, 8, 9, 't', ''),
    (1, '$.body[0].body[1].orelse[0].targets[0].ctx', 'Store', 0, 0, 0, 0, '', ''),
    (1, '$.body[0].body[1].orelse[0].value', 'Constant', 8, 12, 8, 19, '', '{N}'),
    (1, '$.body[0].body[2]', 'Return', 9, 4, 9, 12, '', ''),
    (1, '$.body[0].body[2].value', 'Name', 9, 11, 9, 12, 't', ''),
    (1, '$.body[0].body[2].value.ctx', 'Load', 0, 0, 0, 0, '', ''),
    (2, '$', 'Module', 0, 0, 0, 0, '', ''),
    (2, '$.body[0]', 'Import', 1, 0, 1, 21, '', ''),
    (2, '$.body[0].names[0]', 'alias', 1, 7, 1, 21, 'm_{K}', ''),
    (2, '$.body[1]', 'Try', 2, 0, 7, 9, '', ''),
    (2, '$.body[1].body[0]', 'Assign', 3, 4, 3, 33, '', ''),
    (2, '$.body[1].body[0].targets[0]', 'Name', 3, 4, 3, 5, 'y', ''),
    (2, '$.body[1].body[0].targets[0].ctx', 'Store', 0, 0, 0, 0, '', ''),
    (2, '$.body[1].body[0].value', 'Call', 3, 8, 3, 33, '', ''),
    (2, '$.body[1].body[0].value.func', 'Attribute', 3, 8, 3, 24, '', ''),
    (2, '$.body[1].body[0].value.func.value', 'Name', 3, 8, 3, 22, 'm_{K}', ''),
    (2, '$.body[1].body[0].value.func.value.ctx', 'Load', 0, 0, 0, 0, '', ''),
    (2, '$.body[1].body[0].value.func.ctx', 'Load', 0, 0, 0, 0, '', ''),
    (2, '$.body[1].body[0].value.args[0]', 'Constant', 3, 25, 3, 32, '', '{N}'),
    (2, '$.body[1].handlers[0]', 'ExceptHandler', 4, 0, 5, 12, '', ''),
    (2, '$.body[1].handlers[0].type', 'Name', 4, 7, 4, 14, 'OSError', ''),
    (2, '$.body[1].handlers[0].type.ctx', 'Load', 0, 0, 0, 0, '', ''),
    (2, '$.body[1].handlers[0].body[0]', 'Expr', 5, 4, 5, 12, '', ''),
    (2, '$.body[1].handlers[0].body[0].value', 'Call', 5, 4, 5, 12, '', ''),
    (2, '$.body[1].handlers[0].body[0].value.func', 'Name', 5, 4, 5, 9, 'print', ''),
    (2, '$.body[1].handlers[0].body[0].value.func.ctx', 'Load', 0, 0, 0, 0, '', ''),
    (2, '$.body[1].handlers[0].body[0].value.args[0]', 'Name', 5, 10, 5, 11, 'y', ''),
    (2, '$.body[1].handlers[0].body[0].value.args[0].ctx', 'Load', 0, 0, 0, 0, '', ''),
    (2, '$.body[1].finalbody[0]', 'Delete', 7, 4, 7, 9, '', ''),
    (2, '$.body[1].finalbody[0].targets[0]', 'Name', 7, 8, 7, 9, 'y', ''),
    (2, '$.body[1].finalbody[0].targets[0].ctx', 'Del', 0, 0, 0, 0, '', ''),
    (3, '$', 'Module', 0, 0, 0, 0, '', ''),
    (3, '$.body[0]', 'FunctionDef', 1, 0, 2, 12, 'f_{K}', ''),
    (3, '$.body[0].args', 'arguments', 0, 0, 0, 0, '', ''),
    (3, '$.body[0].args.args[0]', 'arg', 1, 19, 1, 20, 'x', ''),
    (3, '$.body[0].body[0]', 'Return', 2, 4, 2, 12, '', ''),
    (3, '$.body[0].body[0].value', 'Name', 2, 11, 2, 12, 'x', ''),
    (3, '$.body[0].body[0].value.ctx', 'Load', 0, 0, 0, 0, '', ''),
    (3, '$.body[1]', 'While', 3, 0, 4, 12, '', ''),
    (3, '$.body[1].test', 'Call', 3, 6, 3, 29, '', ''),
    (3, '$.body[1].test.func', 'Name', 3, 6, 3, 20, 'f_{K}', ''),
    (3, '$.body[1].test.func.ctx', 'Load', 0, 0, 0, 0, '', ''),
    (3, '$.body[1].test.args[0]', 'Constant', 3, 21, 3, 28, '', '{N}'),
    (3, '$.body[1].body[0]', 'Continue', 4, 4, 4, 12, '', ''),
]

# template, source, target, discriminator
FLOW = [
    (0, '$.__entry__', '$.body[0]', 'scope-entry'),
    (0, '$.body[0]', '$.__exit__', 'next'),
    (0, '$.body[0].__entry__', '$.body[0].body[0]', 'scope-entry'),
    (0, '$.body[0].body[0]', '$.body[0].body[0].body[0]', 'if-true'),
    (0, '$.body[0].body[0]', '$.body[0].body[1]', 'if-false'),
    (0, '$.body[0].body[0].body[0]', '$.body[0].__exit__', 'return'),
    (0, '$.body[0].body[1]', '$.body[0].__exit__', 'return'),
    (1, '$.__entry__', '$.body[0]', 'scope-entry'),
    (1, '$.body[0]', '$.__exit__', 'next'),
    (1, '$.body[0].__entry__', '$.body[0].body[0]', 'scope-entry'),
    (1, '$.body[0].body[0]', '$.body[0].body[1]', 'next'),
    (1, '$.body[0].body[1]', '$.body[0].body[1].body[0]', 'loop-body'),
    (1, '$.body[0].body[1]', '$.body[0].body[1].orelse[0]', 'loop-exit'),
    (1, '$.body[0].body[1].body[0]', '$.body[0].body[1].body[0].body[0]', 'if-true'),
    (1, '$.body[0].body[1].body[0]', '$.body[0].body[1].body[1]', 'if-false'),
    (1, '$.body[0].body[1].body[0].body[0]', '$.body[0].body[2]', 'break'),
    (1, '$.body[0].body[1].body[1]', '$.body[0].body[1]', 'next'),
    (1, '$.body[0].body[1].orelse[0]', '$.body[0].body[2]', 'next'),
    (1, '$.body[0].body[2]', '$.body[0].__exit__', 'return'),
    (2, '$.__entry__', '$.body[0]', 'scope-entry'),
    (2, '$.body[0]', '$.body[1]', 'next'),
    (2, '$.body[1]', '$.body[1].body[0]', 'try-body'),
    (2, '$.body[1]', '$.body[1].handlers[0].body[0]', 'except-0'),
    (2, '$.body[1].body[0]', '$.body[1].finalbody[0]', 'next'),
    (2, '$.body[1].finalbody[0]', '$.__exit__', 'next'),
    (2, '$.body[1].handlers[0].body[0]', '$.body[1].finalbody[0]', 'next'),
    (3, '$.__entry__', '$.body[0]', 'scope-entry'),
    (3, '$.body[0]', '$.body[1]', 'next'),
    (3, '$.body[0].__entry__', '$.body[0].body[0]', 'scope-entry'),
    (3, '$.body[0].body[0]', '$.body[0].__exit__', 'return'),
    (3, '$.body[1]', '$.__exit__', 'loop-exit'),
    (3, '$.body[1]', '$.body[1].body[0]', 'loop-body'),
    (3, '$.body[1].body[0]', '$.body[1]', 'continue'),
]

# template, source, target, variable, resolved
DATA = [
    (0, '$.body[0].args.args[0]', '$.body[0].body[0].body[0].value.left', 'x', True),
    (0, '$.body[0].args.args[0]', '$.body[0].body[0].test.left', 'x', True),
    (0, '$.body[0].args.args[0]', '$.body[0].body[1].value', 'x', True),
    (1, '$.body[0].args.args[0]', '$.body[0].body[1].iter', 'x', True),
    (1, '$.body[0].body[0].targets[0]', '$.body[0].body[1].body[1].target', 't', True),
    (1, '$.body[0].body[1].body[1].target', '$.body[0].body[1].body[1].target', 't', True),
    (1, '$.body[0].body[1].body[1].target', '$.body[0].body[2].value', 't', True),
    (1, '$.body[0].body[1].orelse[0].targets[0]', '$.body[0].body[1].body[1].target', 't', True),
    (1, '$.body[0].body[1].orelse[0].targets[0]', '$.body[0].body[2].value', 't', True),
    (1, '$.body[0].body[1].target', '$.body[0].body[1].body[0].test', 'i', True),
    (1, '$.body[0].body[1].target', '$.body[0].body[1].body[1].value', 'i', True),
    (2, '$.__external__.dfg:OSError', '$.body[1].handlers[0].type', 'OSError', False),
    (2, '$.__external__.dfg:print', '$.body[1].handlers[0].body[0].value.func', 'print', False),
    (2, '$.__external__.dfg:y', '$.body[1].handlers[0].body[0].value.args[0]', 'y', False),
    (2, '$.body[0].names[0]', '$.body[1].body[0].value.func.value', 'm_{K}', True),
    (2, '$.body[1].body[0].targets[0]', '$.body[1].handlers[0].body[0].value.args[0]', 'y', True),
    (3, '$.body[0]', '$.body[1].test.func', 'f_{K}', True),
    (3, '$.body[0].args.args[0]', '$.body[0].body[0].value', 'x', True),
]

# template, call, target, callee, resolved
CALLS = [
    (2, '$.body[1].body[0].value', 'call:m_{K}.f', 'm_{K}.f', False),
    (2, '$.body[1].handlers[0].body[0].value', 'call:print', 'print', False),
    (3, '$.body[1].test', '$.body[0]', 'f_{K}', True),
]
