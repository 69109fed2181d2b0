"""A small sandboxed template language, compiled to Python closures.

Source text is cut into literal text, ``{{ expression }}``, ``{% statement %}`` and
``{# comment #}`` (a ``-`` inside a delimiter drops the white space on that side),
parsed into a syntax tree, folded (expressions of constants, branches of constant
conditions, neighbouring literals), and turned into one closure per node.

Statements: ``for x in list`` with ``loop.index``, ``index0``, ``first``, ``last``;
``if`` / ``elif`` / ``else``; ``set``; ``generation``, which marks what a model is to
learn. Expressions: strings, numbers, lists, names, ``.name`` and ``[item]`` of maps
and lists, ``== != < <= > >= in and or not + - * // % ~``, ``a if c else b``, the filters
and tests below.

Sandbox: values are plain data. Names and fields that start with an underscore do not
parse, nothing can be called but the filters listed, fields are map entries (never
Python attributes), nesting is bounded, and the only loops run over the data given.

Rendering is lazy: chunks (text, inside generation) are yielded as they come and a loop
reads its list one item ahead at most, so a very long conversation streams through.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

MAX_DEPTH = 64
DELIMITERS = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<num>\d+)|(?P<name>[A-Za-z_]\w*)"""
                   r"""|(?P<op>==|!=|<=|>=|//|[-+*%~<>.,|()\[\]=]))""", re.S)
STRING_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}

Env = dict[str, Any]
Expr = Callable[[Env], Any]
Chunk = tuple[str, bool]
Stmt = Callable[[Env], Iterator[Chunk]]


class TemplateError(ValueError):
    """The template does not parse, or uses a value in a way its language does not have."""


# ---- syntax tree: expressions are (kind, ...) nodes, statements likewise

@dataclass(frozen=True)
class Node:
    kind: str
    value: Any = None
    parts: tuple = ()
    bodies: tuple = field(default=())


def const(value: Any) -> Node:
    return Node("const", value)


def _as_text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _need_text(value: Any) -> str:
    if value is None:
        return ""
    if not isinstance(value, str):
        raise TemplateError(f"text expected, {type(value).__name__} found")
    return value


FILTERS: dict[str, Callable[..., Any]] = {
    "trim": lambda v: _need_text(v).strip(),
    "upper": lambda v: _need_text(v).upper(),
    "lower": lambda v: _need_text(v).lower(),
    "length": lambda v: 0 if v is None else len(v),
    "default": lambda v, other="": other if v is None else v,
    "replace": lambda v, old, new: _need_text(v).replace(old, new),
    "string": _as_text,
}
TESTS: dict[str, Callable[[Any], bool]] = {
    "none": lambda v: v is None, "defined": lambda v: v is not None, "string": lambda v: isinstance(v, str),
    "odd": lambda v: v % 2 == 1, "even": lambda v: v % 2 == 0,
}
BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
    "-": operator.sub, "//": operator.floordiv, "%": operator.mod,
    "~": lambda a, b: _as_text(a) + _as_text(b),
    "in": lambda a, b: b is not None and a in b,
}


def _add(a: Any, b: Any) -> Any:
    if isinstance(a, str) != isinstance(b, str):
        raise TemplateError("+ joins two texts or adds two numbers")
    return a + b


def _times(a: Any, b: Any) -> Any:
    if not (isinstance(a, int) and isinstance(b, int)):
        raise TemplateError("* multiplies numbers only")       # no repeated texts: output stays linear in the data
    return a * b


BINARY |= {"+": _add, "*": _times}


# ---- parser

def tokens(source: str) -> list[tuple[str, Any]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        m = TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"unexpected text: {source[at:at + 20]!r}")
        at = m.end()
        kind, value = m.lastgroup, m.group(m.lastgroup)
        if kind == "str":
            value = re.sub(r"\\(.)", lambda e: STRING_ESCAPES.get(e.group(1), e.group(1)), value[1:-1], flags=re.S)
        elif kind == "num":
            value = int(value)
        elif kind == "name" and value.startswith("_"):
            raise TemplateError(f"names may not start with an underscore: {value}")
        out.append((kind, value))
    return out


class _Expression:
    """Recursive descent over one delimiter's tokens."""

    LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "<", "<=", ">", ">=", "in"), ("~", "+", "-"), ("*", "//", "%"))

    def __init__(self, toks: list[tuple[str, Any]], filters: dict):
        self.toks, self.at, self.depth, self.filters = toks, 0, 0, filters

    def peek(self) -> tuple[str, Any]:
        return self.toks[self.at] if self.at < len(self.toks) else ("end", None)

    def take(self, *values: str) -> Any:
        kind, value = self.peek()
        if kind in ("op", "name") and value in values:
            self.at += 1
            return value
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected, {self.peek()[1]!r} found")

    def name(self) -> str:
        kind, value = self.peek()
        if kind != "name":
            raise TemplateError(f"a name expected, {value!r} found")
        self.at += 1
        return value

    def end(self) -> None:
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")

    def full(self) -> Node:
        self.depth += 1
        if self.depth > MAX_DEPTH:
            raise TemplateError("expression nested too deeply")
        value = self.level(0)
        if self.take("if"):
            condition = self.level(0)
            self.need("else")
            value = Node("choice", None, (condition, value, self.full()))
        self.depth -= 1
        return value

    def level(self, n: int) -> Node:
        if n == len(self.LEVELS):
            return self.postfix()
        ops = self.LEVELS[n]
        if ops == ("not",):
            return Node("not", None, (self.level(n),)) if self._bounded() and self.take("not") else self.level(n + 1)
        left = self.level(n + 1)
        while True:
            if ops[0] == "==" and self.peek() == ("name", "not") and self.toks[self.at + 1:self.at + 2] == [("name", "in")]:
                self.at += 2
                left = Node("not", None, (Node("binary", "in", (left, self.level(n + 1))),))
            elif op := self.take(*ops):
                left = Node(op if op in ("or", "and") else "binary", op, (left, self.level(n + 1)))
            elif ops[0] == "==" and self.take("is"):
                negative = bool(self.take("not"))
                test = self.name()
                if test not in TESTS:
                    raise TemplateError(f"unknown test {test}")
                left = Node("test", test, (left,))
                left = Node("not", None, (left,)) if negative else left
            else:
                return left

    def _bounded(self) -> bool:
        if self.at > 10_000:
            raise TemplateError("expression too long")
        return True

    def postfix(self) -> Node:
        value = self.atom()
        while True:
            if self.take("."):
                value = Node("field", None, (value, const(self.name())))
            elif self.take("["):
                value = Node("field", None, (value, self.full()))
                self.need("]")
            elif self.take("|"):
                name, args = self.name(), ()
                if name not in self.filters:
                    raise TemplateError(f"unknown filter {name}")
                if self.take("("):
                    args = self.listed(")")
                value = Node("filter", name, (value, *args))
            else:
                return value

    def listed(self, close: str) -> tuple:
        out = []
        while not self.take(close):
            if out:
                self.need(",")
            out.append(self.full())
        return tuple(out)

    def atom(self) -> Node:
        kind, value = self.peek()
        self.at += 1
        if kind in ("str", "num"):
            return const(value)
        if kind == "name":
            words = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
            return const(words[value]) if value in words else Node("name", value)
        if (kind, value) == ("op", "("):
            inner = self.full()
            self.need(")")
            return inner
        if (kind, value) == ("op", "["):
            return Node("list", None, self.listed("]"))
        if (kind, value) == ("op", "-"):
            return Node("binary", "-", (const(0), self.postfix()))
        raise TemplateError(f"unexpected {value!r}")


class _Statements:
    """Nested statements from the delimiter pieces of a source."""

    def __init__(self, source: str, filters: dict):
        self.filters, self.pieces, at, strip = filters, [], 0, False
        for m in DELIMITERS.finditer(source):
            text = source[at:m.start()]
            text = text.lstrip() if strip else text
            text = text.rstrip() if m.group()[2:3] == "-" else text
            self.pieces.append(("text", text))
            if m.group(1) is not None:
                self.pieces.append(("output", m.group(1)))
            elif m.group(2) is not None:
                self.pieces.append(("statement", m.group(2)))
            at, strip = m.end(), m.group()[-3] == "-"
        self.pieces.append(("text", source[at:].lstrip() if strip else source[at:]))
        self.at, self.depth = 0, 0

    def block(self, *ends: str) -> tuple[tuple, tuple[str, _Expression]]:
        """Nodes up to one of the statements ``ends``, and that statement."""
        self.depth += 1
        if self.depth > MAX_DEPTH:
            raise TemplateError("statements nested too deeply")
        out = []
        while self.at < len(self.pieces):
            kind, value = self.pieces[self.at]
            self.at += 1
            if kind == "text":
                out.append(Node("text", value))
                continue
            e = _Expression(tokens(value), self.filters)
            if kind == "output":
                out.append(Node("output", None, (e.full(),)))
                e.end()
                continue
            word = e.name()
            if word in ends:
                self.depth -= 1
                return tuple(out), (word, e)
            out.append(self.statement(word, e))
        if ends:
            raise TemplateError(f"{' or '.join(ends)} expected")
        self.depth -= 1
        return tuple(out), ("", _Expression([], self.filters))

    def statement(self, word: str, e: _Expression) -> Node:
        if word == "for":
            name = e.name()
            e.need("in")
            over = e.full()
            e.end()
            body, (_, last) = self.block("endfor")
            last.end()
            return Node("for", name, (over,), (body,))
        if word == "if":
            conditions, bodies = [e.full()], []
            e.end()
            while True:
                body, (ended, following) = self.block("elif", "else", "endif")
                bodies.append(body)
                if ended == "elif":
                    conditions.append(following.full())
                    following.end()
                    continue
                following.end()
                if ended == "else":
                    body, (_, last) = self.block("endif")
                    last.end()
                    bodies.append(body)
                return Node("if", None, tuple(conditions), tuple(bodies))
        if word == "set":
            name = e.name()
            e.need("=")
            value = e.full()
            e.end()
            return Node("set", name, (value,))
        if word == "generation":
            e.end()
            body, (_, last) = self.block("endgeneration")
            last.end()
            return Node("generation", None, (), (body,))
        raise TemplateError(f"unknown statement {word}")


# ---- constant folding

def fold(node: Node, filters: dict) -> Node:
    parts = tuple(fold(p, filters) for p in node.parts)
    node = Node(node.kind, node.value, parts, tuple(fold_body(b, filters) for b in node.bodies))
    if node.kind == "choice" and parts[0].kind == "const":
        return parts[1] if parts[0].value else parts[2]
    if node.kind in ("and", "or") and parts[0].kind == "const":
        return parts[1] if bool(parts[0].value) == (node.kind == "and") else parts[0]
    if node.kind in ("not", "binary", "test", "filter") and all(p.kind == "const" for p in parts):
        return const(expression(node, filters)({}))
    return node


def fold_body(body: tuple, filters: dict) -> tuple:
    """Folded statements: constant outputs become text, constant conditions their branch, neighbouring texts one."""
    out: list[Node] = []

    def add(node: Node) -> None:
        if node.kind == "output" and node.parts[0].kind == "const":
            node = Node("text", _as_text(node.parts[0].value))
        if node.kind == "if":
            conditions, bodies = list(node.parts), list(node.bodies)
            while conditions and conditions[0].kind == "const" and not conditions[0].value:
                conditions.pop(0)
                bodies.pop(0)
            if not conditions or conditions[0].kind == "const":
                for inner in bodies[0] if bodies else ():
                    add(inner)
                return
            node = Node("if", None, tuple(conditions), tuple(bodies))
        if node.kind == "text" and out and out[-1].kind == "text":
            out[-1] = Node("text", out[-1].value + node.value)
        elif node.kind != "text" or node.value:
            out.append(node)

    for n in body:
        add(fold(n, filters))
    return tuple(out)


# ---- closures

def expression(node: Node, filters: dict) -> Expr:
    parts = [expression(p, filters) for p in node.parts]
    kind, value = node.kind, node.value
    if kind == "const":
        return lambda env: value
    if kind == "name":
        return lambda env: env.get(value)
    if kind == "list":
        return lambda env: [p(env) for p in parts]
    if kind == "not":
        return lambda env: not parts[0](env)
    if kind == "and":
        return lambda env: parts[0](env) and parts[1](env)
    if kind == "or":
        return lambda env: parts[0](env) or parts[1](env)
    if kind == "choice":
        return lambda env: parts[1](env) if parts[0](env) else parts[2](env)
    if kind == "binary":
        apply = BINARY[value]

        def binary(env: Env) -> Any:
            try:
                return apply(parts[0](env), parts[1](env))
            except (TypeError, ZeroDivisionError) as e:
                raise TemplateError(f"{value}: {e}") from None
        return binary
    if kind == "test":
        test = TESTS[value]
        return lambda env: test(parts[0](env))
    if kind == "filter":
        run, first, rest = filters[value], parts[0], parts[1:]
        return lambda env: run(first(env), *[p(env) for p in rest])
    if kind == "field":
        def get(env: Env) -> Any:
            of, key = parts[0](env), parts[1](env)
            if isinstance(of, dict):
                return of.get(key)
            if isinstance(of, list) and isinstance(key, int):
                return of[key] if -len(of) <= key < len(of) else None
            return None
        return get
    raise TemplateError(f"not an expression: {kind}")


def statements(body: tuple, filters: dict) -> Stmt:
    runs = [statement(n, filters) for n in body]
    if len(runs) == 1:
        return runs[0]

    def run(env: Env) -> Iterator[Chunk]:
        for r in runs:
            yield from r(env)
    return run


def statement(node: Node, filters: dict) -> Stmt:
    kind, value = node.kind, node.value
    parts = [expression(p, filters) for p in node.parts]
    bodies = [statements(b, filters) for b in node.bodies]

    def text(env: Env) -> Iterator[Chunk]:
        yield value, False

    def output(env: Env) -> Iterator[Chunk]:
        yield _as_text(parts[0](env)), False

    def assign(env: Env) -> Iterator[Chunk]:
        env[value] = parts[0](env)
        return iter(())

    def generation(env: Env) -> Iterator[Chunk]:
        for t, _ in bodies[0](env):
            yield t, True

    def branch(env: Env) -> Iterator[Chunk]:
        for condition, body in zip(parts, bodies):
            if condition(env):
                return body(env)
        return bodies[-1](env) if len(bodies) > len(parts) else iter(())

    def each(env: Env) -> Iterator[Chunk]:
        items, nothing = iter(parts[0](env) or ()), object()
        at, item = 0, next(items, nothing)
        while item is not nothing:
            following = next(items, nothing)
            loop = {"index": at + 1, "index0": at, "first": at == 0, "last": following is nothing}
            yield from bodies[0](env | {value: item, "loop": loop})      # what the body sets ends with it
            at, item = at + 1, following

    return {"text": text, "output": output, "set": assign, "generation": generation, "if": branch, "for": each}[kind]


def names(node: Node) -> set[str]:
    """Names a node reads."""
    own = {node.value} if node.kind == "name" else set()
    return own.union(*map(names, node.parts), *(names(n) for b in node.bodies for n in b))


class Template:
    """A compiled template; ``filters`` adds filters of the caller's."""

    def __init__(self, source: str, filters: dict[str, Callable[..., Any]] | None = None):
        known = FILTERS | (filters or {})
        body, _ = _Statements(source, known).block()
        self.tree = fold_body(body, known)
        self._run = statements(self.tree, known)
        loops = [i for i, n in enumerate(self.tree) if n.kind == "for" and n.parts[0] == Node("name", "messages")]
        #: the loop over messages reads nothing but its message: turns render apart from one another
        self.per_turn = False
        if len(loops) == 1:
            at = loops[0]
            loop, around = self.tree[at], self.tree[:at] + self.tree[at + 1:]
            assigned = {n.value for n in around if n.kind == "set"} | {"loop", "messages"}
            inner = set().union(*(names(n) for n in loop.bodies[0]))
            self.per_turn = not inner & (assigned - {loop.value}) and not any("messages" in names(n) for n in around)
            self._name = loop.value
            self._head, self._turn, self._tail = (statements(b, known) for b in (self.tree[:at], loop.bodies[0], self.tree[at + 1:]))

    def chunks(self, messages: Iterable[dict], **values: Any) -> Iterator[Chunk]:
        """(text, inside generation) piece by piece; ``messages`` may be an iterator."""
        return self._run(values | {"messages": messages})

    def head(self) -> list[Chunk]:
        return list(self._head({}))

    def turn(self, message: dict) -> list[Chunk]:
        return list(self._turn({self._name: message}))

    def tail(self) -> list[Chunk]:
        return list(self._tail({}))


def joined(chunks: Iterable[Chunk]) -> tuple[str, list[tuple[int, int]]]:
    """The text and the (start, end) code points of its generation marks; touching marks of one text stay apart."""
    texts, spans, at = [], [], 0
    for t, mark in chunks:
        texts.append(t)
        if mark and t:
            spans.append((at, at + len(t)))
        at += len(t)
    return "".join(texts), spans
