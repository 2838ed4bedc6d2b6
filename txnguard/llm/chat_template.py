"""A small sandboxed template language, compiled to Python closures.

Syntax: text, ``{{ expression }}``, ``{% for x in expr %}..{% endfor %}``,
``{% if %}/{% elif %}/{% else %}/{% endif %}``, ``{% set x = expr %}`` and
``{% generation %}..{% endgeneration %}`` around what a model is to learn. A dash
inside a tag's brace drops the white space beside it. Expressions have literals,
names, ``a.b`` and ``a['b']`` on mappings, filters, ``~ + == != < > <= >= in not
and or`` and ``a if c else b``.

The sandbox: a name is a value handed to ``render`` or a loop variable, a dot
looks up a mapping's key and never an attribute, and only the given filters can
be called.

``compile_template`` parses into a tree of tuples, folds constants (operators on
literals, filters of literals, branches with a known condition, neighbouring
text) and makes a closure of each node. Rendering is lazy: a loop takes one item
ahead of the one it renders, so a conversation streams through in bounded memory.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator
from typing import Any

CUT = object()  # between the iterations of a loop over a stream


class TemplateError(ValueError):
    pass


class Stream:
    """Items that a template may loop over once; the renderer marks the end of each turn."""

    def __init__(self, items: Iterator):
        self.items = iter(items)


_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+~<>()\[\].|=,]))")
_ESCAPES = {"n": "\n", "t": "\t"}
_BINARY = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge,
    "+": operator.add, "~": lambda a, b: _text(a) + _text(b), "in": lambda a, b: a in b, "not in": lambda a, b: a not in b,
}


def _text(x: Any) -> str:
    return "" if x is None else x if isinstance(x, str) else str(x)


# --- parsing --------------------------------------------------------------------------


class _Expression:
    """Recursive descent over one tag's tokens; nodes are ('const', v), ('name', n), ('item', a, key), ('op', o, a, b), ..."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return None if kind == "str" else value

    def take(self, *values: str) -> str | None:
        if self.peek() in values and self.peek() is not None:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected, found {self.peek()!r}")

    def name(self) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        if kind != "name":
            raise TemplateError(f"a name expected, found {value!r}")
        self.at += 1
        return value

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def expression(self):
        value = self.either()
        if self.take("if"):
            test = self.either()
            self.need("else")
            return ("choice", test, value, self.expression())
        return value

    def either(self):
        left = self.both()
        while self.take("or"):
            left = ("or", left, self.both())
        return left

    def both(self):
        left = self.negated()
        while self.take("and"):
            left = ("and", left, self.negated())
        return left

    def negated(self):
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self):
        left = self.joined()
        while (op := self.take("==", "!=", "<", ">", "<=", ">=", "in", "not")) is not None:
            if op == "not":
                self.need("in")
                op = "not in"
            left = ("op", op, left, self.joined())
        return left

    def joined(self):
        left = self.filtered()
        while (op := self.take("+", "~")) is not None:
            left = ("op", op, left, self.filtered())
        return left

    def filtered(self):
        value = self.atom()
        while True:
            if self.take("."):
                value = ("item", value, ("const", self.name()))
            elif self.take("["):
                value = ("item", value, self.expression())
                self.need("]")
            elif self.take("|"):
                value = ("filter", self.name(), value)
            else:
                return value

    def atom(self):
        if self.take("("):
            value = self.expression()
            self.need(")")
            return value
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        if kind == "str":
            self.at += 1
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "int":
            self.at += 1
            return ("const", int(value))
        name = self.name()
        return ("const", {"true": True, "false": False, "none": None}[name.lower()]) if name.lower() in ("true", "false", "none") else ("name", name)


def parse(source: str) -> tuple:
    """The syntax tree: ('block', [nodes])."""
    pieces, at, strip = [], 0, False
    for m in _TAG.finditer(source):
        text = source[at : m.start()]
        text = text.lstrip() if strip else text
        text = text.rstrip() if m[1] or m[4] else text
        if text:
            pieces.append(("text", text))
        pieces.append(("out", m[2]) if m[2] is not None else ("tag", m[5].strip()))
        at, strip = m.end(), bool(m[3] or m[6])
    rest = source[at:].lstrip() if strip else source[at:]
    if rest:
        pieces.append(("text", rest))
    pieces.reverse()

    def block(*ends: str) -> tuple[tuple, str]:
        nodes = []
        while pieces:
            kind, value = pieces.pop()
            if kind == "text":
                nodes.append(("const", value))
            elif kind == "out":
                e = _Expression(value)
                nodes.append(e.expression())
                e.end()
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return ("block", nodes), value
                nodes.append(statement(word, rest))
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return ("block", nodes), ""

    def condition(source: str) -> tuple:
        e = _Expression(source)
        test = e.expression()
        e.end()
        return test

    def statement(word: str, rest: str) -> tuple:
        if word == "for":
            e = _Expression(rest)
            name = e.name()
            e.need("in")
            items = e.expression()
            e.end()
            return ("for", name, items, block("endfor")[0])
        if word == "if":
            body, ended = block("elif", "else", "endif")
            if ended.startswith("elif"):
                return ("if", condition(rest), body, ("block", [statement("if", ended[4:])]))
            return ("if", condition(rest), body, block("endif")[0] if ended == "else" else ("block", []))
        if word == "set":
            e = _Expression(rest)
            name = e.name()
            e.need("=")
            value = e.expression()
            e.end()
            return ("set", name, value)
        if word == "generation":
            return ("generation", block("endgeneration")[0])
        raise TemplateError(f"unknown tag {word!r}")

    tree, _ = block()
    return tree


# --- folding --------------------------------------------------------------------------


def fold(node: tuple, filters: dict[str, Callable]) -> tuple:
    """The same tree with everything computed that no input can change."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "block":
        out: list[tuple] = []
        for child in (fold(n, filters) for n in node[1]):
            for n in child[1] if child[0] == "block" else [child]:
                if n[0] == "const" and out and out[-1][0] == "const":
                    out[-1] = ("const", _text(out[-1][1]) + _text(n[1]))
                elif n != ("const", ""):
                    out.append(n)
        return ("block", out)
    if kind in ("if", "choice"):
        test, yes, no = (fold(n, filters) for n in node[1:])
        return (yes if test[1] else no) if test[0] == "const" else (kind, test, yes, no)
    if kind in ("and", "or"):
        left, right = fold(node[1], filters), fold(node[2], filters)
        if left[0] == "const":
            return right if bool(left[1]) == (kind == "and") else left
        return (kind, left, right)
    if kind == "not":
        value = fold(node[1], filters)
        return ("const", not value[1]) if value[0] == "const" else ("not", value)
    if kind == "op":
        left, right = fold(node[2], filters), fold(node[3], filters)
        return ("const", _BINARY[node[1]](left[1], right[1])) if left[0] == right[0] == "const" else ("op", node[1], left, right)
    if kind == "item":
        return ("item", fold(node[1], filters), fold(node[2], filters))
    if kind == "filter":
        if node[1] not in filters:
            raise TemplateError(f"unknown filter {node[1]!r}")
        value = fold(node[2], filters)
        return ("const", filters[node[1]](value[1])) if value[0] == "const" else ("filter", node[1], value)
    if kind == "for":
        return ("for", node[1], fold(node[2], filters), fold(node[3], filters))
    if kind == "set":
        return ("set", node[1], fold(node[2], filters))
    return ("generation", fold(node[1], filters))


# --- closures -------------------------------------------------------------------------


def _value(node: tuple, filters: dict[str, Callable]) -> Callable[[dict], Any]:
    kind = node[0]
    if kind == "const":
        return lambda env, v=node[1]: v
    if kind == "name":
        return lambda env, n=node[1]: env.get(n)
    if kind == "item":
        of, key = _value(node[1], filters), _value(node[2], filters)

        def item(env):
            value = of(env)
            return value.get(key(env)) if isinstance(value, dict) else None

        return item
    if kind == "filter":
        call, of = filters[node[1]], _value(node[2], filters)
        return lambda env: call(of(env))
    if kind == "not":
        of = _value(node[1], filters)
        return lambda env: not of(env)
    if kind == "choice":
        test, yes, no = (_value(n, filters) for n in node[1:])
        return lambda env: yes(env) if test(env) else no(env)
    left, right = _value(node[-2], filters), _value(node[-1], filters)
    if kind == "and":
        return lambda env: left(env) and right(env)
    if kind == "or":
        return lambda env: left(env) or right(env)
    call = _BINARY[node[1]]
    return lambda env: call(left(env), right(env))


def _writer(node: tuple, filters: dict[str, Callable], learn: bool) -> Callable[[dict], Iterator]:
    """A generator function of (text, learn) pieces and CUT marks."""
    kind = node[0]
    if kind == "block":
        parts = [_writer(n, filters, learn) for n in node[1]]

        def block(env):
            for part in parts:
                yield from part(env)

        return block
    if kind == "if":
        test, yes, no = _value(node[1], filters), _writer(node[2], filters, learn), _writer(node[3], filters, learn)

        def branch(env):
            yield from yes(env) if test(env) else no(env)

        return branch
    if kind == "for":
        name, items, body = node[1], _value(node[2], filters), _writer(node[3], filters, learn)

        def loop(env):
            source = items(env)
            stream = isinstance(source, Stream)
            ahead, index = iter(source.items if stream else source or ()), 0
            item = next(ahead, CUT)
            while item is not CUT:
                after = next(ahead, CUT)
                yield from body(env | {name: item, "loop": {"index": index + 1, "index0": index, "first": index == 0, "last": after is CUT}})
                if stream:
                    yield CUT
                item, index = after, index + 1

        return loop
    if kind == "set":
        of = _value(node[2], filters)

        def assign(env, name=node[1]):
            env[name] = of(env)
            return iter(())

        return assign
    if kind == "generation":
        return _writer(node[1], filters, True)
    if kind == "const":
        piece = [(_text(node[1]), learn)]
        return lambda env: piece
    of = _value(node, filters)
    return lambda env: [(_text(of(env)), learn)]


DEFAULT_FILTERS: dict[str, Callable] = {
    "trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(), "length": lambda x: len(x or ""),
}


def compile_template(source: str, filters: dict[str, Callable] | None = None) -> Callable[..., Iterator]:
    """``render(**values)``: yields (text, learn) pieces, and CUT after each item of a loop over a ``Stream``."""
    known = DEFAULT_FILTERS | (filters or {})
    write = _writer(fold(parse(source), known), known, False)
    return lambda **values: write(dict(values))
