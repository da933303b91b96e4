"""A small template language for conversations, compiled to Python closures.

::

    {{ expression }}            {% if e %}..{% elif e %}..{% else %}..{% endif %}
    {% for x in e %}..{% endfor %}     {% generation %}..{% endgeneration %}

Expressions: strings, integers, true/false/none, names, ``a.b``, ``a[e]``, ``+``,
``==``, ``!=``, ``<``, ``<=``, ``>``, ``>=``, ``and``, ``or``, ``not``, brackets
and filters ``e | name``. Inside a loop, ``loop`` has ``index``, ``index0``,
``first`` and ``last``. A tag that starts ``{%-`` or ends ``-%}`` eats the blanks
next to it.

Sandbox: a template reaches the values it is given and the filters it is compiled
with. It cannot call anything, nor read an attribute of a Python object: ``a.b`` is
a key of a mapping. Unknown names, keys and filters are errors.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

Filter = Callable[[object], object]
Eval = Callable[[dict], object]


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    base: object
    key: object


@dataclass(frozen=True)
class Binary:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class Not:
    value: object


@dataclass(frozen=True)
class Apply:
    filter: str
    value: object


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class If:
    arms: tuple  # of (condition, body); the last condition may be Const(True)


@dataclass(frozen=True)
class For:
    name: str
    items: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_TAG = re.compile(r"(\{\{-?|\{%-?)(.*?)(-?\}\}|-?%\})", re.S)
_TOKEN = re.compile(
    r"""\s*(?:(?P<str>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>+|.\[\]()]))"""
)
_WORDS = {"true": True, "false": False, "none": None}
_ESCAPES = {"n": "\n", "t": "\t"}
_KEYWORDS = {"and", "or", "not", "in", "if", "elif", "else", "for", *_WORDS}
_COMPARE = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
}


class _Expression:
    """Recursive descent over the tokens of one tag, loosest operator first."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        at = 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.tokens.append(("end", ""))

    def take(self, *wanted: str) -> str | None:
        kind, text = self.tokens[0]
        if kind in ("op", "name") and text in wanted:
            self.tokens.pop(0)
            return text
        return None

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} expected, not {self.tokens[0][1]!r}")

    def whole(self) -> object:
        value = self.either()
        if self.tokens[0][0] != "end":
            raise TemplateError(f"unexpected {self.tokens[0][1]!r}")
        return value

    def either(self) -> object:
        value = self.both()
        while self.take("or"):
            value = Binary("or", value, self.both())
        return value

    def both(self) -> object:
        value = self.negated()
        while self.take("and"):
            value = Binary("and", value, self.negated())
        return value

    def negated(self) -> object:
        return Not(self.negated()) if self.take("not") else self.compared()

    def compared(self) -> object:
        value = self.added()
        if op := self.take(*_COMPARE):
            value = Binary(op, value, self.added())
        return value

    def added(self) -> object:
        value = self.filtered()
        while self.take("+"):
            value = Binary("+", value, self.filtered())
        return value

    def filtered(self) -> object:
        value = self.indexed()
        while self.take("|"):
            value = Apply(self.name(), value)
        return value

    def indexed(self) -> object:
        value = self.primary()
        while True:
            if self.take("."):
                value = Item(value, Const(self.name()))
            elif self.take("["):
                value = Item(value, self.either())
                self.need("]")
            else:
                return value

    def name(self) -> str:
        kind, text = self.tokens.pop(0)
        if kind != "name" or text in _KEYWORDS:
            raise TemplateError(f"a name expected, not {text!r}")
        return text

    def primary(self) -> object:
        if self.take("("):
            value = self.either()
            self.need(")")
            return value
        kind, text = self.tokens.pop(0)
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "int":
            return Const(int(text))
        if kind == "name" and text in _WORDS:
            return Const(_WORDS[text])
        if kind == "name" and text not in _KEYWORDS:
            return Name(text)
        raise TemplateError(f"a value expected, not {text!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template: a tuple of statements."""
    parts: list[tuple[str, str]] = []  # ("text" | "output" | "tag", content)
    at, strip = 0, False
    for m in _TAG.finditer(source):
        if m[1][:2] == "{{" and m[3][-2:] != "}}" or m[1][:2] == "{%" and m[3][-2:] != "%}":
            raise TemplateError(f"tag {m[0]!r} ends otherwise than it starts")
        text = source[at : m.start()]
        text = text.lstrip() if strip else text
        parts.append(("text", text.rstrip() if m[1].endswith("-") else text))
        parts.append(("output" if m[1][:2] == "{{" else "tag", m[2].strip()))
        at, strip = m.end(), m[3].startswith("-")
    parts.append(("text", source[at:].lstrip() if strip else source[at:]))
    body, end = _block(parts, 0, ())
    assert end == len(parts)
    return body


def _block(parts: list[tuple[str, str]], at: int, ends: tuple[str, ...]) -> tuple[tuple, int]:
    """Statements from ``at`` up to a tag whose first word is one of ``ends``."""
    body: list[object] = []
    while at < len(parts):
        kind, content = parts[at]
        at += 1
        if kind == "text":
            if content:
                body.append(Output(Const(content)))
            continue
        if kind == "output":
            body.append(Output(_Expression(content).whole()))
            continue
        word, _, rest = content.partition(" ")
        if word in ends:
            return tuple(body), at - 1
        if word == "if":
            arms, condition = [], _Expression(rest).whole()
            while True:
                inner, at = _block(parts, at, ("elif", "else", "endif") if condition != Const(True) or not arms else ("endif",))
                arms.append((condition, inner))
                word, _, rest = parts[at][1].partition(" ")
                at += 1
                if word == "endif":
                    break
                condition = Const(True) if word == "else" else _Expression(rest).whole()
            body.append(If(tuple(arms)))
        elif word == "for":
            head = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not head or head[1] in _KEYWORDS:
                raise TemplateError(f"cannot read {content!r}")
            inner, at = _block(parts, at, ("endfor",))
            body.append(For(head[1], _Expression(head[2]).whole(), inner))
            at += 1
        elif word == "generation":
            inner, at = _block(parts, at, ("endgeneration",))
            body.append(Generation(inner))
            at += 1
        else:
            raise TemplateError(f"unknown or misplaced tag {content!r}")
    if ends:
        raise TemplateError(f"{' or '.join(ends)} is missing")
    return tuple(body), at


def fold(node: object, filters: Mapping[str, Filter]) -> object:
    """The tree with constant expressions computed, dead arms gone and texts joined."""
    if isinstance(node, tuple):
        out: list[object] = []
        for part in node:
            part = fold(part, filters)
            for one in part if isinstance(part, tuple) else (part,):
                if isinstance(one, Output) and isinstance(one.value, Const):
                    if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                        one = Output(Const(_text(out.pop().value.value) + _text(one.value.value)))
                    elif _text(one.value.value) == "":
                        continue
                out.append(one)
        return tuple(out)
    if isinstance(node, Output):
        return Output(fold(node.value, filters))
    if isinstance(node, For):
        return For(node.name, fold(node.items, filters), fold(node.body, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    if isinstance(node, If):
        arms = []
        for condition, body in node.arms:
            condition = fold(condition, filters)
            if isinstance(condition, Const) and not condition.value:
                continue
            arms.append((condition, fold(body, filters)))
            if isinstance(condition, Const):
                break
        if arms and isinstance(arms[0][0], Const):
            return arms[0][1]
        return If(tuple(arms)) if arms else ()
    inner = {
        Item: lambda n: Item(fold(n.base, filters), fold(n.key, filters)),
        Binary: lambda n: Binary(n.op, fold(n.left, filters), fold(n.right, filters)),
        Not: lambda n: Not(fold(n.value, filters)),
        Apply: lambda n: Apply(n.filter, fold(n.value, filters)),
    }.get(type(node))
    if not inner:
        return node
    node = inner(node)
    if all(isinstance(v, Const) for k, v in vars(node).items() if k not in ("op", "filter")):
        return Const(_expression(node, filters)({}))
    return node


def _text(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool) or not isinstance(value, (str, int)):
        raise TemplateError(f"{type(value).__name__} cannot be written into a text")
    return str(value)


def _expression(node: object, filters: Mapping[str, Filter]) -> Eval:
    """A closure that computes the node's value from the names in scope."""
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name

        def look(scope: dict) -> object:
            if name not in scope:
                raise TemplateError(f"unknown name {name!r}")
            return scope[name]

        return look
    if isinstance(node, Item):
        base, key = _expression(node.base, filters), _expression(node.key, filters)

        def pick(scope: dict) -> object:
            held, k = base(scope), key(scope)
            if isinstance(held, Mapping) and k in held or isinstance(held, (list, tuple)) and isinstance(k, int) and -len(held) <= k < len(held):
                return held[k]
            raise TemplateError(f"no item {k!r}")

        return pick
    if isinstance(node, Not):
        inner = _expression(node.value, filters)
        return lambda scope: not inner(scope)
    if isinstance(node, Apply):
        if node.filter not in filters:
            raise TemplateError(f"unknown filter {node.filter!r}")
        of, inner = filters[node.filter], _expression(node.value, filters)
        return lambda scope: of(inner(scope))
    left, right = _expression(node.left, filters), _expression(node.right, filters)
    if node.op == "and":
        return lambda scope: left(scope) and right(scope)
    if node.op == "or":
        return lambda scope: left(scope) or right(scope)
    if node.op in _COMPARE:
        compare = _COMPARE[node.op]
        return lambda scope: compare(left(scope), right(scope))

    def add(scope: dict) -> object:
        a, b = left(scope), right(scope)
        if type(a) is not type(b) or not isinstance(a, (str, int)):
            raise TemplateError("+ needs two texts or two numbers")
        return a + b

    return add


@dataclass
class Rendering:
    """What is written so far, and the spans inside generation markers (code points)."""

    parts: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _statement(node: object, filters: Mapping[str, Filter]) -> Callable[[dict, Rendering], None]:
    if isinstance(node, tuple):
        steps = [_statement(part, filters) for part in node]

        def run(scope: dict, out: Rendering) -> None:
            for step in steps:
                step(scope, out)

        return run
    if isinstance(node, Output):
        if isinstance(node.value, Const):
            text = _text(node.value.value)
            return lambda scope, out: out.write(text)
        value = _expression(node.value, filters)
        return lambda scope, out: out.write(_text(value(scope)))
    if isinstance(node, Generation):
        body = _statement(node.body, filters)

        def mark(scope: dict, out: Rendering) -> None:
            start = out.length
            body(scope, out)
            out.spans.append((start, out.length))

        return mark
    if isinstance(node, If):
        arms = [(_expression(c, filters), _statement(b, filters)) for c, b in node.arms]

        def choose(scope: dict, out: Rendering) -> None:
            for condition, body in arms:
                if condition(scope):
                    return body(scope, out)

        return choose
    items, body, name = _expression(node.items, filters), _statement(node.body, filters), node.name

    def loop(scope: dict, out: Rendering) -> None:
        held = items(scope)
        if not isinstance(held, (list, tuple)):
            raise TemplateError("only a list can be looped over")
        for i, item in enumerate(held):
            place = {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(held) - 1}
            body({**scope, name: item, "loop": place}, out)

    return loop


def compile_template(source: str, filters: Mapping[str, Filter]) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from the names in scope to the text and its generation spans."""
    run = _statement(fold(parse(source), filters), filters)

    def render(scope: dict) -> tuple[str, list[tuple[int, int]]]:
        out = Rendering()
        run(scope, out)
        return "".join(out.parts), out.spans

    return render
