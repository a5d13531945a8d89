"""A small sandboxed template language: parsed into a syntax tree, constants folded, compiled into Python closures.

Text, `{{ expression }}`, `{% for x in name %} .. {% endfor %}`, `{% if %} .. {% elif %} .. {% else %} .. {% endif %}`,
`{% generation %} .. {% endgeneration %}` and `{# comments #}`. Expressions: strings, integers, true, false, none, names,
`a.b` and `a['b']` on mappings, `==`, `!=`, `in`, `and`, `or`, `not`, `+` or `~` (joins text), `|filter`, parentheses. There
are no calls, no attributes of Python objects and no loops but over what is given, so a template can't reach anything else.

A compiled template yields (text, generated) pairs while it walks its messages, which may be an iterator: nothing of a
conversation is held but the current message.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

Scope = dict[str, Any]
Piece = tuple[str, bool]
Value = Callable[[Scope], Any]
Render = Callable[[Scope, bool], Iterator[Piece]]

PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
LEXEMES = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[|.()\[\]+~]))""")
ESCAPES = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Constant:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: Any
    key: Any


@dataclass(frozen=True)
class Operation:
    kind: str  # ==, !=, in, and, or, not, + or a filter's name behind |
    parts: tuple


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple  # (test, body); the last test may be Constant(True)


@dataclass(frozen=True)
class Generation:
    body: tuple


def text_of(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def escape(value: Any) -> str:
    """Make control strings impossible in a text, reversibly: no `###` and no `</` is left."""
    return text_of(value).replace("\\", "\\\\").replace("##", "#\\#").replace("</", "<\\/")


def escape_name(value: Any) -> str:
    return escape(value).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


FILTERS: dict[str, Callable[[Any], Any]] = {
    "escape": escape, "escape_name": escape_name, "trim": lambda v: text_of(v).strip(),
    "upper": lambda v: text_of(v).upper(), "lower": lambda v: text_of(v).lower(),
}
OPERATIONS: dict[str, Callable[..., Any]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: text_of(a) + text_of(b),
    "in": lambda a, b: isinstance(b, str) and text_of(a) in b, "not": lambda a: not a,
}


class Expression:
    """Recursive descent over the lexemes of one expression."""

    def __init__(self, source: str):
        self.lexemes: list[tuple[str, str]] = []
        at = 0
        while source[at:].strip():
            if not (m := LEXEMES.match(source, at)):
                raise TemplateError(f"can't read {source[at:].strip()!r}")
            self.lexemes.append((("text", "number", "name", "sign")[m.lastindex - 1], m[m.lastindex]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.lexemes[self.at][1] if self.at < len(self.lexemes) and self.lexemes[self.at][0] in ("name", "sign") else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return self.lexemes[self.at - 1][1]
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing")

    def name(self) -> str:
        if self.at >= len(self.lexemes) or self.lexemes[self.at][0] != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return self.lexemes[self.at - 1][1]

    def whole(self) -> Any:
        found = self.either()
        if self.at < len(self.lexemes):
            raise TemplateError(f"{self.lexemes[self.at][1]!r} is too much")
        return found

    def either(self) -> Any:
        left = self.both()
        while self.take("or"):
            left = Operation("or", (left, self.both()))
        return left

    def both(self) -> Any:
        left = self.negated()
        while self.take("and"):
            left = Operation("and", (left, self.negated()))
        return left

    def negated(self) -> Any:
        return Operation("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Any:
        left = self.added()
        kind = self.take("==", "!=", "in")
        return Operation(kind, (left, self.added())) if kind else left

    def added(self) -> Any:
        left = self.filtered()
        while self.take("+", "~"):
            left = Operation("+", (left, self.filtered()))
        return left

    def filtered(self) -> Any:
        value = self.single()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = Operation("|" + name, (value,))
        return value

    def single(self) -> Any:
        if self.take("("):
            value = self.either()
            self.need(")")
        elif self.at < len(self.lexemes) and self.lexemes[self.at][0] in ("text", "number"):
            kind, source = self.lexemes[self.at]
            self.at += 1
            value = Constant(int(source) if kind == "number" else re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), source[1:-1], flags=re.S))
        else:
            name = self.name()
            value = Constant({"true": True, "false": False, "none": None}[name]) if name in ("true", "false", "none") else Name(name)
        while sign := self.take(".", "["):
            if sign == ".":
                value = Item(value, Constant(self.name()))
            else:
                value = Item(value, self.either())
                self.need("]")
        return value


def parse(source: str) -> tuple:
    """The syntax tree of a template: a tuple of nodes."""
    parts: list[tuple[str, str]] = []
    at = 0
    for m in PARTS.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at : m.start()]))
        if m[1] is not None:
            parts.append(("output", m[1]))
        elif m[2] is not None:
            parts.append(("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    nodes, rest, end = _block(parts, 0, ())
    if end:
        raise TemplateError(f"{end!r} without a beginning")
    assert rest == len(parts)
    return nodes


def _block(parts: list[tuple[str, str]], at: int, ends: tuple[str, ...]) -> tuple[tuple, int, str | None]:
    """Nodes up to one of the ending tags; the place behind it and the tag."""
    nodes: list[Any] = []
    while at < len(parts):
        kind, source = parts[at]
        at += 1
        if kind == "text":
            nodes.append(Output(Constant(source)))
        elif kind == "output":
            nodes.append(Output(Expression(source).whole()))
        else:
            word, _, more = source.partition(" ")
            if word in ends:
                return tuple(nodes), at, source
            if word == "for":
                name, _, over = more.strip().partition(" in ")
                if not re.fullmatch(r"[A-Za-z_]\w*", name.strip()):
                    raise TemplateError(f"can't read {source!r}")
                body, at, _ = _block(parts, at, ("endfor",))
                nodes.append(For(name.strip(), Expression(over).whole(), body))
            elif word == "if":
                branches, test = [], Expression(more).whole()
                while True:
                    body, at, end = _block(parts, at, ("elif", "else", "endif"))
                    branches.append((test, body))
                    if end == "endif":
                        break
                    test = Constant(True) if end == "else" else Expression(end[4:]).whole()
                nodes.append(If(tuple(branches)))
            elif word == "generation":
                body, at, _ = _block(parts, at, ("endgeneration",))
                nodes.append(Generation(body))
            else:
                raise TemplateError(f"unknown tag {source!r}")
    if ends:
        raise TemplateError(f"{ends[-1]!r} is missing")
    return tuple(nodes), at, None


def fold_value(value: Any) -> Any:
    """Evaluate what is constant in an expression."""
    if isinstance(value, Item):
        return Item(fold_value(value.of), fold_value(value.key))
    if not isinstance(value, Operation):
        return value
    parts = tuple(map(fold_value, value.parts))
    if value.kind in ("and", "or") and isinstance(parts[0], Constant):
        return parts[1] if bool(parts[0].value) == (value.kind == "and") else parts[0]
    if value.kind not in ("and", "or") and all(isinstance(p, Constant) for p in parts):
        apply = FILTERS[value.kind[1:]] if value.kind[0] == "|" else OPERATIONS[value.kind]
        return Constant(apply(*(p.value for p in parts)))
    return Operation(value.kind, parts)


def fold(nodes: tuple) -> tuple:
    """Fold expressions, join neighbouring constant texts, and drop branches that are never taken."""
    out: list[Any] = []

    def add(node: Any) -> None:
        if isinstance(node, Output) and isinstance(node.value, Constant):
            text = text_of(node.value.value)
            if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Constant):
                out[-1] = Output(Constant(out[-1].value.value + text))
            elif text:
                out.append(Output(Constant(text)))
        else:
            out.append(node)

    for node in nodes:
        if isinstance(node, Output):
            add(Output(fold_value(node.value)))
        elif isinstance(node, For):
            add(For(node.name, fold_value(node.over), fold(node.body)))
        elif isinstance(node, Generation):
            add(Generation(fold(node.body)))
        else:
            branches = []
            for test, body in node.branches:
                test = fold_value(test)
                if isinstance(test, Constant) and not test.value:
                    continue
                branches.append((test, fold(body)))
                if isinstance(test, Constant):
                    break
            if branches and isinstance(branches[0][0], Constant):
                for inner in branches[0][1]:
                    add(inner)
            elif branches:
                add(If(tuple(branches)))
    return tuple(out)


def value_closure(value: Any) -> Value:
    if isinstance(value, Constant):
        constant = value.value
        return lambda scope: constant
    if isinstance(value, Name):
        name = value.name
        return lambda scope: scope.get(name)
    if isinstance(value, Item):
        of, key = value_closure(value.of), value_closure(value.key)

        def item(scope: Scope) -> Any:
            found = of(scope)
            return found.get(key(scope)) if isinstance(found, Mapping) else None

        return item
    parts = tuple(map(value_closure, value.parts))
    if value.kind == "and":
        return lambda scope: parts[0](scope) and parts[1](scope)
    if value.kind == "or":
        return lambda scope: parts[0](scope) or parts[1](scope)
    apply = FILTERS[value.kind[1:]] if value.kind[0] == "|" else OPERATIONS[value.kind]
    if len(parts) == 1:
        return lambda scope: apply(parts[0](scope))
    return lambda scope: apply(parts[0](scope), parts[1](scope))


def closure(nodes: tuple) -> Render:
    steps = tuple(map(node_closure, nodes))

    def render(scope: Scope, generated: bool) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope, generated)

    return render


def node_closure(node: Any) -> Render:
    if isinstance(node, Output):
        value = value_closure(node.value)

        def output(scope: Scope, generated: bool) -> Iterator[Piece]:
            if text := text_of(value(scope)):
                yield text, generated

        return output
    if isinstance(node, Generation):
        body = closure(node.body)
        return lambda scope, generated: body(scope, True)
    if isinstance(node, For):
        name, over, body = node.name, value_closure(node.over), closure(node.body)

        def loop(scope: Scope, generated: bool) -> Iterator[Piece]:
            for item in over(scope) or ():
                yield from body({**scope, name: item}, generated)

        return loop
    branches = tuple((value_closure(test), closure(body)) for test, body in node.branches)

    def choice(scope: Scope, generated: bool) -> Iterator[Piece]:
        for test, body in branches:
            if test(scope):
                yield from body(scope, generated)
                return

    return choice


def compiled(source: str) -> Callable[[Iterable[Mapping[str, Any]]], Iterator[Piece]]:
    """A function from messages to (text, generated) pieces."""
    render = closure(fold(parse(source)))
    return lambda messages: render({"messages": messages}, False)
