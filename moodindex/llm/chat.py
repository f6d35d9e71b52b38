"""Chat formatting: a small sandboxed template language, compiled.

A template is parsed into a syntax tree, constants are folded, and the tree
becomes Python closures that write a conversation turn by turn and note
which code points lie between generation markers.

Language: text; ``{{ expr }}``; ``{% for m in messages %} .. {% endfor %}``;
``{% if expr %} .. {% elif expr %} .. {% else %} .. {% endif %}``;
``{% generation %} .. {% endgeneration %}``.  Expressions: 'strings',
integers, true, false, ``m.role``, ``m.text``, ``loop.index0``,
``loop.first``, ``loop.last``, ``==``, ``!=``, ``~`` (join), ``and``, ``or``,
``not``, parentheses and the filters ``escape``, ``trim``, ``upper``,
``lower``.  Nothing else can be named: no attribute, call or import of the
host language is reachable.

``escape`` makes control strings inside a text harmless and can be undone: a
backslash is doubled and each control string gets a backslash after its
first character, so an escaped text contains no control string.

Defined results: a null text or role is empty; turns are ordered by turn
(null first), role and text, so ties and repeated rows have one order; rows
with a null id form one conversation with id null; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodindex.llm.common import text_of

# The control strings of the template below.
CONTROLS = ("[SYS]", "[/SYS]", "[INST]", "[/INST]", "<s>", "</s>", "[TURN]", "[:]", "[/TURN]")
TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}<s>{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% elif m.role == 'system' %}[SYS] {{ m.text | escape }} [/SYS]"
    "{% else %}[TURN]{{ m.role | escape }}[:]{{ m.text | escape }}[/TURN]{% endif %}"
    "{% endfor %}")
# A formatted conversation is one row up to about this many code points; a
# longer one continues in further rows, cut between turns.
PART_CHARS = 1 << 20

_CONTROL = re.compile(r"\\|" + "|".join(re.escape(c) for c in CONTROLS))


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}
FIELDS = {"role", "text"}
LOOP = {"index0", "first", "last"}


class TemplateError(ValueError):
    pass


# -- syntax tree -------------------------------------------------------------

@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Field:
    scope: str  # "message" or "loop"
    name: str


@dataclass(frozen=True)
class Op:
    kind: str  # ==, !=, ~, and, or, not, or a filter's name
    args: tuple


@dataclass(frozen=True)
class Write:
    expr: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:(\d+)|'((?:[^'\\]|\\.)*)'|(==|!=|[()|~.])|([A-Za-z_]\w*))")


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str, loop_var: str | None):
        self.loop_var, self.toks, at = loop_var, [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:]!r}")
            number, string, sign, name = m.groups()
            self.toks.append(("int", int(number)) if number else ("str", unescape(string))
                             if string is not None else ("sign", sign) if sign else ("name", name))
            at = m.end()
        self.at = 0

    def peek(self, *values) -> bool:
        return self.at < len(self.toks) and self.toks[self.at][0] in ("sign", "name") \
            and self.toks[self.at][1] in values

    def take(self):
        if self.at >= len(self.toks):
            raise TemplateError("unexpected end of expression")
        self.at += 1
        return self.toks[self.at - 1]

    def parse(self):
        e = self._or()
        if self.at != len(self.toks):
            raise TemplateError(f"unexpected {self.toks[self.at][1]!r}")
        return e

    def _chain(self, below, *kinds):
        e = below()
        while self.peek(*kinds):
            e = Op(self.take()[1], (e, below()))
        return e

    def _or(self):
        return self._chain(self._and, "or")

    def _and(self):
        return self._chain(self._not, "and")

    def _not(self):
        if self.peek("not"):
            self.take()
            return Op("not", (self._not(),))
        return self._chain(self._join, "==", "!=")

    def _join(self):
        return self._chain(self._filtered, "~")

    def _filtered(self):
        e = self._atom()
        while self.peek("|"):
            self.take()
            kind, name = self.take()
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            e = Op(name, (e,))
        return e

    def _atom(self):
        kind, value = self.take()
        if kind in ("int", "str"):
            return Const(value)
        if (kind, value) == ("sign", "("):
            e = self._or()
            if self.take() != ("sign", ")"):
                raise TemplateError("missing )")
            return e
        if kind == "name" and value in ("true", "false"):
            return Const(value == "true")
        if kind == "name" and self.loop_var and value in (self.loop_var, "loop") and self.peek("."):
            self.take()
            field = self.take()[1]
            scope = "loop" if value == "loop" else "message"
            if field in (LOOP if scope == "loop" else FIELDS):
                return Field(scope, field)
            raise TemplateError(f"unknown field {value}.{field}")
        raise TemplateError(f"unknown name {value!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    pieces, at = [], 0
    for m in _PIECE.finditer(source):
        if m.start() > at:
            pieces.append(("text", source[at:m.start()]))
        pieces.append(("expr", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        pieces.append(("text", source[at:]))
    pieces.reverse()

    def block(ends: tuple[str, ...], var: str | None) -> tuple[tuple, str]:
        out = []
        while pieces:
            kind, s = pieces.pop()
            word = s.split(None, 1)[0] if kind == "tag" and s else ""
            if kind == "text":
                out.append(Write(Const(s)))
            elif kind == "expr":
                out.append(Write(_Expression(s, var).parse()))
            elif word in ends:
                return tuple(out), s
            elif word == "if":
                out.append(branch(s[2:], var))
            elif word == "generation":
                out.append(Generation(block(("endgeneration",), var)[0]))
            elif m := re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+messages", s):
                if var:
                    raise TemplateError("loops don't nest")
                out.append(For(block(("endfor",), m[1])[0]))
            else:
                raise TemplateError(f"unknown tag {s!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return tuple(out), ""

    def branch(test: str, var: str | None) -> If:
        then, end = block(("elif", "else", "endif"), var)
        other: tuple = ()
        if end.startswith("elif"):
            other = (branch(end[4:], var),)
        elif end == "else":
            other = block(("endif",), var)[0]
        return If(_Expression(test, var).parse(), then, other)

    return block((), None)[0]


# -- constant folding --------------------------------------------------------

def _text(v) -> str:
    return "" if v is None else ("true" if v else "false") if isinstance(v, bool) else str(v)


APPLY: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "~": lambda a, b: _text(a) + _text(b),
    "and": lambda a, b: bool(a) and bool(b), "or": lambda a, b: bool(a) or bool(b),
    "not": lambda a: not a,
    **{k: (lambda a, f=f: f(_text(a))) for k, f in FILTERS.items()}}


def fold_expr(e):
    if not isinstance(e, Op):
        return e
    args = tuple(map(fold_expr, e.args))
    if all(isinstance(a, Const) for a in args):
        return Const(APPLY[e.kind](*(a.value for a in args)))
    if e.kind in ("and", "or"):
        absorbing = e.kind == "or"
        if any(isinstance(a, Const) and bool(a.value) == absorbing for a in args):
            return Const(absorbing)
    return Op(e.kind, args)


def fold(body: Iterable) -> tuple:
    """Fold constant expressions, drop dead branches, join adjacent text."""
    out: list = []
    for n in body:
        if isinstance(n, Write):
            new = [Write(fold_expr(n.expr))]
        elif isinstance(n, If):
            test = fold_expr(n.test)
            if isinstance(test, Const):
                new = list(fold(n.then if test.value else n.other))
            else:
                new = [If(test, fold(n.then), fold(n.other))]
        else:
            new = [type(n)(fold(n.body))]
        for x in new:
            if isinstance(x, Write) and isinstance(x.expr, Const):
                text = _text(x.expr.value)
                if not text:
                    continue
                if out and isinstance(out[-1], Write) and isinstance(out[-1].expr, Const):
                    out[-1] = Write(Const(out[-1].expr.value + text))
                    continue
                x = Write(Const(text))
            out.append(x)
    return tuple(out)


# -- closures ----------------------------------------------------------------

class Sink:
    """Collects text and the spans between generation markers.  ``start`` is
    the number of code points that earlier parts have taken."""

    def __init__(self):
        self.parts: list[str] = []
        self.spans: list[tuple[int, int]] = []
        self.at = self.start = 0

    def write(self, s: str) -> None:
        self.parts.append(s)
        self.at += len(s)

    def cut(self) -> tuple[int, str, list]:
        out = (self.start, "".join(self.parts), self.spans)
        self.start, self.parts, self.spans = self.at, [], []
        return out


def _value(e) -> Callable[[dict], object]:
    if isinstance(e, Const):
        return lambda env, v=e.value: v
    if isinstance(e, Field):
        return lambda env, k=f"{e.scope}.{e.name}": env[k]
    f, args = APPLY[e.kind], [_value(a) for a in e.args]
    if len(args) == 1:
        return lambda env, f=f, a=args[0]: f(a(env))
    return lambda env, f=f, a=args[0], b=args[1]: f(a(env), b(env))


def _closure(body: tuple) -> Callable[[dict, Sink], None]:
    steps = []
    for n in body:
        if isinstance(n, Write):
            if isinstance(n.expr, Const):
                steps.append(lambda env, sink, s=n.expr.value: sink.write(s))
            else:
                steps.append(lambda env, sink, v=_value(n.expr): sink.write(_text(v(env))))
        elif isinstance(n, If):
            def choose(env, sink, t=_value(n.test), a=_closure(n.then), b=_closure(n.other)):
                (a if t(env) else b)(env, sink)
            steps.append(choose)
        elif isinstance(n, Generation):
            def marked(env, sink, f=_closure(n.body)):
                start = sink.at
                f(env, sink)
                if sink.at > start:
                    sink.spans.append((start, sink.at))
            steps.append(marked)
        else:
            raise TemplateError("a loop must stand outside of other blocks")

    def run(env, sink):
        for s in steps:
            s(env, sink)
    return run


class Template:
    """A compiled template.  ``render`` takes the turns one by one, so a
    conversation of any length needs the memory of one part."""

    def __init__(self, source: str):
        self.tree = fold(parse(source))
        self.sections = [(isinstance(n, For), _closure(n.body if isinstance(n, For) else (n,)))
                         for n in self.tree]
        if sum(loop for loop, _ in self.sections) > 1:
            raise TemplateError("one loop over the messages at most")

    def render(self, turns: Iterable[tuple[str, str]], part_chars: int = PART_CHARS) \
            -> Iterator[tuple[int, str, list]]:
        """``(start, text, spans)`` of each part; spans count from the
        conversation's first code point."""
        sink = Sink()
        for loop, f in self.sections:
            if not loop:
                f({}, sink)
                continue
            turns, index, now = iter(turns), 0, None
            now = next(turns, None)
            while now is not None:
                after = next(turns, None)
                f({"message.role": now[0], "message.text": now[1], "loop.index0": index,
                   "loop.first": index == 0, "loop.last": after is None}, sink)
                if sink.at - sink.start >= part_chars and after is not None:
                    yield sink.cut()
                now, index = after, index + 1
        yield sink.cut()


_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|<s>(?P<assistant>.*?)</s>|\[SYS\] (?P<system>.*?) \[/SYS\]"
    r"|\[TURN\](?P<role>.*?)\[:\](?P<text>.*?)\[/TURN\]", re.S)


def read_back(text: str) -> Iterator[tuple[str, str]]:
    """The turns ``(role, text)`` of a part that ``TEMPLATE`` has formatted."""
    at = 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            raise ValueError(f"no turn at code point {at}")
        at = m.end()
        if m["role"] is not None:
            yield unescape(m["role"]), unescape(m["text"])
        else:
            yield m.lastgroup, unescape(m[m.lastgroup])
    if at != len(text):
        raise ValueError(f"no turn at code point {at}")


def _grouped(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    from itertools import groupby
    return groupby(rows, key=lambda r: r[0])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def format_conversations(turns: DataFrame, template: str = TEMPLATE, id_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                         part_chars: int = PART_CHARS) -> DataFrame:
    """``conv_id, part, start, formatted, spans``: a row per part, in order
    within a partition; ``spans`` are the generated code points.  Turns
    shuffle once, by conversation, and stream through the closures."""
    kind = turns.schema[id_col].dataType
    Template(template)  # a bad template fails here, on the driver

    def run(batches):
        compiled, arrow = Template(template), None

        def first(bs):
            nonlocal arrow
            for b in bs:
                arrow = b.schema.field(0).type
                yield b

        out = []

        def flush():
            cols = list(zip(*out, strict=True))
            kinds = [arrow, pa.int64(), pa.int64(), pa.string(), pa.list_(
                pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            out.clear()
            return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                   names=["conv_id", "part", "start", "formatted", "spans"])

        chars = 0
        for conv, group in _grouped(_rows(first(batches))):
            parts = compiled.render(((r[1], r[2]) for r in group), part_chars)
            for n, (start, text, spans) in enumerate(parts):
                out.append((conv, n, start, text, [{"start": a, "end": b} for a, b in spans]))
                chars += len(text)
                if chars >= part_chars or len(out) >= 1000:
                    yield flush()
                    chars = 0
        if out:
            yield flush()

    rows = turns.select(turns[id_col].alias("id"), turns[turn_col].alias("turn"),
                        text_of(role_col).alias("role"), text_of(text_col).alias("text"))
    return (rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text")
            .select("id", "role", "text")
            .mapInArrow(run, f"conv_id {kind.simpleString()}, part long, start long, formatted string,"
                             " spans array<struct<start: long, end: long>>"))


def digest(formatted: DataFrame) -> DataFrame:
    """Read the parts back, a conversation after the other, into counts and
    digests of the turns and of the text under the loss mask."""
    kind = formatted.schema["conv_id"].dataType

    def run(batches):
        from hashlib import sha256
        arrow = pa.null()

        def first(bs):
            nonlocal arrow
            for b in bs:
                arrow = b.schema.field(0).type
                yield b

        out = []

        def flush():
            cols = list(zip(*out, strict=True))
            out.clear()
            kinds = [arrow, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.record_batch(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                       "formatted_chars"])

        for conv, group in _grouped(_rows(first(batches))):
            turns, loss, n, loss_chars, chars = sha256(), sha256(), 0, 0, 0
            for _, start, text, spans in group:
                for role, said in read_back(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for s in spans:
                    said = unescape(text[s["start"] - start:s["end"] - start])
                    loss.update(said.encode())
                    loss_chars += len(said)
                chars += len(text)
            out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) >= 1000:
                yield flush()
        if out:
            yield flush()

    return formatted.select("conv_id", "start", "formatted", "spans").mapInArrow(
        run, f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long,"
             " loss_sha256 string, formatted_chars long")
