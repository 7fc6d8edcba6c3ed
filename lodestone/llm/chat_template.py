"""Chat formatting by a compiled template.

A template is parsed into a syntax tree, constant parts are folded, and every node becomes a
Python closure; nothing is evaluated by name or attribute beyond the values given, so a
template cannot reach outside.  Language:

    {{ expr }}                                   output
    {% for m in expr %} .. {% endfor %}          loop; also sets loop_first, loop_index
    {% if expr %} .. {% elif expr %} .. {% else %} .. {% endif %}
    {% generation %} .. {% endgeneration %}      what training computes its loss on

    expr: strings, integers, true/false/none, names, m.key, m["key"], == != + ~, not, and, or,
          ( ), and filters: x | escape, x | line, x | trim, x | upper, x | lower

Rendering is a generator of (text, generated) pieces over a generator of messages, so a
conversation of any length passes through a task without being held.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .text import bounded_batches

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CHAT = ("{% for m in messages %}" + OPEN + "{{ m.role | line }}\n"
        "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
        "{% else %}{{ m.text | escape }}{% endif %}" + CLOSE + "\n{% endfor %}")
CHUNK = 1 << 16  # code points of formatted text per output row, about

_MARK, _MARKED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left: between ``<`` and ``|`` goes one backslash more than there was."""
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"<\1|", text)


def escape_line(text: str) -> str:
    """``escape`` for a text that must stay on one line: line feeds become ``\\n``."""
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_line(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text), flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "line": escape_line, "trim": str.strip, "upper": str.upper, "lower": str.lower}

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}", re.S)
_TOKEN = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[+~|.()\[\]]))""")
_CONSTANTS = {"true": True, "false": False, "none": None}
_BACK = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    pass


# Nodes are tuples: ("const", v) ("name", n) ("get", node, key) ("filter", node, f)
# ("not", a) ("and" | "or" | "==" | "!=" | "+", a, b); ("out", node) ("for", var, node, body)
# ("if", [(node, body), ..]) ("generation", body); a body is a list of nodes.

class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            self.tokens.append((m.lastindex, m[m.lastindex]))
            at = m.end()
        self.i = 0

    def peek(self) -> tuple[int, str]:
        return self.tokens[self.i] if self.i < len(self.tokens) else (0, "")

    def take(self, value: str | None = None) -> tuple[int, str]:
        token = self.peek()
        if not token[0] or value is not None and token[1] != value:
            raise TemplateError(f"expected {value or 'a value'}, found {token[1] or 'the end'}")
        self.i += 1
        return token

    def parse(self) -> tuple:
        node = self.either()
        if self.peek()[0]:
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return node

    def _chain(self, words: tuple[str, ...], below: Callable[[], tuple]) -> tuple:
        node = below()
        while self.peek()[1] in words and self.peek()[0] != 1:
            word = self.take()[1]
            node = ("+" if word == "~" else word, node, below())
        return node

    def either(self) -> tuple:
        return self._chain(("or",), self.both)

    def both(self) -> tuple:
        return self._chain(("and",), self.negation)

    def negation(self) -> tuple:
        if self.peek() == (3, "not"):
            self.take()
            return ("not", self.negation())
        return self._chain(("==", "!="), self.sum)

    def sum(self) -> tuple:
        return self._chain(("+", "~"), self.filtered)

    def filtered(self) -> tuple:
        node = self.value()
        while self.peek() == (4, "|"):
            self.take()
            name = self.take()[1]
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = ("filter", node, name)
        return node

    def value(self) -> tuple:
        kind, word = self.take()
        if kind == 1:
            node = ("const", re.sub(r"\\(.)", lambda m: _BACK.get(m[1], m[1]), word[1:-1], flags=re.S))
        elif kind == 2:
            node = ("const", int(word))
        elif kind == 3:
            if word in ("and", "or", "not"):
                raise TemplateError(f"unexpected {word!r}")
            node = ("const", _CONSTANTS[word]) if word in _CONSTANTS else ("name", word)
        elif word == "(":
            node = self.either()
            self.take(")")
        else:
            raise TemplateError(f"unexpected {word!r}")
        while self.peek() in ((4, "."), (4, "[")):
            if self.take()[1] == ".":
                node = ("get", node, self.take()[1])
            else:
                key = self.take()[1]
                node = ("get", node, key[1:-1] if key[:1] in "'\"" else int(key))
                self.take("]")
        return node


def parse(source: str) -> list[tuple]:
    """The template's syntax tree."""
    pieces, at = [], 0
    for m in _TAG.finditer(source):
        if m.start() > at:
            pieces.append(("text", source[at:m.start()]))
        pieces.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        pieces.append(("text", source[at:]))
    body, rest = _body(pieces, 0, ())
    return body


def _body(pieces: list[tuple], i: int, ends: tuple[str, ...]) -> tuple[list[tuple], int]:
    out: list[tuple] = []
    while i < len(pieces):
        kind, source = pieces[i]
        i += 1
        if kind == "text":
            out.append(("out", ("const", source)))
        elif kind == "out":
            out.append(("out", _Expression(source).parse()))
        else:
            word, _, rest = source.partition(" ")
            if word in ends:
                return out, i - 1
            if word == "for":
                m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
                if not m:
                    raise TemplateError(f"bad loop {source!r}")
                body, i = _body(pieces, i, ("endfor",))
                out.append(("for", m[1], _Expression(m[2]).parse(), body))
            elif word == "generation":
                body, i = _body(pieces, i, ("endgeneration",))
                out.append(("generation", body))
            elif word == "if":
                branches, test = [], _Expression(rest).parse()
                while True:
                    body, i = _body(pieces, i, ("elif", "else", "endif"))
                    branches.append((test, body))
                    word, _, rest = pieces[i][1].partition(" ")
                    if word == "endif":
                        break
                    test = ("const", True) if word == "else" else _Expression(rest).parse()
                    i += 1
                out.append(("if", branches))
            else:
                raise TemplateError(f"unknown tag {source!r}")
            i += 1
    if ends:
        raise TemplateError(f"missing {ends[-1]}")
    return out, i


def _text(v: Any) -> str:
    return "" if v is None else v if isinstance(v, str) else str(v)


_OPERATORS: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: _text(a) + _text(b),
    "and": lambda a, b: a and b, "or": lambda a, b: a or b}


def fold(node: tuple) -> tuple:
    """The expression with constant parts computed."""
    op = node[0]
    if op in _OPERATORS:
        a, b = fold(node[1]), fold(node[2])
        if a[0] == b[0] == "const":
            return ("const", _OPERATORS[op](a[1], b[1]))
        if op in ("and", "or") and a[0] == "const":
            return b if bool(a[1]) == (op == "and") else a
        return (op, a, b)
    if op == "not":
        a = fold(node[1])
        return ("const", not a[1]) if a[0] == "const" else ("not", a)
    if op == "filter":
        a = fold(node[1])
        return ("const", FILTERS[node[2]](_text(a[1]))) if a[0] == "const" else ("filter", a, node[2])
    return ("get", fold(node[1]), node[2]) if op == "get" else node


def fold_body(body: list[tuple]) -> list[tuple]:
    """A body with folded expressions, dead branches dropped and adjacent texts joined."""
    out: list[tuple] = []
    for node in body:
        if node[0] == "out":
            new = [("out", fold(node[1]))]
        elif node[0] == "for":
            new = [("for", node[1], fold(node[2]), fold_body(node[3]))]
        elif node[0] == "generation":
            new = [("generation", fold_body(node[1]))]
        else:
            branches = []
            for test, inner in node[1]:
                test = fold(test)
                if test[0] != "const" or test[1]:
                    branches.append((test, fold_body(inner)))
                if test[0] == "const" and test[1]:
                    break
            new = branches[0][1] if branches and branches[0][0][0] == "const" else [("if", branches)] if branches else []
        for n in new:
            if out and n[0] == out[-1][0] == "out" and n[1][0] == out[-1][1][0] == "const":
                out[-1] = ("out", ("const", _text(out[-1][1][1]) + _text(n[1][1])))
            elif n != ("out", ("const", "")):
                out.append(n)
    return out


def _value(node: tuple) -> Callable[[dict], Any]:
    op = node[0]
    if op == "const":
        return lambda env, v=node[1]: v
    if op == "name":
        return lambda env, n=node[1]: env.get(n)
    if op == "get":
        def get(env, inner=_value(node[1]), key=node[2]):
            v = inner(env)
            return v.get(key) if isinstance(v, dict) else None
        return get
    if op == "filter":
        return lambda env, f=FILTERS[node[2]], inner=_value(node[1]): f(_text(inner(env)))
    if op == "not":
        return lambda env, inner=_value(node[1]): not inner(env)
    a, b = _value(node[1]), _value(node[2])
    if op == "and":
        return lambda env: a(env) and b(env)
    if op == "or":
        return lambda env: a(env) or b(env)
    return lambda env, f=_OPERATORS[op]: f(a(env), b(env))


Piece = tuple[str, bool]
Render = Callable[[dict, bool], Iterator[Piece]]


def _statement(node: tuple) -> Render:
    if node[0] == "out":
        value = _value(node[1])

        def out(env, gen):
            text = _text(value(env))
            if text:
                yield text, gen
        return out
    if node[0] == "generation":
        inner = _sequence(node[1])
        return lambda env, gen: inner(env, True)
    if node[0] == "for":
        items, body, name = _value(node[2]), _sequence(node[3]), node[1]

        def loop(env, gen):
            for i, item in enumerate(items(env) or ()):
                yield from body({**env, name: item, "loop_index": i, "loop_first": i == 0}, gen)
        return loop
    branches = [(_value(test), _sequence(body)) for test, body in node[1]]

    def choose(env, gen):
        for test, body in branches:
            if test(env):
                yield from body(env, gen)
                return
    return choose


def _sequence(body: list[tuple]) -> Render:
    parts = [_statement(n) for n in body]

    def run(env, gen):
        for p in parts:
            yield from p(env, gen)
    return run


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages to (text, generated) pieces."""
    run = _sequence(fold_body(parse(source)))
    return lambda messages: run({"messages": messages}, False)


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


_CHUNK_SCHEMA = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("text", pa.string()),
                           ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])


def formatted(conversations: DataFrame, template: str = CHAT, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, chunk, text, spans): the formatted text of every conversation of
    ``conversations`` (conv_id, turn, role, text; other columns are ignored), in chunks of
    about ``chunk`` code points cut between pieces, and per chunk the spans under the loss mask.

    Rows are ordered by turn, then role and text (nulls first); a null role or text is empty;
    rows without a conv_id make one conversation; repeated rows are repeated turns; an empty
    table gives no rows.  A partition's conversations are streamed: a task holds one chunk and
    one text, however long a conversation is."""
    compile_template(template)  # errors show here, not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render, ready, held = compile_template(template), [], 0
        for conv_id, rows in groupby(_rows(batches, "conv_id", "role", "text"), key=lambda r: r[0]):
            number, text, at, spans = 0, [], 0, []
            for piece, gen in render({"role": r[1], "text": r[2]} for r in rows):
                if gen:
                    if spans and spans[-1]["stop"] == at:
                        spans[-1]["stop"] = at + len(piece)
                    else:
                        spans.append({"start": at, "stop": at + len(piece)})
                text.append(piece)
                at += len(piece)
                if at >= chunk:
                    ready.append({"conv_id": conv_id, "chunk": number, "text": "".join(text), "spans": spans})
                    number, text, held, at, spans = number + 1, [], held + at, 0, []
                    if held >= 16 * chunk:
                        yield pa.RecordBatch.from_pylist(ready, _CHUNK_SCHEMA)
                        ready, held = [], 0
            if text or not number:
                ready.append({"conv_id": conv_id, "chunk": number, "text": "".join(text), "spans": spans})
                held += at
            if held >= 16 * chunk:
                yield pa.RecordBatch.from_pylist(ready, _CHUNK_SCHEMA)
                ready, held = [], 0
        if ready:
            yield pa.RecordBatch.from_pylist(ready, _CHUNK_SCHEMA)

    ship_package(conversations.sparkSession)
    blank = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    return (bounded_batches(conversations).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *blank)
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, "conv_id long, chunk long, text string, spans array<struct<start: long, stop: long>>"))


_TURN = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE) + "\n", re.S)


def read_back(chunks: DataFrame) -> DataFrame:
    """Digests of the texts read from the output of ``formatted`` with the chat template:
    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.  ``chunks`` is
    that frame itself, whose rows come in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv_id, rows in groupby(_rows(batches, "conv_id", "text", "spans"), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = chars = 0
            rest = ""
            for _, text, spans in rows:
                chars += len(text)
                for s in spans:
                    plain = unescape(text[s["start"]:s["stop"]])
                    loss_chars += len(plain)
                    loss.update(plain.encode("utf-8", "surrogatepass"))
                rest, at = rest + text, 0
                for m in _TURN.finditer(rest):
                    turns.update(f"{unescape_line(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
                    n, at = n + 1, m.end()
                rest = rest[at:]
            out.append({"conv_id": conv_id, "n_turns": n, "turns_sha256": turns.hexdigest(),
                        "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(), "formatted_chars": chars})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out)

    return chunks.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                  "loss_sha256 string, formatted_chars long")
