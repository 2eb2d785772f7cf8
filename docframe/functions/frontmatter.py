"""Front matter: the part of YAML that documents open with, read and written.

Read are block maps and lists of any depth, lists and maps in brackets, quoted and plain texts over several lines,
literal (``|``) and folded (``>``) texts, comments. Anchors, tags and several documents are not. Reading is lenient
where a model's output often is: a value may contain ``: ``, a top line ``key:value`` is a pair, other lines that fit
nowhere are left out. A block is a page's at most, so it is read in its row, in batches of rows.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts that read as something else unless they are quoted.
AMBIGUOUS = re.compile(r"(?i:true|false|yes|no|on|off|null|~|)\Z|[+-]?(?:\d[\d_]*)?\.?\d+(?:[eE][+-]?\d+)?\Z|\d{4}-\d\d-\d\d|0[xo][0-9a-fA-F]+\Z")
PLAIN = re.compile(r"[^\W_/(]?[/(\w][^:#\"'{}\[\],&*!|>%@`\n]*(?:\([^:#\"'\n]*\))?\Z")
KEY = re.compile(r"""("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^\s\[\]{}"'#&*!|>%@`,-][^\n]*?|-[^\s][^\n]*?)[ \t]*:(?:[ \t]+|\Z)""")
SCALAR = re.compile(r"[|>]([+-]?)([1-9]?)([+-]?)[ \t]*(?:#.*)?\Z")
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "0": "\0", "b": "\b", "f": "\f", "e": "\x1b", "a": "\a", "v": "\v", " ": " ", "_": "\xa0"}
WIDTHS = {"x": 2, "u": 4, "U": 8}


@dataclass(frozen=True)
class Text:
    """A scalar, and whether it was quoted."""

    text: str
    quoted: bool = False


Node = Text | dict | list | None


def _plain(raw: str) -> Text | None:
    return None if raw in ("", "~", "null", "Null", "NULL") else Text(raw)


def _unescaped(body: str) -> str:
    def one(m: re.Match) -> str:
        code, digits = m[1][0], m[1][1:]
        if digits:
            return chr(min(int(digits, 16), 0x10FFFF))
        return ESCAPES.get(code, code)

    return re.sub(r"\\(x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|.)", one, body, flags=re.DOTALL)


def _quoted(raw: str) -> str:
    """The text of a quoted scalar; line ends in it are folded."""
    body = re.sub(r"(?<!\\)((?:\\\\)*)\\\n[ \t]*", r"\1", raw[1:-1]) if raw[0] == '"' else raw[1:-1]
    body = re.sub(r"[ \t]*\n((?:[ \t]*\n)*)[ \t]*", lambda m: "\n" * m[1].count("\n") or " ", body)
    return body.replace("''", "'") if raw[0] == "'" else _unescaped(body)


def _bare(raw: str) -> str:
    """A plain text without its comment."""
    return re.split(r"(?:\A|[ \t])#", raw, maxsplit=1)[0].strip()


def _closing(text: str) -> int:
    """Where the quote that a text opens with ends; -1 if it does not."""
    mark, i = text[0], 1
    while i < len(text):
        if text[i] == "\\" and mark == '"':
            i += 1
        elif text[i] == mark:
            if mark == "'" and text[i + 1 : i + 2] == "'":
                i += 1
            else:
                return i
        i += 1
    return -1


class _Flow:
    """A list or map in brackets."""

    def __init__(self, text: str) -> None:
        self.text, self.at = text, 0

    def space(self) -> None:
        while m := re.compile(r"\s+|#[^\n]*(?=\n|\Z)").match(self.text, self.at):
            self.at = m.end()

    def node(self, stop: str) -> Node:
        self.space()
        mark = self.text[self.at : self.at + 1]
        if mark and mark in "[{":
            return self.sequence() if mark == "[" else self.mapping()
        if mark and mark in "\"'":
            end = _closing(self.text[self.at :])
            raw = self.text[self.at : self.at + end + 1] if end > 0 else self.text[self.at :] + mark
            self.at = self.at + end + 1 if end > 0 else len(self.text)
            return Text(_quoted(raw), True)
        m = re.compile(stop, re.DOTALL).match(self.text, self.at)
        self.at = m.end()
        return _plain(" ".join(m[0].split()))

    def next(self, end: str) -> bool:
        """Whether another element follows; leaves the closing bracket behind."""
        self.space()
        if self.text[self.at : self.at + 1] == ",":
            self.at += 1
            self.space()
        if self.at >= len(self.text) or self.text[self.at] == end:
            self.at += 1
            return False
        return True

    def sequence(self) -> list:
        self.at += 1
        out = []
        while self.next("]"):
            before = self.at
            out.append(self.node(r"[^,\[\]{}]*"))
            self.at += self.at == before
        return out

    def mapping(self) -> dict:
        self.at += 1
        out = {}
        while self.next("}"):
            before = self.at
            key = self.node(r"(?:[^,:\[\]{}]|:(?!\s|\Z))*")
            self.space()
            value = None
            if self.text[self.at : self.at + 1] == ":":
                self.at += 1
                value = self.node(r"[^,\[\]{}]*")
            out[key.text if isinstance(key, Text) else json.dumps(plain(key), ensure_ascii=False)] = value
            self.at += self.at == before
        return out


class _Block:
    def __init__(self, text: str) -> None:
        self.lines, self.at = text.replace("\r\n", "\n").split("\n"), 0

    def indent(self) -> int:
        """The next line's, comments and empty lines left behind; -1 at the end."""
        while self.at < len(self.lines):
            line = self.lines[self.at]
            if line.strip() and not line.lstrip().startswith("#"):
                return len(line) - len(line.lstrip(" \t"))
            self.at += 1
        return -1

    def content(self) -> str:
        return self.lines[self.at].strip()

    def dash(self) -> bool:
        return bool(re.match(r"-(?:[ \t]|\Z)", self.content()))

    def node(self, least: int) -> Node:
        indent = self.indent()
        if indent < least:
            return None
        if self.dash():
            return self.sequence(indent)
        if KEY.match(self.content()):
            return self.mapping(indent)
        rest = self.content()
        self.at += 1
        return self.value(rest, indent - 1)

    def mapping(self, indent: int, lenient: bool = False) -> dict:
        out = {}
        while (found := self.indent()) >= indent:
            line = self.content()
            m = None if found > indent or self.dash() else KEY.match(line)
            if not m and lenient and found == indent and ":" in line and not self.dash():
                m = re.match(r"([^:]*?)[ \t]*:", line)
            if m:
                self.at += 1
                key = _quoted(m[1]) if m[1][:1] in ("'", '"') and len(m[1]) > 1 else m[1]
                out[key] = self.value(line[m.end() :].strip(), indent, in_map=True)
            elif found == indent and not lenient:
                break
            else:
                self.at += 1
        return out

    def sequence(self, indent: int) -> list:
        out = []
        while self.indent() == indent and self.dash():
            line = self.content()
            rest = line[1:].lstrip()
            if not rest or rest.startswith("#"):
                self.at += 1
                out.append(self.node(indent + 1))
            elif KEY.match(rest) or re.match(r"-(?:[ \t]|\Z)", rest):
                self.lines[self.at] = " " * (indent + len(line) - len(rest)) + rest  # what follows the dash is a node of its own
                out.append(self.node(indent + 1))
            else:
                self.at += 1
                out.append(self.value(rest, indent))
        return out

    def value(self, rest: str, indent: int, in_map: bool = False) -> Node:
        if not rest or rest.startswith("#"):
            if in_map and self.indent() == indent and self.dash():
                return self.sequence(indent)
            return self.node(indent + 1)
        if m := SCALAR.match(rest):
            return self.scalar(rest[0], m[1] or m[3], int(m[2] or 0), indent)
        if rest[0] in "[{":
            while not self.closed(rest) and self.at < len(self.lines):
                rest += "\n" + self.lines[self.at].strip()
                self.at += 1
            return _Flow(rest).node("")
        if rest[0] in "\"'":
            while (end := _closing(rest)) < 0 and self.at < len(self.lines):
                rest += "\n" + self.lines[self.at].strip()
                self.at += 1
            if end > 0 and not _bare(" " + rest[end + 1 :]):
                return Text(_quoted(rest[: end + 1]), True)
        parts = [rest]
        while self.indent() > indent:
            parts.append(self.content())
            self.at += 1
        return _plain(" ".join(_bare(p) for p in parts).strip())

    @staticmethod
    def closed(text: str) -> bool:
        depth, i = 0, 0
        while i < len(text):
            if text[i] in "\"'" and (i == 0 or text[i - 1] in " \n[{,:"):
                end = _closing(text[i:])
                if end < 0:
                    return False
                i += end
            depth += (text[i] in "[{") - (text[i] in "]}")
            i += 1
            if depth == 0:
                return True
        return False

    def scalar(self, style: str, chomp: str, given: int, indent: int) -> Text:
        width, rows = indent + given if given and indent >= 0 else given, []
        while self.at < len(self.lines):
            line = self.lines[self.at]
            depth = len(line) - len(line.lstrip(" "))
            if line.strip():
                if depth <= indent:
                    break
                width = width or depth
                if depth < width:
                    break
            rows.append(line[width:] if line.strip() else line[width:] if width and len(line) > width else "")
            self.at += 1
        end = len(rows)
        while end and not rows[end - 1]:
            end -= 1
        text = "\n".join(rows[:end])
        if style == ">":
            text = re.sub(r"(?<![\n])\n(?=[^\n \t])", lambda m: " ", re.sub(r"(?m)^([ \t].*)\n", "\\1\0", text)).replace("\0", "\n")
            text = re.sub(r"\n(\n+)(?=[^\n \t])", r"\1", text)
        if chomp == "-" or not end:
            tail = "" if chomp != "+" else "\n" * (len(rows) - end)
        else:
            tail = "\n" * (len(rows) - end + 1) if chomp == "+" else "\n"
        return Text(text + tail, True)


def parsed(block: str) -> dict:
    """The top pairs of a block; nothing if it is a list or a text."""
    reader = _Block(block)
    first = reader.indent()
    return reader.mapping(max(0, first), lenient=True)


def plain(node: Node):
    """A node as JSON would hold it, all scalars texts."""
    if isinstance(node, dict):
        return {k: plain(v) for k, v in node.items()}
    if isinstance(node, list):
        return [plain(v) for v in node]
    return node.text if isinstance(node, Text) else None


def leaves(node: Node, path: str = "") -> list[tuple[str, str | None]]:
    """(path, text) of all scalars, empty maps and lists as ``{}`` and ``[]``."""
    if isinstance(node, dict) and node:
        return [x for k, v in node.items() for x in leaves(v, f"{path}.{k}" if path else k)]
    if isinstance(node, list) and node:
        return [x for i, v in enumerate(node) for x in leaves(v, f"{path}[{i}]")]
    return [(path, "{}" if isinstance(node, dict) else "[]" if isinstance(node, list) else plain(node))]


def written_text(text: Text, indent: int) -> str:
    """A scalar behind ``key:`` or a dash, lines of a literal text indented."""
    t = text.text
    if "\n" in t and not re.search(r"[\x00-\x08\x0b-\x1f\x85\u2028\u2029]|[ \t]\n|[ \t]\Z", t) and t.strip("\n"):
        body = t.rstrip("\n")
        chomp = {0: "-", 1: ""}.get(len(t) - len(body), "+")
        hint = "2" if body[0] in " \t\n" else ""
        extra = "\n" * max(0, len(t) - len(body) - 1)
        rows = [(" " * indent + row) if row else "" for row in body.split("\n")]
        return f" |{hint}{chomp}\n" + "\n".join(rows) + extra
    if re.search(r"[\x00-\x1f\x7f\x85\u2028\u2029]", t):
        return " " + json.dumps(t)
    if PLAIN.match(t) and t == t.strip() and not (AMBIGUOUS.match(t) and (text.quoted or not t)):
        return " " + t
    return " '" + t.replace("'", "''") + "'"


def written_key(key: str) -> str:
    return key if re.match(r"[^\W\d_][\w .-]*\Z", key) and not key.endswith(" ") and not AMBIGUOUS.match(key) else json.dumps(key, ensure_ascii=False)


def shown(node: Node, indent: int = 0) -> str:
    """What follows ``key:`` in a block map of this indent; keys in order, lists not indented."""
    pad = " " * indent
    if isinstance(node, dict) and node:
        inner = pad + "  "
        return "\n" + "\n".join(f"{inner}{written_key(k)}:{shown(node[k], indent + 2)}" for k in sorted(node))
    if isinstance(node, list) and node:
        return "\n" + "\n".join(pad + "-" + _item(v, indent) for v in node)
    if isinstance(node, dict | list):
        return " {}" if isinstance(node, dict) else " []"
    return " null" if node is None else written_text(node, indent + 2)


def _item(node: Node, indent: int) -> str:
    if isinstance(node, dict) and node:  # its first pair stands behind the dash
        return " " + shown(node, indent).removeprefix("\n").lstrip(" ")
    if isinstance(node, list) and node:
        return " " + shown(node, indent + 2).removeprefix("\n").lstrip(" ")
    return shown(node, indent)


def _entries(block: str | None) -> list[tuple[str, str | None, str | None]]:
    out = []
    for key, node in parsed(block or "").items():
        flat = node is None or (isinstance(node, Text) and "\n" not in node.text and not (node.quoted and AMBIGUOUS.match(node.text)))
        value = node.text if isinstance(node, Text) else None if node is None else json.dumps(plain(node), ensure_ascii=False)
        out.append((key, value, None if flat else shown(node)))
    return out


def _leaves(block: str | None) -> list[tuple[str, str | None]]:
    return leaves(parsed(block or "")) if parsed(block or "") else []


def _rows(*names: str) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in names]))


#: [{key, value, shown}] of a block's top pairs, keys once. The value of a map or list is its JSON; ``shown`` is what
#: a written block has behind the colon, null for a plain scalar.
entries = F.udf(_entries, _rows("key", "value", "shown"), useArrow=True)
#: [{path, value}] of all scalars in a block.
values = F.udf(_leaves, _rows("path", "value"), useArrow=True)
