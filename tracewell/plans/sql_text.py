"""Tokens of SQL text and their nesting in parentheses; comments are left out. Small helpers of the readers of definitions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

TOKEN = re.compile(
    r"""(?P<space>\s+|--[^\n]*|//[^\n]*|/\*.*?\*/)|(?P<string>'(?:[^']|'')*')|(?P<quoted>"[^"]*"|`[^`]*`)|(?P<number>\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)|(?P<word>[^\W\d][\w$]*|\$\d+)"""
    r"""|(?P<sign>:=|::|\|\||<=|>=|<>|!=|=>|->|\$\$|.)""",
    re.S,
)


class Token(NamedTuple):
    kind: str  # word, quoted, string, number or sign
    text: str  # words and signs in upper case

    def __str__(self) -> str:
        return self.text


class Name(NamedTuple):
    """A word or quoted identifier with its own case."""

    kind: str
    text: str
    own: str


Part = Name | Token | list


def tokens(sql: str) -> Iterator[Part]:
    for m in TOKEN.finditer(sql):
        kind, text = m.lastgroup, m[0]
        if kind == "word":
            yield Name(kind, text.upper(), text)
        elif kind == "quoted":
            yield Name(kind, "", text[1:-1])
        elif kind == "string":
            yield Token(kind, text[1:-1].replace("''", "'"))
        elif kind != "space":
            yield Token(kind, text)


def nested(flat: Iterator[Part]) -> list[Part]:
    """Parentheses become lists, those around nothing but other parentheses left out; ValueError if they don't match."""
    stack: list[list[Part]] = [[]]
    for t in flat:
        if t.kind == "sign" and t.text == "(":
            stack.append([])
        elif t.kind == "sign" and t.text == ")":
            if len(stack) == 1:
                raise ValueError("unbalanced parentheses")
            inner = stack.pop()
            stack[-1].append(inner[0] if len(inner) == 1 and isinstance(inner[0], list) else inner)
        else:
            stack[-1].append(t)
    if len(stack) > 1:
        raise ValueError("unbalanced parentheses")
    return stack[0]


def is_word(t: Part | None, *texts: str) -> bool:
    return t is not None and not isinstance(t, list) and t.kind == "word" and (not texts or t.text in texts)


def is_sign(t: Part | None, *texts: str) -> bool:
    return t is not None and not isinstance(t, list) and t.kind == "sign" and t.text in texts


def is_name(t: Part | None) -> bool:
    return t is not None and not isinstance(t, list) and t.kind in ("word", "quoted")


def is_query(t: Part | None) -> bool:
    """Whether a group is a query."""
    while isinstance(t, list) and t and isinstance(t[0], list):
        t = t[0]
    return isinstance(t, list) and bool(t) and is_word(t[0], "SELECT", "WITH")


def split(parts: list[Part], test) -> list[list[Part]]:
    """parts cut at those that pass the test."""
    found: list[list[Part]] = [[]]
    for t in parts:
        if test(t):
            found.append([])
        else:
            found[-1].append(t)
    return found


def commas(parts: list[Part]) -> list[list[Part]]:
    return split(parts, lambda t: is_sign(t, ","))


def chain(parts: list[Part], i: int) -> tuple[list[str], int]:
    """The names joined by dots from i on, and where they end."""
    names = [parts[i].own]
    i += 1
    while i + 1 < len(parts) and is_sign(parts[i], ".") and is_name(parts[i + 1]):
        names.append(parts[i + 1].own)
        i += 2
    return names, i
