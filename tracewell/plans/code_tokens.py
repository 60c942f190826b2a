"""Strings, comments and brackets of code that isn't Python, and the functions that it defines, as intervals.

Small helpers of one file's text: mask() blanks out what isn't code, pairs() matches brackets by one running stack, and
function_ranges() gives each function the interval from its head to the end of its body.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from typing import NamedTuple

BRACES = ("js", "jsx", "ts", "tsx", "java", "scala", "r", "sh")
KEYWORDS = frozenset("if for while switch catch function return new throw else do try typeof await async in of with match case synchronized class interface enum super this yield def then fi done elif until select".split())
#: Where a slash begins a pattern and not a division.
BEFORE_PATTERN = re.compile(r"(?:^|[(,=:\[!&|?{};\n]|\breturn|\btypeof)[ \t]*$")

OPENING = {
    "c": re.compile(r"""//|/\*|\"\"\"|["'`/{}]"""),
    "r": re.compile(r"""#|["'`]"""),
    "sh": re.compile(r"""(?<![^\s;&|()])#|["']|\\."""),
}
ENDS = {q: re.compile(rf"(?:\\.|[^\\{q}])*{q}", re.S) for q in "\"'"}
IN_TEMPLATE = re.compile(r"\\.|`|\$\{", re.S)
PATTERN_END = re.compile(r"(?:\\.|\[(?:\\.|[^\]\\\n])*\]|[^/\\\n\[])+/[a-z]*")

NAMES = {
    "js": r"\bfunction\b\s*\*?\s*(\w+)\s*(?=\()|([\w$]+)\s*(?::[^=:;{}()]{1,80})?[=:]\s*(?:async\s+)?function\b\s*\w*\s*(?=\()|([\w$]+)\s*(?::[^=:;{}\n]{1,80})?=\s*(?:[\w.$]{1,80}\(\s*)?(?:async\b\s*)?(?=(?:<[^<>()]{0,80}>)?\(|[\w$]+\s*=>)|([\w$]+)\s*:\s*(?:async\b\s*)?(?=\(|[\w$]+\s*=>)|(?<![\w$.])([\w$]+)\s*(?:<[^<>()]{0,80}>)?(?=\()",
    "java": r"(?<![\w.])[\w.]+(?:<[^;(){}=]{0,80}>)?(?:\[\])*\s+(\w+)\s*(?=\()|\b(?:public|private|protected)\s+(\w+)\s*(?=\()",
    "scala": r"\bdef\s+(\w+)",
    "r": r"([\w.]+)\s*(?:<-|=)\s*function\s*(?=\()",
    "sh": r"(?m)\bfunction\s+([\w-]+)\s*(?:\(\s*\))?\s*(?=\{)|^\s*([\w-]+)\s*\(\s*\)\s*(?=\{)",
}
NAMES = {k: re.compile(v) for k, v in NAMES.items()}
SAME = {"ts": "js", "jsx": "js", "tsx": "js"}


class Range(NamedTuple):
    name: str
    begin: int
    end: int  # past its last character


def _skipped(text: str, i: int, kind: str, m: re.Match) -> int:
    """Where the comment or text that starts at i ends."""
    mark = m[0]
    if mark in ("//", "#"):
        end = text.find("\n", i)
        return len(text) if end < 0 else end
    if mark in ("/*", '"""'):
        end = text.find("*/" if mark == "/*" else mark, i + len(mark))
        return len(text) if end < 0 else end + len(mark)
    if mark == "`" and kind == "r":
        end = text.find("`", i + 1)
        return len(text) if end < 0 else end + 1
    if mark == "/":
        end = PATTERN_END.match(text, i + 1) if BEFORE_PATTERN.search(text, max(0, i - 200), i) else None
        return end.end() if end else -1
    if mark[0] == "\\":
        return -2
    end = ENDS[mark].match(text, i + 1)
    return end.end() if end else i + 1


def mask(text: str, extension: str) -> tuple[str, list[tuple[int, int]]]:
    """text with comments and the insides of strings as blanks, lines kept; and where strings (with their quotes) are, whole templates too."""
    kind = extension if extension in ("r", "sh") else "c"
    out, strings, i, code = [], [], 0, 0
    templates: list[tuple[int, int]] = []  # begin of a template that is interrupted by code, and the depth of braces in that code
    depth = 0
    blank = lambda s: re.sub(r"[^\n]", " ", s)
    find = OPENING[kind].search

    def template(start: int, at: int) -> int:
        """Reads a template from at on; returns where code goes on."""
        nonlocal depth
        while m := IN_TEMPLATE.search(text, at):
            at = m.end()
            if m[0] == "`":
                strings.append((start, at))
                return at
            if m[0] == "${":
                templates.append((start, depth))
                depth = 0
                return at
        strings.append((start, len(text)))
        return len(text)

    while m := find(text, i):
        begin, mark = m.start(), m[0]
        if mark == "{":
            depth, i = depth + 1, m.end()
            continue
        if mark == "}":
            if templates and depth == 0:
                start, depth = templates.pop()
                end = template(start, m.end())
            else:
                depth, i = max(0, depth - 1) if templates else depth - 1, m.end()
                continue
        elif mark == "`" and kind == "c":
            end = template(begin, m.end())
        else:
            end = _skipped(text, begin, kind, m)
            if end < 0:
                i = m.end()
                continue
            if mark[0] in "\"'":
                strings.append((begin, end))
        out += [text[code:begin], blank(text[begin:end])]
        i = code = end
    out.append(text[code:])
    return "".join(out), sorted(strings)


def pairs(code: str) -> dict[int, int]:
    """The place of the closing bracket of each opening one in masked code; brackets that stay open end with it."""
    found: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    closes = {")": "(", "]": "[", "}": "{"}
    for m in re.finditer(r"[(){}\[\]]", code):
        c, at = m[0], m.start()
        if c not in closes:
            stack.append((c, at))
        elif any(o == closes[c] for o, _ in stack[-50:]):  # else a stray one
            while stack:
                o, begin = stack.pop()
                found[begin] = at
                if o == closes[c]:
                    break
    for _, begin in stack:
        found[begin] = len(code)
    return found


AFTER_HEAD = {
    "js": re.compile(r"\s*(?::[^=;]{1,200}?(?=\s*(?:=>|\{)))?\s*(=>)?\s*"),
    "java": re.compile(r"\s*(?:throws\s+[\w.,\s]{1,400})?\s*"),
    "scala": re.compile(r"\s*(?::[^={\n]*)?\s*(=)?\s*"),
    "r": re.compile(r"\s*"),
    "sh": re.compile(r"\s*"),
}


WORD = re.compile(r"[\w$]+")


def _expression_end(code: str, i: int, closing: dict[int, int], ends: dict[int, int]) -> int:
    """The end of an expression without braces: a semicolon, a closing bracket, a comma, or a line after which nothing goes on. ends: of expressions that begin further on."""
    while i < len(code):
        c = code[i]
        if i in ends:
            i = ends[i]
            continue
        if c in "([{":
            i = closing.get(i, len(code))
        elif c in ";)]},":
            return i
        elif c == "\n" and not re.match(r"\s*[.?:+\-*/&|]", code[i + 1 : i + 80]) and not re.search(r"[=>+\-*/&|,(]\s*$", code[max(0, i - 80) : i]):
            return i
        i += 1
    return len(code)


def _head(code: str, closing: dict[int, int], language: str, m: re.Match) -> tuple[str, int, int, bool] | None:
    """Of a match of NAMES: the function's name, where it begins, where its body begins, and whether the body must be in braces; None of what is no function."""
    group = m.lastindex
    name = m[group] if group else ""
    if not name or name in KEYWORDS or language == "java" and re.match(r"(?:return|new|else|throw|case)\b", m[0]):
        return None
    at, arrow = m.end(), None
    if language == "js" and code[at : at + 1] == "<":
        at = code.find("(", at)
    if code[at : at + 1] == "(":
        at = closing.get(at, len(code)) + 1
    elif language == "js":  # one argument without parentheses
        at = WORD.match(code, at).end()
    elif language == "scala":
        while (more := re.match(r"\s*(?:\[[^\]]*\]\s*)?\(", code[at : at + 400])) is not None:
            at = closing.get(at + more.end() - 1, len(code)) + 1
    if (after := AFTER_HEAD[language].match(code, at)) is not None:
        at, arrow = after.end(), after.lastindex and after[after.lastindex]
    method = language == "js" and group == 5
    if method and arrow or language == "js" and group in (3, 4) and not arrow:
        return None  # calls in expressions; variables that aren't functions
    return name, m.start(group), at, method or language in ("java", "sh") or language == "js" and not arrow


def function_ranges(code: str, closing: dict[int, int], extension: str) -> list[Range]:
    """Functions of masked code, outer ones first."""
    language = SAME.get(extension, extension)
    heads: dict[int, tuple[str, int, int, bool]] = {}
    for m in NAMES[language].finditer(code):
        if head := _head(code, closing, language, m):
            heads.setdefault(head[1], head)
    found, ends = [], {}
    for name, begin, at, in_braces in sorted(heads.values(), key=lambda h: -h[2]):  # later ones first: an expression may end with another
        if code[at : at + 1] == "{":
            end = closing.get(at, len(code)) + 1
        elif in_braces:
            continue
        else:
            end = ends[at] = _expression_end(code, at, closing, ends)
        found.append(Range(name, begin, min(end, len(code))))
    return sorted(found, key=lambda r: (r.begin, -r.end))


class Innermost:
    """The function that a place of the code is in, of all around it the one that begins last."""

    def __init__(self, ranges: list[Range]):
        self.at: list[int] = []
        self.of: list[Range | None] = []
        open_: list[Range] = []

        def mark(at: int, r: Range | None) -> None:
            self.at.append(at), self.of.append(r)

        def close(until: float) -> None:
            while open_ and min(r.end for r in open_[-1:]) <= until:
                done = open_.pop()
                mark(done.end, open_[-1] if open_ and open_[-1].end > done.end else None)

        for r in ranges:
            close(r.begin)
            open_.append(r)
            mark(r.begin, r)
        close(float("inf"))

    def __call__(self, at: int) -> Range | None:
        k = bisect_right(self.at, at) - 1
        return self.of[k] if k >= 0 else None
