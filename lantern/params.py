"""SQL text at the level of tokens: parameters become named markers, whose values travel beside the text."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from lantern.errors import LanternError

_TOKEN = re.compile(
    r"(?P<quoted>'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.|\"\")*\"|`(?:[^`]|``)*`)|(?P<comment>--[^\n]*|/\*.*?\*/)"
    r"|%\((?P<named>\w+)\)s|(?P<positional>%s)|(?P<percent>%%)|(?P<word>[A-Za-z_]\w*)|(?P<other>.)",
    re.S,
)


def tokens(sql: str) -> Iterator[tuple[str, str, int]]:
    """(kind, text, position) of all of sql."""
    for m in _TOKEN.finditer(sql):
        yield m.lastgroup, m.group(), m.start()


def value(v: Any) -> Any:
    """A parameter as Spark takes it."""
    return str(v) if isinstance(v, uuid.UUID) else bytearray(v) if isinstance(v, bytes) else v


def bind(sql: str, params: Sequence | Mapping | None = None) -> tuple[str, dict[str, Any]]:
    """sql with :name markers, and their values. `%s` takes a sequence, `%(name)s` a mapping; a name may come again.

    Markers in quotes and comments are text. Too few, too many, or the wrong kind of parameters raise E4.
    """
    out, names, n = [], [], 0
    for kind, text, _ in tokens(sql):
        if kind == "named":
            names.append(text[2:-2])
            text = f":{text[2:-2]}"
        elif kind == "positional":
            text, n = f":_p{n}", n + 1
        out.append("%" if kind == "percent" else text)
    if names and n:
        raise LanternError("E4", "positional and named parameters are mixed")
    if names:
        if not isinstance(params, Mapping) or set(params) != set(names):
            raise LanternError("E4")
        args = {k: value(params[k]) for k in set(names)}
    else:
        if isinstance(params, Mapping) and params or isinstance(params, str) or len(params or ()) != n:
            raise LanternError("E4")
        args = {f"_p{i}": value(v) for i, v in enumerate(params or ())}
    return "".join(out), args


def split_at(sql: str, *keywords: str) -> list[str]:
    """sql cut before the first of each keyword outside parentheses, in this order; absent ones give empty text."""
    depth, cuts, todo = 0, [], [k.upper() for k in keywords]
    for kind, text, at in tokens(sql):
        if kind == "other":
            depth += (text == "(") - (text == ")")
        elif kind == "word" and depth == 0 and text.upper() in todo:
            k = todo.index(text.upper())
            cuts += [None] * k + [(at, len(text))]
            todo = todo[k + 1 :]
    cuts += [None] * len(todo)
    out, start = [], 0
    at = [c for c in cuts if c]
    bounds = [c[0] for c in at] + [len(sql)]
    out.append(sql[: bounds[0]])
    k = 0
    for c in cuts:
        if c is None:
            out.append("")
        else:
            start = c[0] + c[1]
            k += 1
            out.append(sql[start : bounds[k]])
    return [x.strip() for x in out]


def commas(sql: str) -> list[str]:
    """sql cut at commas outside parentheses."""
    depth, start, out = 0, 0, []
    for kind, text, at in tokens(sql):
        if kind == "other":
            depth += (text in "([") - (text in ")]")
            if text == "," and depth == 0:
                out.append(sql[start:at].strip())
                start = at + 1
    return [*out, sql[start:].strip()]


def _bare(pattern: str) -> str:
    return pattern[1:-1] if len(pattern) > 1 and pattern[0] == pattern[-1] == "/" else pattern


def adapted(sql: str, args: dict[str, Any]) -> tuple[str, dict[str, Any]]:
    """Patterns of REGEXP and RLIKE without their slashes, as text or as parameters, and quoted "a.b" as a path."""
    out, args, after, marker = [], dict(args), False, False
    for kind, text, _ in tokens(sql):
        if kind == "quoted" and text[0] == '"' and "." in text:
            text = ".".join(f"`{x}`" for x in text[1:-1].split("."))
        elif kind == "quoted" and text[0] == "'" and after:
            text = f"'{_bare(text[1:-1])}'"
        elif kind == "word" and marker and isinstance(args.get(text), str):
            args[f"{text}_pattern"] = _bare(args[text])  # the same name may stand elsewhere
            text += "_pattern"
        marker = after and text == ":"
        after = kind == "word" and text.upper() in ("REGEXP", "RLIKE") or after and (text.isspace() or marker)
        out.append(text)
    text = "".join(out)
    used = {m for m in re.findall(r":(\w+)", text)}
    return text, {k: v for k, v in args.items() if k in used}


def first_values(sql: str) -> str | None:
    """A grouped query with the first value of a group for columns that are neither keys nor in an aggregate; None if it
    isn't one."""
    head, items, rest = split_at(sql, "SELECT", "FROM")
    _, keys = split_at(rest, "GROUP")
    if head or not keys or split_at(rest, "UNION")[1]:
        return None
    keys = re.split(r"\b(?:HAVING|ORDER|LIMIT|OFFSET)\b", keys, maxsplit=1, flags=re.I)[0]
    plain = lambda x: x.strip().strip("`").split(".")[-1].strip("`").lower()
    named = {plain(k) for k in commas(re.sub(r"^BY\b", "", keys, flags=re.I))}
    out = []
    for item in commas(items):
        m = re.fullmatch(r"([\w.`]+)(?:\s+(?:AS\s+)?(\w+))?", item)
        own = m and not m[1][0].isdigit() and plain(m[1]) not in named and not re.fullmatch(r"NULL|TRUE|FALSE", m[1], re.I)
        out.append(f"first({m[1]}) AS `{m[2] or plain(m[1])}`" if own else item)
    return f"SELECT {', '.join(out)} FROM {rest}"
