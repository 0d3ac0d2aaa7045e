"""Text templates compiled to column expressions.

The text holds assignments ``#set($name = value)``, with ``==`` and ``!=`` between
values, references ``$name`` and ``${name}``, quiet ones ``$!name``, and lookups
``$name.get("key")``, ``$name.key`` and ``$name["key"]`` in maps and structs. A
quiet reference prints nothing for a null; a plain one prints its own text. Two
values are equal if their texts are. A line that holds nothing but an assignment
leaves no line behind. In a text in double quotes references are filled in.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAME = r"[A-Za-z_]\w*"
_LOOKUP = rf"""(?:\.get\(\s*(?:"[^"]*"|'[^']*')\s*\)|\["[^"]*"\]|\['[^']*'\]|\.{_NAME}(?!\w|\())"""
REFERENCE = re.compile(rf"\$(?P<quiet>!?)(?:\{{(?P<braced>{_NAME}(?:{_LOOKUP})*)\}}|(?P<plain>{_NAME}(?:{_LOOKUP})*))")
KEY = re.compile(rf"""\.get\(\s*["']([^"']*)["']\s*\)|\[["']([^"']*)["']\]|\.({_NAME})""")
OPERAND = re.compile(rf"""\s*(?:(?P<text>"[^"]*"|'[^']*')|(?P<number>-?\d+(?:\.\d+)?)|(?P<word>true|false|null)\b"""
                     rf"""|(?P<ref>{REFERENCE.pattern.replace("?P<", "?P<r_")}))\s*""")
ASSIGN = re.compile(rf"#set\(\s*\$!?\{{?({_NAME})\}}?\s*=")


class TemplateError(ValueError):
    """The text is no template; the message names the place."""


def _lookup(ref: str, names: Mapping[str, Column]) -> Column:
    name = re.match(_NAME, ref)[0]
    value = names.get(name)
    if value is None:
        return F.lit(None).cast("string")
    for m in KEY.finditer(ref, len(name)):
        value = value.getItem(next(g for g in m.groups() if g is not None))
    return value


def _text(value: Column) -> Column:
    return value.cast("string")


def _operand(text: str, at: int, names: Mapping[str, Column]) -> tuple[Column, int]:
    m = OPERAND.match(text, at)
    if m is None:
        raise TemplateError(f"no value at {at}: {text[at:at + 30]!r}")
    if m["text"]:
        inner = m["text"][1:-1]
        value = compile_template(inner, names) if m["text"][0] == '"' else F.lit(inner)
    elif m["number"]:
        value = F.lit(m["number"])
    elif m["word"]:
        value = F.lit({"true": True, "false": False, "null": None}[m["word"]])
    else:
        value = _lookup(m["r_braced"] or m["r_plain"], names)
    return value, m.end()


def _value(text: str, at: int, names: Mapping[str, Column]) -> tuple[Column, int]:
    """A value, or the comparison of two, up to the closing bracket."""
    left, at = _operand(text, at, names)
    if text[at:at + 2] in ("==", "!="):
        equal = text[at:at + 2] == "=="
        right, at = _operand(text, at + 2, names)
        same = F.coalesce(_text(left) == _text(right), F.lit(False))
        left = same if equal else ~same
    if text[at:at + 1] != ")":
        raise TemplateError(f"')' expected at {at}: {text[at:at + 30]!r}")
    return left, at + 1


def compile_template(text: str, names: Mapping[str, Column]) -> Column:
    """The text that the template renders for a row; ``names`` are the columns that
    its references mean. The template is read once, on the driver; what it renders is
    one expression."""
    names, parts, at = dict(names), [], 0
    while at < len(text):
        ref, assign = REFERENCE.search(text, at), ASSIGN.search(text, at)
        found = min((m for m in (ref, assign) if m), key=lambda m: m.start(), default=None)
        if "#set" in text[at:found.start() if found else len(text)]:
            raise TemplateError(f"not an assignment: {text[text.index('#set', at):][:30]!r}")
        if found is None:
            parts.append(F.lit(text[at:]))
            break
        before = text[at:found.start()]
        if found is assign:
            value, at = _value(text, found.end(), names)
            names[found[1]] = value
            alone = re.search(r"(^|\n)[ \t]*$", text[:found.start()])
            if alone and (end := re.match(r"[ \t]*(\n|$)", text[at:])):
                at += end.end()
                before = before[:len(before) - len(re.search(r"[ \t]*$", before)[0])]
            parts.append(F.lit(before))
        else:
            none = F.lit("") if found["quiet"] else F.lit(found[0])
            parts += [F.lit(before), F.coalesce(_text(_lookup(found["braced"] or found["plain"], names)), none)]
            at = found.end()
    return F.concat(*parts) if parts else F.lit("")
