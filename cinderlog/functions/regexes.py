"""RE2-style patterns for Spark's (Java's) engine."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

_POSIX = {"alpha": "Alpha", "digit": "Digit", "alnum": "Alnum", "upper": "Upper", "lower": "Lower", "punct": "Punct", "space": "Space", "xdigit": "XDigit", "blank": "Blank", "cntrl": "Cntrl", "graph": "Graph", "print": "Print"}


class Pattern(NamedTuple):
    java: str
    names: list[str | None]  # of the groups, from 1

    def named(self) -> dict[str, int]:
        return {n: i for i, n in enumerate(self.names, 1) if n}


def translate(pattern: str) -> Pattern:
    """Named groups become positions, POSIX classes Java's, $ the very end (unless (?m) is set). Lookaround and back references, which RE2 lacks, are errors."""
    if re.search(r"(?<!\\)(?:\\\\)*\(\?(?:[=!>]|<[=!])", pattern) or re.search(r"(?<!\\)(?:\\\\)*\\[1-9]", pattern):
        raise ValueError("lookaround and back references are not supported")
    if pattern.count("(?P<") != len(re.findall(r"\(\?P<[A-Za-z_0-9]+>", pattern)):
        raise ValueError("malformed group name")
    out, names, i, in_class = [], [], 0, False
    multiline = re.match(r"\(\?[a-zA-Z]*m", pattern)
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            two = pattern[i : i + 2]
            out.append("\\z" if two == "\\z" else two)
            i += 2
        elif in_class:
            if m := re.match(r"\[:(\^?)([a-z]+):\]", pattern[i:]):
                if m[2] not in (*_POSIX, "word"):
                    raise ValueError(f"unknown class {m[0]}")
                out.append({"word": "\\w"}.get(m[2]) or ("\\P" if m[1] else "\\p") + f"{{{_POSIX[m[2]]}}}")
                i += len(m[0])
                continue
            in_class = c != "]"
            out.append("\\[" if c == "[" else "\\&" if c == "&" else c)
            i += 1
        elif c == "[":
            in_class = True
            m = re.match(r"\[\^?\]?", pattern[i:])
            out.append(m[0].replace("]", "\\]"))
            i += len(m[0])
        elif c == "(":
            if m := re.match(r"\(\?P?<([A-Za-z_0-9]+)>", pattern[i:]):
                names.append(m[1])
                out.append("(")
                i += len(m[0])
            else:
                if pattern[i + 1 : i + 2] != "?":
                    names.append(None)
                out.append(c)
                i += 1
        else:
            out.append("\\z" if c == "$" and not multiline else c)
            i += 1
    java = "".join(out)
    try:
        re.compile(java.replace("\\z", "\\Z").replace("\\p{", "[{").replace("\\P{", "[{") if "\\p" not in java.lower() else "x")
    except re.error as e:
        raise ValueError(f"bad pattern {pattern!r}: {e}") from e
    return Pattern(java, names)


def group(c: Column, p: Pattern, i: int) -> Column:
    """Group i of the first match; empty where the group or the whole did not match."""
    return F.regexp_extract(c, p.java, i)


def matched(c: Column, p: Pattern) -> Column:
    return c.rlike(p.java)
