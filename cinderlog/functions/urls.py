"""Request shaping: a request line or URL into path, query and shape fields."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def split_request(c: Column) -> tuple[Column, Column, Column]:
    """(method, uri, protocol version); method and version are null unless there are exactly three parts."""
    p = F.split(c, " ", -1)
    three = F.size(p) == 3
    return F.when(three, p[0]), F.when(three, p[1]).otherwise(p[0]), F.when(three, p[2])


def compile_pattern(pattern: str) -> tuple[str, list[str]]:
    """(anchored regex, names of its groups): ":name" takes one path segment, "*" the rest."""
    names, out = [], []
    for part in re.split(r"(:[A-Za-z_][A-Za-z0-9_]*|\*)", pattern):
        if part.startswith(":") and len(part) > 1:
            names.append(part[1:])
            out.append("([^/]+)")
        elif part == "*":
            out.append(".*")
        elif part:
            out.append(re.escape(part))
    return "^" + "".join(out) + r"\z", names


def shape(uri: Column, patterns: list[str] | None = None) -> dict[str, Column]:
    """path, query, pathshape, queryshape, shape (null where absent), pairs (array of key and value) and path_<name>."""
    bad = uri.rlike("%(?![0-9A-Fa-f]{2})|[\\x00-\\x20]") | (uri == "")
    no_fragment = F.regexp_replace(F.when(~bad, uri), "#.*$", "")
    no_host = F.regexp_replace(no_fragment, "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?]*", "")
    path = decode(F.regexp_replace(F.regexp_extract(no_host, r"^([^?]*)", 1), r"\+", "%2B"))
    path = F.when(no_host.isNotNull(), path)
    raw = F.nullif(F.regexp_extract(no_host, r"^[^?]*\?(.*)$", 1), F.lit(""))
    items = F.filter(F.split(raw, "&", -1), lambda x: x != "")
    pairs = F.transform(items, lambda x: F.struct(decode(F.regexp_extract(x, "^([^=]*)", 1)).alias("key"), decode(F.regexp_replace(x, "^[^=]*=?", "")).alias("value")))
    out: dict[str, Column] = {"path": path, "query": raw, "pairs": pairs}
    hit = None
    names: dict[str, Column] = {}
    before = F.lit(False)
    for p in patterns or []:
        regex, own = compile_pattern(p)
        here = ~before & F.coalesce(path.rlike(regex), F.lit(False))
        hit = F.when(here, F.lit(p)) if hit is None else hit.when(here, F.lit(p))
        for i, n in enumerate(own, 1):
            found = F.when(here, F.regexp_extract(path, regex, i))
            names[n] = F.coalesce(names[n], found) if n in names else found
        before = before | here
    out["pathshape"] = path if hit is None else F.coalesce(hit, path)
    out["queryshape"] = F.nullif(F.array_join(F.array_sort(F.transform(pairs, lambda x: F.concat(x["key"], F.lit("=?")))), "&"), F.lit(""))
    out["shape"] = F.concat(out["pathshape"], F.coalesce(F.concat(F.lit("?"), out["queryshape"]), F.lit("")))
    return out | {f"path_{n}": c for n, c in names.items()}


def query_values(pairs: Column, key: str) -> Column:
    """A key's values, sorted and joined by ", "; null if absent."""
    own = F.transform(F.filter(pairs, lambda x: x["key"] == key), lambda x: x["value"])
    return F.when(F.size(own) > 0, F.array_join(F.array_sort(own), ", "))
