"""Rule patterns as column predicates and captures."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .naming import is_blank

MATCH_ALL = ".*"
_GROUP_OPEN = re.compile(r"\\.|\[(?:\\.|[^\]\\])+\]|\((?:\?<([A-Za-z_]\w*)>|\?'([A-Za-z_]\w*)'|(?!\?))")


def portable(pattern: str) -> str:
    """Named groups lose their names: captures are addressed by position."""
    return re.sub(r"\(\?(?:<[A-Za-z_]\w*>|'[A-Za-z_]\w*')", "(", pattern)


def groups(pattern: str) -> list[tuple[int, str]]:
    """(position, key) of every capture: whole match, unnamed by number, then named."""
    named, unnamed, position = [], [], 0
    for m in _GROUP_OPEN.finditer(pattern):
        if not m.group(0).startswith("("):
            continue
        position += 1
        key = m.group(1) or m.group(2)
        if key:
            named.append((position, key))
        else:
            unnamed.append((position, str(len(unnamed) + 1)))
    return [(0, "0"), *unnamed, *named]


def matches(pattern: str | None, c: Column) -> Column:
    """Unanchored search; no pattern means 'must be empty'; '.*' always holds."""
    if not pattern:
        return is_blank(c)
    if pattern == MATCH_ALL:
        return F.lit(True)
    return F.coalesce(c, F.lit("")).rlike(portable(pattern))


def captures(pattern: str | None, c: Column) -> list[tuple[str, Column]]:
    """Captured text per key; a group that did not take part gives ''."""
    if not pattern or pattern == MATCH_ALL:
        return []
    text = F.coalesce(c, F.lit(""))
    return [(key, F.regexp_extract(text, portable(pattern), i)) for i, key in groups(pattern)]


LEAST_LITERAL = 3  # shorter ones stand in too many texts to tell anything


def required_literal(pattern: str | None) -> str | None:
    """Longest text that whatever a pattern finds must hold, or none where that can't be told.

    Only plain characters outside of groups and classes count. Patterns with alternatives, flags, look-arounds
    or character codes say nothing.
    """
    if not pattern or "|" in pattern or re.search(r"\(\?(?!:|<[A-Za-z_]|'[A-Za-z_])", pattern):
        return None
    runs, depth, at = [""], 0, 0
    while at < len(pattern):
        c = pattern[at]
        at += 1
        if c == "\\":
            escaped = pattern[at:at + 1]
            at += 1
            if escaped and not escaped.isalnum():
                if depth == 0:
                    runs[-1] += escaped
            elif escaped and escaped in "dDwWsSbBAzZtnrfaehHvVRG":
                runs.append("")
            else:
                return None
        elif c == "[":
            end = re.compile(r"\^?(?:\\[^QE]|[^\[\]\\&])+\]").match(pattern, at)
            if not end:
                return None
            at = end.end()
            runs.append("")
        elif c in "()":
            depth += 1 if c == "(" else -1
            runs.append("")
        elif c in "*?{":
            # The character before may be missing.
            runs[-1] = runs[-1][:-1]
            runs.append("")
            if c == "{":
                at = pattern.find("}", at) + 1
                if at == 0:
                    return None
        elif c in "+.^$":
            runs.append("")
        elif depth == 0:
            runs[-1] += c
    longest = max(runs, key=len)
    return longest if len(longest) >= LEAST_LITERAL else None


def any_of(literals: list[str]) -> str:
    """One pattern that finds any of many texts: their tree of prefixes, cut where a text ends."""
    tree: dict = {}
    for text in sorted(set(literals), key=len):
        at = tree
        for c in text[:-1]:
            at = at.setdefault(c, {})
            if at is None:
                break  # holds a shorter one
        else:
            at[text[-1]] = None

    def written(node: dict | None) -> str:
        if node is None:
            return ""
        parts = [(c if c.isalnum() else "\\" + c) + written(below) for c, below in node.items()]
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    return written(tree)
