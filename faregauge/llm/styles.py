"""Which elements of a page its style sheets hide: selectors, cascade and inheritance.

Rules may set ``display`` and ``visibility``; of several the strongest counts, by
``!important``, inline style, specificity and order, as in a browser. Selectors may hold
tags, classes, ids, attributes, descendants and children; a rule with any other selector
hides nothing. Rules under a medium count if that is ``all`` or ``screen`` without
further conditions, so text that is hidden only at some sizes is kept.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->", re.S)
_STRINGS = re.compile(r"\"[^\"\n]*\"|'[^'\n]*'")
_MEDIUM = re.compile(r"(?:only\s+)?(?:all|screen)")
_DECLARATION = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+)[^;!]*(!\s*important)?", re.I)
_PART = re.compile(r"(\*|[A-Za-z_][\w-]*)|([.#])((?:[\w-]|[^\x00-\x7f])+)|\[\s*([\w-]+)\s*(?:=\s*[\"']?([^\"'\]]*)[\"']?\s*)?\]")


def on_screen(medium: str) -> bool:
    """Whether a list of media holds one that a screen meets without conditions."""
    return any(not m.strip() or _MEDIUM.fullmatch(m.strip().lower()) for m in medium.split(","))


def declared(body: str) -> list[tuple[str, str, bool]]:
    """(property, value, whether important) of what can hide, in order."""
    return [(name.lower(), value.lower(), bool(strong)) for name, value, strong in _DECLARATION.findall(body)]


def rules(sheet: str) -> Iterator[tuple[str, str]]:
    """(selectors, body) of the rules of a sheet that count on a screen."""
    sheet = _COMMENT.sub(" ", sheet)
    counted = [True]
    start = 0
    for mark in re.finditer(r"[{};]", sheet):
        head = sheet[start : mark.start()].strip()
        if mark.group() == ";" and not head.startswith("@"):
            continue  # the end of a declaration, which belongs to the body up to its brace
        start = mark.end()
        if mark.group() == "{":
            if head.startswith("@media"):
                counted.append(counted[-1] and on_screen(head[6:]))
            elif head.startswith("@"):
                counted.append(False)
            else:
                counted.append(head if counted[-1] and isinstance(counted[-1], bool) else False)
        elif mark.group() == "}" and len(counted) > 1:
            opened = counted.pop()
            if isinstance(opened, str):
                yield opened, head


def _compound(text: str) -> tuple | None:
    """(key, tests, specificity) of a selector without spaces, or None if it isn't understood."""
    at, tests, rank, key = 0, [], [0, 0, 0], "*"
    while at < len(text):
        part = _PART.match(text, at)
        if not part or (part[1] and at):
            return None
        tag, sign, name, attribute, value = part.groups()
        if tag:
            if tag != "*":
                rank[2] += 1
                tests.append(("tag", tag.lower(), None))
                key = tag.lower()
        elif sign:
            rank[0 if sign == "#" else 1] += 1
            tests.append(("id" if sign == "#" else "class", name, None))
            key = sign + name
        else:
            rank[1] += 1
            tests.append(("attribute", attribute.lower(), value))
        at = part.end()
    return (key, tests, rank) if text else None


def _meets(node, tests: list[tuple]) -> bool:
    for kind, name, value in tests:
        have = node.attributes
        if kind == "tag":
            met = node.tag == name
        elif kind == "id":
            met = have.get("id", "") == name
        elif kind == "class":
            met = name in have.get("class", "").split()
        else:
            met = name in have and (value is None or have[name] == value)
        if not met:
            return False
    return True


class Styles:
    """Rules of a page, in the order they were added.

    Every part of every selector has a bit. Walking down the tree, a node knows the bits
    that an ancestor or its parent has met, so nothing looks upwards again.
    """

    def __init__(self) -> None:
        self._parts: dict[str, list[tuple]] = defaultdict(list)
        self._bits = 0
        self._order = 0

    def add(self, sheet: str) -> None:
        for selectors, body in rules(sheet):
            found = declared(body)
            for selector in selectors.split(",") if found else ():
                self._order += 1
                self._add(selector, found)

    def _add(self, selector: str, found: list) -> None:
        tokens = re.sub(r"\s*>\s*", " > ", selector.strip()).split()
        if not tokens or tokens[0] == ">" or tokens[-1] == ">":
            return
        steps, child = [], False
        for token in tokens:
            if token == ">":
                child = True
                continue
            made = _compound(token)
            if made is None:
                return
            steps.append((child, *made))
            child = False
        rank = tuple(sum(step[3][i] for step in steps) for i in range(3))
        before = 0
        for at, (child, key, tests, _) in enumerate(steps):
            bit = 1 << self._bits
            self._bits += 1
            last = (found, rank, self._order) if at == len(steps) - 1 else None
            self._parts[key].append((bit, before, child, tests, last))
            before = bit

    def _met(self, node, above: int, parent: int, won: dict) -> int:
        """Bits that ``node`` meets; what its rules declare goes to ``won``."""
        bits = 0
        have = node.attributes
        keys = {"*", node.tag, *("." + c for c in have.get("class", "").split()), "#" + have.get("id", "")}
        for key in keys:
            for bit, before, child, tests, last in self._parts.get(key, ()):
                if (not before or (parent if child else above) & before) and _meets(node, tests):
                    bits |= bit
                    for name, value, strong in last[0] if last else ():
                        _offer(won, name, value, (strong, 0, *last[1:]))
        return bits

    def apply(self, root) -> None:
        """Set ``hidden`` and ``visible`` of all nodes below ``root``."""
        todo = [(root, 0, 0, True)]
        while todo:
            node, above, parent, visible = todo.pop()
            won: dict[str, tuple] = {}
            bits = self._met(node, above, parent, won) if self._parts else 0
            for at, (name, value, strong) in enumerate(declared(node.attributes.get("style", ""))):
                _offer(won, name, value, (strong, 1, (0, 0, 0), at))
            if "display" in won:
                node.hidden = node.never or won["display"][1] == "none"
            value = won["visibility"][1] if "visibility" in won else "inherit"
            node.visible = visible if value in ("inherit", "unset") else value not in ("hidden", "collapse")
            if not node.hidden:
                todo += [(c, above | bits, bits, node.visible) for c in node.children if not isinstance(c, str)]


def _offer(won: dict, name: str, value: str, rank: tuple) -> None:
    if name not in won or rank >= won[name][0]:
        won[name] = (rank, value)
