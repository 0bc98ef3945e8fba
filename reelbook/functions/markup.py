"""One page of markup as nodes, the part of the work that runs in Python workers.

The class travels to the workers by value, so they need no copy of this package.
"""

from __future__ import annotations

import re
import sys
from html import entities
from html.parser import HTMLParser

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without content, elements whose text does not count as
# text of their parents, elements that keep runs of blanks, blanks of markup.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex "
    "keygen link menuitem meta nextid param source spacer track wbr".split()
)
HIDDEN_TEXT_TAGS = frozenset("rp rt script style template".split())
PREFORMATTED_TAGS = frozenset("pre textarea".split())
_SPECIAL = HIDDEN_TEXT_TAGS | PREFORMATTED_TAGS
MARKUP_BLANKS = " \n\t\x0c\r"

# Constructs in their usual spelling, which HTMLParser reads in one way only: text, a start tag
# with quoted attributes, an end tag, a named reference, a script with its text, a comment or document type.
_NAME = r"[a-zA-Z][a-zA-Z0-9]*+"
_ATTR = r'[a-zA-Z][-a-zA-Z0-9]*+="[^"<>&]*+"'
_RAW_TEXT = "iframe|noembed|noframes|noscript|plaintext|script|style|textarea|title|xmp"
_USUAL = re.compile(
    rf"([^<&]++)|<(?!(?i:{_RAW_TEXT})[ \n/>])({_NAME})((?:[ \n]++{_ATTR})*+)(/?)>|</(?!(?i:{_RAW_TEXT})>)({_NAME})>"
    rf"|&([a-zA-Z][a-zA-Z0-9]*+);|<(script)((?:[ \n]++{_ATTR})*+)>([^<]*+(?:<(?!/\s*(?i:script)|!)[^<]*+)*+)</script>"
    r"|<!((?i:doctype)[^>]*+|--(?!-?>)[^-]*+(?:-(?!-)[^-]*+)*+--)>"
)
_GIVEN = re.compile(r'([a-zA-Z][-a-zA-Z0-9]*+)="([^"]*+)"')


def _given(attrs: str) -> list[tuple[str, str]]:
    return [(name.lower(), value) for name, value in _GIVEN.findall(attrs)] if attrs else []


class NodeReader(HTMLParser):
    """Collects nodes of one page. End tags close back to the nearest open tag of
    their name; end tags without one are ignored; nothing else closes a tag."""

    def __init__(self, tags: frozenset[str] | None, attrs: frozenset[str] | None):
        super().__init__(convert_charrefs=False)
        self.tags, self.keep = tags, attrs
        self.nodes: list[dict] = []
        self.open: list[tuple[str, dict | None]] = []
        self.depth: dict[str, int] = {}
        self.hidden = self.preformatted = 0
        self.pending: list[str] = []
        self.pieces: list[bytes] = []
        self.size = 0

    def read(self, html: str) -> dict:
        self.feed(html[self._usual(html) :])
        self.close()
        self._flush()
        while self.open:
            self._pop()
        return {"text": b"".join(self.pieces), "nodes": self.nodes}

    def _usual(self, html: str) -> int:
        """Read the constructs up to the first unusual one, in a fraction of HTMLParser's time;
        return where that begins. Nearly all are tags, which are handled here without a call each."""
        at, match, pending = 0, _USUAL.match, self.pending
        opened, depth, special = self.open, self.depth, _SPECIAL
        while found := match(html, at):
            kind, at = found.lastindex, found.end()
            if kind == 1:
                pending.append(found[1])
            elif kind == 4:
                name, attrs, closed = found.group(2, 3, 4)
                tag = name.lower()
                if pending:
                    self._flush()
                node = None if self.tags is not None and tag not in self.tags else self._node(tag, _given(attrs))
                if not closed and tag not in VOID_TAGS:
                    opened.append((tag, node))
                    depth[tag] = depth.get(tag, 0) + 1
                    if tag in special:
                        self.hidden += tag in HIDDEN_TEXT_TAGS
                        self.preformatted += tag in PREFORMATTED_TAGS
            elif kind == 5:
                tag = found[5].lower()
                if pending:
                    self._flush()
                if opened and opened[-1][0] == tag and tag not in special:
                    node = opened.pop()[1]
                    depth[tag] -= 1
                    if node is not None:
                        node["last"], node["t1"] = len(self.nodes) - 1, self.size
                else:
                    self.handle_endtag(tag)
            elif kind == 6:
                self.handle_entityref(found[6])
            elif kind == 9:
                self.handle_starttag("script", _given(found[8]))
                self.handle_data(found[9])
                self.handle_endtag("script")
            else:
                self.handle_comment(found[10])
        return at

    def handle_starttag(self, tag, attrs, closed=False):
        self._flush()
        node = self._node(tag, attrs) if self.tags is None or tag in self.tags else None
        if not closed and tag not in VOID_TAGS:
            self.open.append((tag, node))
            self.depth[tag] = self.depth.get(tag, 0) + 1
            self.hidden += tag in HIDDEN_TEXT_TAGS
            self.preformatted += tag in PREFORMATTED_TAGS

    def _node(self, tag: str, attrs: list[tuple[str, str | None]]) -> dict:
        """A new node that begins here."""
        keep, size, index = self.keep, self.size, len(self.nodes)
        kept = {name: value or "" for name, value in attrs if keep is None or name in keep} if attrs else {}
        node = {"i": index, "last": index, "tag": tag, "attrs": list(kept.items()), "t0": size, "t1": size}
        self.nodes.append(node)
        return node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, closed=True)

    def handle_endtag(self, tag):
        self._flush()
        if self.depth.get(tag):
            while self._pop() != tag:
                pass

    def handle_data(self, data):
        self.pending.append(data)

    def handle_entityref(self, name):
        self.pending.append(entities.html5.get(f"{name};", f"&{name}"))

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[0] in "xX" else int(name)
            # Numbers of one byte mean the Windows character of that byte, if there is one.
            char = bytes([code]).decode("cp1252", "ignore") if code < 256 else ""
            char = char or chr(code)
            char.encode()
        except (ValueError, OverflowError):
            char = "\N{REPLACEMENT CHARACTER}"
        self.pending.append(char)

    def handle_comment(self, data):
        self._flush()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self._flush()
        if data.upper().startswith("CDATA["):
            self.pending.append(data[6:])
            self._flush(blanks=True)

    def _pop(self) -> str:
        tag, node = self.open.pop()
        self.depth[tag] -= 1
        self.hidden -= tag in HIDDEN_TEXT_TAGS
        self.preformatted -= tag in PREFORMATTED_TAGS
        if node is not None:
            node["last"], node["t1"] = len(self.nodes) - 1, self.size
        return tag

    def _flush(self, blanks=False):
        if self.pending:
            piece = "".join(self.pending)
            self.pending.clear()
            if not blanks and not self.preformatted and not piece.strip(MARKUP_BLANKS):
                piece = "\n" if "\n" in piece else " "
            if not self.hidden:
                self.pieces.append(piece.encode())
                self.size += len(self.pieces[-1])
