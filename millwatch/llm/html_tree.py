"""Pages as trees of elements and texts, read leniently and in one pass."""

from __future__ import annotations

import re

#: Fixed values of the HTML language.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "select", "object", "canvas", "math", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: An opening tag of the key closes an open element of the values, if one is open in the same container.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    **{t: ("p",) for t in "p address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()},
}
SCOPES = frozenset("html body article aside blockquote div dl fieldset footer form header main nav ol section table td th ul".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

TEXT = "#text"


def _unclosed(m: re.Match) -> bool:
    """Whether a comment or raw text goes on beyond what was matched."""
    if m[1]:
        return re.search(rf"</{m[1]}\s*>\Z", m[0][-64:], re.I) is None
    return m[0].startswith("<!--") and (len(m[0]) < 7 or not m[0].endswith("-->"))


class Tree:
    """Nodes in page order: parent, depth, tag, names (of class, id and role), text (of text nodes), link, block."""

    def __init__(self, html: str) -> None:
        self.parent, self.depth, self.tag = [-1], [0], ["#root"]
        self.names: list[str] = [""]
        self.text: list[str] = [""]
        self.link = [False]  # inside an anchor
        self.block = [0]  # texts of one block have one number
        stack, block, at = [0], 0, 0
        # behind the last ">" no tag can end, so nothing is searched there; but a comment, or raw text, may go on
        cut = html.rfind(">") + 1
        tail = html.find("<!--", cut)
        stop = len(html) if tail < 0 else tail
        m = None
        for m in _TOKEN.finditer(html, 0, cut):
            if m.start() > at:
                self._text(html[at : m.start()], stack, block)
            at = m.end()
            if m[1]:
                block += m[1].lower() not in INLINE
                continue
            name = m[3] or m[6]
            if not name:
                continue
            tag = name.lower()
            if m[2] or m[5]:
                for k in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[k]] == tag:
                        del stack[k:]
                        break
                    if tag in INLINE and self.tag[stack[k]] in SCOPES:
                        break
            else:
                for old in CLOSES.get(tag, ()):
                    for k in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[k]] == old:
                            del stack[k:]
                            break
                        if self.tag[stack[k]] in SCOPES:
                            break
                if tag not in VOID:
                    attributes = m[4] if m[3] else m[7]
                    names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if "=" in attributes else ""
                    new = self._node(stack[-1], tag, names.lower(), "", tag == "a" or self.link[stack[-1]], block)
                    if not attributes.endswith("/"):
                        stack.append(new)
            if tag not in INLINE:
                block += 1
        if m is not None and at == cut and _unclosed(m):
            return
        self._text(html[at:stop], stack, block)

    def _text(self, raw: str, stack: list[int], block: int) -> None:
        if raw:
            self._node(stack[-1], TEXT, "", raw, self.link[stack[-1]], block)

    def _node(self, parent: int, tag: str, names: str, text: str, link: bool, block: int) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.link.append(link)
        self.block.append(block)
        return len(self.tag) - 1
