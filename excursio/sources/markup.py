"""One page to its element list: the only per-row Python of the package.

Kept small on purpose: it numbers the elements of a page in document order and
says where their text lies. Everything that selects or reads elements is a Spark
expression over that list.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style iframe noembed noframes noscript xmp textarea title".split())
DECODED = frozenset(("textarea", "title"))
HEAD = frozenset("base link meta noscript script style template title".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p "
    "pre search section summary table ul".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# A start tag ends these open elements, looking no further up than the second set.
REPLACES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead"}, {"table"}),
    "a": ({"a"}, {"td", "th"}),
    "button": ({"button"}, {"td", "th"}),
}
SCOPE_END = frozenset("html table td th caption button object marquee applet template".split())
BLOCKS = CLOSES_P | SCOPE_END
# Elements in which a slash at the end of a tag closes it.
FOREIGN = frozenset(("svg", "math"))
FORMATTING = frozenset("a b big code em font i nobr s small span strike strong tt u".split())

# Possessive repeats: no page makes these patterns back-track.
_ATTRS = r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)"


def _token(raw: frozenset[str], unless: str) -> re.Pattern:
    """A text and the mark behind it: text, end tag, raw element with attributes and content, start tag with attributes."""
    names = "|".join(sorted(raw))
    firsts = "".join(sorted({c for name in raw for c in (name[0], name[0].upper())}))
    return re.compile(
        r"((?:[^<]++|<(?!/?[a-zA-Z!?]|/[^\n]|/\n[^>]*+>))*+)(?:<(?:!--(?:-?>|.*?(?:--!?>|\Z))"
        r"|[!?][^>]*+>"
        r"|/([a-zA-Z][^\s/>]*+)[^>]*+>"
        r"|/[^a-zA-Z][^>]*+>"
        # by its first letter most tags are seen not to be raw
        rf"|((?=[{firsts}])(?i:{names})(?=[\s/>])){_ATTRS}{unless}>"
        r"((?:[^<]++|<(?!/(?i:\3)(?=[\s/>])[^>]*+>))*+)(?:</[^>]*+>|\Z)"
        rf"|([a-zA-Z][^\s/>]*+){_ATTRS}>"
        # a tag that never ends swallows the rest of the page
        r"|.+)|\Z)",
        re.S,
    )


_TOKEN = _token(RAW, "")
# In a drawing or formula a slash closes any element, and a title holds elements.
_FOREIGN_TOKEN = _token(RAW - {"title"}, "(?<!/)")
_ATTR = re.compile(r"([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")
_REFERENCE = re.compile(
    r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[a-zA-Z][a-zA-Z0-9]*+(?:;|(?!=)))"
)

# What a start tag does besides opening an element; tags of none of these sets do nothing else.
_REPLACES, _CLOSES_P, _HEADING, _VOID, _OTHER = 1, 2, 4, 8, 16
_DOES: dict[str, int] = defaultdict(int)
for _mark, _names in (
    (_REPLACES, REPLACES), (_CLOSES_P, CLOSES_P), (_HEADING, HEADINGS), (_VOID, VOID),
    (_OTHER, ("html", "head", "body", "template", "image", *FOREIGN)),
):
    for _name in _names:
        _DOES[_name] |= _mark
_DOES = dict(_DOES)
_NO_ATTRS: dict[str, str] = {}


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    references = "&" in source
    for name, double, single, bare in _ATTR.findall(source):
        value = double or single or bare
        if references and "&" in value:
            value = _REFERENCE.sub(lambda m: unescape(m.group()), value)
        found.setdefault(name.lower(), value)
    return found


def _utf8_length(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode("utf-8", "replace"))


class PageTree:
    """Elements of one page in document order, as parallel lists.

    ``t0`` and ``t1`` are byte offsets into the UTF-8 text of the page, so a text
    is cut out without scanning what precedes it.
    """

    def __init__(self, html: str) -> None:
        self.tag: list[str] = []
        self.parent: list[int] = []
        self.attrs: list[dict[str, str]] = []
        self.t0: list[int] = []
        # Set where an element ends. There are no more elements than marks, html, head and body.
        self.size = [0] * (html.count("<") + 3)
        self.t1 = self.size.copy()
        self._stack: list[int] = []
        self._levels: dict[str, list[int]] = defaultdict(list)
        self._chunks: list[str] = []
        self._length = 0
        self._head = self._body = -1
        self._open("html", {})
        self._read(html.replace("\r\n", "\n").replace("\r", "\n") if "\r" in html else html)
        self._enter_body()
        self._pop_to(0)
        del self.size[len(self.tag):], self.t1[len(self.tag):]
        self.text = "".join(self._chunks).encode("utf-8", "replace")

    @property
    def depth(self) -> list[int]:
        found: list[int] = []
        for up in self.parent:
            found.append(found[up] + 1 if found else 0)
        return found

    @property
    def children(self) -> list[int]:
        """Number of child elements of each element."""
        found = [0] * len(self.tag)
        for up in self.parent[1:]:
            found[up] += 1
        return found

    @property
    def prev_tag(self) -> list[str | None]:
        """Tag of the element before each one under the same parent."""
        last: dict[int, str] = {}
        found = []
        for tag, up in zip(self.tag, self.parent):
            found.append(last.get(up))
            last[up] = tag
        return found

    # -- building ----------------------------------------------------------
    def _open(self, tag: str, attrs: dict[str, str]) -> int:
        stack = self._stack
        me = len(self.tag)
        self.tag.append(tag)
        self.parent.append(stack[-1] if stack else -1)
        self.attrs.append(attrs)
        self.t0.append(self._length)
        self._push(me)
        return me

    def _push(self, me: int) -> None:
        self._levels[self.tag[me]].append(len(self._stack))
        self._stack.append(me)

    def _pop_to(self, level: int) -> None:
        """Close every element from stack position ``level`` on."""
        last, length = len(self.tag) - 1, self._length
        for me in self._stack[level:]:
            self.size[me] = last - me
            self.t1[me] = length
            self._levels[self.tag[me]].pop()
        del self._stack[level:]

    def _say(self, text: str) -> None:
        self._chunks.append(text)
        self._length += _utf8_length(text)

    def _enter_head(self) -> None:
        if self._head < 0:
            self._head = self._open("head", {})
        elif self._head not in self._stack:
            self._push(self._head)

    def _enter_body(self) -> None:
        if self._body < 0:
            if self._head < 0:
                self._enter_head()
            self._pop_to(1)
            self._body = self._open("body", {})

    def _top(self, tags) -> int:
        return max((lv[-1] for t in tags if (lv := self._levels.get(t))), default=-1)

    def _find(self, tags, stops) -> int:
        """Stack position of the innermost of ``tags`` not hidden by ``stops``."""
        level = self._top(tags)
        above = len(self._stack) - level - 1
        if level < 0 or above == 0:
            return level
        return level if self._top(stops) <= level else -1

    # -- reading -----------------------------------------------------------
    def _characters(self, text: str) -> None:
        if self._body < 0:
            if not text.strip(" \t\n\f"):
                return
            self._enter_body()
        self._say(unescape(text) if "&" in text else text)

    def _read(self, html: str) -> None:
        """Everything between the first and the last character.

        What most tags do is written out here: a call for each step of each element would take
        longer than the step.
        """
        tags, parents, sizes, attrs, t0, t1 = self.tag, self.parent, self.size, self.attrs, self.t0, self.t1
        stack, levels, say = self._stack, self._levels, self._chunks.append
        svg, math, paragraphs, kinds = levels["svg"], levels["math"], levels["p"], _DOES.get
        at = hidden = length = 0
        foreign = begun = False
        while at >= 0:
            marks = (_FOREIGN_TOKEN if foreign else _TOKEN).finditer(html, at)
            at = -1
            for mark in marks:
                text, end_tag, raw, raw_inside, content, start_tag, inside = mark.groups()
                if hidden:
                    # Content of a template is no part of the page.
                    if (end_tag or start_tag or "").lower() == "template":
                        hidden += -1 if end_tag else 1
                        if not hidden and (svg or math):
                            foreign, at = True, mark.end()
                            break
                    continue
                if text:
                    if begun:
                        if "&" in text:
                            text = unescape(text)
                        say(text)
                        self._length = length = length + (len(text) if text.isascii() else _utf8_length(text))
                    else:
                        self._characters(text)
                        begun, length = self._body >= 0, self._length
                if end_tag:
                    tag = end_tag.lower()
                    if len(stack) > 2 and tags[stack[-1]] == tag:
                        me = stack.pop()
                        sizes[me] = len(tags) - me - 1
                        t1[me] = length
                        levels[tag].pop()
                    else:
                        self._end(tag)
                        begun = self._body >= 0
                elif start_tag:
                    tag = start_tag.lower()
                    does = kinds(tag, 0)
                    if does & _OTHER or foreign or not begun:
                        self._start_other(tag, inside, foreign)
                        begun, hidden = self._body >= 0, int(tag == "template")
                        if not foreign and not hidden and (svg or math):
                            foreign, at = True, mark.end()
                            break
                    else:
                        if does:
                            if does & _REPLACES:
                                self._replace(tag)
                            if does & _CLOSES_P:
                                if paragraphs:
                                    self._close_p()
                                if does & _HEADING and tags[stack[-1]] in HEADINGS:
                                    self._pop_to(len(stack) - 1)
                        me = len(tags)
                        tags.append(tag)
                        parents.append(stack[-1])
                        attrs.append(_attributes(inside) if inside else _NO_ATTRS)
                        t0.append(length)
                        if does & _VOID:
                            t1[me] = length
                        else:
                            levels[tag].append(len(stack))
                            stack.append(me)
                elif raw:
                    self._raw(raw.lower(), raw_inside, content)
                    length = self._length
                if foreign and (hidden or not svg and not math):
                    foreign, at = False, mark.end()
                    break

    def _raw(self, tag: str, inside: str, content: str) -> None:
        """An element whose content is text."""
        if self._body < 0:
            if tag in HEAD:
                self._enter_head()
            else:
                self._enter_body()
        me = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self._stack[-1])
        self.attrs.append(_attributes(inside) if inside else _NO_ATTRS)
        self.t0.append(self._length)
        self._say(unescape(content) if tag in DECODED and "&" in content else content)
        self.t1[me] = self._length

    def _start_other(self, tag: str, inside: str, foreign: bool) -> None:
        """A start tag before the body, inside a drawing or formula, or of a kind of its own."""
        self._start(tag, _attributes(inside) if inside else {})
        if tag == "template" or (foreign or tag in FOREIGN) and inside.endswith("/") and self.tag[self._stack[-1]] == tag:
            self._pop_to(len(self._stack) - 1)

    def _replace(self, tag: str) -> None:
        """Close the elements that a start tag ends."""
        replaced = REPLACES[tag]
        if any(map(self._levels.get, replaced[0])):
            level = self._find(*replaced)
            if level > 0:
                self._pop_to(level)

    def _close_p(self) -> None:
        level = self._find(("p",), SCOPE_END)
        if level > 0:
            self._pop_to(level)

    def _start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in ("html", "body"):
            if tag == "body":
                self._enter_body()
            known = self.attrs[0 if tag == "html" else self._body]
            for k, v in attrs.items():
                known.setdefault(k, v)
            return
        if tag == "head":
            if self._head < 0 and self._body < 0:
                self._head = self._open("head", attrs)
            return
        if self._body < 0:
            if tag in HEAD:
                self._enter_head()
            else:
                self._enter_body()
        if tag in REPLACES:
            self._replace(tag)
        if tag in CLOSES_P:
            if self._levels["p"]:
                self._close_p()
            if tag in HEADINGS and self.tag[self._stack[-1]] in HEADINGS:
                self._pop_to(len(self._stack) - 1)
        self._open("img" if tag == "image" else tag, attrs)
        if tag in VOID:
            self._pop_to(len(self._stack) - 1)

    def _end(self, tag: str) -> None:
        top = len(self._stack) - 1
        if top > 1 and self.tag[self._stack[top]] == tag:
            self._pop_to(top)
            return
        if tag in ("html", "body"):
            return
        if tag == "head":
            if self._body < 0 and self._head >= 0:
                self._pop_to(1)
            return
        if tag in ("p", "br"):
            if tag == "br" or self._find(("p",), SCOPE_END) < 0:
                self._start(tag, {})
            if tag == "br":
                return
        # An inline end tag does not reach out of the block it stands in.
        stops = BLOCKS if tag in FORMATTING else SCOPE_END - {tag}
        wanted = HEADINGS if tag in HEADINGS else (tag,)
        level = self._find(wanted, stops)
        if level > (0 if self._body < 0 else 1):
            self._pop_to(level)
