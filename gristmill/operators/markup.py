"""Field harvesting from one HTML document: the row-level helper behind `extract`.

One pass over the tags with a stack of open elements; no tree is kept. Only the selector forms
the extraction rules need are understood: tag, `.class`, `#id`, descendant and `>`.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass
from html import unescape
from urllib.parse import urljoin

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW_TEXT = frozenset("script style textarea title".split())
# Start tags that end an open <p>, and elements that end an open sibling of the same name.
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
    "nav ol p pre section table ul".split()
)
_ENDS_SIBLING = frozenset("li dt dd option tr td th".split())
# Elements that an implied end does not cross.
_SCOPES = frozenset("html body table ul ol dl select td th article div section".split())

# A comment, a declaration, or a tag with its attribute text; quotes may hide a `>`. What is never
# closed runs to the end, which also keeps the search linear.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|"
    r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^>]*+)(>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_COMPOUND = re.compile(r"([.#]?)([\w-]+)")


@dataclass(frozen=True)
class Rule:
    """What to take from a container: `kind` is `text`, `joined` (text nodes joined by a space)
    or an attribute as `@name`. `many` keeps every match, otherwise the first one counts.
    `form` is applied to each value: `raw`, `nfkc` or `url` (resolved against the page URL)."""

    name: str
    selector: str
    kind: str = "text"
    many: bool = False
    form: str = "raw"


@dataclass(frozen=True)
class Spec:
    """One kind of page. An empty container stands for the whole document."""

    name: str
    container: str
    rules: tuple[Rule, ...]
    keep_fragment: bool = False


def compile_selector(selector: str) -> list[tuple[bool, list[tuple[str, str]]]]:
    """`h3 > a.x` as steps from right to left: (the next step must be the parent, tests)."""
    steps: list[tuple[bool, list[tuple[str, str]]]] = []
    for token in reversed(selector.split()):
        if token == ">":
            steps[-1] = (True, steps[-1][1])
        else:
            steps.append((False, _COMPOUND.findall(token)))
    return steps


def _search_of(rule: Rule) -> tuple[str, str, bool]:
    """Selector, attribute ('' for text) and whether all matches count."""
    return rule.selector, rule.kind[1:] if rule.kind[0] == "@" else "", rule.many


def _tag_of(steps: list) -> str | None:
    mark, word = steps[0][1][0]
    return None if mark else word


class _Element:
    """An open element; its attributes are read when a selector first asks for them."""

    __slots__ = ("tag", "source", "listeners", "boxes", "_attrs")

    def __init__(self, tag: str, source: str):
        self.tag = tag
        self.source = source
        self.listeners: list[list[str]] = []
        self.boxes: list[_Box] = []
        self._attrs: dict[str, str] | None = None

    @property
    def attrs(self) -> dict[str, str]:
        if self._attrs is None:
            self._attrs = {}
            for name, double, single, bare in _ATTRIBUTE.findall(self.source):
                value = double or single or bare
                self._attrs.setdefault(name.lower(), unescape(value) if "&" in value else value)
        return self._attrs

    def fits(self, tests: list[tuple[str, str]]) -> bool:
        for mark, word in tests:
            if mark == "":
                if self.tag != word:
                    return False
            elif word not in self.source:
                return False
            elif mark == ".":
                if word not in self.attrs.get("class", "").split():
                    return False
            elif self.attrs.get("id") != word:
                return False
        return True


class _Box:
    """One matched container and what was found in it."""

    def __init__(self, floor: int, start: int):
        self.floor = floor
        self.start = start
        self.end: int | None = None
        self.found: dict[tuple, list] = {}


def _selected(stack: list[_Element], floor: int, steps: list) -> bool:
    """Whether the top of `stack` matches; elements at or below index `floor` do not count."""
    position = len(stack) - 1
    if not stack[position].fits(steps[0][1]):
        return False
    parent_only = steps[0][0]
    for next_parent_only, tests in steps[1:]:
        position -= 1
        while position > floor and not stack[position].fits(tests):
            if parent_only:
                return False
            position -= 1
        if position <= floor:
            return False
        parent_only = next_parent_only
    return True


class Harvester:
    """Collects the containers of one spec from documents."""

    def __init__(self, spec: Spec):
        self._spec = spec
        self._container = compile_selector(spec.container) if spec.container else None
        # Rules that look for the same thing share one search. Searches are kept by the tag their
        # last step names, so that most start tags try none.
        finders = {_search_of(r): compile_selector(r.selector) for r in spec.rules}
        self._untagged = [(f, s) for f, s in finders.items() if _tag_of(s) is None]
        self._by_tag = {
            tag: [(f, s) for f, s in finders.items() if _tag_of(s) in (None, tag)]
            for tag in {_tag_of(s) for s in finders.values()} - {None}
        }

    def harvest(self, html: str, page_url: str) -> list[tuple[dict[str, list[str]], str]]:
        """`(values by rule name, source of the container)` per container, in document order."""
        self._stack: list[_Element] = []
        self._open_tags: Counter[str] = Counter()
        self._hearing: list[list[str]] = []
        self._boxes: list[_Box] = []
        self._open_boxes: list[_Box] = []
        if self._container is None:
            self._boxes.append(_Box(-1, 0))
            self._open_boxes.append(self._boxes[0])
        self._walk(html)
        while self._stack:
            self._pop(len(html))
        spec = self._spec
        return [
            (
                {rule.name: _values(rule, box, page_url) for rule in spec.rules},
                html[box.start : box.end] if spec.keep_fragment else "",
            )
            for box in self._boxes
        ]

    def _walk(self, html: str) -> None:
        at = 0
        while True:
            match = _MARKUP.search(html, at)
            text_end = match.start() if match else len(html)
            if self._hearing and text_end > at:
                text = html[at:text_end]
                if "&" in text:
                    text = unescape(text)
                for chunks in self._hearing:
                    chunks.append(text)
            if match is None:
                return
            at = match.end()
            tag = match[2]
            if tag is None or not match[4]:
                continue
            tag = tag.lower()
            if match[1]:
                self._close(tag, match.start(), at)
                continue
            self._open(tag, match[3], match.start())
            if tag in _RAW_TEXT:
                at = self._raw_text(html, tag, at)

    def _raw_text(self, html: str, tag: str, at: int) -> int:
        """Text of an element that holds no markup; returns the position of its end tag."""
        closing = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(html, at)
        end = closing.start() if closing else len(html)
        text = html[at:end]
        if tag in ("title", "textarea"):
            text = unescape(text)
        for chunks in self._hearing:
            chunks.append(text)
        return end

    def _open(self, tag: str, source: str, at: int) -> None:
        stack = self._stack
        if tag in _ENDS_PARAGRAPH:
            self._end_implied("p", at)
        if tag in _ENDS_SIBLING:
            self._end_implied(tag, at)
        element = _Element(tag, source)
        stack.append(element)
        self._open_tags[tag] += 1
        finders = self._by_tag.get(tag, self._untagged)
        for box in self._open_boxes if finders else ():
            for finder, steps in finders:
                _, attribute, many = finder
                if (many or finder not in box.found) and _selected(stack, box.floor, steps):
                    if attribute:
                        value = element.attrs.get(attribute)
                    else:
                        value = []
                        element.listeners.append(value)
                        self._hearing.append(value)
                    box.found.setdefault(finder, []).append(value)
        if self._container and _tag_of(self._container) in (None, tag) and _selected(
            stack, -1, self._container
        ):
            box = _Box(len(stack) - 1, at)
            self._boxes.append(box)
            self._open_boxes.append(box)
            element.boxes.append(box)
        if tag in _VOID:
            self._pop(at)

    def _close(self, tag: str, at: int, end: int) -> None:
        if self._open_tags[tag]:
            while self._stack[-1].tag != tag:
                self._pop(at)
            self._pop(end)

    def _end_implied(self, tag: str, at: int) -> None:
        if not self._open_tags[tag]:
            return
        for element in reversed(self._stack):
            if element.tag == tag:
                while self._stack[-1] is not element:
                    self._pop(at)
                self._pop(at)
                return
            if element.tag in _SCOPES:
                return

    def _pop(self, end: int) -> None:
        element = self._stack.pop()
        self._open_tags[element.tag] -= 1
        for chunks in element.listeners:
            # by identity: two listeners may hold equal text
            self._hearing = [other for other in self._hearing if other is not chunks]
        for box in element.boxes:
            box.end = end
            self._open_boxes.remove(box)


def _values(rule: Rule, box: _Box, page_url: str) -> list[str]:
    values = []
    for found in box.found.get(_search_of(rule), ()):
        if isinstance(found, list):
            pieces = (piece.strip() for piece in found)
            found = (" " if rule.kind == "joined" else "").join(piece for piece in pieces if piece)
        if found is None:
            continue
        if rule.form == "nfkc":
            found = unicodedata.normalize("NFKC", found).strip()
        elif rule.form == "url" and found:
            try:
                found = urljoin(page_url, found.strip())
            except ValueError:
                pass  # left as it stands; the URL check rejects it
        values.append(found)
    return values
