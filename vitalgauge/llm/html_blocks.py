"""The leaf blocks of an HTML page: stretches of text that no block-level tag interrupts, with what stands around them.

Follows what browsers do as far as it decides where blocks begin and what they stand in: comments, quoted attributes, raw
text, implied ends of paragraphs, list items and cells, stray and missing end tags. One pass, no recursion.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

#: Elements whose content is no text of the page. The text of these runs to their end tag, whatever is in between.
RAW = frozenset("script style template iframe noembed noframes xmp title textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand on lines of their own.
BLOCKS = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary"
    " table tbody td tfoot th thead tr ul".split()
)
#: Elements that end an open paragraph; all blocks but those of tables, lists' items and the page.
_END_PARAGRAPH = BLOCKS - frozenset("body caption col colgroup head html legend optgroup option tbody td tfoot th thead tr".split())
#: By element: the open elements it ends, and those beyond which it ends none.
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    **dict.fromkeys(("dd", "dt"), (frozenset(["dd", "dt"]), frozenset(["dl"]))),
    **dict.fromkeys(("option", "optgroup"), (frozenset(["option"]), frozenset(["select"]))),
    **dict.fromkeys(("td", "th"), (frozenset(["td", "th"]), frozenset(["table"]))),
    "tr": (frozenset(["td", "th", "tr"]), frozenset(["table"])),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (frozenset(["td", "th", "tr", "tbody", "thead", "tfoot", "caption"]), frozenset(["table"]))),
    "body": (frozenset(["head"]), frozenset(["html"])),
}
_MARKUP = re.compile(r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|(?:[!?]|/(?![a-zA-Z]))[^>]*>?|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)(>?))", re.S)
_NAMES = re.compile(r"(?<![\w-])(class|id|role|aria-label|itemprop|rel)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?<![\w-])(?:hidden(?!\s*=\s*[\"']?until)(?=[\s=>/]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=[^>]*display\s*:\s*none)", re.I)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Block(NamedTuple):
    """A leaf block: its text with white space turned into single spaces, how much of it is links, and features of its place."""

    text: str
    link_characters: int
    tag: str
    place: frozenset[str]


class _Element:
    __slots__ = ("tag", "place")

    def __init__(self, tag: str, attributes: str, above: frozenset[str]):
        self.tag = tag
        names = {f"in={tag}"}
        if attributes and tag not in ("html", "body"):
            for found in _NAMES.findall(attributes):
                names.update(f"name={part.lower()}" for part in _NAME_PARTS.findall(found[1] or found[2] or found[3]))
            if _HIDDEN.search(attributes):
                names.add("hidden")
        self.place = above if names <= above else above | names


def leaf_blocks(page: str) -> list[Block]:
    """The blocks of a page that have text, in page order."""
    root = _Element("html", "", frozenset())
    stack, out, parts, at, size, links, link_size = [root], [], [], 0, len(page), 0, 0
    opened: Counter[str] = Counter()

    def flush() -> None:
        nonlocal parts, link_size
        text = " ".join("".join(parts).split())
        if text:
            element = next((e for e in reversed(stack) if e.tag in BLOCKS), root)
            out.append(Block(text, link_size, element.tag, stack[-1].place))
        parts, link_size = [], 0

    def add(text: str) -> None:
        nonlocal link_size
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                link_size += len("".join(text.split()))

    def pop_to(k: int) -> None:
        nonlocal links
        for element in stack[k:]:
            opened[element.tag] -= 1
        links = opened["a"]
        del stack[k:]

    def end_open(ended: frozenset[str], beyond: frozenset[str]) -> None:
        """Close the outermost of the elements that a new one ends."""
        k, last = len(stack) - 1, 0
        while k and stack[k].tag not in beyond:
            if stack[k].tag in ended:
                last = k
            k -= 1
        if last:
            pop_to(last)

    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            add(page[at:])
            break
        add(page[at:begin])
        found = _MARKUP.match(page, begin)
        if found is None:
            parts.append("<")
            at = begin + 1
            continue
        at = found.end()
        ending, tag, attributes, closed = found.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if not closed:  # a quote that nothing closes
            until = page.find(">", at)
            at = size if until < 0 else until + 1
        if ending:
            if tag in BLOCKS:
                if opened[tag] or tag == "p":
                    flush()
                if opened[tag]:
                    pop_to(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            else:
                k = len(stack) - 1
                while k and stack[k].tag != tag and stack[k].tag not in BLOCKS:
                    k -= 1
                if k and stack[k].tag == tag:
                    pop_to(k)
            continue
        if tag in RAW:
            if not attributes.endswith("/") or tag != "title":
                ended = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                at = ended.start() if ended else size
            continue
        if tag == "br":
            parts.append("\n")
            continue
        if tag in BLOCKS:
            flush()
            if tag in _END_PARAGRAPH:
                end_open(frozenset(["p"]), _PARAGRAPH_SCOPE)
            if tag in _ENDS:
                end_open(*_ENDS[tag])
        if tag in VOID or tag == "html":
            continue
        stack.append(_Element(tag, attributes, stack[-1].place))
        opened[tag] += 1
        links = opened["a"]
    flush()
    return out


_PARAGRAPH_SCOPE = BLOCKS - frozenset(["p"])
