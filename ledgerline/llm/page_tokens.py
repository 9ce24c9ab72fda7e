"""Tokens of an HTML page: tags with the path of open elements, and blocks of text."""

from __future__ import annotations

import hashlib
import html
import re
from dataclasses import dataclass

# fixed values: element names of the HTML standard by how a page reader treats them
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSED_BY_BLOCK = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# fixed values: elements, roles and words of class and id names that mark what is not main text
ASIDE = frozenset("head nav header footer aside form menu dialog script style noscript template svg math canvas audio video object iframe button select textarea input title".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
ASIDE_WORDS = frozenset(
    "nav navbar navigation menu header footer sidebar aside ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies "
    "consent notice notices popup modal newsletter subscribe subscription share sharing social related recommended comment comments reply replies disqus "
    "breadcrumb breadcrumbs pagination pager login signup search widget toolbar skip".split())
MAIN = ("article", "main")
LANDMARKS = frozenset("body main article section div nav aside header footer form table ul td".split())
# a class or id word does not set apart an element that holds at least this share of a page's text; longest label kept as it is
MOST, LABEL = 0.8, 40

_TAG = re.compile(r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?P<void>/?)>|[!?][^>]*>|/[^>]*>|(?=[a-zA-Z/!?])[^<]*\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$|["'])""", re.I)
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    path: str
    aside: bool
    text: str


def _marks(attributes: str, name: str) -> tuple[str, bool, bool]:
    """What names the element in a path, whether its role or state sets it apart from the main text, and whether a class or
    id is a word for such elements."""
    label, aside, word = "", False, False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").strip()
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            aside = True
        elif key == "role":
            aside |= value.lower() in ASIDE_ROLES
        elif key in ("class", "id"):
            word |= any(v in ASIDE_WORDS for v in value.lower().split())
            label = label or "." + _label(re.sub(r"\d+", "#", value).replace("/", "_"))
    return name + label, aside, word and name not in ("html", "body", *MAIN)


def _label(value: str) -> str:
    return value if len(value) <= LABEL else f"{value[:LABEL]}~{hashlib.blake2b(value.encode(), digest_size=8).hexdigest()}"


def layout(tags: list[str]) -> int:
    """The same number for pages with the same landmarks in the outer levels."""
    outer = sorted({t for t in tags if t.count("/") <= 3 and re.split(r"[./]", t.rsplit("/", 1)[-1])[0] in LANDMARKS})
    return int.from_bytes(hashlib.blake2b("\n".join(outer).encode(), digest_size=8).digest(), signed=True)


def blocks(page: str) -> tuple[list[str], list[Block]]:
    """Paths of the elements in page order, and blocks of text with the path that holds them. An element is left open
    where the page leaves it open, until its parent ends; inline elements do not end a block. A class or id word sets an
    element apart unless it holds most of the page's text, and no article or main element with text lies outside it."""
    stack: list[tuple[str, str, tuple[bool, tuple[int, ...]]]] = []  # name, label, set apart here or above: surely, by which words
    tags: list[str] = []
    out: list[tuple[str, bool, tuple[int, ...], str]] = []
    marked = 0
    held: list[str] = []

    def path() -> str:
        return "/".join(label for name, label, _ in stack if name not in INLINE)

    def apart() -> tuple[bool, tuple[int, ...]]:
        return stack[-1][2] if stack else (False, ())

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(held)).strip()
        held.clear()
        if text:
            out.append((path(), *apart(), text))

    def close(upto: int) -> None:
        flush()
        del stack[upto:]

    at = 0
    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        held.append(html.unescape(page[at : m.start()]))
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if name in INLINE and all(s[0] in INLINE for s in stack[k:]):
                        if stack[k][2] != (stack[k - 1][2] if k else (False, ())):
                            flush()
                        del stack[k:]
                    elif name not in INLINE:
                        close(k)
                    break
            else:
                if name in ("p", "br"):
                    flush()
            continue
        label, sure, word = _marks(m["attributes"], name)
        above = apart()
        aside = (sure or name in ASIDE or above[0], (*above[1], marked) if word else above[1])
        marked += word
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name not in INLINE:
            flush()
            if name in CLOSED_BY_BLOCK:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        close(k)
                    if k < len(stack) and stack[k][0] not in INLINE:
                        break
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in SIBLINGS.get(name, ()):
                    close(k)
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table", "select"):
                    break
        elif aside != apart():
            flush()
        if name in VOID:
            if name == "br":
                flush()
            continue
        stack.append((name, label, aside))
        if name not in INLINE:
            tags.append(path())
    if at < len(page):
        held.append(html.unescape(page[at:]))
    flush()
    return tags, _settled(out)


def _settled(found: list[tuple[str, bool, tuple[int, ...], str]]) -> list[Block]:
    """Blocks, set apart by words only where these do not name most of the page."""
    inside: dict[int, int] = {}
    whole, mains, main_inside = 0, 0, {}
    for path, sure, words, text in found:
        if not sure:
            in_main = len(text) if any(p.split(".")[0] in MAIN for p in path.split("/")) else 0
            whole, mains = whole + len(text), mains + in_main
            for w in words:
                inside[w] = inside.get(w, 0) + len(text)
                main_inside[w] = main_inside.get(w, 0) + in_main
    void = {w for w, n in inside.items() if n >= MOST * whole and main_inside[w] == mains}
    return [Block(path, sure or any(w not in void for w in words), text) for path, sure, words, text in found]
