"""Labelled pages for fitting: texts laid out as an article amid everything else that pages have.

Texts come from a sample of the pages at hand; layouts are drawn from a small grammar of page parts, each in
the elements and under the names that sites give them. Every block is known to be the article's or not.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

# Names that sites give to the parts of a page, and what stands in these.
ARTICLE_NAMES = "article post entry story content body text main page single prose blogpost news detail".split()
PART_NAMES = {
    "menu": "nav menu navbar navigation topnav mainmenu links tabs breadcrumb breadcrumbs pagination pager toc".split(),
    "header": "header masthead banner top branding site title logo tagline hero".split(),
    "footer": "footer bottom copyright legal colophon imprint foot sitemap credits".split(),
    "sidebar": "sidebar side aside widget rail secondary archive tagcloud recent popular trending blogroll".split(),
    "notice": "notice cookie cookies consent gdpr alert message popup modal overlay warning banner privacy disclaimer announcement".split(),
    "advert": "ad ads advert advertisement sponsored sponsor promo promotion banner dfp adslot partner affiliate".split(),
    "form": "form newsletter subscribe signup login search contact register input field".split(),
    "share": "share social sharing follow tools buttons meta tags byline related recommended more".split(),
    "comments": "comments comment reply replies discussion responses disqus thread commentlist respond reader".split(),
}
PART_TAGS = {
    "menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "notice": "section", "advert": "aside", "form": "form",
    "share": "div", "comments": "section",
}
PHRASES = {
    "menu": "Home|About us|Contact|News|Sports|Archive|Products|Next page|Previous|Categories|Login",
    "header": "The Daily Page|Welcome to our site|Your source of news|Skip to content|Search",
    "footer": "© 2021 All rights reserved.|Copyright 2019 Example Media|Privacy policy|Terms of use|Powered by software|Imprint|Back to top",
    "sidebar": "Recent posts|Popular articles|Categories|Tags|Most read|About the author|Archives|You may also like",
    "notice": "We use cookies to give you the best experience.|Accept all|Please enable JavaScript.|By using this site you agree to our terms."
    "|This site is for information only.|Your browser is out of date.",
    "advert": "Advertisement|Sponsored|Buy now and save 20%|Special offer, today only!|Click here|Limited time offer",
    "form": "Subscribe to our newsletter|Your e-mail address|Sign up|Search|Submit|User name|Password|Remember me|Required fields are marked *",
    "share": "Share this|Tweet|Follow us|Read more|Print|E-mail this|Related articles|Tags: news, world|Like 12",
    "comments": "3 comments|Leave a reply|Reply|Great post, thanks!|says: I don't agree with this at all.|Anonymous wrote:|Report|Load more",
}
NOISE = "wrapper container row col inner outer clearfix box wrap grid left right section block module flex grid-item has-sidebar with-header".split()
WORDS = "the of a to and in that it is was for on with as by at from this be are or an which not have had but they one all".split()


class Layouts:
    """Lays texts out. ``texts``: those of articles; ``bits``: short texts of everything else."""

    def __init__(self, texts: list[str], bits: list[str], seed: int = 0):
        self.rng = random.Random(seed)
        self.texts = texts or [self._words(30) for _ in range(40)]
        self.bits = bits or [self._words(3) for _ in range(40)]

    def _words(self, n: int) -> str:
        return " ".join(self.rng.choice(WORDS) for _ in range(n)).capitalize() + "."

    def _named(self, tag: str, names: list[str]) -> str:
        """A start tag, mostly with some names."""
        rng, attributes = self.rng, ""
        if names and rng.random() < 0.9:
            name = rng.choice(names)
            if rng.random() < 0.5:
                name = rng.choice(("-", "_", " ")).join([name, rng.choice(NOISE + names)])
            attributes = f' {rng.choice(("class", "class", "id", "class"))}="{name}"'
        return f"<{tag}{attributes}>"

    def _part(self, kind: str) -> Iterator[tuple[str, bool | None]]:
        """Markup and texts of one part; texts come with False, markup with None."""
        rng = self.rng
        tag = PART_TAGS[kind] if rng.random() < 0.5 else "div"
        yield self._named(tag, PART_NAMES[kind] if tag == "div" or rng.random() < 0.5 else []), None
        phrases, listed = PHRASES[kind].split("|"), rng.random() < (0.8 if kind in ("menu", "share") else 0.4)
        if listed:
            yield "<ul>", None
        for _ in range(rng.randint(2, 8) if listed else rng.randint(1, 3)):
            long = kind in ("comments", "notice", "advert", "footer", "sidebar") and rng.random() < 0.4
            text = rng.choice(self.texts) if long else rng.choice(phrases) if rng.random() < 0.5 else rng.choice(self.bits)
            element = "li" if listed else rng.choice(("div", "p", "p", "h3", "label" if kind == "form" else "div"))
            linked = kind in ("menu", "share") or not long and rng.random() < 0.4
            yield f"<{element}>" if element != "label" else "<div><label>", None
            yield (f'<a href="/{rng.randrange(99)}">', None) if linked else ("", None)
            yield text, False
            yield ("</a>" if linked else "") + (f"</{element}>" if element != "label" else "</label></div>"), None
        yield ("</ul>" if listed else "") + f"</{tag}>", None

    def _article(self) -> Iterator[tuple[str, bool | None]]:
        rng = self.rng
        tag = rng.choice(("article", "article", "main", "div", "div", "div", "section", "td"))
        before = "<table><tr>" if tag == "td" else ""
        yield before + self._named(tag, ARTICLE_NAMES if tag in ("div", "section", "td") or rng.random() < 0.5 else []), None
        yield "<h1>", None
        yield rng.choice(self.bits + [t[:60] for t in self.texts[:50]]), True
        yield "</h1>", None
        if rng.random() < 0.3:
            yield from self._part("share")
        for _ in range(rng.choice((0, 1, 2, 4, 8, 12))):
            kind = rng.random()
            element = "p" if kind < 0.75 else rng.choice(("h2", "blockquote", "pre", "li", "div", "figcaption"))
            yield f"<{element}>", None
            marked = rng.random()
            text = rng.choice(self.bits) if element == "h2" or rng.random() < 0.15 else rng.choice(self.texts)
            yield ("<b>" if marked < 0.1 else '<a href="/x">' if marked < 0.14 else ""), None
            yield text, True
            yield ("</a>" if 0.1 <= marked < 0.14 else "") + ("<br>" if marked > 0.9 else f"</{element}>"), None
            if kind > 0.85:
                yield from self._part(rng.choice(("advert", "advert", "share", "sidebar", "form")))
        for kind in ("share", "form", "comments", "advert"):
            if rng.random() < 0.12:
                yield from self._part(kind)
        yield f"</{tag}>" + ("</tr></table>" if tag == "td" else ""), None

    def page(self) -> tuple[str, list[tuple[str, bool]]]:
        """A page, and its blocks' texts with whether they are the article's."""
        rng, items = self.rng, []
        wraps = rng.randint(0, 3)
        items += [(self._named("div", NOISE + ["content", "main", "page", "site"]), None) for _ in range(wraps)]
        for kind, chance in (("notice", 0.3), ("header", 0.6), ("menu", 0.8), ("notice", 0.15), ("sidebar", 0.2), ("advert", 0.4), ("form", 0.1)):
            if rng.random() < chance:
                items += self._part(kind)
        if rng.random() < 0.95:
            items += self._article()
        for kind, chance in (("share", 0.3), ("form", 0.2), ("comments", 0.4), ("sidebar", 0.4), ("advert", 0.3), ("menu", 0.1), ("footer", 0.8)):
            if rng.random() < chance:
                items += self._part(kind)
        items.append(("</div>" * wraps, None))
        body = "".join(x if main is None else html.escape(x) for x, main in items)
        found = [(" ".join(x.split()), main) for x, main in items if main is not None]
        return f"<html><head><title>x</title></head><body>{body}</body></html>", [f for f in found if f[0]]
