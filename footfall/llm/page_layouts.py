"""Labelled pages to learn from: pages in many layouts, each block with what it is.

No table of labelled pages is given, so these are written by rule from a seed: semantic elements,
named ``div`` elements, tables, or next to nothing around the article; menus, notices, adverts,
forms, sidebars, comments and footers around and inside it. Words mean nothing, so what is learned
is the elements, their names, and the shape of the text.
"""

from __future__ import annotations

import random
from html import escape

_SYLLABLES = "an be chu da é fo gü hi ion ja ko lu ñe or pa qui ré sto tä ver wo ß 文 字 да не".split()
#: Names that elements of a kind are given, as plain text.
NAMES = {
    "content": "content main article post entry story text body page maincontent post-content entry-content article-body articleBody single hentry blog-post prose",
    "menu": "nav navbar menu navigation topnav main-menu navlinks links breadcrumb breadcrumbs tabs toc site-nav pagination pager",
    "header": "header masthead top topbar site-header branding brand logo banner-top page-header site-title",
    "footer": "footer foot bottom site-footer page-footer copyright colophon credits legal imprint",
    "aside": "sidebar aside side rail widget widgets related related-posts recommended more popular trending secondary teaser see-also tags",
    "notice": "notice cookie cookies cookie-banner cookie-notice consent gdpr alert warning message popup modal overlay disclaimer announcement banner-notice paywall privacy",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner adsbygoogle ad-slot commercial",
    "form": "form search search-form newsletter signup subscribe login contact register",
    "comments": "comment comments comment-list discussion responses replies reply disqus feedback user-comments reader-comments thread",
    "share": "share social sharing social-links follow toolbar buttons author-box byline meta post-meta entry-meta",
}
_TAGS = {
    "menu": ("nav", "div", "div", "ul", "menu"), "header": ("header", "header", "div"), "footer": ("footer", "footer", "div"), "aside": ("aside", "div", "section"),
    "notice": ("div", "p", "section", "noscript", "dialog", "aside"), "advert": ("div", "div", "aside", "section", "ins"),
    "form": ("form", "form", "div", "fieldset"), "comments": ("section", "div", "ol", "ul"), "share": ("div", "ul", "p"),
}
#: Elements that say what they are without a name.
_PLAIN = {"nav", "header", "footer", "aside", "form", "noscript", "menu", "dialog", "fieldset"}


class _Writer:
    def __init__(self, rng: random.Random, named: float):
        self.rng, self.named, self.out, self.truth = rng, named, [], []

    def words(self, low: int, high: int) -> str:
        rng = self.rng
        found = ["".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        if rng.random() < 0.2:
            found[rng.randrange(len(found))] = str(rng.randrange(10**5))
        if rng.random() < 0.05:
            found.insert(0, "©")
        text = " ".join(found)
        return text[:1].upper() + text[1:] + rng.choice([".", ".", ".", "", "!", "?", ":"])

    def say(self, tag: str, text: str, main: bool, link: bool = False) -> None:
        shown = escape(text, quote=False)
        if link:
            shown = f'<a href="/{self.rng.randrange(999)}">{shown}</a>'
        elif self.rng.random() < 0.15:
            shown = f"<b>{shown}</b>" if self.rng.random() < 0.6 else f"<b>{shown}<br>"
        self.out.append(f"<{tag}>{shown}" + (f"</{tag}>" if self.rng.random() < 0.9 or tag == "div" else ""))
        self.truth.append((" ".join(text.split()), main))

    def open(self, tag: str, kind: str | None) -> None:
        rng, attribute = self.rng, ""
        if kind and (tag not in _PLAIN and tag not in ("main", "article") or rng.random() < self.named):
            attribute = f' {rng.choice(["class", "class", "id"])}="{rng.choice(NAMES[kind].split())}"'
        self.out.append(f"<{tag}{attribute}>")

    def part(self, kind: str) -> None:
        """A part of the page that is not the article."""
        rng = self.rng
        tag = rng.choice(_TAGS[kind])
        self.open(tag, kind)
        item = "li" if tag in ("ul", "ol", "menu") else rng.choice(["p", "div", "span", "li"])
        if item == "li" and tag not in ("ul", "ol", "menu"):
            self.out.append("<ul>")
        many = {"menu": (3, 9), "aside": (1, 6), "comments": (2, 8), "footer": (1, 4), "form": (1, 4)}.get(kind, (1, 2))
        if kind in ("aside", "comments", "form") and item != "li" and rng.random() < 0.6:
            self.say(rng.choice(["h2", "h3", "h4"]), self.words(1, 5), False)
        if kind == "header" and rng.random() < 0.5:
            self.say("h1", self.words(1, 5), False)
        for _ in range(rng.randint(*many)):
            long = {"comments": (1, 80), "notice": (3, 50), "advert": (2, 40), "footer": (1, 30), "aside": (1, 30)}.get(kind, (1, 5))
            link = kind in ("menu", "aside", "share") and rng.random() < 0.85
            if item == "span":
                text = self.words(*long)
                self.out.append(f"<div><span>{escape(text)}</span></div>")
                self.truth.append((" ".join(text.split()), False))
            elif kind == "comments" and rng.random() < 0.3:
                self.out.append(f'<{rng.choice(["article", "div"])} class="comment">')
                nested = self.out[-1][1:].split()[0]
                self.say("p", self.words(*long), False)
                self.out.append(f"</{nested}>")
            else:
                self.say(item, self.words(*long), False, link)
        if item == "li" and tag not in ("ul", "ol", "menu"):
            self.out.append("</ul>")
        self.out.append(f"</{tag}>")

    def article(self, tag: str, inside: list[str]) -> None:
        rng = self.rng
        self.open(tag, "content" if tag not in ("body",) else None)
        nested = rng.random() < 0.3
        if nested:
            self.open("div", "content" if rng.random() < self.named else None)
        title = rng.random()
        if title < 0.15:
            self.out.append("<header>")
            self.say("h1", self.words(1, 12), True)
            self.out.append("</header>")
        elif title < 0.9:
            self.say(rng.choice(["h1", "h1", "h1", "h2"]), self.words(1, 12), True)
        blocks = rng.choice([1, 2, 4, 8, 14])
        spots = [rng.randrange(blocks + 1) for _ in inside]
        for number in range(blocks + 1):
            for kind, spot in zip(inside, spots):
                if spot == number:
                    self.part(kind)
            if number < blocks:
                self.piece()
        self.out.append("</div>" if nested else "")
        self.out.append(f"</{tag}>" if tag != "body" else "")

    def piece(self) -> None:
        rng, kind = self.rng, self.rng.random()
        length = rng.choice([(1, 2), (3, 12), (10, 60), (40, 160)])
        if kind < 0.72:
            self.say("p", self.words(*length), True, link=rng.random() < 0.03)
        elif kind < 0.8:
            self.say(rng.choice(["h2", "h3"]), self.words(1, 8), True)
        elif kind < 0.87:
            outer = rng.choice(["ul", "ol"])
            self.out.append(f"<{outer}>")
            for _ in range(rng.randint(1, 5)):
                self.say("li", self.words(1, 25), True, link=rng.random() < 0.1)
            self.out.append(f"</{outer}>")
        elif kind < 0.91:
            self.out.append("<blockquote>")
            self.say("p", self.words(*length), True)
            self.out.append("</blockquote>")
        elif kind < 0.94:
            self.say("pre", self.words(3, 40), True)
        elif kind < 0.97:
            self.out.append("<table><tr>")
            for _ in range(rng.randint(2, 4)):
                self.say("td", self.words(1, 6), True)
            self.out.append("</tr></table>")
        else:
            self.say("div", self.words(*length), True)


def labelled_page(rng: random.Random) -> tuple[str, list[tuple[str, bool]]]:
    """A page, and the text of its blocks in order with whether they belong to the article."""
    writer = _Writer(rng, named=rng.choice([0.2, 0.6, 1.0]))
    before = [k for k, chance in (("notice", 0.3), ("header", 0.5), ("menu", 0.8), ("form", 0.15), ("advert", 0.5), ("share", 0.1)) if rng.random() < chance]
    after = [k for k, chance in (("share", 0.2), ("aside", 0.4), ("comments", 0.4), ("form", 0.15), ("advert", 0.2), ("menu", 0.15), ("footer", 0.8), ("notice", 0.2)) if rng.random() < chance]
    inside = [k for k in ("advert", "aside", "form", "share", "comments", "notice") if rng.random() < 0.12]
    style = rng.choice(["article", "article", "article", "div", "div", "main", "section", "table", "body", "none"])
    if rng.random() < 0.3:
        rng.shuffle(before)
    writer.out.append("<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>var a='<p>';</script></head><body>")
    if style == "table":
        writer.out.append("<table><tr><td>")
    for kind in before:
        writer.part(kind)
    if style == "table":
        writer.out.append("</td>")
    if style == "none" and rng.random() < 0.5:
        pass
    else:
        writer.article({"table": "td", "none": "div"}.get(style, style), inside)
    if style == "table":
        writer.out.append("<td>")
    for kind in after:
        writer.part(kind)
    writer.out.append("</td></tr></table></body></html>" if style == "table" else "</body></html>")
    return "".join(writer.out), [(t, m) for t, m in writer.truth if t]


def labelled_pages(number: int, seed: int) -> list[tuple[str, list[tuple[str, bool]]]]:
    rng = random.Random(seed)
    return [labelled_page(rng) for _ in range(number)]
