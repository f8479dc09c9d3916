"""Invented page layouts, to learn from: given texts in pages whose main text is known."""

from __future__ import annotations

import html

import numpy as np

# In front of a text: it belongs to the main text. Not a character of texts.
MARK = ""

# What main texts and the other parts of pages are usually called.
MAIN_TAGS = ("article", "main", "div", "section", "article", "div")
MAIN_NAMES = (
    "content post entry story article main body text page-content article-body post-content entry-content"
    " main-content article-text story-body blog-post single hentry"
).split()
PARTS = {
    "menu": (("nav", "div", "ul", "menu"), "nav menu navbar navigation topnav main-menu breadcrumb pagination tabs links"),
    "header": (("header", "div"), "header masthead banner topbar brand logo site-title branding"),
    "footer": (("footer", "div", "section"), "footer copyright colophon bottom legal site-info"),
    "sidebar": (("aside", "div", "section"), "sidebar side widget rail related recommended popular trending tags recent archive"),
    "notice": (("div", "section", "p", "aside"), "notice cookie consent gdpr alert warning message modal popup overlay banner disclaimer"),
    "advert": (("div", "aside", "section", "ins"), "ad ads advert advertisement sponsor sponsored promo promotion adsense banner"),
    "form": (("form", "div", "section"), "form search login signup subscribe newsletter contact register"),
    "comments": (("section", "div", "ol", "aside"), "comments comment discussion replies reply respond responses thread feedback"),
    "share": (("div", "ul", "section"), "share social follow sharing"),
}
_PREFIXES = ("", "", "", "site-", "js-", "c-", "top-", "widget_", "block-")
_SUFFIXES = ("", "", "", "-wrapper", "-container", "-box", "-list", "-1", "-area", "-inner", "Section", "s")
_PHRASES = (
    "Home", "About us", "Contact", "Accept all cookies", "We use cookies to improve this site.", "Subscribe",
    "Sign up for our newsletter", "Reply", "Log in", "Advertisement", "Sponsored", "All rights reserved.",
    "© 2024", "Share this", "Read more", "Next", "Previous", "Search", "Related articles", "Leave a comment",
    "Privacy policy", "Terms", "Please enable JavaScript.", "Skip to content", "Most popular",
)


class Layouts:
    def __init__(self, texts: list[str], rng: np.random.Generator):
        self.texts, self.rng = texts or list(_PHRASES), rng

    def page(self) -> str:
        chance = self.chance
        front = [self.part(k) for k in ("header", "menu", "notice", "advert", "form") if chance(0.5)]
        behind = [self.part(k) for k in ("sidebar", "comments", "share", "advert", "notice", "form") if chance(0.35)]
        last = [self.part("footer")] if chance(0.8) else []
        if chance(0.3):
            behind, front = behind[1:], front + behind[:1]
        if chance(0.15):
            behind = last = []
        if chance(0.1):
            front = []
        body = "".join([*front, self.main(), *behind, *last])
        for _ in range(int(self.rng.integers(0, 3))):
            body = self.wrap(("div",), ("page", "wrapper", "container", "site", "layout", "root", "row", "col", ""), body)
        return f"<html><head><title>{self.text(4)}</title></head><body>{body}</body></html>"

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def pick(self, values):
        return values[int(self.rng.integers(len(values)))]

    def text(self, most: int | None = None) -> str:
        """A given text, or its first words."""
        words = self.pick(self.texts).split()
        if most:
            at = int(self.rng.integers(max(1, len(words) - most)))
            words = words[at : at + int(self.rng.integers(1, most + 1))]
        return html.escape(" ".join(words), quote=False)

    def wrap(self, tags, names, inner: str) -> str:
        tag, name = self.pick(tags), self.pick(names)
        if name:
            name = self.pick(_PREFIXES) + name + self.pick(_SUFFIXES)
        kind = self.pick(("class", "class", "id", "role"))
        return f'<{tag} {kind}="{name}">{inner}</{tag}>' if name else f"<{tag}>{inner}</{tag}>"

    def main(self) -> str:
        inner = [f"<h1>{MARK}{self.text(12)}</h1>"] if self.chance(0.8) else []
        if inner and self.chance(0.2):
            inner = [f"<header>{inner[0]}</header>"]
        for _ in range(int(self.rng.integers(1, 14))):
            inner.append(self.main_part())
            if self.chance(0.06):
                inner.append(self.part(self.pick(("advert", "notice", "share", "sidebar", "form", "menu"))))
        if self.chance(0.06):
            # One short line again and again, as in lists without markup.
            line = f"<p>{MARK}{self.text(3)}</p>"
            inner += [line] * int(self.rng.integers(4, 40))
        if self.chance(0.12):
            inner.append(self.part("comments"))
        body = "".join(inner)
        for depth in range(int(self.rng.integers(1, 4))):
            plain = depth > 0 and self.chance(0.5)
            tags = ("div", "section") if plain else MAIN_TAGS
            body = self.wrap(tags, ("",) if plain or self.chance(0.15) else MAIN_NAMES, body)
        return body

    def main_part(self) -> str:
        def said(most=None):
            return MARK + self.text(most)

        kind = self.rng.random()
        if kind < 0.62:
            text = said(None if self.chance(0.55) else self.pick((3, 14)))
            return f"<p>{text}</p>" if self.chance(0.85) else f"<p><b>{text}<br>"
        if kind < 0.72:
            return f"<{(tag := self.pick(('h2', 'h3', 'h4')))}>{said(8)}</{tag}>"
        if kind < 0.8:
            items = "".join(f"<li>{said(self.pick((6, 20)))}</li>" for _ in range(int(self.rng.integers(2, 6))))
            return f"<{(tag := self.pick(('ul', 'ol')))}>{items}</{tag}>"
        if kind < 0.86:
            return f"<blockquote><p>{said()}</p></blockquote>" if self.chance(0.5) else f"<blockquote>{said()}</blockquote>"
        if kind < 0.9:
            return f"<div>{said()}</div>"
        if kind < 0.94:
            cells = "".join(f"<tr><td>{said(3)}</td><td>{said(3)}</td></tr>" for _ in range(int(self.rng.integers(1, 4))))
            return f"<table>{cells}</table>"
        if kind < 0.97:
            return f"<figure><img src=x><figcaption>{said(12)}</figcaption></figure>"
        return f'<pre>{said(10)}</pre><p>{said(10)} <a href="/x">{self.text(3)}</a> {self.text(8)}</p>'

    def part(self, kind: str) -> str:
        tags, names = PARTS[kind]
        named = names.split()
        # An element that says by its own name what it is may go without a class.
        if self.chance(0.35):
            return f"<{tags[0]}>{self.filled(kind)}</{tags[0]}>" if tags[0] != "div" else self.wrap(tags, named, self.filled(kind))
        return self.wrap(tags, named, self.filled(kind))

    def filled(self, kind: str) -> str:
        few = range(int(self.rng.integers(1, 6)))
        short = lambda: self.pick(_PHRASES) if self.chance(0.4) else self.text(4)
        if kind == "comments":
            tag = self.pick(("p", "div", "p"))
            one = lambda: f"<{tag}>{short()}</{tag}><p>{self.text()}</p>" if self.chance(0.6) else f"<p>{self.text()}</p>"
            return (f"<h3>{short()}</h3>" if self.chance(0.4) else "") + "".join(
                self.wrap(("div", "li", "article"), ("comment", "reply", "", "media"), one()) if self.chance(0.7) else one() for _ in few
            )
        if kind == "form" or (kind == "notice" and self.chance(0.2)):
            return f"<label>{short()}</label><input name=q><select><option>{short()}<option>{short()}</select><button>{short()}</button>" + (
                f"<p>{self.text(14)}</p>" if self.chance(0.4) else ""
            )
        if kind == "header" and self.chance(0.4):
            # The name of the site, which may look like the title of a text.
            title = f"<{(tag := self.pick(('h1', 'h1', 'h2', 'p', 'div')))}>{self.text(4)}</{tag}>"
            return title + (self.part("menu") if self.chance(0.6) else "")
        shape = self.rng.random()
        if kind in ("menu", "share") or (kind in ("footer", "sidebar", "header") and shape < 0.4):
            links = [f'<a href="/{i}">{short()}</a>' for i in few]
            return "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>" if self.chance(0.7) else " ".join(links)
        if shape < 0.6:
            return (f"<h3>{short()}</h3>" if self.chance(0.3) else "") + f"<p>{self.text(None if self.chance(0.5) else 15)}</p>"
        return short() if shape < 0.7 else self.text(None if self.chance(0.4) else 15)
