"""Labelled pages to train the extraction model on, drawn from templates with many variations.

Texts of main blocks end with MARK, which says what is main text and is taken off before anything is learnt.
"""

from __future__ import annotations

import random

MARK = ""

# Names that sites give to the parts of a page.
PARTS = {
    "main": ["content", "article", "post", "entry-content", "story", "article-body", "post-body", "main-text", "text"],
    "menu": ["nav", "menu", "navbar", "breadcrumb", "topnav", "main-menu", "toc", "pagination"],
    "header": ["header", "masthead", "site-header", "top", "branding", "logo"],
    "footer": ["footer", "site-footer", "bottom", "copyright", "colophon", "legal"],
    "aside": ["sidebar", "aside", "related", "widget", "recommended", "trending", "most-read", "tags"],
    "ad": ["ad", "ads", "advert", "banner", "sponsored", "promo", "ad-slot", "advertisement"],
    "notice": ["notice", "cookie", "cookie-banner", "consent", "alert", "gdpr", "paywall", "message", "popup", "modal"],
    "comments": ["comments", "comment", "discussion", "replies", "reply", "responses", "disqus", "user-comments"],
    "form": ["form", "newsletter", "subscribe", "search", "login", "signup", "contact-form"],
    "share": ["share", "social", "follow", "share-buttons", "author-box"],
}
TAGS = {
    "menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"],
    "ad": ["div", "aside", "section", "ins"], "notice": ["div", "section", "dialog"], "comments": ["section", "div", "ol"],
    "form": ["form", "div"], "share": ["div", "ul"],
}
ROLES = {"menu": "navigation", "header": "banner", "footer": "contentinfo", "aside": "complementary", "form": "search", "notice": "alert"}
PHRASES = {
    "footer": ["&copy; {w}", "All rights reserved.", "Privacy policy", "Terms of use {w}", "&copy; 2021 {w} &middot; {s}", "{s}"],
    "notice": ["We use cookies. {s}", "Please accept cookies to continue. {s}", "Notice: {s}", "{s}", "{s} {s}"],
    "ad": ["Advertisement", "Sponsored: {s}", "{s}", "Buy now {w}", "{s} {s}"],
    "form": ["Your e-mail", "Subscribe to our newsletter", "Search", "Name", "{s}", "Sign in"],
    "share": ["Share", "Follow us", "Tweet", "{w}"],
    "header": ["{w}", "{w} {w}", "{s}"],
    "aside": ["Related", "Most read", "{s}", "{w} {w}"],
}


class Pages:
    """Draws pages; the same seed draws the same pages."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.syllables = ["".join(self.rng.choice("aeioubdfghklmnprstvwzéüñ") for _ in range(self.rng.randint(1, 3))) for _ in range(120)]

    def word(self) -> str:
        return "".join(self.rng.choices(self.syllables, k=self.rng.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() + ("," if self.rng.random() < 0.08 else "") for _ in range(self.rng.randint(low, high)))

    def prose(self, low: int = 1, high: int = 7) -> str:
        return " ".join(self.words(1, 18).capitalize() + "." for _ in range(self.rng.randint(low, high)))

    def odd(self, share: float) -> bool:
        return self.rng.random() < share

    def links(self, low: int, high: int) -> str:
        return "".join(f'<li><a href="/{self.word()}">{self.words(1, 4)}</a></li>' for _ in range(self.rng.randint(low, high)))

    def opening(self, part: str) -> tuple[str, str]:
        """Start and end tag of a part; it says what it is by its tag, its name or its role."""
        tag = self.rng.choice(TAGS[part])
        named = tag in ("div", "ul", "ol", "section", "ins", "dialog") or self.odd(0.4)
        text = f"<{tag}"
        if part in ROLES and self.odd(0.15):
            text += f' role="{ROLES[part]}"'
        elif named:
            text += f' {self.rng.choice(["class", "class", "id"])}="{self.rng.choice(PARTS[part])}"'
        return text + ">", f"</{tag}>"

    def part(self, part: str) -> str:
        start, end = self.opening(part)
        if part == "menu":
            inner = self.links(2, 8) if start.startswith("<ul") else f"<ul>{self.links(2, 8)}</ul>"
        elif part == "comments":
            inner = "".join(f"<{t}>{self.prose(1, 4)}</{t}>" for t in self.rng.choices(["p", "li", "div"], k=self.rng.randint(1, 4)))
            inner = self.rng.choice(["", "<h3>Comments</h3>", f"<h3>{self.words(1, 3)}</h3>"]) + inner
        else:
            texts = [p.format(w=self.word(), s=self.prose(1, 2)) for p in self.rng.choices(PHRASES[part], k=self.rng.randint(1, 3))]
            tags = ["p", "span", "div", "h2", "label"] if part == "form" else ["p", "div", "h2", "li", "span"]
            inner = texts[0] if self.odd(0.4) else "".join(f"<{t}>{x}</{t}>" for t, x in zip(self.rng.choices(tags, k=len(texts)), texts, strict=True))
            if part in ("aside", "share") and self.odd(0.6):
                inner += f"<ul>{self.links(1, 6)}</ul>"
            if part == "form":
                inner += '<input type="text"><button>OK</button>'
        if self.odd(0.1):
            inner = f"<b>{inner}"
        return start + inner + end

    def block(self) -> str:
        text = self.prose() if self.odd(0.75) else self.words(1, 12) if self.odd(0.5) else self.words(1, 3).capitalize() + "."
        if self.odd(0.2):
            text = text.replace(" ", f' <a href="#">{self.word()}</a> ', 1)
        kind = self.rng.random()
        if kind < 0.12:
            return f"<h{(n := self.rng.randint(2, 4))}>{self.words(1, 8)}{MARK}</h{n}>"
        if kind < 0.18:
            return "<ul>" + "".join(f"<li>{self.words(2, 12)}{MARK}</li>" for _ in range(self.rng.randint(2, 5))) + "</ul>"
        if kind < 0.22:
            return f"<blockquote>{text}{MARK}</blockquote>"
        if kind < 0.25:
            return f"<pre>{text}{MARK}</pre>"
        if kind < 0.28:
            return "<table>" + "".join(f"<tr><td>{self.words(1, 4)}{MARK}</td><td>{self.words(1, 4)}{MARK}</td></tr>" for _ in range(2)) + "</table>"
        if kind < 0.4:
            return f"<p><b>{text}{MARK}<br>"
        if kind < 0.46:
            return f"<div>{text}{MARK}</div>"
        return f"<p>{text}{MARK}" + ("</p>" if self.odd(0.8) else "")

    def article(self) -> str:
        kind = self.rng.random()
        if kind < 0.45:
            start, end = "<article>", "</article>"
        elif kind < 0.6:
            start, end = "<main>", "</main>"
        else:
            tag = self.rng.choice(["div", "section", "article", "main"])
            start, end = f'<{tag} {self.rng.choice(["class", "id"])}="{self.rng.choice(PARTS["main"])}">', f"</{tag}>"
        title = f"<h1>{self.words(2, 12)}{MARK}</h1>" if self.odd(0.85) else ""
        if title and self.odd(0.1):
            title = f"<header>{title}</header>"
        blocks = [self.block() for _ in range(self.rng.choice([1, 1, 2, 3, 5, 8, 13]))]
        for part in self.rng.choices(["ad", "share", "form", "aside", "notice", "menu"], k=self.rng.choice([0, 0, 0, 1, 2])):
            blocks.insert(self.rng.randint(0, len(blocks)), self.part(part))
        if self.odd(0.1):
            blocks.append(self.part("comments"))
        return start + title + "".join(blocks) + end

    def page(self) -> str:
        before = [p for p in ("notice", "header", "menu", "ad", "form", "share") if self.odd(0.45)]
        after = [p for p in ("share", "comments", "aside", "ad", "form", "notice") if self.odd(0.35)]
        after += ["footer"] if self.odd(0.9) else []
        parts = [self.part(p) for p in before] + [self.article()] + [self.part(p) for p in after]
        if self.odd(0.15):
            parts.insert(self.rng.randint(0, len(before)), self.part("aside"))
        return "<html><body>" + "".join(parts) + ("</body></html>" if self.odd(0.9) else "")
