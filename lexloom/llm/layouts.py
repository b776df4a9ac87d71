"""Pages to learn from: those whose markup tells main text, and drawn layouts around known texts."""

from __future__ import annotations

from collections.abc import Callable
from html import escape

import numpy as np

# How pages commonly name their parts.
#: Elements, or words of class, id and role, of parts that are not main text.
PARTS = {
    "menu": ["nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topnav", "tabs", "pagination", "pager"],
    "header": ["header", "masthead", "banner", "topbar", "logo", "branding"],
    "footer": ["footer", "copyright", "colophon", "legal", "contentinfo", "bottom"],
    "sidebar": ["aside", "sidebar", "widget", "related", "recommended", "trending", "complementary", "rail", "popular"],
    "notice": ["cookie", "cookies", "consent", "notice", "alert", "gdpr", "popup", "modal", "toast", "announcement", "dialog"],
    "advert": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "promotion", "adsbygoogle", "sponsor"],
    "form": ["form", "newsletter", "subscribe", "search", "login", "signup", "fieldset", "button"],
    "comments": ["comments", "comment", "commentlist", "responses", "replies", "disqus", "discussion", "respond"],
    "share": ["share", "social", "sharing", "follow", "tags", "byline", "meta"],
}
OTHER = frozenset(w for words in PARTS.values() for w in words)
#: Elements that hold main text.
MAIN = frozenset(["article", "main"])
#: Names of containers of main text, in drawn layouts.
HOLDERS = [
    "article", "main", "article", "section", "div", "div class=content", "div class=article-body", "div class=post", "div id=content", "div class=entry-content",
    "div class=story", "div id=main", "section class=post-content", "div role=main", "div class=text", "td class=body", "div class=page", "article class=post", "div class=container",
]
#: Short texts of such parts.
PHRASES = {
    "menu": ["Home", "About", "Contact", "News", "Products", "Blog", "Inicio", "Accueil", "Startseite", "Kontakt", "Next page", "FAQ"],
    "header": ["Welcome", "The daily site", "Your source of news", "Skip to content", "Bienvenue", "Willkommen", "Menu"],
    "footer": ["© 2024 All rights reserved.", "Privacy policy", "Terms of use", "Impressum", "Mentions légales", "Aviso legal", "Powered by our platform", "Back to top"],
    "sidebar": ["Related articles", "Most read", "You may also like", "Recent posts", "Archives", "Categories", "Artículos relacionados", "Mehr zum Thema"],
    "notice": ["We use cookies to improve your experience.", "Accept all", "This site uses cookies.", "Your browser is out of date.", "Wir verwenden Cookies.", "Nous utilisons des cookies.", "Manage preferences"],
    "advert": ["Advertisement", "Sponsored", "Buy now and save 50%", "Limited offer!", "Shop the sale", "Publicidad", "Anzeige", "Publicité"],
    "form": ["Subscribe to our newsletter", "Email address", "Sign up", "Search", "Send", "Password", "Log in", "Your name"],
    "comments": ["Comments", "Reply", "3 comments", "Leave a comment", "Great article, thanks!", "I do not agree with this at all.", "Posted by guest", "Kommentare"],
    "share": ["Share", "Tweet", "Share on Facebook", "Follow us", "Print", "By the editors", "Tags: news"],
}


def _other(name: str) -> bool:
    return name.strip("<>") in OTHER


def marked(html: str, leaves: Callable) -> list[tuple[str, int]] | None:
    """(text, 1 for main text) of the blocks of a page that has an article and something else; else None."""
    trail = _Trail()
    blocks = leaves(html, trail)
    out = []
    for path, text, _ in blocks:
        names = trail.names[path]
        inside = [i for i, e in enumerate(names) if e.split()[0].strip("<>") in MAIN]
        out.append((text, int(bool(inside) and not any(_other(w) for e in names[inside[0]:] for w in e.split()))))
    return out if {y for _, y in out} == {0, 1} else None


class _Trail:
    """Paths as lists of elements."""

    def __init__(self):
        self.known: dict[tuple[int, str], int] = {}
        self.names: list[tuple[str, ...]] = [()]

    def below(self, parent: int, element: str) -> int:
        at = self.known.get((parent, element))
        if at is None:
            at = self.known[parent, element] = len(self.names)
            self.names.append((*self.names[parent], element))
        return at


class Writer:
    """A page being written, and the blocks it must have."""

    def __init__(self, rng: np.random.Generator):
        self.rng, self.html, self.blocks = rng, [], []

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def one(self, of):
        return of[int(self.rng.integers(len(of)))]

    def open(self, holder: str) -> str:
        name, *marks = holder.split()
        self.html.append(f"<{name}" + "".join(' {}="{}"'.format(*m.split("=")) for m in marks) + ">")
        return f"</{name}>"

    def block(self, element: str, text: str, y: int, link: bool = False, closed: bool = True):
        """One block; texts are clean, so the block must come out as it goes in."""
        self.blocks.append((text, y))
        words = escape(text, quote=False)
        if link:
            words = f'<a href="/{len(self.html)}">{words}</a>'
        elif self.chance(0.15):
            words = f"<{self.one(['b', 'em', 'span'])}>{words}" + ("<br>" if self.chance(0.3) else "")
        end = self.open(element)
        self.html.append(words + (end if closed else ""))


def _part(w: Writer, kind: str, sentences: list[str], rest: list[str]) -> None:
    """A part that is not main text: named by an element, by words, by nothing but its look."""
    name = w.one(PARTS[kind])
    plain = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}.get(kind)
    look = w.rng.random()
    if plain and look < 0.35:
        holder = plain
    elif look < 0.8 or kind in ("comments", "advert", "notice"):
        holder = w.one(["div", "div", "section", "ul", "aside" if kind in ("advert", "sidebar") else "div"]) + w.one([" class=", " class=", " id="]) + w.one(["", "", "site-", "top-", "box-"]) + name + w.one(["", "", "-bar", "-notice" if kind == "notice" else "-box"])
    else:
        holder = w.one(["div", "section", "div class=box", "div class=row"])
    end = w.open(holder)
    linked = kind in ("menu", "share") or (kind in ("sidebar", "footer") and w.chance(0.5)) or look >= 0.8

    def words() -> str:
        r = w.rng.random()
        if r < 0.3:
            return w.one(PHRASES[kind])
        if kind == "comments" or (r < 0.55 and not linked):
            return w.one(sentences)[:400].strip() or "…"
        return w.one(rest)[:200].strip() if r < 0.75 else " ".join(w.one(sentences).split()[: int(w.rng.integers(1, 6))]) or "…"

    if kind in ("header", "sidebar", "comments", "form") and w.chance(0.5):
        w.block(w.one(["h1", "h2", "h2", "h3", "h4"]), words(), 0, w.chance(0.3))
    for _ in range(int(w.rng.integers(1, 7))):
        if kind == "comments":
            inner = w.open(w.one(["div class=comment", "li", "article class=comment", "div"]))
            w.block(w.one(["p", "div", "p class=comment-text"]), words(), 0)
            w.html.append(inner)
        else:
            w.block(w.one(["li", "li", "p"] if linked else ["p", "div", "li", "h3", "p"]), words(), 0, linked)
    w.html.append(end)


def page(rng: np.random.Generator, main: list[str], sentences: list[str], rest: list[str]) -> tuple[str, list[tuple[str, int]]]:
    """A drawn page around the blocks `main`, and its (text, 1 for main text) blocks in order."""
    w = Writer(rng)
    kinds = list(PARTS)
    before, within, after = (int(rng.integers(0, n)) for n in (6, 4, 6))
    w.html.append("<!DOCTYPE html><html><head><title>a page</title><style>p{margin:0}</style></head><body>")
    ends = [w.open(w.one(["div id=page", "div class=wrapper", "div"])) for _ in range(int(rng.integers(0, 3)))]
    for kind in [*rng.choice(["header", "menu", "notice", "notice", "advert", "sidebar", "form"], before)]:
        _part(w, str(kind), sentences, rest)
    ends += [w.open(w.one(HOLDERS)) for _ in range(int(rng.integers(1, 3)))]
    if len(main) < 3 or w.chance(0.3):
        main = main + [w.one(sentences) for _ in range(int(rng.integers(1, 8)))]
    if w.chance(0.25):
        # Some main texts say one line over and over.
        at, again = int(rng.integers(1, len(main) + 1)), min(main + [w.one(sentences)], key=len)
        main = main[:at] + [again] * int(rng.integers(3, 25)) + main[at:]
    places = set(rng.integers(1, len(main) + 1, within).tolist())
    for i, text in enumerate(main):
        if i in places:
            _part(w, w.one(["advert", "sidebar", "share", "form", "notice", "advert"]), sentences, rest)
        heads = ["h1", "h1", "h2"] if i == 0 else ["p"] * 12 + ["h2", "h3", "li", "blockquote", "div"]
        w.block(w.one(heads), text, 1, closed=w.chance(0.9))
    if w.chance(0.35):
        _part(w, w.one(["comments", "share", "sidebar"]), sentences, rest)
    inner = int(rng.integers(0, len(ends) + 1))
    w.html.append("".join(reversed(ends[-1:] if not inner else ends)))
    for kind in [*rng.choice(kinds, after)]:
        _part(w, str(kind), sentences, rest)
    w.html.append("</body></html>" if w.chance(0.9) else "")
    return "".join(w.html), w.blocks
