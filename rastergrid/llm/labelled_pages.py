"""Labelled pages with layouts drawn by rule: the article text is what stands in elements of the class ``wanted``.

They show layouts that a table of pages may lack: articles in divs of any depth or in no container at all, with and
without paragraph elements, and other text beside and inside them. Class names are random letters, so that nothing can be learned
from them, only from structure.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

WANTED = "wanted"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


class _Page:
    """One drawn page; ``rng`` decides everything."""

    def __init__(self, rng: random.Random):
        self.rng = rng

    def word(self) -> str:
        return "".join(self.rng.choice(_LETTERS) for _ in range(self.rng.randint(2, 9)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(6, 18).capitalize() + self.rng.choice("...!?") for _ in range(self.rng.randint(low, high)))

    def mark(self, chance: float = 0.6) -> str:
        kind = self.rng.choice(("class", "class", "id"))
        return f' {kind}="{self.word()}"' if self.rng.random() < chance else ""

    def wrapped(self, inner: str, depth: int) -> str:
        for _ in range(depth):
            inner = f"<div{self.mark()}>{inner}</div>"
        return inner

    def link(self) -> str:
        return f'<a href="/{self.word()}">{self.words(1, 4).capitalize()}</a>'

    def menu(self) -> str:
        links = [self.link() for _ in range(self.rng.randint(2, 7))]
        form = self.rng.randrange(3)
        if form == 0:
            return "<ul>" + "".join(f"<li>{a}</li>" for a in links) + "</ul>"
        return f"<div{self.mark()}>" + (" ".join(links) if form == 1 else "".join(f"<p>{a}</p>" for a in links)) + "</div>"

    def notice(self) -> str:
        text = self.words(3, 9).capitalize() + self.rng.choice(("", "", "."))
        return f"<div{self.mark(0.9)}>" + self.rng.choice((f"<p>{text}</p>", text, f"{text} {self.link()}", f"<p>{text}</p><p>{self.link()}</p>")) + "</div>"

    def replies(self) -> str:
        kind, tag = f' class="{self.word()}"', self.rng.choice(("div", "div", "li", "section"))
        items = []
        for _ in range(self.rng.randint(2, 6)):
            name = self.rng.choice(("", f"<span>{self.word()}</span>", f"<b>{self.word()}</b>"))
            said = self.sentences(1, 2) if self.rng.random() < 0.8 else self.words(2, 8)
            items.append(f"<{tag}{kind}>{name}<p>{said}</p></{tag}>")
        head = self.rng.choice(("", f"<h3>{self.words(1, 3)}</h3>"))
        outer = "ul" if tag == "li" else "div"
        return f"<{outer}{self.mark(0.8)}>{head}{''.join(items)}</{outer}>"

    def aside(self) -> str:
        return self.rng.choice((
            lambda: f"<aside{self.mark()}><h3>{self.words(1, 4)}</h3><p>{self.sentences(1, 2)}</p></aside>",
            lambda: f"<aside{self.mark()}>{self.menu()}</aside>",
            lambda: f"<form{self.mark()}><label>{self.words(1, 5)}</label><p>{self.words(3, 9)}.</p><button>{self.word()}</button></form>",
            lambda: f"<nav>{self.menu()}</nav>", self.notice,
        ))()

    def article(self) -> str:
        plain = self.rng.random() < 0.25
        parts = [f'<h1 class="{WANTED}">{self.words(2, 8).capitalize()}</h1>'] if self.rng.random() < 0.8 else []
        for _ in range(self.rng.randint(3, 9)):
            tag = "div" if plain else "p"
            inner = self.sentences(1, 4)
            if self.rng.random() < 0.2:
                inner = inner.replace(" ", " <b>", 1).replace(" ", "</b> ", 1) if "<b>" not in inner else inner
            parts.append(f'<{tag} class="{WANTED}">{inner}</{tag}>')
            draw = self.rng.random()
            if draw < 0.08:
                parts.append(f'<h2 class="{WANTED}">{self.words(2, 6).capitalize()}</h2>')
            elif draw < 0.14:
                parts.append("<ul>" + "".join(f'<li class="{WANTED}">{self.sentences(1, 1)}</li>' for _ in range(3)) + "</ul>")
            elif draw < 0.18:
                parts.append(f'<blockquote class="{WANTED}">{self.sentences(1, 2)}</blockquote>')
            elif draw < 0.28:
                parts.append(self.aside())
        if self.rng.random() < 0.3:
            parts.append(self.replies())
        inner = self.wrapped("".join(parts), self.rng.randint(0, 3))
        tag = self.rng.choice(("article", "article", "main", "section", "div", "div"))
        return f"<{tag}{self.mark()}>{inner}</{tag}>" if self.rng.random() < 0.9 else inner

    def html(self) -> str:
        before, after = [], []
        if self.rng.random() < 0.7:
            before.append(f"<header{self.mark()}>{self.rng.choice((self.menu(), f'<p>{self.words(2, 8)}</p>', f'<h2>{self.words(1, 4)}</h2>'))}</header>")
        if self.rng.random() < 0.8:
            before.append(f"<nav{self.mark()}>{self.menu()}</nav>" if self.rng.random() < 0.6 else self.menu())
        for side in (before, after):
            if self.rng.random() < 0.5:
                side.append(self.aside())
        if self.rng.random() < 0.4:
            after.append(self.replies())
        if self.rng.random() < 0.8:
            text = self.words(3, 10)
            after.append(f"<footer{self.mark()}><p>{text}</p>{self.menu()}</footer>" if self.rng.random() < 0.7 else f"<div{self.mark()}>{text}</div>")
        body = self.wrapped("".join(before) + self.article() + "".join(after), self.rng.randint(0, 2))
        return f"<html><head><title>{self.words(2, 6)}</title></head><body>{body}</body></html>"


def layouts(count: int, seed: int = 1) -> Iterator[str]:
    """``count`` pages; another seed draws others."""
    for k in range(count):
        yield _Page(random.Random(f"{seed}/{k}")).html()
