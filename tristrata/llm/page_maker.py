"""Made-up pages with known main text, to train the block labeller on."""

from __future__ import annotations

import random

#: Words of page furniture, by kind.
MENU = (
    "home about contact login register help search products services blog news archive "
    "categories tags sitemap next previous subscribe sign in shop cart account jobs"
).split()
NOTICE = (
    "we use cookies to improve your experience accept all reject settings privacy policy "
    "terms this site by continuing you agree consent newsletter"
).split()
ADVERT = (
    "advertisement sponsored buy now offer sale discount free shipping best price deal "
    "click here limited order today promo"
).split()
COMMENT = (
    "great post thanks i agree reply says ago user wrote like comment first nice article "
    "minutes hours report guest anonymous"
).split()
FOOT = "copyright rights reserved imprint terms privacy contact powered by follow us".split()

_SYLLABLES = (
    "the an er on re ti es st en at ed nd to or ea in ha le de la ou ion que ai ment eau une "
    "sch ein ich und der ung che keit ver ge be co mi ra do ga ez ci ll os as el ue rr ja"
).split()

# Ways to mark the parts of a page: (tag, attributes).
_PARTS = {
    "menu": [("nav", ""), ("nav", 'class="main-nav"'), ("div", 'class="menu"'),
             ("div", 'id="navigation"'), ("ul", 'class="nav navbar"'), ("div", 'class="breadcrumb"'),
             ("div", 'role="navigation"'), ("div", 'class="topbar links"')],
    "header": [("header", ""), ("div", 'id="header"'), ("div", 'class="site-header"'),
               ("div", 'class="masthead banner"')],
    "footer": [("footer", ""), ("div", 'id="footer"'), ("div", 'class="site-footer"'),
               ("div", 'class="bottom copyright"')],
    "sidebar": [("aside", ""), ("div", 'class="sidebar"'), ("div", 'id="sidebar"'),
                ("div", 'class="widget"'), ("div", 'class="related"'), ("div", 'class="right rail"'),
                ("section", 'class="recommended more"'), ("aside", 'class="related posts"')],
    "notice": [("div", 'class="cookie-notice"'), ("div", 'id="consent"'),
               ("div", 'class="notice"'), ("div", 'class="alert banner"'), ("div", 'role="alert"'),
               ("div", 'class="popup newsletter"'), ("p", 'class="notice"')],
    "advert": [("div", 'class="ad"'), ("div", 'class="ads"'), ("div", 'class="advert"'),
               ("div", 'id="ad-slot"'), ("aside", 'class="ad"'), ("div", 'class="sponsored promo"'),
               ("p", 'class="ad"'), ("section", 'class="advertisement"'), ("ins", 'class="adsbygoogle"')],
    "form": [("form", ""), ("form", 'class="search"'), ("form", 'action="/login"')],
    "comments": [("div", 'class="comments"'), ("section", 'id="comments"'),
                 ("div", 'class="comment-list"'), ("ol", 'class="commentlist"'),
                 ("section", 'class="discussion"'), ("div", 'class="comment"'),
                 ("div", 'class="replies responses"'), ("article", 'class="comment"')],
}
_WORDS = {"menu": MENU, "header": MENU, "footer": FOOT, "sidebar": MENU, "notice": NOTICE,
          "advert": ADVERT, "form": MENU, "comments": COMMENT}
_ARTICLES = [("article", ""), ("article", ""), ("main", ""), ("div", 'class="content"'),
             ("div", 'id="content"'), ("div", 'class="post-body entry"'), ("div", 'class="article-text"'),
             ("section", 'class="story"'), ("div", 'id="main"'), ("article", 'class="post"'),
             ("div", 'role="main"'), ("div", "")]


class PageMaker:
    def __init__(self, seed: int):
        self.random = random.Random(seed)
        self.labels: dict[str, int] = {}

    def _word(self) -> str:
        return "".join(self.random.choices(_SYLLABLES, k=self.random.choice((1, 1, 2, 2, 3))))

    def _text(self, words: int, label: int, kind: str | None = None) -> str:
        """Words, some of the kind's own; no two texts of a page are equal."""
        r, pool = self.random, _WORDS.get(kind or "", [])
        share = r.choice((0, 0, 0.5, 1)) if pool else 0
        while True:
            got = [r.choice(pool) if r.random() < share else self._word() for _ in range(words)]
            if not kind or r.random() < 0.3:
                got = [w + "." if r.random() < 0.08 else w for w in got]
            text = " ".join(got)
            text = text[0].upper() + text[1:] + ("." if words > 4 or r.random() < 0.3 else "")
            if r.random() < 0.1:
                text = " ".join(w + r.choice(("###", "***", "%%%", "|", "!!")) for w in text.split())
            if r.random() < 0.03:
                text = text.upper()
            if text not in self.labels:
                self.labels[text] = label
                return text

    def _length(self) -> int:
        return self.random.choice((1, 3, 5, 8, 15, 30, 60, 120))

    def _furniture(self, kind: str) -> str:
        r = self.random
        tag, attributes = r.choice(_PARTS[kind])
        inner = []
        if kind in ("menu", "header", "sidebar", "footer") and r.random() < 0.75:
            items = [self._text(r.choice((1, 1, 2, 3)), 0, kind) for _ in range(r.randint(2, 7))]
            inner.append("<ul>" + "".join(f'<li><a href="/x">{t}</a></li>' for t in items) + "</ul>")
        if kind == "form":
            inner.append(f"<label>{self._text(2, 0, kind)}</label><input name=q>"
                         f"<button>{self._text(1, 0, kind)}</button>")
        if kind in ("advert", "notice", "footer") or not inner or r.random() < 0.3:
            for _ in range(r.choice((1, 1, 2)) if kind != "comments" else r.randint(1, 6)):
                text = self._text(r.choice((2, 4, 8, 15, 25)), 0, kind)
                inner.append(text if len(inner) == 0 and r.random() < 0.5
                             else r.choice(("<p>{}</p>", "<div>{}</div>", "<p>{}</p>")).format(text))
        body = "".join(inner)
        if tag == "ul" and "<li" not in body:
            body = f"<li>{body}</li>"
        return f"<{tag} {attributes}>{body}</{tag}>".replace(" >", ">")

    def _article(self) -> str:
        r = self.random
        tag, attributes = r.choice(_ARTICLES)
        inner = []
        if r.random() < 0.85:
            inner.append(f"<h1>{self._text(r.choice((2, 6, 10)), 1)}</h1>")
        for _ in range(r.choice((1, 2, 4, 6, 10, 16))):
            kind = r.random()
            if kind < 0.6:
                inner.append(f"<p>{self._text(self._length(), 1)}</p>")
            elif kind < 0.7:
                inner.append(f"<p><b>{self._text(self._length(), 1)}<br>")
            elif kind < 0.76:
                inner.append(f"<h2>{self._text(r.choice((2, 5)), 1)}</h2>")
            elif kind < 0.82:
                items = [self._text(r.choice((2, 6, 12)), 1) for _ in range(r.randint(2, 5))]
                inner.append("<ul>" + "".join(f"<li>{t}</li>" for t in items) + "</ul>")
            elif kind < 0.85:
                inner.append(f"<blockquote>{self._text(self._length(), 1)}</blockquote>")
            elif kind < 0.88:
                inner.append(f"<pre>{self._text(self._length(), 1)}</pre>")
            elif kind < 0.9:
                cells = [self._text(r.choice((1, 2)), 1) for _ in range(4)]
                inner.append("<table><tr>" + "".join(f"<td>{t}</td>" for t in cells) + "</tr></table>")
            elif kind < 0.92:
                inner.append(f"<figure><img src=x><figcaption>{self._text(6, 1)}</figcaption></figure>")
            elif kind < 0.94:
                inner.append(f'<p><a href="/y">{self._text(5, 1)}</a></p>')
            else:
                inner.append(self._furniture(r.choice(("advert", "sidebar", "notice", "form"))))
        if r.random() < 0.15:
            inner.append(self._furniture("comments"))
        body = "".join(inner)
        return f"<{tag} {attributes}>{body}</{tag}>".replace(" >", ">")

    def page(self) -> tuple[str, dict[str, int]]:
        """A page, and 1 for each of its texts that is main text, else 0."""
        r, self.labels = self.random, {}
        before = [k for k in ("notice", "header", "menu", "advert", "menu") if r.random() < 0.5]
        after = [k for k in ("comments", "sidebar", "form", "advert", "footer", "notice")
                 if r.random() < 0.45]
        parts = [f"<title>{self._text(6, 0)}</title></head><body>"]
        parts += [self._furniture(k) for k in before]
        article = self._article() if r.random() < 0.95 else ""
        if r.random() < 0.3:
            article = f"<div class=\"{r.choice(('wrapper', 'container', 'page', 'row'))}\">{article}</div>"
        parts += [article, *(self._furniture(k) for k in after)]
        end = "</body></html>" if r.random() < 0.9 else ""
        return "<!DOCTYPE html><html><head>" + "".join(parts) + end, self.labels
