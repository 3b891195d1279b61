"""Labelled pages to train the extractor on: layouts of articles with what sites put around them.

The layouts are written out by hand; the words in them are drawn by a seeded generator, as only their number, their
punctuation and their place matter. `data-main="1"` labels the text that belongs to the article, "0" the rest; the
label is never a feature.
"""

import random

#: Names that sites give to the parts of a page, by what the part is.
ARTICLE_NAMES = "article content post entry story text body main page-content article-body post-content entry-content"
MENU_NAMES = "nav navbar menu main-menu navigation breadcrumb breadcrumbs toc topnav links sitemap tabs pagination pager"
HEADER_NAMES = "header site-header masthead topbar banner logo branding tagline page-header"
FOOTER_NAMES = "footer site-footer copyright legal imprint bottom colophon footer-links"
SIDE_NAMES = "sidebar aside widget related recommended popular trending more-stories tags share social author-box rail"
NOTICE_NAMES = "notice cookie cookie-notice consent gdpr alert warning message popup modal overlay announcement paywall"
ADVERT_NAMES = "ad ads advert advertisement sponsor sponsored promo promotion banner-ad adsbox commercial dfp"
FORM_NAMES = "form search login signup newsletter subscribe subscription contact-form poll survey"
COMMENT_NAMES = "comments comment comment-list reply replies respond discussion disqus feedback reader-comments"
KINDS = {
    "article": ARTICLE_NAMES,
    "menu": MENU_NAMES,
    "header": HEADER_NAMES,
    "footer": FOOTER_NAMES,
    "side": SIDE_NAMES,
    "notice": NOTICE_NAMES,
    "advert": ADVERT_NAMES,
    "form": FORM_NAMES,
    "comment": COMMENT_NAMES,
}
PAGES = 360


def _name(rng: random.Random, names: str) -> str:
    return rng.choice(names.split())


class _Writer:
    def __init__(self, rng: random.Random):
        self.rng = rng
        self.letters = "etaoinshrdlucmfwypvbgkj" if rng.random() < 0.7 else "eéaioñuürsäöltncdm"

    def word(self) -> str:
        return "".join(self.rng.choices(self.letters, k=self.rng.randint(1, 9)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high)))

    def sentence(self) -> str:
        end = self.rng.choice([".", ".", ".", ".", "?", "!", "..."])
        words = self.words(2, 25).split(" ")
        if len(words) > 6 and self.rng.random() < 0.5:
            words[3] += ","
        if self.rng.random() < 0.1:
            words[0] = self.rng.choice(["&quot;", "&amp; ", "&#8211; ", "$$$"]) + words[0]
        return " ".join(words).capitalize() + end

    def prose(self, low: int, high: int) -> str:
        text = " ".join(self.sentence() for _ in range(self.rng.randint(low, high)))
        if self.rng.random() < 0.2:
            text = text.replace(" ", f' <a href="/{self.word()}">{self.word()}</a> ', 1)
        return text if self.rng.random() < 0.8 else text.replace(" ", " <b>", 1) + "</b>"

    def tagged(self, tag: str, names: str, inner: str) -> str:
        if tag in ("nav", "header", "footer", "aside", "form", "article", "main") and self.rng.random() < 0.5:
            return f"<{tag}>{inner}</{tag}>"
        key = self.rng.choice(["class", "class", "id"])
        return f'<{tag} {key}="{_name(self.rng, names)}">{inner}</{tag}>'

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{self.word()}">{self.words(1, 4)}</a>' for _ in range(self.rng.randint(low, high))]
        shape = self.rng.random()
        if shape < 0.6:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " | ".join(items) if shape < 0.8 else "".join(f"<div>{i}</div>" for i in items)

    # --- parts around the article

    def menu(self) -> str:
        return self.tagged(self.rng.choice(["nav", "nav", "div", "ul"]), MENU_NAMES, self.links(3, 9))

    def header(self) -> str:
        inner = self.rng.choice([f"<h1>{self.words(1, 4)}</h1>", f"<div>{self.words(1, 5)}</div>", ""])
        inner += self.rng.choice([f"<p>{self.words(3, 9)}</p>", self.menu(), "", f"<a href='/'>{self.word()}</a>"])
        return self.tagged(self.rng.choice(["header", "header", "div"]), HEADER_NAMES, inner or self.words(1, 3))

    def footer(self) -> str:
        line = self.rng.choice(["&copy; ", "&copy; 2024 ", "Copyright ", ""]) + self.words(1, 4)
        line += self.rng.choice(["", " &middot; " + self.sentence(), " | " + self.words(1, 4), ". " + self.prose(1, 3)])
        inner = self.rng.choice([line, f"<p>{line}</p>", f"<div>{line}</div>" + self.links(2, 5)])
        return self.tagged(self.rng.choice(["footer", "footer", "div"]), FOOTER_NAMES, inner)

    def side(self) -> str:
        inner = f"<h{(n := self.rng.randint(2, 4))}>{self.words(1, 4)}</h{n}>"
        inner += self.rng.choice([self.links(2, 6), f"<p>{self.prose(1, 3)}</p>", f"<div>{self.prose(1, 2)}</div>"])
        return self.tagged(self.rng.choice(["aside", "aside", "div", "section"]), SIDE_NAMES, inner)

    def notice(self) -> str:
        text = self.prose(1, 3)
        inner = self.rng.choice([text, f"<p>{text}</p>", f"<p>{text}</p><button>{self.word()}</button>"])
        return self.tagged(self.rng.choice(["div", "div", "section"]), NOTICE_NAMES, inner)

    def advert(self) -> str:
        text = self.rng.choice([self.sentence(), self.prose(1, 3), self.words(2, 9)])
        inner = self.rng.choice([text, f"<p>{text}</p>", f'<a href="/{self.word()}">{text}</a>'])
        return self.tagged(self.rng.choice(["div", "div", "aside", "section"]), ADVERT_NAMES, inner)

    def form(self) -> str:
        inner = f"<label>{self.words(1, 4)}</label><input name=q>" + self.rng.choice(["", f"<p>{self.prose(1, 2)}</p>"])
        body = f"<form>{inner}<button>{self.word()}</button></form>"
        return body if self.rng.random() < 0.5 else self.tagged("div", FORM_NAMES, body)

    def comments(self) -> str:
        said = [
            self.tagged(self.rng.choice(["div", "li", "article"]), "comment reply comment-body", f"<p>{self.prose(1, 4)}</p>")
            for _ in range(self.rng.randint(1, 4))
        ]
        inner = f"<h3>{self.words(1, 3)}</h3>" + "".join(said)
        return self.tagged(self.rng.choice(["section", "div", "ol"]), COMMENT_NAMES, inner)

    def around(self, *parts: str) -> str:
        return "".join(getattr(self, p)().replace(">", ' data-main="0">', 1) for p in parts)

    # --- the article

    def article(self, inside: bool) -> str:
        out = [f"<h1>{self.words(2, 12)}</h1>"] if self.rng.random() < 0.8 else []
        for _ in range(self.rng.randint(0, 12)):
            kind = self.rng.random()
            if kind < 0.66:
                out.append(f"<p>{self.prose(1, 8)}</p>")
            elif kind < 0.72:
                out.append(f"<p>{self.sentence()}")
            elif kind < 0.77:
                out.append(f"<p><b>{self.words(2, 20)}<br>")
            elif kind < 0.84:
                out.append(f"<h{(n := self.rng.randint(2, 4))}>{self.words(1, 8)}</h{n}>")
            elif kind < 0.90:
                out.append("<ul>" + "".join(f"<li>{self.words(2, 14)}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.94:
                out.append(f"<blockquote>{self.prose(1, 3)}</blockquote>")
            elif kind < 0.96:
                out.append(f"<table><tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr></table>")
            elif kind < 0.98:
                out.append(f"<pre>{self.words(2, 20)}</pre>")
            elif inside:
                out.append(self.around(self.rng.choice(["advert", "side", "form", "notice"])))
        out.append(f"<p>{self.prose(1, 5)}</p>")
        body = "".join(out)
        shape = self.rng.random()
        if shape < 0.45:
            return f'<article data-main="1">{body}</article>'
        if shape < 0.6:
            return f'<main data-main="1">{body}</main>'
        if shape < 0.9:
            return f'<div class="{_name(self.rng, ARTICLE_NAMES)}" data-main="1">{body}</div>'
        return f'<div data-main="1">{body}</div>'

    def page(self) -> str:
        rng = self.rng
        pick = lambda *parts: [p for p in parts if rng.random() < 0.6]
        top = self.around(*pick("notice", "header", "menu", "menu", "advert", "form"))
        body = self.article(inside=rng.random() < 0.5)
        if rng.random() < 0.15:
            body = f"<table><tr><td>{self.around('side')}</td><td>{body}</td></tr></table>"
        below = self.around(*pick("side", "advert", "comments", "form", "side", "footer"))
        return f"<html><head><title>{self.words(2, 8)}</title></head><body>{top}{body}{below}</body></html>"


def labelled_pages(pages: int = PAGES, seed: int = 7) -> list[str]:
    return [_Writer(random.Random(f"{seed}/{i}")).page() for i in range(pages)]
