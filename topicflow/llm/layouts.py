"""Random pages whose main text is known, to learn from: articles amid menus, notices, adverts and comments."""

from __future__ import annotations

import random

#: Attribute tokens of parts of pages, as sites name them (fixed values).
ARTICLE = "content post entry-content article-body story main-content post-body text article entry page-content".split()
PARTS = {
    "nav": "nav menu navbar main-menu navigation breadcrumb breadcrumbs topnav tabs pagination pager toc".split(),
    "header": "header masthead site-header top-bar logo branding banner hero-bar page-header tagline".split(),
    "footer": "footer site-footer bottom copyright legal colophon imprint credits footnote-bar".split(),
    "aside": "sidebar widget related aside recommended most-read trending teaser rail author-box tags".split(),
    "ad": "ad ads advert advertisement sponsored promo sponsor adbox banner-ad ad-slot commercial".split(),
    "notice": "notice cookie cookie-banner consent alert gdpr message popup modal overlay paywall warning".split(),
    "form": "form search login subscribe newsletter signup contact-form search-box poll".split(),
    "share": "share social sharing follow-us toolbar buttons actions like".split(),
    "comments": "comments comment reply discussion respond comment-list thread disqus user-comments reviews".split(),
}
ELEMENTS = {
    "nav": ("nav", "div", "ul"), "header": ("header", "div"), "footer": ("footer", "div"), "aside": ("aside", "div", "section"),
    "ad": ("div", "aside"), "notice": ("div", "section", "p"), "form": ("form", "div"), "share": ("div", "ul"),
    "comments": ("section", "div", "ol"),
}
#: Attribute tokens of blocks of an article (fixed values).
BLOCKS = "lead intro first dropcap byline date subtitle title note caption".split()
_SOUNDS = "an er in on th re ti en ea ou le de st qu ra mi ko sa el ung chen ción ment".split()


class Maker:
    """One random page; what is said inside ``main`` is remembered as its text."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.blocks: list[str] = []

    def words(self, n: int) -> str:
        r = self.r
        out = ["".join(r.choices(_SOUNDS, k=r.randint(1, 3))) for _ in range(max(1, n))]
        for i in range(len(out)):
            if r.random() < 0.12:
                out[i] += r.choice(".,.,;!")
        return " ".join(out).capitalize() + (r.choice(["", ".", ".", "."]))

    def size(self) -> int:
        return int(self.r.choice([1, 2, 4, 9, 20, 40, 80, 150, 300]) * self.r.uniform(0.6, 1.4)) or 1

    def say(self, tag: str, n: int, main: bool, link: float = 0.0) -> str:
        text = self.words(n)
        if main:
            self.blocks.append(text)
        inner = text
        if self.r.random() < link:
            inner = f'<a href="/{n}">{text}</a>'
        elif main and self.r.random() < 0.25:
            a, _, b = text.partition(" ")
            inner = f"<b>{a}</b> {b}" if b else text
        return f"<{tag}>{inner}</{tag}>" if tag else inner

    def attributes(self, kind: str, chance: float) -> str:
        r = self.r
        if r.random() > chance:
            return ""
        name = r.choice(PARTS[kind])
        return f' {r.choice(["class", "class", "id"])}="{name}{r.choice(["", "", f" w-{r.randint(1, 9)}"])}"'

    def part(self, kind: str) -> str:
        r, say = self.r, self.say
        element = r.choice(ELEMENTS[kind])
        open_ = f"<{element}{self.attributes(kind, 0.55 if element in ('nav', 'header', 'footer', 'aside', 'form') else 1.0)}>"
        items = lambda k, n, link: "<ul>" + "".join(f"<li>{say('', n, False, link)}</li>" for _ in range(k)) + "</ul>"
        if kind == "nav":
            body = items(r.randint(3, 10), r.randint(1, 2), 1.0)
            body = body[4:-5] if element == "ul" else body
        elif kind == "header":
            body = say("", r.randint(1, 4), False, 0.9) if r.random() < 0.5 else ""
            body += say(r.choice(["h1", "div", "p", "h2"]), r.randint(1, 6), False, 0.4)
            body += say(r.choice(["p", "p", "div", "h2"]), r.randint(2, 12), False) if r.random() < 0.5 else ""
            body += self.part("nav") if r.random() < 0.5 else ""
        elif kind == "footer":
            body = say(r.choice(["p", "", "div"]), r.choice([3, 8, 25, 60]), False)
            body = ("&copy; " if r.random() < 0.7 else "") + body + (items(r.randint(2, 6), 2, 1.0) if r.random() < 0.4 else "")
        elif kind == "aside":
            body = say("h3", 2, False) + (items(r.randint(2, 8), 5, 0.9) if r.random() < 0.7 else say("p", self.size(), False))
        elif kind in ("ad", "notice"):
            body = "".join(say(r.choice(["", "p", "p"]), r.choice([4, 8, 15, 40]), False, 0.15) for _ in range(r.randint(1, 2)))
            if kind == "notice" and r.random() < 0.5:
                body += "<button>" + self.words(1) + "</button>"
        elif kind == "form":
            body = "".join(f"<label>{self.words(2)}</label><input name='x'>" for _ in range(r.randint(1, 4)))
            body += (say("p", r.choice([5, 20]), False) if r.random() < 0.5 else "") + f"<button>{self.words(1)}</button>"
            if element == "div":
                body = f"<form>{body}</form>"
        elif kind == "share":
            body = "".join(f"<li>{say('', 1, False, 1.0)}</li>" for _ in range(r.randint(2, 5)))
        else:
            each = lambda: f'<{r.choice(["div", "article", "li"])} class="comment">{say("p", 2, False, 0.5)}{say("p", self.size(), False)}</div>'
            body = say("h3", 2, False) + "".join(each() for _ in range(r.randint(1, 6)))
        return f"{open_}{body}</{element}>"

    def code(self) -> str:
        """A block of code; its lines are one block of text."""
        r = self.r
        line = lambda: " ".join(self.words(1).strip(".,;!").lower() + r.choice(["", "()", " =", "_x", ";", ":", "(a, b)"]) for _ in range(r.randint(1, 8)))
        text = "\n".join(line() for _ in range(r.choice([1, 1, 3, 8])))
        self.blocks.append(text)
        return f"<pre><code>{text}</code></pre>" if r.random() < 0.5 else f"<pre>{text}</pre>"

    def block(self) -> str:
        """A block of an article, or several that belong together."""
        r, say = self.r, self.say
        kind = r.random()
        if kind < 0.6:
            text = say("p", self.size(), True, 0.02)
            return f'<p class="{r.choice(BLOCKS)}"{text[2:]}' if r.random() < 0.06 else text
        if kind < 0.7:
            return say(r.choice(["h2", "h2", "h3", "h3", "h4", "h5", "h6"]), r.randint(1, 7), True)
        if kind < 0.76:
            items = "".join(say("li", r.choice([1, 2, 8, 20]), True, 0.1) for _ in range(r.randint(1, 6)))
            return f"<ol>{items}</ol>" if r.random() < 0.3 else f"<ul>{items}</ul>"
        if kind < 0.8:
            return f"<blockquote>{say(r.choice(['p', '']), self.size(), True)}</blockquote>"
        if kind < 0.84:
            cell = lambda: say(r.choice(["td", "td", "td", "th"]), r.choice([1, 2, 9]), True)
            both = lambda: f"<td>{say('', 2, True)}{say('p', 9, True)}</td>"
            row = lambda: "<tr>" + "".join(cell() if r.random() < 0.9 else both() for _ in range(r.randint(1, 3))) + "</tr>"
            return "<table>" + "".join(row() for _ in range(r.randint(1, 4))) + "</table>"
        if kind < 0.88:
            return self.code()
        if kind < 0.92:
            return f'<figure><img src="a.png" alt="a">{say("figcaption", r.choice([2, 5, 12, 25]), True)}</figure>'
        if kind < 0.94:
            return "<dl>" + "".join(say("dt", 1, True) + say("dd", self.size(), True) for _ in range(r.randint(1, 3))) + "</dl>"
        if kind < 0.98:  # text beside blocks
            return say("", self.size(), True) + say("p", self.size(), True) + (say("", self.size(), True) + "<hr>" if r.random() < 0.5 else "")
        return f"<section>{say('h2', 3, True)}{say('p', self.size(), True)}{say('p', self.size(), True)}</section>"

    def article(self, between: float = 0.06, headed: float = 0.15) -> str:
        """Blocks, with parts that are no text of it between them."""
        r, say = self.r, self.say
        out = []
        if r.random() < 0.8:
            title = say(r.choice(["h1", "h1", "h1", "h2"]), r.randint(1, 14), True)
            out.append(f"<header>{title}</header>" if r.random() < headed else title)
        for _ in range(r.choice([0, 1, 1, 1, 2, 4, 7, 12, 20]) or (0 if out else 1)):
            out.append(self.block())
            if r.random() < between:
                out.append(self.part(r.choice(["ad", "share", "aside", "notice", "form"])))
        if r.random() < 2 * between:
            out.append(self.part("comments"))
        return "".join(out)

    def bare(self) -> str:
        """An article right in the body, with little around it."""
        r = self.r
        if r.random() < 0.15:
            return self.say(r.choice(["", "p"]), self.size(), True)
        top = [self.part(k) for k in r.choices(["nav", "header", "nav"], k=r.choice([0, 0, 1]))]
        body = self.article(0.01, 0.0)
        end = [self.part(k) for k in r.choices(["footer", "footer", "comments"], k=r.choice([0, 0, 1]))]
        return "".join([*top, body, *end])

    def inner(self) -> str:
        """The body of a page whose article stands in elements of its own."""
        r = self.r
        top = [self.part(k) for k in r.choices(["nav", "header", "header", "ad", "notice", "form", "share"], k=r.randint(0, 4))]
        body = self.article()
        for _ in range(r.choice([1, 1, 1, 2])):
            kind = r.random()
            if kind < 0.45:
                element, name = r.choice(["article", "article", "main", "section"]), ""
            else:
                element, name = "div", (f' class="{r.choice(ARTICLE)}"' if kind < 0.85 else "")
            if r.random() < 0.2:
                body += self.part(r.choice(["comments", "share", "aside", "ad"]))
            body = f"<{element}{name}>{body}</{element}>"
        end = [self.part(k) for k in r.choices(["comments", "aside", "footer", "form", "ad", "notice"], k=r.randint(0, 4))]
        return "".join([*top, body, *end])

    def page(self) -> str:
        r = self.r
        inner = self.bare() if r.random() < 0.2 else self.inner()
        if r.random() < 0.3:
            inner = f'<div class="{r.choice(["page", "wrapper", "container", "site", "layout"])}">{inner}</div>'
        head = f"<head><title>{self.words(4)}</title><script>var t='</p>'</script></head>" if r.random() < 0.8 else ""
        return f"<!DOCTYPE html><html>{head}<body>{inner}</body></html>"


def made(seed: int) -> tuple[str, list[str]]:
    """A page and the blocks of its main text."""
    maker = Maker(seed)
    page = maker.page()
    return page, [" ".join(b.split()) for b in maker.blocks]
