"""Labelled pages to train on: text of sampled pages put into many kinds of page frames.

Raw pages carry no labels, so the training pages are built: a sampled page's text becomes an article, and the parts that
stand around articles (menus, headers, notices, adverts, sidebars, forms, reader comments, footers) are written around and
into it, in varying order, nesting, tags and attribute names, some without any telling name. The label of a part stands in
an attribute that the features never see. Everything follows from the seed and the sampled text.
"""

from __future__ import annotations

import random

LABEL = "data-part"  # c: article, d: not; elements outside both are frames

# Attribute names by part: what page authors commonly call them.
NAMES = {
    "menu": "nav navbar menu main-menu navigation breadcrumbs breadcrumb topnav site-nav links pagination pager toc tabs skip-links",
    "header": "header site-header masthead top-bar topbar brand logo page-header head-area hero-banner",
    "notice": "notice cookie-notice cookie-consent consent gdpr alert warning-box banner message popup modal overlay paywall subscribe newsletter signup "
              "announcement disclaimer toast age-gate",
    "advert": "ad ads advert advertisement ad-slot banner-ad sponsored promo promotion adsbygoogle sponsor partner-content commercial",
    "sidebar": "sidebar side aside widget secondary rail right-col related related-posts recommended popular trending most-read more-stories "
               "tag-cloud archive author-box teaser-list see-also",
    "form": "search search-form login login-form contact-form subscribe-form feedback newsletter-form comment-form poll filter",
    "comments": "comments comment-list comment-section commentlist responses replies discussion disqus thread reviews user-comments reactions guestbook",
    "share": "share social share-buttons social-links sharing follow-us post-actions toolbar",
    "footer": "footer site-footer colophon bottom footer-widgets copyright legal imprint site-info credits",
    "article": "article post entry content post-content entry-content article-body story story-body body-copy post-body text main-content hentry "
               "blog-post news-item article-text prose markdown-body",
    "frame": "container wrapper wrap page site layout row col inner outer grid main-wrap content-area page-wrap primary app root section clearfix",
}
NAMES = {k: v.split() for k, v in NAMES.items()}
FILLER = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you".split()


class _Writer:
    def __init__(self, r: random.Random, paragraphs: list[str], words: list[str]) -> None:
        self.r, self.paragraphs, self.words = r, paragraphs, words or FILLER

    def phrase(self, low: int, high: int) -> str:
        return " ".join(self.r.choice(self.words) for _ in range(self.r.randint(low, high)))

    def sentence(self, low: int = 4, high: int = 16) -> str:
        return self.phrase(low, high).capitalize() + self.r.choice("...!?") * (self.r.random() < 0.9)

    def prose(self, low: int = 1, high: int = 4) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(low, high)))

    def attrs(self, kind: str, p: float = 0.8) -> str:
        r = self.r
        if r.random() > p:
            return r.choice(["", "", f' class="{r.choice("abcdefgh")}{r.randrange(1000)}"', ' style="margin:0"'])
        name = r.choice(NAMES[kind])
        if r.random() < 0.3:
            name += r.choice(["-1", " clearfix", f" {r.choice(NAMES[kind])}", "-wrap", "_main", " js-" + name])
        return f' {r.choice(["class", "class", "class", "id"])}="{name}"'

    def part(self, tag: str, attrs: str, label: str, inner: str) -> str:
        mark = f' {LABEL}="{label}"' if label else ""
        return f"<{tag}{attrs}{mark}>{inner}</{tag}>"

    def link(self, words: tuple[int, int] = (1, 4)) -> str:
        return f'<a href="/{self.r.randrange(9999)}">{self.phrase(*words)}</a>'

    def links(self, low: int, high: int, words: tuple[int, int] = (1, 3)) -> str:
        n, r = self.r.randint(low, high), self.r
        if r.random() < 0.65:
            return self.r.choice(["<ul>{}</ul>", "<ol>{}</ol>"]).format("".join(f"<li>{self.link(words)}</li>" for _ in range(n)))
        if r.random() < 0.5:
            return r.choice([" | ", " ", " &middot; ", " / "]).join(self.link(words) for _ in range(n))
        return "".join(f"<div>{self.link(words)}</div>" for _ in range(n))

    def menu(self) -> str:
        tag = self.r.choice(["nav", "nav", "div", "ul", "section"])
        inner = self.links(3, 14)
        return self.part(tag, self.attrs("menu", 0.4 if tag == "nav" else 0.9), "d", inner if tag != "ul" else "".join(
            f"<li>{self.link()}</li>" for _ in range(self.r.randint(3, 12))))

    def header(self) -> str:
        tag = self.r.choice(["header", "header", "div", "table"])
        inner = self.r.choice(["<h1>{}</h1>", "<a href='/'>{}</a>", "<p>{}</p>", "<div class='logo'>{}</div>"]).format(self.phrase(1, 4))
        inner += self.r.choice(["", self.links(2, 6), self.form(False), f"<p>{self.sentence()}</p>"])
        if tag == "table":
            inner = f"<tr><td>{inner}</td></tr>"
        return self.part(tag, self.attrs("header", 0.5 if tag == "header" else 0.9), "d", inner)

    def notice(self) -> str:
        inner = self.r.choice(["", f"<h3>{self.phrase(1, 4)}</h3>"]) + self.r.choice(["<p>{}</p>", "{}", "<span>{}</span>", "<p>{}</p><p>x</p>"]).format(self.prose(1, 3))
        inner += self.r.choice(["", "<button>OK</button>", self.link(), f"<p>{self.link()}</p>"])
        return self.part(self.r.choice(["div", "div", "section", "aside", "p"]) if "<p>" not in inner and "<h3>" not in inner else "div", self.attrs("notice", 0.95), "d", inner)

    def advert(self) -> str:
        inner = self.r.choice(["{}", "<p>{}</p>", "<a href='//x'>{}</a>", "<h4>{}</h4>"]).format(self.prose(1, 2))
        return self.part(self.r.choice(["div", "div", "aside", "section"]), self.attrs("advert", 0.97), "d", inner)

    def sidebar(self) -> str:
        r = self.r
        inner = "".join(r.choice([f"<h3>{self.phrase(1, 3)}</h3>{self.links(3, 9, (2, 9))}", f"<div><h4>{self.link()}</h4><p>{self.sentence()}</p></div>" * r.randint(1, 4),
                                  f"<p>{self.prose(1, 2)}</p>", self.form(False)]) for _ in range(r.randint(1, 4)))
        tag = r.choice(["aside", "aside", "div", "section", "td"])
        inner = self.part("aside" if tag == "aside" else "div", self.attrs("sidebar", 0.5 if tag == "aside" else 0.95), "d", inner)
        return inner

    def form(self, labelled: bool = True) -> str:
        inner = "".join(f"<label>{self.phrase(1, 3)}</label><input name='a'>" for _ in range(self.r.randint(1, 4)))
        inner += self.r.choice(["<button>Go</button>", "<input type='submit'>", f"<p>{self.sentence()}</p><button>x</button>", "<textarea>x</textarea>"])
        return self.part("form", self.attrs("form", 0.5), "d" if labelled else "", inner)

    def share(self) -> str:
        return self.part(self.r.choice(["div", "ul", "p"]), self.attrs("share", 0.95), "d", " ".join(self.link((1, 2)) for _ in range(self.r.randint(2, 6))))

    def comments(self) -> str:
        r = self.r
        tag = r.choice(["li", "div", "article"])
        body = "".join(self.part(tag, r.choice([' class="comment"', ' class="comment-body"', "", ' class="reply"']), "",
                                 r.choice(["<b>{}</b>", "<h4>{}</h4>", "<div class='author'>{}</div>", "<span>{}</span>"]).format(self.phrase(1, 2))
                                 + "".join(f"<p>{self.prose(1, 4)}</p>" for _ in range(r.randint(1, 3))) + r.choice(["", "<a href='#'>Reply</a>"]))
                       for _ in range(r.randint(1, 9)))
        if tag == "li":
            body = f"<ol>{body}</ol>"
        inner = r.choice(["", f"<h3>{self.phrase(1, 3)}</h3>", f"<h2>{self.phrase(1, 3)}</h2>"]) + body + r.choice(["", self.form(False)])
        return self.part(r.choice(["div", "section", "div"]), self.attrs("comments", 0.97), "d", inner)

    def footer(self) -> str:
        tag = self.r.choice(["footer", "footer", "div"])
        inner = self.r.choice(["&copy; {}", "<p>&copy; {}</p>", "<p>{}</p>", "<small>{}</small>"]).format(self.prose(1, 4))
        inner = self.r.choice([inner, inner + self.links(2, 8), self.links(2, 8) + inner])
        return self.part(tag, self.attrs("footer", 0.4 if tag == "footer" else 0.95), "d", inner)

    def inline(self, text: str) -> str:
        r = self.r
        words = text.split()
        if len(words) > 3 and r.random() < 0.4:
            k = r.randrange(len(words) - 1)
            words[k] = r.choice(["<b>{}</b>", "<i>{}</i>", "<em>{}</em>", '<a href="/x">{}</a>', "<strong>{}</strong>", "<code>{}</code>", "{}<br>"]).format(words[k])
        return " ".join(words)

    def story(self, bare: bool) -> tuple[str, bool]:
        """(an article, whether it has its own element); every block of a bare one is labelled."""
        r = self.r
        mark = f' {LABEL}="c"' if bare else ""
        n = r.choice([0, 1, 1, 2, 3, 5, 8, 13, 21, 40])
        if n > 2:
            body = [r.choice(self.paragraphs) if self.paragraphs and r.random() < 0.7 else self.prose(1, 7) for _ in range(n)]
        else:
            body = [self.prose(1, 3) for _ in range(n)]
        out = [f"<h1{mark}>{self.phrase(1, 10)}</h1>"] if r.random() < 0.9 or not n else []
        opened = r.random() < 0.3
        for k, text in enumerate(body):
            kind = r.random()
            if k and kind < 0.06:
                out.append(f"<h2{mark}>{self.phrase(1, 6)}</h2>")
            elif k and kind < 0.12:
                out.append(f"<ul{mark}>" + "".join(f"<li>{self.inline(self.sentence(2, 12))}</li>" for _ in range(r.randint(2, 8))) + "</ul>")
            elif k and kind < 0.15:
                out.append(f"<blockquote{mark}><p>{text}</p></blockquote>")
            elif k and kind < 0.17:
                out.append(f"<table{mark}>" + "".join("<tr>" + "".join(f"<td>{self.phrase(1, 3)}</td>" for _ in range(3)) + "</tr>" for _ in range(3)) + "</table>")
            elif k and kind < 0.19:
                out.append(f"<figure{mark}><img src='a.png'><figcaption>{self.sentence()}</figcaption></figure>")
            elif kind < 0.22:
                out.append(f"<pre{mark}>{text}</pre>")
            elif kind < 0.28:
                out.append(f"<div{mark}>{self.inline(text)}</div>")
            elif opened and not k:
                out.append(f"<p{mark}><b>{text}<br>")
            elif r.random() < 0.1:
                out.append(f"<p{mark}>{self.inline(text)}")
            else:
                out.append(f"<p{mark}>{self.inline(text)}</p>")
            if k and r.random() < 0.05:
                out.append(r.choice([self.advert, self.advert, self.sidebar, self.notice, self.share, self.form])())
        if not n and r.random() < 0.5:
            out.append(f"<p{mark}><b>{self.phrase(1, 4)}.<br>")
        if r.random() < 0.15:
            out.append(r.choice([self.share, self.sidebar, self.form, self.comments])())
        if bare:
            return "".join(out)
        tag = r.choice(["article", "article", "article", "div", "div", "section", "td", "main"])
        inner = "".join(out)
        if tag == "td":
            return f"<table><tr>{self.part('td', self.attrs('article', 0.6), 'c', inner)}</tr></table>"
        return self.part(tag, self.attrs("article", 0.25 if tag in ("article", "main") else 0.75), "c", inner)

    def page(self) -> str:
        r = self.r
        before = [p() for p, chance in ((self.header, 0.5), (self.menu, 0.8), (self.notice, 0.25), (self.advert, 0.5), (self.form, 0.1),
                                        (self.sidebar, 0.15)) if r.random() < chance]
        after = [p() for p, chance in ((self.share, 0.2), (self.comments, 0.35), (self.sidebar, 0.35), (self.advert, 0.25), (self.menu, 0.2),
                                       (self.form, 0.1), (self.footer, 0.85), (self.notice, 0.15)) if r.random() < chance]
        r.shuffle(before)
        middle = self.story(r.random() < 0.12)
        if r.random() < 0.35:
            middle = f"<main{self.attrs('frame', 0.3)}>{middle}</main>" if "<main" not in middle else middle
        for _ in range(r.choice([0, 0, 0, 1, 1, 2, 3])):
            k, m = r.randint(0, len(before)), r.randint(0, len(after))
            tag = r.choice(["div", "div", "section"])
            middle = f"<{tag}{self.attrs('frame', 0.7)}>{''.join(before[k:])}{middle}{''.join(after[:m])}</{tag}>"
            before, after = before[:k], after[m:]
        closing = r.choice(["</body></html>", "</body></html>", ""])
        return (f"<!DOCTYPE html><html><head><title>{self.phrase(1, 9)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
                f"<body>{''.join(before)}{middle}{''.join(after)}{closing}")


def training_pages(texts: list[list[str]], count: int, seed: int) -> list[str]:
    """``count`` labelled pages; the blocks of each text in ``texts`` are used for one page after the other."""
    r = random.Random(seed)
    out = []
    for k in range(count):
        blocks = texts[k % len(texts)] if texts else []
        words = [w for b in blocks for w in b.replace("<", "").replace("&", "").split()[:200]]
        paragraphs = [b.replace("&", "&amp;").replace("<", "&lt;") for b in blocks if len(b) > 20]
        out.append(_Writer(r, paragraphs, words).page())
    return out
