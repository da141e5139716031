"""Labelled web pages to learn from, made by rule from a seed.

Nobody labelled the given pages, so the field of ``extraction`` learns from pages
whose main blocks are known because they were built: articles in many
layouts among menus, notices, adverts, sidebars, forms, reader comments and
footers, with broken markup, entities and noise as on real pages.
"""

from __future__ import annotations

import html
import random

#: Stands at the head of every main block's text.
MARK = ""
SYLLABLES = "an be ci de en fo ga he in ka le mi no or pe ra sa ti un ve st er al ou ch ê é ñ ö ß ión eau".split()
PHRASES = {
    "menu": ["Home", "About", "News", "Contact", "Search", "Login", "Sign in", "Archive", "Products", "Blog", "Help", "Menu"],
    "notice": ["We use cookies to improve your experience.", "Please accept our privacy policy.", "This site uses cookies.", "Your browser is out of date.", "Subscribe to continue reading."],
    "ad": ["Advertisement", "Sponsored", "Buy now and save 50%", "Limited offer", "Special deals for you", "Shop today"],
    "side": ["Related articles", "Most read", "Read more", "Popular posts", "Recent comments", "Tags", "Follow us", "Share this"],
    "form": ["Your name", "E-mail address", "Subscribe", "Send", "Submit", "Sign up for our newsletter", "Password", "Search"],
    "comment": ["Reply", "Report", "3 comments", "Leave a comment", "Posted by", "Like"],
    "footer": ["All rights reserved.", "Terms of use", "Privacy policy", "Imprint", "Powered by", "Contact us"],
}
NAMES = {
    "menu": "nav menu navbar navigation breadcrumb topbar sitenav toc pager pagination links",
    "header": "header masthead top banner branding siteheader logo",
    "notice": "cookie notice alert gdpr consent message warning popup modal overlay",
    "ad": "ad ads advert advertisement sponsored promo banner sponsor adsbox",
    "side": "sidebar aside related widget rail secondary share social recommended tags teaser",
    "form": "form signup newsletter search login subscribe",
    "comment": "comments comment discussion replies respond disqus thread",
    "footer": "footer bottom copyright colophon legal sitefooter",
    "main": "content article post entry story body text main page single prose",
}
TAGS = {"menu": "nav nav div ul", "header": "header header div", "notice": "div div section aside", "ad": "div div aside ins", "side": "aside aside div section", "form": "form form form div", "comment": "section div ol", "footer": "footer footer div", "main": "article article article main div div section td"}


class Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.style = self.r.choice(["plain"] * 6 + ["caps", "signs", "lower", "digits", "bars", "again"])

    def word(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def sentence(self, most: int = 18) -> str:
        words = [self.word() for _ in range(self.r.randint(1, most))]
        if len(words) > 8:
            words[self.r.randrange(3, 7)] += ","
        s = " ".join(words) + self.r.choice("....?!")
        return s if self.style == "lower" else s[0].upper() + s[1:]

    def prose(self, sentences: int, plain: float = 0.0) -> str:
        """Sentences, and with chance ``plain`` what pages say beside articles: articles say it, too."""
        said = lambda: self.r.choice(PHRASES[self.r.choice(list(PHRASES))]) if self.r.random() < plain else self.sentence()
        s = " ".join(said() for _ in range(self.r.randint(1, sentences)))
        if self.style == "caps":
            s = s.upper().replace(" ", "!! ")
        elif self.style == "signs":
            s = " ".join(w + self.r.choice(["***", "%%%", "$$$", "&&&", "###"]) for w in s.split())
        elif self.style == "bars":
            s = s.replace(" ", self.r.choice([" | ", " · ", " - ", ", ", " > ", " © "]))
        elif self.style == "again":
            s = " ".join(w + " " + w for w in s.split() * self.r.randint(1, 3))
        elif self.style == "digits":
            s = " ".join(w if self.r.random() < 0.7 else str(self.r.randrange(10**5)) for w in s.split())
        return s

    def inline(self, text: str) -> str:
        """Text as markup, now and then with elements inside, closed or not."""
        words = [html.escape(w, quote=False) for w in text.split(" ")]
        if self.r.random() < 0.25:
            k, t = self.r.randrange(len(words)), self.r.choice(["b", "i", "em", "a href='/x'", "span", "strong"])
            words[k] = f"<{t}>{words[k]}</{t.split()[0]}>"
        if self.r.random() < 0.08:
            words[0] = self.r.choice(["<b>", "<i>", "<span>"]) + words[0]
        if self.r.random() < 0.08:
            words[-1] += "<br>"
        return self.r.choice([" ", " ", " ", "\n"]).join(words)

    def open(self, kind: str) -> tuple[str, str]:
        tag = self.r.choice(TAGS[kind].split())
        names = self.r.choice(NAMES[kind].split())
        if self.r.random() < 0.3:
            names += self.r.choice(["-", " ", "_"]) + self.r.choice([self.word(), "wrap", "box", "inner", str(self.r.randrange(99)), "container"])
        # A tag that says what it is seldom needs a name, a plain one mostly has one.
        said = tag not in ("div", "section", "td", "ul", "ol", "ins")
        if self.r.random() < (0.35 if said else 0.92):
            attribute = f' {self.r.choice(["class", "class", "id"])}="{names}"'
        else:
            attribute = ""
        before, after = ("<table><tr>", "</tr></table>") if tag == "td" else ("", "")
        return f"{before}<{tag}{attribute}>", f"</{tag}>{after}"

    def links(self, kind: str, most: int = 7) -> str:
        said = lambda: self.r.choice(PHRASES[kind]) if self.r.random() < 0.5 else self.word()
        items = [f'<a href="/{k}">{html.escape(said())}</a>' for k in range(self.r.randint(1, most))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if self.r.random() < 0.7 else self.r.choice([" | ", " ", " &middot; "]).join(items)

    def aside(self, kind: str) -> str:
        """Something beside the article."""
        a, b = self.open(kind)
        phrase = lambda: html.escape(self.r.choice(PHRASES.get(kind, PHRASES["menu"])))
        prose = lambda n: self.inline(self.prose(n))
        if kind in ("menu", "header"):
            inner = ("" if self.r.random() < 0.5 else f"<{self.r.choice(['h1', 'div', 'p', 'span'])}>{html.escape(self.word().title())}</div>") + self.links("menu")
        elif kind in ("notice", "ad"):
            inner = self.r.choice([phrase(), prose(3), f"<p>{prose(2)}</p>", f"{prose(2)} <a href='#'>{phrase()}</a>", f"<h3>{phrase()}</h3><p>{prose(2)}</p>"])
        elif kind == "side":
            inner = self.r.choice([f"<h3>{phrase()}</h3>{self.links('side')}", f"<h2>{html.escape(self.word())}</h2><p>{prose(3)}</p>", f"<p>{prose(2)}</p>", self.links("side")])
        elif kind == "form":
            inner = f"<p>{phrase()}</p><label>{phrase()}<input name='q'></label>" + self.r.choice(["", f"<p>{prose(1)}</p>", f"<select><option>{self.word()}<option>{self.word()}</select>", "<textarea></textarea>"]) + f"<button>{phrase()}</button>"
        elif kind == "comment":
            one = lambda: f"<{t}><b>{self.word()}</b> {self.r.choice(['', phrase()])}<p>{prose(4)}</p></{t}>"
            t = "li" if a.startswith("<ol") else self.r.choice(["div class='comment'", "div", "article class='comment'", "li"])
            inner = self.r.choice(["", f"<h3>{phrase()}</h3>"]) + "".join(one().replace(f"</{t}>", f"</{t.split()[0]}>") for _ in range(self.r.randint(1, 5)))
        else:
            inner = self.r.choice([f"&copy; www.{self.word()}.com &middot; {prose(3)}", f"<p>&copy; 2024 {html.escape(self.word())}. {phrase()}</p>", self.links("footer"), f"<p>{prose(2)}</p>{self.links('footer')}", phrase()])
        return a + inner + b

    def main(self) -> str:
        a, b = self.open("main")
        out, head = [], self.prose(1)[:60]
        self.title = head
        m = lambda text: MARK + self.inline(text)
        if self.r.random() < 0.8:
            h = f"<h1>{m(head)}</h1>"
            out.append(f"<header>{h}</header>" if self.r.random() < 0.15 else h)
        if self.r.random() < 0.2:
            out.append(f"<p class='{self.r.choice(['byline', 'author', 'date', 'meta'])}'>{m(self.word().title() + ', ' + str(self.r.randint(1, 28)) + ' May 2023')}</p>")
        for _ in range(self.r.choice([1, 1, 2, 3, 4, 6, 9, 14])):
            x = self.r.random()
            if x < 0.72:
                again = head + " " if self.r.random() < 0.12 else ""
                out.append(f"<p>{m(again + self.prose(self.r.choice([1, 1, 3, 7]), 0.1))}" + ("</p>" if self.r.random() < 0.9 else ""))
            elif x < 0.78:
                out.append(f"<h2>{m(self.sentence(6))}</h2>")
            elif x < 0.84:
                out.append("<ul>" + "".join(f"<li>{m(self.sentence(8))}" for _ in range(self.r.randint(1, 5))) + "</ul>")
            elif x < 0.88:
                out.append(f"<blockquote><p>{m(self.prose(2))}</p></blockquote>")
            elif x < 0.92:
                out.append("<table>" + "".join(f"<tr><td>{m(self.word())}</td><td>{m(str(self.r.randrange(999)))}</td></tr>" for _ in range(3)) + "</table>")
            elif x < 0.95:
                out.append(f"<figure><img src='x.png'><figcaption>{m(self.sentence(8))}</figcaption></figure>")
            elif x < 0.97:
                out.append(f"<pre>{m(self.prose(2))}</pre>")
            else:
                out.append(f"<div>{m(self.prose(3))}</div>")
        for kind in ("ad", "side", "form", "comment", "notice"):  # also inside the article
            if self.r.random() < 0.08:
                out.insert(self.r.randint(min(1, len(out)), len(out)) if kind != "comment" else len(out), self.aside(kind))
        return a + "".join(out) + b

    def page(self) -> str:
        r = self.r
        before = [k for k, p in (("notice", 0.25), ("header", 0.35), ("menu", 0.8), ("ad", 0.5), ("form", 0.1), ("side", 0.2)) if r.random() < p]
        after = [k for k, p in (("side", 0.35), ("comment", 0.4), ("ad", 0.25), ("form", 0.25), ("menu", 0.15), ("notice", 0.15), ("footer", 0.85)) if r.random() < p]
        if r.random() < 0.3:
            r.shuffle(before)
        main = self.main()
        wrap = r.choice([("", ""), ("", ""), ("<div id='page'>", "</div>"), ("<div class='wrapper'><div class='row'>", "</div></div>"), ("<main>", "</main>"), ("<table><tr><td>", "</td></tr></table>")])
        body = "".join(self.aside(k) for k in before) + wrap[0] + main + wrap[1] + "".join(self.aside(k) for k in after)
        end = "</body></html>" if r.random() < 0.8 else ""
        return f"<!DOCTYPE html><html><head><title>{html.escape(self.title)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>{body}{end}"


def labelled_page(seed: int) -> str:
    """A page whose main blocks begin with ``MARK``."""
    return Writer(seed).page()
