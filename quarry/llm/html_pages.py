"""Labelled pages to train the extraction model on: a bounded, seeded set.

Pages are composed of sections in the mark-up that sites use: semantic tags,
roles, or plain divisions whose classes name their purpose, with the article in
many forms and menus, headers, footers, side bars, notices, adverts, forms and
reader comments around and inside it.  The attribute ``data-y`` of an element
labels the blocks below it (1: main text); the parser reads it for training
alone.  Words are invented syllables, so the model can't lean on a language."""

from __future__ import annotations

import random

SYLLABLES = "an be cor da el fi gon hu is ju ka lo mer ni os pra qua ri sen tu ul vor wex yi zo".split()


class PageMaker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choices(SYLLABLES, k=self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(4, 18).capitalize() + self.r.choice(".....!?") for _ in range(self.r.randint(low, high)))

    def link(self, text: str) -> str:
        return f'<a href="/{self.word()}">{text}</a>'

    def links(self, low: int, high: int, item: str = "li") -> str:
        return "".join(f"<{item}>{self.link(self.words(1, 3))}</{item}>" for _ in range(self.r.randint(low, high)))

    def named(self, names: str) -> str:
        """Attributes with one of the names, alone or among others."""
        name = self.r.choice(names.split())
        style = self.r.random()
        if style < 0.25:
            return f' id="{name}"'
        if style < 0.6:
            return f' class="{name}"'
        other = self.word()
        return f' class="{self.r.choice([f"{name} {other}", f"{other} {name}", f"{other}-{name}", f"{name}-{other}", f"{name}__{other}"])}"'

    def plain(self) -> str:
        return self.r.choice(["", "", f' class="{self.word()}"', f' id="{self.word()}"'])

    # -- what isn't main text ------------------------------------------------
    def menu(self) -> str:
        r = self.r
        inner = r.choice([f"<ul>{self.links(3, 8)}</ul>", self.links(3, 7, "span"), self.links(3, 6, "div"), f"<ol>{self.links(2, 4)}</ol>", " | ".join(self.link(self.words(1, 2)) for _ in range(r.randint(3, 7)))])
        return r.choice([f"<nav{self.plain()}>{inner}</nav>", f"<div{self.named('menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar pagination pager toc')}>{inner}</div>", f'<div role="navigation">{inner}</div>',
                         f"<ul{self.named('menu nav navigation breadcrumbs tabs links')}>{self.links(3, 8)}</ul>"])

    def header(self) -> str:
        inner = self.r.choice([f"<div>{self.link(self.words(1, 3))}</div>", f"<h1>{self.words(1, 3)}</h1>", f"<p>{self.words(2, 7)}</p>", f"<h2>{self.words(1, 3)}</h2><p>{self.sentences(1, 1)}</p>", self.words(1, 5)])
        inner += self.menu() if self.r.random() < 0.5 else ""
        return self.r.choice([f"<header{self.plain()}>{inner}</header>", f"<div{self.named('header masthead site-header page-header topbar branding logo')}>{inner}</div>", f'<div role="banner">{inner}</div>'])

    def footer(self) -> str:
        r = self.r
        inner = r.choice([f"&copy; {self.words(1, 3)} &middot; {self.sentences(1, 2)}", f"<p>&copy; 2020 {self.words(1, 4)}. All rights reserved.</p>", f"<ul>{self.links(2, 5)}</ul><p>{self.sentences(1, 2)}</p>", f"<p>{self.sentences(1, 3)}</p>", f"<div>{self.words(2, 8)}</div><small>{self.words(2, 6)}</small>"])
        return r.choice([f"<footer{self.plain()}>{inner}</footer>", f"<div{self.named('footer site-footer page-footer colophon copyright legal credits')}>{inner}</div>", f'<div role="contentinfo">{inner}</div>'])

    def side(self) -> str:
        r = self.r
        inner = r.choice([f"<h3>{self.words(1, 3)}</h3><ul>{self.links(2, 6)}</ul>", f"<h2>{self.words(1, 3)}</h2><p>{self.sentences(1, 3)}</p>", f"<p>{self.sentences(1, 2)}</p>", f"<div>{self.words(2, 6)}</div>", self.words(3, 9)])
        return r.choice([f"<aside{self.plain()}>{inner}</aside>", f"<div{self.named('sidebar side widget related recommended trending popular rail secondary teaser more-stories')}>{inner}</div>", f'<div role="complementary">{inner}</div>', f"<section{self.named('related recommended sidebar widget popular')}>{inner}</section>"])

    def notice(self) -> str:
        r = self.r
        inner = r.choice([f"<p>{self.sentences(1, 3)}</p>", self.sentences(1, 2), f"<p>{self.sentences(1, 2)}</p><button>{self.words(1, 2)}</button>", f"<h2>{self.words(1, 4)}</h2><p>{self.sentences(1, 2)}</p>", f"We use cookies. {self.sentences(1, 1)} <a href='/p'>{self.word()}</a>"])
        return r.choice([f"<div{self.named('cookie cookies cookie-notice cookie-banner consent gdpr notice alert banner modal popup overlay disclaimer newsletter subscribe subscription paywall announcement privacy toast signup')}>{inner}</div>",
                         f'<div role="{r.choice(["dialog", "alert", "alertdialog", "status"])}">{inner}</div>', f"<dialog>{inner}</dialog>", f"<section{self.named('notice cookie-notice newsletter alert consent')}>{inner}</section>", f"<noscript>{inner}</noscript>", f"<p{self.named('notice alert disclaimer cookie')}>{self.sentences(1, 2)}</p>"])

    def advert(self) -> str:
        r = self.r
        inner = r.choice([self.sentences(1, 2), f"<p>{self.sentences(1, 2)}</p>", f"<a href='/x'>{self.words(3, 9)}</a>", f"<span>{self.words(1, 3)}</span><p>{self.words(3, 12)}</p>"])
        name = self.named("ad ads advert advertisement adverts adsense sponsored sponsor promo promotion banner-ad ad-slot ad-box commercial")
        return r.choice([f"<div{name}>{inner}</div>", f"<aside{name}>{inner}</aside>", f"<section{name}>{inner}</section>", f"<p{name}>{self.sentences(1, 1)}</p>", f"<ins class='adsbygoogle'>{self.words(2, 6)}</ins>" if r.random() < 0.2 else f"<div{name}>{inner}</div>"])

    def form(self) -> str:
        r = self.r
        inner = "".join(r.choice([f"<label>{self.words(1, 3)}</label><input name='q'>", f"<p>{self.sentences(1, 1)}</p>", f"<select><option>{self.word()}</option><option>{self.word()}</option></select>", f"<div>{self.words(1, 4)}</div>", f"<textarea>{self.words(0, 5)}</textarea>", f"<fieldset><legend>{self.words(1, 3)}</legend></fieldset>"]) for _ in range(r.randint(1, 4)))
        return f"<form{self.plain()}>{inner}<button>{self.words(1, 2)}</button></form>"

    def comments(self) -> str:
        r = self.r
        def one() -> str:
            body = r.choice([f"<p>{self.sentences(1, 4)}</p>", f"<p>{self.sentences(1, 2)}</p><p>{self.sentences(1, 3)}</p>", self.sentences(1, 3)])
            who = r.choice(["", f"<h4>{self.words(1, 2)}</h4>", f"<div>{self.words(1, 2)}</div>", f"<span>{self.word()}</span>"])
            return r.choice([f"<div class='comment'>{who}{body}</div>", f"<article class='comment'>{who}{body}</article>", f"<li>{who}{body}</li>", f"<div>{who}{body}</div>", f"<blockquote>{body}</blockquote>"])
        head = r.choice(["", f"<h2>{self.words(1, 2)}</h2>", f"<h3>{r.randint(1, 99)} {self.word()}</h3>"])
        inner = head + "".join(one() for _ in range(r.randint(1, 5))) + (self.form() if r.random() < 0.3 else "")
        names = self.named("comments comment comment-list commentlist comments-area comment-section reader-comments responses replies respond discussion disqus user-comments")
        return r.choice([f"<section{names}>{inner}</section>", f"<div{names}>{inner}</div>", f"<ol{names}>{inner}</ol>", f"<aside{names}>{inner}</aside>"])

    def share(self) -> str:
        return f"<div{self.named('share social sharing follow tags share-buttons')}>{self.r.choice([self.links(2, 4, 'span'), f'<ul>{self.links(2, 4)}</ul>', self.words(1, 4)])}</div>"

    # -- main text -------------------------------------------------------------
    def paragraph(self) -> str:
        r, text = self.r, self.sentences(1, 6)
        if r.random() < 0.15:
            text = self.words(1, 6).capitalize() + r.choice(["", "."])
        if r.random() < 0.2:
            text += f" <b>{self.words(1, 5)}" + r.choice(["</b>", "</b>", "<br>"]) + self.sentences(1, 1)
        if r.random() < 0.2:
            text += f" {self.link(self.words(1, 3))} {self.sentences(1, 1)}"
        return text

    def body(self) -> str:
        r, out = self.r, []
        for _ in range(r.choice([1, 2, 3, 4, 6, 9, 12])):
            x = r.random()
            if x < 0.72:
                out.append(f"<p{self.plain() if r.random() < 0.1 else ''}>{self.paragraph()}" + ("</p>" if r.random() < 0.9 else ""))
            elif x < 0.80:
                out.append(f"<h{r.randint(2, 4)}>{self.words(1, 8)}</h2>" if r.random() < 0.05 else (lambda n: f"<h{n}>{self.words(1, 8)}</h{n}>")(r.randint(2, 4)))
            elif x < 0.86:
                tag = r.choice(["ul", "ol"])
                out.append(f"<{tag}>" + "".join(f"<li>{r.choice([self.sentences(1, 1), self.words(1, 8)])}</li>" for _ in range(r.randint(1, 5))) + f"</{tag}>")
            elif x < 0.90:
                out.append(f"<blockquote>{r.choice([self.sentences(1, 3), f'<p>{self.sentences(1, 2)}</p>'])}</blockquote>")
            elif x < 0.93:
                out.append(f"<table><tr><th>{self.words(1, 2)}</th><th>{self.words(1, 2)}</th></tr><tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr></table>")
            elif x < 0.96:
                out.append(f"<figure><img src='x.png'><figcaption>{self.words(2, 10)}</figcaption></figure>")
            elif x < 0.98:
                out.append(f"<pre>{self.words(2, 12)}</pre>")
            else:
                out.append(f"<div>{self.paragraph()}</div>")
        return "".join(out)

    def article(self) -> str:
        r = self.r
        title = r.choice([f"<h1>{self.words(1, 12)}</h1>"] * 4 + [f"<header><h1>{self.words(2, 10)}</h1></header>", f"<h2>{self.words(2, 9)}</h2>", "", f"<header{self.plain()}><h1>{self.words(2, 8)}</h1><p>{self.sentences(1, 2)}</p></header>"])
        inside = []
        for _ in range(r.choice([1, 1, 1, 2, 3])):
            inside.append(self.body())
            if r.random() < 0.3:
                inside.append(f'<div data-y="0">{r.choice([self.advert, self.share, self.side, self.form, self.notice, self.menu])()}</div>' if r.random() < 0.3 else self.off(r.choice([self.advert, self.share, self.side, self.form, self.notice, self.menu])()))
        inner = title + "".join(inside)
        if r.random() < 0.12:
            inner += self.off(self.comments())
        names = self.named("content article post entry main story article-body post-content entry-content main-content text body-text article-content")
        kind = r.random()
        if kind < 0.4:
            return f'<article data-y="1"{self.plain()}>{inner}</article>'
        if kind < 0.55:
            return f'<main data-y="1"{self.plain()}>{inner}</main>'
        if kind < 0.65:
            return f'<main{self.plain()}><article data-y="1"{self.plain()}>{inner}</article>{self.off(r.choice([self.comments, self.side, self.share])()) if r.random() < 0.4 else ""}</main>'
        if kind < 0.85:
            return f'<div data-y="1"{names}>{inner}</div>'
        if kind < 0.9:
            return f'<div data-y="1" role="main">{inner}</div>'
        if kind < 0.95:
            return f'<section data-y="1"{self.plain()}>{inner}</section>'
        return f'<div data-y="1">{inner}</div>'

    @staticmethod
    def off(section: str) -> str:
        """The section with the label of what isn't main text on its first tag."""
        at = section.index(">")
        return section[:at] + ' data-y="0"' + section[at:]

    def page(self) -> str:
        r = self.r
        before = [f() for f in (self.notice, self.header, self.menu, self.advert, self.form, self.side) if r.random() < 0.4]
        after = [f() for f in (self.comments, self.side, self.advert, self.share, self.menu, self.notice, self.form, self.footer) if r.random() < 0.4]
        r.shuffle(before)
        main = self.article()
        if r.random() < 0.4:
            main = f"<div{r.choice([' class=wrapper', ' class=container', ' id=page', ' class=row', ' class=col', self.plain()])}>{main}{self.side() if r.random() < 0.4 else ''}</div>"
        inner = "".join(before) + main + "".join(after)
        if r.random() < 0.3:
            inner = f"<div{r.choice([' id=wrapper', ' class=site', ' id=root', self.plain()])}>{inner}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{}}</style></head><body>{inner}<script>var x='</p>';</script></body></html>"


def labelled_pages(count: int, seed: int = 11) -> list[str]:
    maker = PageMaker(seed)
    return [maker.page() for _ in range(count)]
