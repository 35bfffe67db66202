"""Layouts of the pages the connectors read.

The element and class names are fixed values: they are what those pages are made of.
"""

from __future__ import annotations

import re

from corvane.sources.html import Layout, Node, attr_of, text_of


def _link(take, prefix: str = "http"):
    return lambda n: (v if (v := take(n)) and v.startswith(prefix) else None)


def _slug(take, pattern: str):
    return lambda n: (m.group(1) if (v := take(n)) and (m := re.search(pattern, v)) else None)


def _either(*takes):
    return lambda n: next((v for t in takes if (v := t(n))), None)


# Profile cards with a link to a person page
PROFILE_CARDS = Layout(
    lambda d: d.select("article.cc--component-container.cc--profile-card"),
    {"name": lambda n: re.sub(r"[\s\-.]+$", "", text_of("h3 a[href^='/person/']")(n) or "") or None, "slug": _slug(attr_of("h3 a[href^='/person/']", "href"), r"/person/([^/?#]+)")},
    ("name", "slug"),
)
#: Texts that mark a contact or footer block.
FOOTER_TEXTS = ("Contact Us", "All rights reserved")


def _list_links(d: Node) -> list[Node]:
    found = d.select("ul.links-container li")
    for block in d.select("div.f--field.f--wysiwyg"):
        if not any(t in block.text(" ") for t in FOOTER_TEXTS):
            found += block.select("ul li")
    seen, out = set(), []
    for li in found:
        a = li.first("a[href]")
        name = a.text() if a else ""
        if a is not None and len(name) >= 3 and "rice.edu" not in a.attrs["href"] and name.lower() not in seen:
            seen.add(name.lower())
            out.append(li)
    return out


# Lists of links
LINK_LIST = Layout(_list_links, {"name": text_of("a[href]"), "website": _link(attr_of("a[href]", "href"))})


def _about(d: Node) -> str | None:
    return next((t for b in d.select("div.f--field.f--wysiwyg") if (t := b.text(" ")) and not any(f in t for f in FOOTER_TEXTS)), None)


# One profile page
PROFILE = Layout(
    lambda d: [d],
    {
        "name": lambda d: re.sub(r"[\s\-.]+$", "", text_of(".header-container .f--field.f--text, .title-hero .f--field.f--text")(d) or "") or None,
        "website": lambda d: next((a.attrs["href"] for a in d.select("a.button--alt[href]") if a.attrs["href"].startswith("http")), None),
        "description": _about,
        "affiliation": lambda d: (t[1].text() or None) if len(t := d.select(".header-container .f--field.f--text, .title-hero .f--field.f--text")) > 1 else None,
    },
    (),
)
# Links in the body of an article
ARTICLE_LINKS = Layout(lambda d: d.select("a[href]"), {"name": lambda n: n.text() or n.attrs.get("href"), "website": _link(lambda n: n.attrs.get("href")), "description": lambda n: (p.text(" ") or None) if (p := n.up("p")) is not None else None}, ("website",))
# Participant cards
PARTICIPANTS = Layout(
    lambda d: d.select("a.grid-item.participant"),
    {
        "name": text_of(".grid-item-title"), "website": _link(attr_of(None, "href")), "description": _either(text_of(".grid-item-description p"), text_of(".grid-item-description")),
        "location": text_of(".grid-item-address"), "cohort": lambda n: "current" if "warm-gradient" in n.classes else "alumni",
    },
)


def _fund(block: Node) -> str:
    root = block
    while root.parent is not None:
        root = root.parent
    heads = []
    for n in root.walk():
        if n is block:
            break
        if n.tag in ("h1", "h2", "h3", "h4"):
            heads.append(n.text())
    for text in reversed(heads[-5:]):
        if re.search(r"(?i)\bFund\s+II\b", text):
            return "II"
        if re.search(r"(?i)\bFund\s+I\b", text):
            return "I"
    return "unknown"


def _holder(n: Node) -> Node:
    while n.parent is not None and "w-dyn-items" not in n.classes:
        n = n.parent
    return n


# Index of a portfolio with its funds, and a detail page of labelled cards
PORTFOLIO_INDEX = Layout(lambda d: d.select("div.w-dyn-items a.portfolios-hero-link"), {"slug": _slug(attr_of(None, "href"), r"^/portfolio/([^/?#]+)"), "fund": lambda n: _fund(_holder(n))}, ("slug",))


def _labelled(label: str):
    def take(d: Node) -> str | None:
        value = None
        for card in d.select("div.desc-card-wrap"):
            heads = [e for e in card.select("div.text-18px-bold") if "w-condition-invisible" not in e.classes]
            body = card.first("div.paragraph-16px.projects")
            if heads and body is not None and heads[0].text().lower() == label and body.text():
                value = body.text()
        return value

    return take


PORTFOLIO_DETAIL = Layout(lambda d: [d], {"name": text_of("h2.heading-b-36px"), "description": text_of("p.paragraph-16px"), "location": _labelled("headquarters"), "founders": _labelled("founders"), "invested": _labelled("investment")})
# Cards whose name is in an image
LOGO_CARDS = Layout(lambda d: d.select("div.companies__item.w-dyn-item"), {"website": _link(attr_of("a.companies__card", "href")), "image": attr_of("img.companies__logo", "src"), "description": text_of("div.companies__description")}, ())
# Members of one page of a paged listing; none once the page says so
MEMBERS = Layout(
    lambda d: [] if d.first(".no-results") is not None else d.select("a.col-4.card"),
    {"name": text_of("h2.entry-title"), "sector": text_of("div.title1 strong"), "description": text_of("p.shortdesc"), "detail_url": attr_of(None, "href"), "slug": _slug(attr_of(None, "href"), r"/members/([^/]+)/")},
)
# List items of an article
ARTICLE_ITEMS = Layout(lambda d: [n for a in d.select("article")[:1] for n in a.select("li")], {"item": lambda n: n.text(" ") or None}, ("item",))


def _offices(d: Node) -> list[Node]:
    place = d.first("div.section-map-places") or d.first("#ion-directory") or d
    for section in (c for c in place.children if isinstance(c, Node)):
        head = section.first("h3")
        if head is not None and "office" in head.text().lower():
            return [li for li in section.select("li.tenant") if li.first("a[href]") is not None]
    return []


# Tenants of one section, and their detail page
TENANTS = Layout(_offices, {"name": _either(text_of("a span"), text_of("a")), "floor": text_of("a sup"), "detail_url": attr_of("a[href]", "href"), "slug": _slug(attr_of("a[href]", "href"), r"/tenants/([^/]+)/?$")})
TENANT_DETAIL = Layout(lambda d: [d], {"name": text_of("h1.tenant-title span"), "description": lambda d: t if (t := text_of("p.description", " ")(d)) and len(t) > 20 else None, "website": _link(attr_of("a.primary-button", "href"))}, ())


def _placed(n: Node) -> str | None:
    ps = n.select("div.text-container p")
    return (ps[1].text() or None) if len(ps) > 1 else None


# Cards of winners and yearly tables
WINNERS = Layout(lambda d: d.select("div.c--mosaic-card"), {"name": text_of("div.text-container p strong"), "year": text_of("div.text-container h4"), "blurb": text_of("div.text-container p"), "placement": _placed})


def _cell(i: int):
    return lambda tr: (c[i].text() or None) if len(c := tr.select("td")) > i else None


STARTUP_TABLE = Layout(lambda d: d.select("table tbody tr"), {"name": _cell(0), "university": _cell(1), "website": lambda tr: _link(attr_of("a", "href"))(c[2]) if len(c := tr.select("td")) > 2 else None})
# Cards with a slug
SLUG_CARDS = Layout(lambda d: d.select("a.company-card"), {"name": text_of("h5.text-base"), "description": text_of("h4.title-lg-company"), "slug": _slug(attr_of(None, "href"), r"/([^/?#]+)/?$"), "source_url": _link(attr_of(None, "href"))}, ())
# Cards with data attributes
DATA_CARDS = Layout(
    lambda d: [c for c in d.select("article.company-card") if c.first("a.company-card__figure-link") is not None],
    {
        "name": _either(attr_of("a.company-card__figure-link", "aria-label"), text_of("h3.company-card__headline span.highlight__target")),
        "description": text_of("p.company-card__desc"), "sectors": attr_of(None, "data-sector"), "status": attr_of(None, "data-status"), "fund": attr_of(None, "data-portfolio"),
        "slug": _slug(attr_of("a.company-card__figure-link", "href"), r"/companies/([^/]+)$"), "source_url": _link(attr_of("a.company-card__figure-link", "href")),
    },
)
