"""Press-release items in listing pages: a page as a table of nodes, and rules that read items off it.

A page becomes flat lists in document order: of each element its parent, tag, attributes and the end of its stretch, and
of each text the element that holds it. Everything below an element is a stretch of both lists, so "does this card hold
another link" and "which texts are in the card but not in the link" are comparisons of numbers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

from noticeloom.functions.dates import BARE, INITIALS, SHAPES, TIME
from noticeloom.functions.urls import CALL_TO_ACTION, DETAIL, LEAST_HEADLINE, NAVIGATION, PLAIN_PAGES, PLAIN_PREFIXES

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Elements that a new one of the same kind closes.
CLOSES = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
SCOPE = frozenset("ul ol table tbody thead div section article body html select dl".split())
ACTION = re.compile(CALL_TO_ACTION)
DATES = tuple((re.compile(shape), order) for shape, order in SHAPES)
#: Where cards, their dates and detail pages' dates are found.
CARDS_BNY = (".list-item-tile", ".cmp-list__item", ".cmp-teaser", "article.cmp-teaser", ".cmp-search__item", ".cmp-search__result", ".cmp-searchresults__item", ".search-result", ".press-release-item", ".press-release-card", "li.cmp-list__item", "article")
CARDS_CME = ("#cmeSearchFilterResults > li",)
DATES_BNY = ("time", ".list-item-header__date", ".cmp-list__item-date", ".cmp-teaser__date", ".cmp-search__item-date", ".date", ".press-release-date", ".release-date", ".article-date", "[class*='date']")
DATES_CME = ("time", ".cmeBrowseAllDate", ".date", ".press-release-date", ".release-date", ".article-date", "[class*='date']")
DATES_DETAIL = ("span.date", "p.date", "div.date", ".press-release-date", ".release-date", ".article-date", ".news-date", ".pr-date", ".date-label", "[class*='date']")
CATEGORIES = ("Sales Releases", "Earnings Releases", "Other Company Releases")


@lru_cache(maxsize=256)
def _selector(selector: str) -> tuple[str | None, ...]:
    """What a selector asks of the parent, and the tag, class, id and part of a class that it asks of an element."""
    up, own = (x.strip() for x in selector.rsplit(">", 1)) if ">" in selector else (None, selector)
    return up, *re.fullmatch(r"([a-z0-9]*)(?:\.([\w-]+)|#([\w-]+)|\[class\*='([^']+)'\])?", own).groups()


class Page(HTMLParser):
    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.attrs, self.parent, self.end = ["[document]"], [{}], [-1], [0]
        self.text: list[str] = []
        self.holder: list[int] = []
        self.first_text, self.last_text = [0], [0]
        self._open = [0]
        self.feed(html)
        self.close()
        while self._open:
            self._close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        closes = CLOSES.get(tag)
        while closes and len(self._open) > 1 and self.tag[self._open[-1]] not in SCOPE - closes:
            if not any(self.tag[n] in closes for n in self._inner(closes)):
                break
            self._close()
        self.tag.append(tag)
        self.attrs.append({k: v or "" for k, v in reversed(attrs)})
        self.parent.append(self._open[-1])
        self.end.append(0)
        self.first_text.append(len(self.text))
        self.last_text.append(0)
        self._open.append(len(self.tag) - 1)
        if tag in VOID:
            self._close()

    def _inner(self, closes: set[str]) -> Iterator[int]:
        for n in reversed(self._open):
            yield n
            if self.tag[n] in SCOPE - closes:
                return

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.tag[self._open[-1]] == tag:
            self._close()

    def handle_endtag(self, tag: str) -> None:
        if any(self.tag[n] == tag for n in self._open[1:]):
            while self.tag[self._open[-1]] != tag:
                self._close()
            self._close()

    def handle_data(self, data: str) -> None:
        if self.holder and self.holder[-1] == self._open[-1] and len(self.tag) - 1 <= self._last_node:
            self.text[-1] += data
        else:
            self.text.append(data)
            self.holder.append(self._open[-1])
        self._last_node = len(self.tag) - 1

    _last_node = -1

    def _close(self) -> None:
        n = self._open.pop()
        self.end[n], self.last_text[n] = len(self.tag), len(self.text)

    def find(self, n: int, *tags: str) -> list[int]:
        return [i for i in range(n + 1, self.end[n]) if self.tag[i] in tags]

    def links(self, n: int = 0) -> list[int]:
        return [i for i in self.find(n, "a") if "href" in self.attrs[i]]

    def href(self, n: int) -> str:
        return self.attrs[n].get("href", "").strip()

    def texts(self, n: int) -> list[str]:
        return [t.strip() for i, t in self._texts(n) if t.strip()]

    def _texts(self, n: int) -> Iterator[tuple[int, str]]:
        for i in range(self.first_text[n], self.last_text[n]):
            if self.tag[self.holder[i]] not in ("script", "style"):
                yield i, self.text[i]

    def joined(self, n: int, by: str = " ") -> str:
        return by.join(self.texts(n))

    def without(self, n: int, anchor: int) -> list[str]:
        """The texts in n that are not in the anchor."""
        a, b = self.first_text[anchor], self.last_text[anchor]
        return [t.strip() for i, t in self._texts(n) if not a <= i < b and t.strip()]

    def unlike(self, n: int, anchor: int) -> list[str]:
        """The texts in n that equal no text of the anchor."""
        own = {t for _, t in self._texts(anchor)}
        return [t.strip() for _, t in self._texts(n) if t not in own and t.strip()]

    def above(self, n: int, most: int, *tags: str) -> Iterator[int]:
        """Up to most ancestors, of these tags if any are given."""
        n = self.parent[n]
        while n >= 0 and most:
            if not tags or self.tag[n] in tags:
                yield n
                most -= 1
            n = self.parent[n]

    def matches(self, n: int, selector: str) -> bool:
        """tag, .class, #id, tag.class, [class*='x'], and "a > b" of these."""
        up, tag, cls, name, part = _selector(selector)
        if up and not (self.parent[n] >= 0 and self.matches(self.parent[n], up)):
            return False
        has = self.attrs[n].get("class", "")
        return (not tag or self.tag[n] == tag) and (not cls or cls in has.split()) and (not name or self.attrs[n].get("id") == name) and (not part or part in has)

    def select(self, selectors: tuple[str, ...], n: int = 0) -> list[int]:
        return [i for i in range(n + 1, self.end[n]) if any(self.matches(i, s) for s in selectors)]


def real_date(year: str, month: str, day: str) -> date | None:
    """The date, or None where there is none such; the month is a name or a number."""
    number = int(month) if month.isdigit() else INITIALS.index(month[:3]) // 3 + 1
    try:
        return date(int(year), number, int(day))
    except ValueError:
        return None


def find_date(text: str, last: bool = False) -> tuple[date | None, str]:
    """Of the first shape that has any, the first (or last) real date and how it is written."""
    for shape, order in DATES:
        real = [(d, m[0].strip()) for m in shape.finditer(text) if (d := real_date(*(m[i] for i in order)))]
        if real:
            return real[-1 if last else 0]
    return None, ""


def find_short_date(text: str) -> tuple[date | None, str]:
    """The first m/d/yy of this century; if that one is no date, none is."""
    m = re.search(r"\b(\d{1,2})/(\d{1,2})/(\d{2})\b", text)
    found = m and real_date(f"20{m[3]}", m[1], m[2])
    return (found, m[0]) if found else (None, "")


def find_time(text: str) -> str:
    m = re.search(TIME, text)
    return m.group(0).strip() if m else ""


def bare(text: str, raw: str) -> bool:
    return text.replace(raw, "", 1).strip(BARE) == ""


def _bare_label(texts: list[str]) -> tuple[date | None, str, str]:
    """The first text that is a date and nothing else, and the first that is a time and nothing else."""
    day, raw, time = None, "", ""
    for t in texts:
        if day is None:
            d, r = find_date(t)
            if d and bare(t, r):
                day, raw = d, r
                continue
        if not time and (c := find_time(t)) and bare(t, c):
            time = c
    return day, raw, time


def date_in_address(url: str, platform: str) -> date | None:
    shapes = {
        "investorroom": (r"/(?P<y>\d{4})-(?P<m>\d{2})-(?P<d>\d{2})-",),
        "investis": (r"/news-releases/\d{4}/(?P<m>\d{2})-(?P<d>\d{2})-(?P<y>\d{4})-\d+",),
        "aem_bny": (r"/(?P<y>\d{4})/(?P<m>\d{1,2})/(?P<d>\d{1,2})(?:/|$)", r"/(?P<y>\d{4})-(?P<m>\d{2})-(?P<d>\d{2})-"),
        "aem_cme": (r"/(?P<y>\d{4})/(?P<m>\d{1,2})/(?P<d>\d{1,2})",),
    }
    told = (m and real_date(m["y"], m["m"], m["d"]) for m in (re.search(shape, url) for shape in shapes.get(platform, ())))
    return next(filter(None, told), None)


def _bare_slug(href: str, base: str) -> bool:
    full, here = urlsplit(urljoin(base, href)), urlsplit(base)
    path = full.path.strip("/").lower()
    return full.netloc == here.netloc and not full.query and not full.fragment and bool(path) and "/" not in path and path not in PLAIN_PAGES and not path.startswith(PLAIN_PREFIXES)


def _probable(href: str, base: str) -> bool:
    full = urlsplit(urljoin(base, href))
    path = full.path.strip("/").lower()
    return full.netloc == urlsplit(base).netloc and not full.query and not full.fragment and bool(path) and path not in NAVIGATION


def _link_title(page: Page, a: int, by: str = " ") -> str:
    span = page.find(a, "span")
    return page.joined(a, by) or (page.joined(span[0], "") if span else "")


Item = tuple[str, str, date | None, str, str, str]  # title, url, publish_date, raw_date_text, publish_time, category


def _each(page: Page, root: str, keep: Callable[[str], bool], strip: bool = True) -> Iterator[tuple[int, str, Callable[[], None]]]:
    """Links to keep with their address; an address counts as seen once its link has given an item."""
    seen: set[str] = set()
    for a in page.links():
        if keep(page.href(a)):
            url = urljoin(root, page.href(a))
            key = url.rstrip("/") if strip else url
            if key not in seen:
                yield a, url, lambda key=key: seen.add(key)


def investorroom(page: Page, base: str, **_) -> Iterator[Item]:
    known = re.compile(DETAIL["investorroom"]).search

    def kind(href: str) -> str | None:
        return "known" if known(href) else "bare" if _bare_slug(href, base) else None

    def target(href: str) -> str:
        full = urlsplit(urljoin(base, href))
        return f"{full.scheme}://{full.netloc}{full.path}".rstrip("/")

    for a, url, done in _each(page, base, lambda h: kind(h) is not None):
        title = _link_title(page, a)
        if not title:
            continue
        day, raw, time, own = None, "", "", target(page.href(a))
        for up in page.above(a, 5):
            if any(kind(page.href(x)) and target(page.href(x)) != own for x in page.links(up) if x != a):
                break
            day, raw, time = _bare_label(page.without(up, a))
            if day:
                break
            time = ""
        if kind(page.href(a)) == "bare" and not (len(title) >= LEAST_HEADLINE and day):
            continue
        done()
        in_url = date_in_address(page.href(a), "investorroom")
        yield title, url, day or in_url, raw if day else in_url.isoformat() if in_url else "", time if day else "", ""


def q4(page: Page, base: str, segment: str = "news-details", **_) -> Iterator[Item]:
    detail = re.compile(rf"(?i)/{re.escape(segment)}/\d{{4}}/[^/]+/?(?:default\.aspx)?").search
    cards = ("li", "article", "div", "section")
    for a, url, done in _each(page, base, lambda h: bool(detail(h)), strip=False):
        title = page.joined(a, "")
        if not title:
            title = next((page.joined(up) for up in page.above(a, 1, "li", "article", "div")), "")
        if not title:
            continue
        day, raw, category = None, "", ""
        for up in page.above(a, 5, *cards):
            if len({page.attrs[x]["href"] for x in page.links(up) if detail(page.attrs[x]["href"])}) > 1:
                break
            context = " ".join(page.unlike(up, a))
            day, raw = find_date(context)
            category = category or next((c for c in CATEGORIES if c in context), "")
            if day:
                break
        if day is None and page.attrs[a].get("aria-label"):
            day, raw = find_date(page.attrs[a]["aria-label"], last=True)
        done()
        yield title, url, day, raw, "", category


def _notified_when(page: Page, a: int, long_cell: bool, short_row: bool) -> tuple[date | None, str, str]:
    own = page.joined(a)
    for t in page.find(a, "time")[:1]:
        if m := re.match(r"\d{4}-\d{2}-\d{2}", page.attrs[t].get("datetime", "")):
            try:
                return date.fromisoformat(m[0]), page.joined(t, "") or m[0], find_time(own)
            except ValueError:
                pass

    def read(text: str, *how: Callable) -> tuple[date | None, str, str] | None:
        for find in how:
            d, raw = find(text)
            if d:
                return d, raw, find_time(text)
        return None

    def rest(n: int) -> str:
        text = page.joined(n)
        return text.replace(own, " ") if own else text

    for up in page.above(a, 10):
        if page.tag[up] == "tr":
            cell = page.find(up, "td")[:1]
            found = read(page.joined(cell[0]), find_short_date, *[find_date] * long_cell) if cell else None
            found = found or read(rest(up), *[find_short_date] * short_row, find_date)
            if found:
                return found
            break
    for up in page.above(a, 5):
        if found := read(rest(up), find_short_date, find_date):
            return found
    return None, "", ""


def _card_title(page: Page, a: int, detail: Callable, own: str) -> str:
    """A headline in the tightest element that holds no other detail link: a heading, a titled class, or the first text that is no date."""
    card = a
    for up in page.above(a, 8):
        if page.tag[up] in ("body", "html", "[document]") or sum(bool(detail(page.attrs[x]["href"])) for x in page.links(up)) > 1:
            break
        card = up
    told = [page.joined(h) for h in page.find(card, *HEADINGS)[:1]]
    told += [t for n in range(card + 1, page.end[card]) if re.search(r"(?i)title|headline", page.attrs[n].get("class", "")) and (t := page.joined(n)) != own]
    told += [t for n in range(card + 1, page.end[card]) if page.parent[n] == card and (t := page.joined(n)) != own and not find_short_date(t)[0] and not find_date(t)[0]]
    return next((t for t in told if t and not ACTION.match(t)), "")


def notified(page: Page, base: str, gated: bool = False, **_) -> Iterator[Item]:
    detail = re.compile(DETAIL["notified_gated" if gated else "notified"]).search
    parts = urlsplit(base)
    for a, url, done in _each(page, f"{parts.scheme}://{parts.netloc}", lambda h: bool(detail(h))):
        title = page.joined(a)
        heading = page.find(a, *HEADINGS)[:1]
        if heading:
            title = page.joined(heading[0]) or title
        elif not gated and (not title or ACTION.match(title)):
            title = _card_title(page, a, detail, title) or title
        title = title or _link_title(page, a)
        if not title:
            continue
        done()
        day, raw, time = _notified_when(page, a, long_cell=gated, short_row=gated)
        yield title, url, day, raw, time, ""


def investis(page: Page, base: str, **_) -> Iterator[Item]:
    detail, parts = re.compile(DETAIL["investis"]).search, urlsplit(base)
    for a, url, done in _each(page, f"{parts.scheme}://{parts.netloc}", lambda h: bool(detail(h))):
        title = page.joined(a)
        if not title:
            continue
        done()
        row = [page.find(up, "td")[0] for up in page.above(a, 1, "tr") if page.find(up, "td")]
        for up in page.above(a, 4):
            if page.tag[up] in ("body", "html", "[document]"):
                break
            row.append(up)
        day, raw = next((f for n in row if (f := find_date(page.joined(n)))[0]), (None, ""))
        if day is None and (day := date_in_address(url, "investis")):
            raw = "(from URL)"
        yield title, url, day, raw, "", ""


def _card_date(page: Page, card: int, a: int | None, selectors: tuple[str, ...]) -> tuple[date | None, str]:
    stamp = page.find(card, "time")[:1]
    tries = [t for n in stamp for t in (page.attrs[n].get("datetime", ""), page.joined(n, ""))]
    tries += [page.joined(n[0], "") for s in selectors if (n := page.select((s,), card)[:1]) and n != stamp]
    for t in tries:
        d, raw = find_date(t)
        if d:
            return d, raw
    return _bare_label(page.unlike(card, a) if a is not None else page.texts(card))[:2]


def aem(page: Page, base: str, platform: str = "aem_bny", **_) -> Iterator[Item]:
    bny = platform == "aem_bny"
    selectors, labels = (CARDS_BNY, DATES_BNY) if bny else (CARDS_CME, DATES_CME)
    cards, seen = page.select(selectors), set()

    def made(title: str, a: int, day: date | None, raw: str) -> Item:
        in_url = date_in_address(page.href(a), platform)
        return title, urljoin(base, page.href(a)), day or in_url, raw if day else in_url.isoformat() if in_url else "", "", ""

    for card in cards:
        a = card if page.tag[card] == "a" and page.href(card) else next(iter(page.links(card)), None)
        if a is None or (key := urljoin(base, page.href(a)).rstrip("/")) in seen:
            continue
        title = page.joined(a) or next((page.joined(h) for h in page.find(card, "h1", "h2", "h3", "h4")[:1]), "")
        if title:
            seen.add(key)
            yield made(title, a, *_card_date(page, card, a, labels))
    if cards or not bny:
        return
    for a, _, done in _each(page, base, lambda h: _probable(h, base)):
        title = page.joined(a)
        day, raw = next((f for up in page.above(a, 5) if (f := _card_date(page, up, a, labels))[0]), (None, ""))
        if len(title) >= LEAST_HEADLINE and day:
            done()
            yield made(title, a, day, raw)


EXTRACTORS: dict[str, Callable[..., Iterator[Item]]] = {
    "investorroom": investorroom,
    "q4": q4,
    "notified": notified,
    "notified_gated": lambda page, base, **o: notified(page, base, gated=True),
    "investis": investis,
    "aem_bny": lambda page, base, **o: aem(page, base, platform="aem_bny"),
    "aem_cme": lambda page, base, **o: aem(page, base, platform="aem_cme"),
}


Extractor = Callable[..., Iterator[Item]]


def link_extractor(is_detail: Callable[[str], bool], when: Callable[[Page, int], tuple[date | None, str, str]] | None = None, title: Callable[[Page, int], str] = _link_title) -> Extractor:
    """An extractor from callbacks: which addresses are releases, and a link's date, raw text and time, and its title.

    Without when, the date is the first one in the nearest five elements around the link that hold no other release.
    """

    def near(page: Page, a: int) -> tuple[date | None, str, str]:
        for up in page.above(a, 5):
            if len({page.href(x) for x in page.links(up) if is_detail(page.href(x))}) > 1:
                break
            text = " ".join(page.without(up, a))
            day, raw = find_date(text)
            if day:
                return day, raw, find_time(text)
        return None, "", ""

    def items(page: Page, base: str, **_) -> Iterator[Item]:
        for a, url, done in _each(page, base, is_detail):
            if told := title(page, a):
                done()
                yield told, url, *(when or near)(page, a), ""

    return items


def items_of(html: str | None, base: str, platform: str, segment: str | None = None, extractors: dict[str, Extractor] | None = None) -> list[Item]:
    """The items of one listing page; an empty or null page, or a platform without an extractor, has none."""
    known = extractors or EXTRACTORS
    if not html or platform not in known:
        return []
    options = {"segment": segment or "news-details"} if platform == "q4" else {}
    return list(known[platform](Page(html), base, **options))


def next_page(html: str, base: str) -> str | None:
    """Where the link to the next page goes."""
    page = Page(html)
    for a in page.links():
        text, label, rel = page.joined(a, "").lower(), page.attrs[a].get("aria-label", "").lower(), page.attrs[a].get("rel", "").lower()
        if (text in ("next", "›", "»", "next »", "next›") or "next" in label or "next" in rel) and page.href(a) not in ("", "#", "javascript:void(0)", "javascript:;"):
            return urljoin(base, page.href(a))
    return None


def last_page(html: str) -> int | None:
    """The number that the link to the last page has, else the highest that any has."""
    page = Page(html)
    number = {a: int(m[1]) for a in page.links() if (m := re.search(r"[?&]page=(\d+)", page.attrs[a]["href"]))}
    told = [n for a, n in number.items() if "last page" in page.attrs[a].get("title", "").lower()]
    return told[0] if told else max(number.values(), default=None)


def detail_date(html: str | None, platform: str = "notified") -> tuple[date | None, str]:
    """The date of a detail page: a time element, a labelled element, or the beginning of its text."""
    if not html:
        return None, ""
    page = Page(html)
    tries = []
    for t in page.find(0, "time"):
        stamp, text = page.attrs[t].get("datetime", ""), page.joined(t, "")
        tries += [stamp or text] if platform == "q4" else [stamp, text]
    if platform == "q4":
        tries.append(page.joined(0)[:4096])
    else:
        tries += [page.joined(n[0], "") for s in DATES_DETAIL if (n := page.select((s,)))]
        body = _story(page)
        tries.append(page.joined(body)[:2000] if body is not None else "")
    return next((f for t in tries if (f := find_date(t))[0]), (None, ""))


def detail_time(html: str | None) -> str:
    """The time at the beginning of a detail page's article, else main, else body; a page without one is all body."""
    if not html:
        return ""
    page = Page(html)
    return find_time(page.joined(_story(page) or 0)[:2000])


def _story(page: Page) -> int | None:
    return next((n for tag in ("article", "main", "body") for n in page.find(0, tag)[:1]), None)


def _widget(html: str | None, ending: str) -> tuple[Page, int, str, dict] | None:
    page = Page(html or "")
    for s in page.find(0, "select"):
        name = page.attrs[s].get("name", "")
        if name.endswith(ending) and len(name) > len(ending):
            hidden = {}
            for form in page.above(s, 1, "form"):
                for i in page.find(form, "input"):
                    if page.attrs[i].get("name") in ("form_id", "form_build_id"):
                        hidden.setdefault(page.attrs[i]["name"], page.attrs[i].get("value"))
            return page, s, name.removesuffix(ending), hidden
    return None


def size_widget(html: str | None) -> dict | None:
    """prefix, sizes, form_id, form_build_id of a page-size selector."""
    if (found := _widget(html, "_items_per_page")) is None:
        return None
    page, select, prefix, hidden = found
    told = [page.attrs[o].get("value") or page.joined(o, "") for o in page.find(select, "option")]
    sizes = sorted({int(t) for t in told if re.fullmatch(r"\s*[+-]?\d+\s*", t)})
    return {"prefix": prefix, "sizes": sizes, "form_id": hidden.get("form_id"), "form_build_id": hidden.get("form_build_id")} if sizes else None


def year_widget(html: str | None) -> dict | None:
    """prefix, years, has_none, default, form_id, form_build_id of a year selector; default is a year as text or _none."""
    if (found := _widget(html, "_year[value]")) is None:
        return None
    page, select, prefix, hidden = found
    years, none, default = [], False, "_none"
    for o in page.find(select, "option"):
        value = page.attrs[o].get("value", "").strip()
        if value == "_none" or re.fullmatch(r"\d+", value):
            none |= value == "_none"
            years += [int(value)] if value != "_none" else []
            default = value if "selected" in page.attrs[o] else default
    if not years and not none:
        return None
    return {"prefix": prefix, "years": sorted(years), "has_none": none, "default": default, "form_id": hidden.get("form_id"), "form_build_id": hidden.get("form_build_id")}


def _submitted(widget: dict, *first: tuple[str, str]) -> list[tuple[str, str]]:
    tail = [(k, widget[k]) for k in ("form_id", "form_build_id") if widget.get(k)]
    return [*first, ("op", "Filter"), (f"{widget['prefix']}_widget_id", widget["prefix"]), *tail]


def size_params(html: str | None, size: int) -> list[tuple[str, str]]:
    """Parameters, in order, for the largest offered page size that is not above size; none without one."""
    widget = size_widget(html)
    fit = [s for s in widget["sizes"] if s <= size] if widget else []
    return _submitted(widget, (f"{widget['prefix']}_items_per_page", str(max(fit))), (f"{widget['prefix']}_year[value]", "_none")) if fit else []


def year_params(html: str | None, years: set[int] | None) -> list[tuple[str, str]]:
    """Parameters for the one year asked for if it is offered; else for all years, if the page shows one year by itself."""
    widget = year_widget(html)
    if widget is None:
        return []
    want = str(next(iter(years))) if years and len(years) == 1 and next(iter(years)) in widget["years"] else None
    if want is None and widget["has_none"] and widget["default"] != "_none":
        want = "_none"
    return _submitted(widget, (f"{widget['prefix']}_year[value]", want)) if want else []


def first_table(html: str | None) -> list[dict[str, str]]:
    """The rows of a page's first table by its headings; short rows lack their last cells, a page without one has no rows."""
    page = Page(html or "")
    tables = page.find(0, "table")
    if not tables:
        return []
    lines = [[page.joined(c) for c in page.find(r, "td", "th") if next(page.above(c, 1, "tr")) == r] for r in page.find(tables[0], "tr") if next(page.above(r, 1, "table")) == tables[0]]
    return [dict(zip(lines[0], line)) for line in lines[1:]] if lines else []


#: What an address holds that may lead to releases, and how many of them are told.
LEADS, TOLD = ("press-release", "news-release", "investor"), 40


def empty_page_leads(html: str | None) -> list[tuple[str, str]]:
    """Of a page without items, the first links that look as if they led to some: address and text, once each."""
    page, seen = Page(html or ""), {}
    for a in page.links():
        href = page.href(a)
        if href not in seen:
            seen[href] = page.joined(a)[:80]
    return [(h, t) for h, t in seen.items() if any(lead in h.lower() for lead in LEADS)][:TOLD]


def details_segment(html: str) -> str | None:
    """The segment that most detail links of a page have; of equally frequent ones the first seen."""
    found = Counter(m.group(1) for m in re.finditer(r"(?i)/([a-z0-9]+(?:-[a-z0-9]+)*-details)/\d{4}/[^/\"'?#]+", html))
    return found.most_common(1)[0][0] if found else None
