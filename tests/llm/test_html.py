import random
from html.parser import HTMLParser

import pytest

from tessera.llm import html

LONG = "Real text of the page that goes on for a while. " * 4
TEXT = LONG.strip()


@pytest.mark.parametrize("page,text", [
    # an article that is out, or holds nothing, does not make the rest weightless
    (f"<div><p>{LONG}</div><aside><article><p>A teaser in the sidebar</article></aside>", TEXT),
    (f"<div><p>{LONG}</div><article class=comment><p>A reader says so</article>", TEXT),
    (f"<div><p>{LONG}</div><div id=comments><article><p>A reader says so</article></div>", TEXT),
    (f"<div><p>{LONG}</div><main></main>", TEXT),
    (f"<article><p>{LONG}<article class='reply odd'><p>A reader says so</article></article>", TEXT),
    # classes of the elements around the page or its text
    (f"<html class='cookie alert'><body class='has-sidebar no-sidebar menu'><p>{LONG}", TEXT),
    (f"<body id=legal><article class='comments-open legal-news'><p>{LONG}</article>", TEXT),
    (f"<body><main id=notice><article class='legal share'><p>{LONG}</article></main>", TEXT),
    # letters whose lower case is longer
    (f"<p>{'İ' * 60}</p><script>var a = '<p>';</SCRIPT><p>{LONG}", f"{'İ' * 60} {TEXT}"),
    # a paragraph that is a link, sections whose names are page furniture elsewhere
    (f"<article><p>{LONG}</p><p><a href=x>Read the full report here</a></p><p>{LONG}</p></article>", f"{TEXT} Read the full report here {TEXT}"),
    (f"<article><section class=discussion><p>{LONG}</section><section id=legal><p>{LONG}</section></article>", f"{TEXT} {TEXT}"),
    # hyphenated names without an article
    (f"<ul class=main-nav><li>Home page of this site<li>Another page of this site</ul><div id=cookie-banner><p>We use cookies on this site, as all do.</div><p>{LONG}</p>"
     f"<div class=site_footer><p>This site is run by somebody somewhere.</div>", TEXT),
    # an open quote
    (f"<p>{LONG}</p><p title=\"x>{LONG}</p><p>{LONG}</p>", f"{TEXT} {TEXT} {TEXT}"),
    # whole tokens only
    (f"<div class='no-sidebar with-comments'><p>{LONG}</div><div class='sidebar left'><p>{LONG}</div>", TEXT),
])
def test_text_is_not_lost(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("page,text", [
    # short sections are text too
    (f"<p>{LONG * 10}</p><form><p>a<p>b<p>c</form><p>A short section that stands behind a form.</p>", f"{(LONG * 10).strip()} A short section that stands behind a form."),
    # link lists and share bars inside the article, that no list of names knows
    (f"<article><h1><a href=x>Title</a></h1><p>{LONG}</p><ul><li><a>One more</a><li><a>Another</a><li><a>A third</a></ul><p><a>Tell</a> <a>Send</a></article>",
     f"Title {TEXT}"),
    # adverts do not cut an article
    (f"<article><p>{LONG}</p><div class=ad><p>a<p>b<p>c<p>d</div><p>The end.</article>", f"{TEXT} The end."),
    # a teaser that does not surge is not the article of the page
    (f"<div><p>{LONG}</div><ul><li><a>x</a><li><a>y</a><li><a>z</a></ul><article><p>Teaser</article>", TEXT),
])
def test_windows_decide(page, text):
    assert html.main_text(page) == text


class Lines(HTMLParser):
    """Blocks of a well-formed page: [text, out, inside, link characters]."""

    def __init__(self):
        super().__init__()
        self.open, self.found = [], [["", False, False, 0]]

    def _cut(self):
        tags = [t for t, _ in self.open]
        self.found.append(["", any(o for _, o in self.open), "article" in tags, 0])

    def handle_starttag(self, tag, attrs):
        self.open.append((tag, tag in ("nav", "footer", "form", "aside") or dict(attrs).get("class") in ("ad", "comments")))
        if tag not in ("a", "b"):
            self._cut()

    def handle_endtag(self, tag):
        self.open.pop()
        if tag not in ("a", "b"):
            self._cut()

    def handle_data(self, data):
        self.found[-1][0] += data
        tags = {t for t, _ in self.open}
        self.found[-1][3] += len(data) if "a" in tags and not ("h2" in tags and "article" in tags) else 0


def oracle(page):
    p = Lines()
    p.feed(page)
    rows = [(" ".join(t.split()), o, i, n) for t, o, i, n in p.found if t.strip()]
    seen = [k for k, r in enumerate(rows) if not r[1]]
    lone = {k for a, k, b in zip(seen, seen[1:], seen[2:]) if rows[k][2] and all(rows[j][2] and rows[j][3] <= 0.6 * len(rows[j][0]) for j in (a, b))}
    weighs = [not o and (n <= 0.6 * len(t) or k in lone) for k, (t, o, i, n) in enumerate(rows)]
    plain = [(r[0], len(r[0]) if w else 0) for r, w in zip(rows, weighs)]
    inner = [(t, len(t) if i and w else 0) for (t, o, i, n), w in zip(rows, weighs) if not (o and i)]

    def surging(lines):
        return any(sum(w for _, w in lines[k:k + 3]) >= 40 for k in range(len(lines)))
    use = inner if any(w for _, w in inner) and (surging(inner) or not surging(plain)) else plain
    groups, gap = [[]], 0
    for t, w in use:
        gap = 0 if w else gap + 1
        if gap == 3:
            groups.append([])
        elif gap < 3:
            groups[-1].append((t, w))
    if surging(use):
        groups = [g for g in groups if surging(g)]
    return " ".join(t for g in groups for t, w in g if w)


def test_against_an_independent_oracle():
    rng = random.Random(4)

    def some(n):
        return " ".join(rng.choice(["stone", "river", "a", "window", "by"]) for _ in range(rng.randrange(1, n)))

    def part():
        k = rng.randrange(9)
        links = "".join(f"<li><a href='x'>{some(4)}</a></li>" for _ in range(rng.randrange(1, 6)))
        return [f"<p>{some(30)}</p>", f"<p>{some(4)}</p>", f"<ul>{links}</ul>", f"<p>{some(3)} <a href='y'>{some(6)}</a></p>",
                f"<h2><a href='z'>{some(5)}</a></h2>", f"<div class='ad'>{'<p>buy</p>' * rng.randrange(1, 5)}</div>", f"<nav><ul>{links}</ul></nav>",
                f"<form><p>{some(6)}</p><p>{some(6)}</p><p>send</p></form>", f"<aside><article><p>{some(20)}</p></article></aside>"][k]

    def parts():
        return "".join(part() for _ in range(rng.randrange(7)))
    kept = 0
    for n in range(3000):
        page = parts() + (f"<article>{parts()}</article>" if n % 2 else "") + parts() + (f"<article>{parts()}</article>" if n % 3 == 0 else "")
        assert html.main_text(page) == oracle(page), page
        kept += bool(oracle(page))
    assert kept > 2000


@pytest.mark.parametrize("page", ["<p>a<b \"" * 12_000, "<p>" + "<a '\">x" * 12_000, "<span class=ad>x</b>" * 8_000, "<span class=ad>" * 20_000 + "</i>" * 20_000,
                                  "<!-- <p" * 20_000, "<" * 100_000, "<script>" * 20_000, "</" * 50_000])
def test_hostile_pages_take_no_longer_than_their_length(page):
    import time
    began = time.process_time()
    html.main_text(page)
    assert time.process_time() - began < 2
