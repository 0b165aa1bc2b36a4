"""One small site per known company; the expected profile is written by hand."""

import datetime

import pytest

from pagefolio.plans.profile import company_profiles
from pagefolio.sources.sites import SITES, site_rules

LONG = "word " * 21 + "end"
LONGER = "word " * 31 + "end"

# company -> {path: html or (html, status)}
PAGES = {
    "SolarKal": {
        "/our-services": '<section class="dblue-bg s"><p>no</p></section>'
        '<section class="s dblue-bg"><h2>x</h2></section>'
        '<section class="s dblue-bg"><p> We sell <b>sun</b></p></section>',
        "/featured-clients": '<html><body><div><section class="s less-padding"><img src="/a/no">'
        '</section></div><section class="x s less-padding">'
        '<img src="https://cdn.x.com/5f3a_66ab_Acme%20Corp%20logo.png"><img>'
        '<img src="5f3a_one%20Big%20Co.png"><img src="5f3a_one%20Big%20Co.png"></section></body></html>',
        "/blog/solar-hedge-against-rising-energy-costs": '<section class="half-bottom"><h1>Hedge</h1>'
        '</section><div class="div-block-25"><p>1</p><p>2</p><p>May 3</p></div>'
        "<p>4</p><p>5</p><p>6</p><p>7</p><p>Sum <i>up</i></p>",
    },
    "H2scan": {
        "/about/": '<section class="my-one-col-text-block-x"><p> </p><p>Hydrogen</p></section>',
        "/": '<img src="/logo.png"><div class="logo-carousel"><img src="/w/acme-corp-1024x343-1.png">'
        '<img src="/a_b_2021.JPG"><img src="/w2/acme-corp-99.png"></div>',
        "/news/can-you-afford-not-to-transformer-downtime": (
            "<div>Topics: Gas </div><div>Published By: Traci Hopkins on September 25, 2025</div>"
            "<h2>Afford</h2><p>Sum</p>",
            404,
        ),
    },
    "EOCharging": {
        "/about-us/": f'<p>first</p><div class="x-content"><span>{LONGER}</span></div>',
        "/": '<img src="/logo/b.svg"><img src="/x/c.png"><img src="/client/d_e.webp">',
        "/news/": '<a href="/n1"><img></a><a href="n2">Go</a>',
        "/n2": "<h1>T</h1><i>In 2024 we</i><i>by By Ann </i><p>S</p>",
    },
    "Prewave": {
        "/about-us/": f'<p>first</p><div class="about"><p>short</p><p>{LONG}</p></div>',
        "/": '<img src="/x/none.png">',
        "/news/": '<a href="https://www.prewave.com/n">Go</a>',
        "/n": "<h2>T</h2><time> May 1 </time><i>Standby power</i><p>S</p>",
    },
    "ChargePoint": {
        "/about/": f'<p>first</p><p>{LONG}</p><section class="hero"><p>{"w " * 20}</p></section>',
        "/": '<img src="/partner/x-2x3.png"><img src="/logo/y--z.png"><img src="/client/x.png">',
        "/about/news": "<a>none</a>",
    },
    "EasyMil": {
        "/about-us/": f"<section><div><p>{LONG}</p></div></section>",
        "/": '<div class="success-stories"><img src="/q/one.png"></div>',
    },
    "EverstreamAnalytics": {
        "/company/about-everstream/": (f'<p class="content">{LONG}</p>', 500),
        "/": '<div class="partner"><img src="a.png"></div><a href="#top">Skip</a>'
        "<h1>Home</h1><p>Hello</p>",
        "/company/media/": ("<a href=x>no</a>", 404),
    },
    "AltusPower": {
        "/about-us": f'<p>{LONG}</p><div class="about-us"><p>{LONG}</p></div>'
        '<div class="partners"><img src="/two.png"><img src="/one.png"></div>',
        "/": '<div class="clients"><img src="/one.png"></div><img src="/Logo/three.png">',
        "/news": '<a href="/first">First</a><a href="//go">go to ARTICLE now</a>',
        "/go": "<h1>Go</h1><p>By  me</p>",
    },
    "CharmIndustrial": {
        "/company": ("gone", 404),
        "/": f'<section><p>{LONG}</p></section><img src="/stripe.png">',
        "/blog": ("", 301),
        "/resources": "<a href=post>Post</a>",
    },
    "AllSpace": {
        "/about-us": "<h1>no paragraph</h1>",
        "/": f'<p>{LONG}</p><div class="trusted-by"><img src="t-1.png"></div>',
        "/insights/category/press-releases": ("", 204),
        "/insights": ("", 503),
    },
    "CabanEnergy": {
        "/en": f'<div class="about"><p>{LONG}</p></div><img src="logo.svg">',
        "/blog": '<a href="/b">B</a>',
        "/en/news": '<a href="/c">C</a>',
        "/b": "<p>no title</p>",
    },
    "BioBTX": {
        "/about-us/": f'<div class="intro"><div><p>{LONG}</p></div></div>',
        "/": '<a href="/">Home</a><h2>Bio</h2>',
    },
    "InfinitedFiber": {
        "/about-us/": '<div class="elementor-widget-container"><i>x</i></div>'
        '<div class="elementor-widget-container"><p>second</p></div>',
        "/": '<img src="ab_New%20Fibre%20Co.png">',
        "/news/": "<article><h2>Head</h2><p>Sum</p></article><time>no</time>",
    },
    "Iogen": {
        "/about-us/": ('<div class="a text-block"><p>Fuel</p></div>', 404),
        "/our-partners/": "<p>none</p>",
        "/news/": "<h2>no article</h2>",
    },
    "Hydrogenious": {
        "/": '<div class="elementor-widget-container"><p></p></div><img src="x">',
    },
}


def n5(url, title="N/A", date="N/A", author="N/A", summary="N/A"):
    return f"url: {url}\n\ntitle: {title}\ndate: {date}\nauthor: {author}\nsummary: {summary}\n"


# company -> (description, clients, news)
EXPECTED = {
    "SolarKal": (
        "We sellsun",
        "Acme Corp,Big Co,Big Co",
        "url: https://www.solarkal.com/blog/solar-hedge-against-rising-energy-costs\n\n"
        "heading: Hedge\n\ndate: May 3\n\nsummary : Sumup\n\n",
    ),
    "H2scan": (
        "Hydrogen",
        "Acme Corp,A B",
        "url: https://h2scan.com/news/can-you-afford-not-to-transformer-downtime\n\n"
        "topic: Gas\n\nauthor: Traci Hopkins\ndate: September 25, 2025\n\ntitle: Afford\n\n"
        "summary: Sum\n\n",
    ),
    "EOCharging": (
        LONGER,
        "B.Svg,D E",
        n5("https://www.eocharging.com/n2", "T", "In 2024 we", "by  Ann", "S"),
    ),
    "Prewave": (
        LONG,
        "",
        "url: https://www.prewave.com/n\n\ntitle: T\n\nauthor: Standby power\ndate: May 1\n\n"
        "summary: S\n\n",
    ),
    "ChargePoint": ("first", "X,Y Z", "No news found."),
    "EasyMil": (LONG, "One", None),
    "EverstreamAnalytics": (
        None,
        "A",
        n5("https://www.everstream.ai/#top", "Home", summary="Hello"),
    ),
    "AltusPower": (
        LONG,
        "One,Three,Two",
        n5("https://www.altuspower.com/go", "Go", author="By  me", summary="By  me"),
    ),
    "CharmIndustrial": (LONG, "Stripe", "url: https://www.charmindustrial.com/post\n\n"),
    "AllSpace": (None, "T", None),
    "CabanEnergy": (LONG, "Logo.Svg", n5("https://www.cabanenergy.com/b", summary="no title")),
    "BioBTX": (LONG, None, n5("https://biobtx.com/", "Bio")),
    "InfinitedFiber": (
        "",
        "Fibre Co",
        "url: https://infinitedfiber.com/news/\n\nheading: Head\n\ndate: \n\nsummary: Sum\n\n",
    ),
    "Iogen": ("Fuel", "", "url: https://www.iogen.com/news/\n\n"),
    "Hydrogenious": ("", "", None),
}


def crawl(spark):
    rows, roots = [], {s["company"]: s["root"] for s in SITES}
    for company, pages in PAGES.items():
        for path, page in pages.items():
            html, status = page if isinstance(page, tuple) else (page, 200)
            # An older crawl of every page, which must not be used.
            rows.append((len(rows), roots[company] + path, "<p>old</p>", 200))
            rows.append((len(rows), roots[company] + path, html, status))
    rows += rows[: len(rows) // 2]  # copies
    return spark.createDataFrame(rows, "page_id long, url string, html string, status int")


@pytest.fixture(scope="module")
def profiles(spark):
    day = datetime.date(2025, 9, 1)
    return company_profiles(crawl(spark), site_rules(spark), run_date=day).collect()


@pytest.mark.parametrize("company", list(PAGES))
def test_profile(profiles, company):
    rows = [r for r in profiles if r.company == company]
    site = next(s for s in SITES if s["company"] == company)
    assert sorted(r.company_id or "" for r in rows) == sorted(i or "" for i in site["ids"])
    for row in rows:
        assert (row.description, row.clients, row.news) == EXPECTED[company]
        assert (row.updt_date, row.filename) == (datetime.date(2025, 9, 1), company)


def test_dispatch(spark):
    ids = ["12008", "400", "unknown"]
    rows = company_profiles(crawl(spark), site_rules(spark), ids).collect()
    assert {(r.company_id, r.company) for r in rows} == {
        ("12008", "ChargePoint"),
        ("400", "CabanEnergy"),
    }
    empty = spark.createDataFrame([], "page_id long, url string, html string, status int")
    rows = company_profiles(empty, site_rules(spark), ids).collect()
    assert [(r.description, r.clients, r.client_names, r.news) for r in rows] == [(None,) * 4] * 2


def test_news_fields_and_names(profiles):
    row = next(r for r in profiles if r.company == "EOCharging")
    assert row.client_names == ["B.Svg", "D E"]
    assert row.news_fields.asDict() == {
        "url": "https://www.eocharging.com/n2", "topic": None, "title": "T",
        "date": "In 2024 we", "author": "by  Ann", "summary": "S",
    }
