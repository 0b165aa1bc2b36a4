"""The rules of the fifteen known sites.

Everything in ``SITES`` and the constants above it are fixed values: company ids, addresses,
class names, word limits, messages and layouts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagefolio.functions.selectors import alt, cond, pick, tags
from pagefolio.sources.rules import rules_table

# Java patterns for the strings that carry a date or an author.
ANY_TEXT = r"(?d).+"
YEAR = r"(?U)\b\d{4}\b"
BY_SPACE = "(?i)By "
BY_BLANK = r"(?iU)By[\s\x1c-\x1f]"


def paragraphs_in(*boxes: dict) -> list[dict]:
    return [alt("p", within=box) for box in boxes]


def images(*parts: str, in_classes: tuple[str, ...] = ()) -> list[dict]:
    """Images whose address contains one of ``parts`` or that sit in one of the classes."""
    by_address = [alt("img", attr="src", attr_sub=part) for part in parts]
    return by_address + [alt("img", within=cond(classes=[c])) for c in in_classes]


def in_class(name: str, tag: str | None = None) -> dict:
    return cond(tag, [name])


HEADING = pick(tags("h1", "h2"), default="N/A")
TIME_TAG = pick(tags("time"), default="N/A")
FIRST_PARAGRAPH = pick(tags("p"), default="N/A")
BY_LINE = pick(string_pattern=BY_BLANK, default="N/A")
BY_NAME = pick(string_pattern=BY_SPACE, remove="By", default="N/A")

ARTICLE = {"title": HEADING, "date": TIME_TAG, "author": BY_LINE, "summary": FIRST_PARAGRAPH}
TEASER = tags("article")
TEASER_FIELDS = {
    "title": pick(tags("h2"), TEASER, default=""),
    "date": pick(tags("time"), TEASER, default=""),
    "summary": pick(tags("p"), TEASER, default=""),
}
TEXT_LINK = [alt("a", attr="href", string_pattern=ANY_TEXT)]

INTRO_BOXES = [in_class("hero", "section"), in_class("intro"), in_class("content"), in_class("about")]
USUAL_LOGOS = images("logo", "Logo", "client", in_classes=("partner",))

# ``about``, ``clients`` and ``news`` list candidate pages, best first; ``more_clients`` is a
# second page whose images follow those of the first.
SITES = [
    {
        "company": "SolarKal", "ids": ["5875"], "root": "https://www.solarkal.com",
        "check_status": False,
        "about": ["/our-services"],
        "description": pick([alt("p", within=cond("section", class_eq="s dblue-bg"))]),
        "clients": ["/featured-clients"],
        "images": pick(
            tags("img"), [alt("section", ["s", "less-padding"], child_of=cond("body"))]
        ),
        "cleaner": "A", "distinct_names": False, "empty_value": "",
        "article": "/blog/solar-hedge-against-rising-energy-costs",
        "fields": {
            "title": pick(tags("h1"), [alt("section", ["half-bottom"])]),
            "date": pick(tags("p"), [alt("div", ["div-block-25"])], nth=2),
            "summary": pick(tags("p"), nth=7),
        },
        "layout": "N2",
    },
    {
        "company": "H2scan", "ids": ["11917"], "root": "https://h2scan.com",
        "about": ["/about/"],
        "description": pick(
            paragraphs_in(cond("section", class_sub=["one-col-text-block"])), min_words=0
        ),
        "clients": ["/"], "images": pick(images(in_classes=("logo-carousel",))),
        "empty_value": "",
        "article": "/news/can-you-afford-not-to-transformer-downtime",
        "article_check_status": False,
        "fields": {
            "topic": pick(string_pattern="Topics:", remove="Topics:", default="N/A"),
            "title": HEADING,
            "date": pick(
                string_pattern="Published By:", remove="Published By:", split_on=" on ",
                split_part=1, default="N/A",
            ),
            "author": pick(
                string_pattern="Published By:", remove="Published By:", split_on=" on ",
                split_part=0, default="N/A",
            ),
            "summary": FIRST_PARAGRAPH,
        },
        "layout": "N3",
    },
    {
        "company": "EOCharging", "ids": ["34005"], "root": "https://www.eocharging.com",
        "about": ["/about-us/"],
        "description": pick(
            [alt("p", class_sub=["about", "content"]), alt("div", class_sub=["about", "content"])],
            min_words=30, fallback=tags("p"),
        ),
        "clients": ["/"], "images": pick(images("logo", "client", "partner")),
        "news": ["/news/"], "no_link_text": "No news articles found.",
        "fields": {**ARTICLE, "date": pick(string_pattern=YEAR, default="N/A"), "author": BY_NAME},
    },
    {
        "company": "Prewave", "ids": ["65212"], "root": "https://www.prewave.com",
        "about": ["/about-us/"],
        "description": pick(
            paragraphs_in(
                cond("section", class_sub=["about", "content"]),
                cond("div", class_sub=["about", "content"]),
            ),
            min_words=20, fallback=tags("p"),
        ),
        "clients": ["/"], "images": pick(images("logo", "client", "partner", "customer")),
        "empty_value": "",
        "news": ["/news/"], "no_link_text": "No articles found.",
        "fields": {**ARTICLE, "author": BY_NAME}, "layout": "N4",
    },
    {
        "company": "ChargePoint", "ids": ["18533", "6134", "12008", "6997"],
        "root": "https://www.chargepoint.com",
        "about": ["/about/"],
        "description": pick(
            paragraphs_in(
                in_class("hero", "section"), in_class("intro", "section"),
                in_class("about-text"), in_class("why-chargepoint"),
            ),
            min_words=20, fallback=tags("p"),
        ),
        "clients": ["/"], "images": pick(images("logo", "partner", "client")),
        "news": ["/about/news"], "no_link_text": "No news found.",
    },
    {
        "company": "EasyMil", "ids": ["2805"], "root": "https://www.easymile.com",
        "about": ["/about-us/"],
        "description": pick(
            paragraphs_in(
                cond("section"), in_class("about-text"), in_class("intro"), in_class("content")
            ),
            min_words=20, fallback=tags("p"),
        ),
        "clients": ["/"],
        "images": pick(images("logo", "partner", "client", in_classes=("success-stories",))),
        "news": ["/news"], "no_link_text": "No news articles found.",
    },
    {
        "company": "EverstreamAnalytics", "ids": ["101741"], "root": "https://www.everstream.ai",
        "about": ["/company/about-everstream/"],
        "description": pick(paragraphs_in(*INTRO_BOXES), min_words=20, fallback=tags("p")),
        "clients": ["/"], "images": pick(USUAL_LOGOS),
        "news": ["/company/media/", "/"], "no_link_text": "No news articles found.",
    },
    {
        "company": "AltusPower", "ids": ["110133"], "root": "https://www.altuspower.com",
        "about": ["/about-us"],
        "description": pick(
            paragraphs_in(
                cond("section"), in_class("about-us"), in_class("content"), in_class("about")
            ),
            min_words=20, fallback=tags("p"),
        ),
        "clients": ["/"], "images": pick(images("logo", "Logo", in_classes=("logo", "clients"))),
        "more_clients": ["/about-us"],
        "more_images": pick(images("logo", in_classes=("clients", "partners"))),
        "news": ["/news"],
        "link": pick(
            [alt("a", attr="href", string_pattern="(?i)Go to article")],
            fallback=[alt("a", attr="href")],
        ),
        "no_link_text": "No news articles found.",
    },
    {
        "company": "CharmIndustrial", "ids": ["12605"], "root": "https://www.charmindustrial.com",
        "about": ["/company", "/"],
        "description": pick(
            paragraphs_in(
                cond("section"), in_class("company"), in_class("about"), in_class("mission"),
                in_class("intro"),
            ),
            min_words=20, fallback=tags("p"),
        ),
        "clients": ["/"],
        "images": pick(
            images("logo", "Logo", "frontier", "alphabet", "meta", "shopify", "stripe")
        ),
        "news": ["/blog", "/resources"], "no_link_text": "No articles found.",
    },
    {
        "company": "AllSpace", "ids": ["105894"], "root": "https://www.all.space",
        "about": ["/about-us", "/"],
        "description": pick(
            paragraphs_in(
                in_class("about", "section"), in_class("about-us"), in_class("intro"),
                in_class("content"),
            ),
            min_words=20, fallback=tags("p"),
        ),
        "clients": ["/"],
        "images": pick(images("logo", "client", "partner", in_classes=("partners", "trusted-by"))),
        "news": ["/insights/category/press-releases", "/insights"],
        "no_link_text": "No articles found.",
    },
    {
        "company": "CabanEnergy", "ids": ["400"], "root": "https://www.cabanenergy.com",
        "about": ["/en"],
        "description": pick(paragraphs_in(*INTRO_BOXES), min_words=20, fallback=tags("p")),
        "clients": ["/en"], "images": pick(USUAL_LOGOS),
        "news": ["/news", "/press-release", "/blog", "/en/news", "/"],
        "no_link_text": "No news articles found.",
    },
    {
        "company": "BioBTX", "ids": ["34204"], "root": "https://biobtx.com",
        "about": ["/about-us/"],
        "description": pick(paragraphs_in(*INTRO_BOXES), min_words=20, fallback=tags("p")),
        "clients": ["/"], "images": pick(USUAL_LOGOS),
        "news": ["/news", "/news/", "/"], "no_link_text": "No news articles found.",
    },
    {
        "company": "InfinitedFiber", "ids": [None], "root": "https://infinitedfiber.com",
        "check_status": False,
        "about": ["/about-us/"],
        "description": pick(tags("p"), [alt("div", ["elementor-widget-container"])], default=""),
        "clients": ["/"], "images": pick(tags("img")),
        "cleaner": "A", "distinct_names": False, "empty_value": "",
        "article": "/news/", "gate": TEASER, "fields": TEASER_FIELDS, "layout": "N1",
    },
    {
        "company": "Iogen", "ids": [None], "root": "https://www.iogen.com",
        "check_status": False,
        "about": ["/about-us/"],
        "description": pick(tags("p"), [alt("div", ["text-block"])], default=""),
        "clients": ["/our-partners/"], "images": pick(tags("img")),
        "cleaner": "A", "distinct_names": False, "empty_value": "",
        "article": "/news/", "gate": TEASER, "fields": TEASER_FIELDS, "layout": "N1",
    },
    {
        "company": "Hydrogenious", "ids": [None], "root": "https://hydrogenious.net",
        "check_status": False,
        "about": ["/"],
        "description": pick(tags("p"), [alt("div", ["elementor-widget-container"])], default=""),
        "clients": ["/"], "images": pick(tags("img")),
        "cleaner": "A", "distinct_names": False, "empty_value": "",
        "article": "/news/", "gate": TEASER, "fields": TEASER_FIELDS, "layout": "N1",
    },
]


def site_rows(site: dict, company_id: str | None) -> list[dict]:
    """The rules rows of one site under one company id."""
    root = site["root"]

    def rows(output: str, paths: list[str], part: int = 0, **values) -> list[dict]:
        return [
            {
                "company_id": company_id, "company": site["company"], "output": output,
                "part": part, "priority": i, "url": root + path,
                "check_status": site.get("check_status", True), **values,
            }
            for i, path in enumerate(paths)
        ]

    clients = {
        "cleaner": site.get("cleaner", "B"),
        "distinct_names": site.get("distinct_names", True),
        "empty_value": site.get("empty_value"),
    }
    article = {"fields": site.get("fields", ARTICLE), "layout": site.get("layout", "N5")}
    found = rows("description", site["about"], pick=site["description"])
    found += rows("clients", site["clients"], pick=site["images"], **clients)
    if "more_clients" in site:
        found += rows("clients", site["more_clients"], 1, pick=site["more_images"], **clients)
    if "article" in site:
        fixed = rows("article", [site["article"]], gate=site.get("gate"), **article)
        for row in fixed:
            row["check_status"] = site.get("article_check_status", row["check_status"])
        found += fixed
    else:
        found += rows(
            "news", site["news"], pick=site.get("link", pick(TEXT_LINK)), base_url=root,
            no_link_text=site["no_link_text"], **article,
        )
    return found


def site_rules(spark: SparkSession) -> DataFrame:
    """The rules table of all known sites."""
    return rules_table(
        spark, [row for site in SITES for i in site["ids"] for row in site_rows(site, i)]
    )
