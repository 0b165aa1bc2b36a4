"""Selectors as data, and the Spark expressions that evaluate them.

A selector is a list of alternatives (a comma list in CSS terms). It is a column value, so
the selectors of any number of sites can sit in one rules table and be evaluated in a single
pass; one that is known when a query is built is a ``Constant``, whose unset conditions fold away.
Everything here is a narrow per-page expression over the ``nodes`` array: no shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagefolio.functions.text import let

COND_FIELDS = "tag:string,class_all:array<string>,class_eq:string,class_sub:array<string>"
ALT_DDL = (
    f"array<struct<{COND_FIELDS},attr:string,attr_sub:string,string_pattern:string,"
    f"within:struct<{COND_FIELDS}>,within_parent:boolean>>"
)
# How one value is picked from a page; see ``pick_node`` and ``pick_string``.
PICK_DDL = (
    f"struct<match:{ALT_DDL},container:{ALT_DDL},nth:int,min_words:int,fallback:{ALT_DDL},"
    "string_pattern:string,remove:string,split_on:string,split_part:int,default:string>"
)


# -- building selector values ------------------------------------------------------------
def cond(tag=None, classes=None, class_eq=None, class_sub=None) -> dict:
    """Test on one element. ``classes``: all of these; ``class_sub``: any of these substrings."""
    return {"tag": tag, "class_all": classes, "class_eq": class_eq, "class_sub": class_sub}


def alt(
    tag=None,
    classes=None,
    class_eq=None,
    class_sub=None,
    attr=None,
    attr_sub=None,
    string_pattern=None,
    within=None,
    child_of=None,
) -> dict:
    """One alternative: tests on the element and, optionally, on an ancestor or the parent."""
    return {
        **cond(tag, classes, class_eq, class_sub),
        "attr": attr,
        "attr_sub": attr_sub,
        "string_pattern": string_pattern,
        "within": within or child_of,
        "within_parent": child_of is not None,
    }


def tags(*names: str) -> list[dict]:
    return [alt(tag=n) for n in names]


def pick(
    match=None,
    container=None,
    nth=0,
    min_words=None,
    fallback=None,
    string_pattern=None,
    remove=None,
    split_on=None,
    split_part=None,
    default=None,
) -> dict:
    return {
        "match": match,
        "container": container,
        "nth": nth,
        "min_words": min_words,
        "fallback": fallback,
        "string_pattern": string_pattern,
        "remove": remove,
        "split_on": split_on,
        "split_part": split_part,
        "default": default,
    }


_TYPES = {
    "class_all": "array<string>", "class_sub": "array<string>", "within_parent": "boolean",
    "nth": "int", "min_words": "int", "split_part": "int",
}


class Constant:
    """A pick, alternative or condition with the fields of the column value, as literals.

    Selectors in it are lists of constants, and a selector or condition that is not set is None.
    """

    def __init__(self, values: dict) -> None:
        self.values = values

    def __getitem__(self, name: str) -> Column | Constant | list[Constant] | None:
        value = self.values[name]
        if name in ("match", "container", "fallback"):
            return None if value is None else selector(*value)
        if name == "within":
            return None if value is None else Constant(value)
        literal = F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value)
        return literal.cast(_TYPES.get(name, "string"))


def selector(*alts: dict) -> list[Constant]:
    """Constant alternatives, for use with ``matched`` in ad hoc queries."""
    return [Constant(a) for a in alts]


def pick_constant(**fields) -> Constant:
    """A constant pick."""
    return Constant(pick(**fields))


# -- evaluating --------------------------------------------------------------------------
def _meets(node: Column, c: Column | Constant) -> Column:
    """All conditions that are set hold for the element; null counts as no, as it does in filters."""
    klass = node["class_attr"]
    return (
        (c["tag"].isNull() | (node["tag"] == c["tag"]))
        & (c["class_eq"].isNull() | (klass == c["class_eq"]))
        & (c["class_sub"].isNull() | F.exists(c["class_sub"], lambda s: klass.contains(s)))
        & _has_classes(klass, c)
    )


def _has_classes(klass: Column, c: Column | Constant) -> Column:
    """The class attribute, tokens with one space between them, holds all of ``class_all``."""
    if isinstance(c, Constant):
        wanted = c.values["class_all"]
        if wanted is None:
            return F.lit(True)
        if wanted and all(t and " " not in t for t in wanted):
            padded = F.concat(F.lit(" "), klass, F.lit(" "))
            return reduce(and_, (padded.contains(f" {t} ") for t in wanted))
    tokens = F.split(klass, " ")
    return c["class_all"].isNull() | (F.size(F.array_except(c["class_all"], tokens)) == 0)


def own_string(nodes: Column, node: Column) -> Column:
    """The only string of an element, however deep it lies in elements without others."""
    return F.get(nodes, node["own_at"])["own_string"]


def _meets_alone(nodes: Column, node: Column, a: Column | Constant) -> Column:
    """The element's own side of an alternative: tag, class, attribute, string."""
    value = F.when(a["attr"] == "class", node["class_attr"]).otherwise(
        F.try_element_at(node["attrs"], a["attr"])
    )
    return (
        _meets(node, a)
        & (a["attr"].isNull() | value.isNotNull())
        & (a["attr_sub"].isNull() | value.contains(a["attr_sub"]))
        & (a["string_pattern"].isNull() | F.rlike(own_string(nodes, node), a["string_pattern"]))
    )


def inside(node: Column, box: Column) -> Column:
    return (node["id"] > box["id"]) & (node["id"] <= box["last"])


def outermost(nodes: Column) -> Column:
    """``id, last`` of the elements, in document order, that lie in none of the others.

    An element inside another adds nothing to "inside any".
    """
    bounds = F.transform(nodes, lambda n: F.struct(n["id"].alias("id"), n["last"].alias("last")))
    empty = F.filter(bounds, lambda b: F.lit(False))
    end = lambda kept: F.coalesce(F.try_element_at(kept, F.lit(-1))["last"], F.lit(-1))
    return F.aggregate(
        bounds, empty, lambda kept, b: F.when(b["id"] > end(kept), F.concat(kept, F.array(b))).otherwise(kept)
    )


def _matched_constant(nodes: Column, alts: list[Constant], among: Column | None = None) -> Column:
    """``matched`` for constant alternatives: only what they set is looked at."""
    boxed = [a for a in alts if a["within"] is not None and not a.values["within_parent"]]

    def meets(n: Column, a: Constant, ready: Column | None) -> Column:
        alone = _meets_alone(nodes, n, a)
        if a in boxed:
            return alone & F.exists(F.get(ready, F.lit(boxed.index(a))), lambda b: inside(n, b))
        if a["within"] is not None:
            return alone & _meets(F.get(nodes, n["parent"]), a["within"])
        return alone

    def boxes(a: Constant) -> Column:
        return outermost(F.filter(nodes, lambda n: _meets(n, a["within"])))

    def found(ready: Column | None) -> Column:
        return F.filter(
            nodes if among is None else among,
            lambda n: reduce(or_, (meets(n, a, ready) for a in alts), F.lit(False)),
        )

    return let(F.array(*map(boxes, boxed)), found) if boxed else found(None)


def _candidates(nodes: Column, p: Constant) -> Column:
    """The matches of a constant pick, looked for only inside the first container if it names one."""
    match, container = p["match"] or [], p["container"]
    if container is None:
        return _matched_constant(nodes, match)
    # An element's id is its position, so what lies inside an element is a slice of the elements.
    return let(
        first(_matched_constant(nodes, container)),
        lambda box: _matched_constant(nodes, match, F.slice(nodes, box["id"] + 2, box["last"] - box["id"])),
    )


def matched(nodes: Column, alts: Column | list[Constant] | None) -> Column:
    """Elements that meet any alternative, in document order, each once.

    The elements named by ``within`` are looked up once per page and alternative; an element
    is tested against their id ranges, so no ancestor lists are stored.
    """
    if not isinstance(alts, Column):
        return _matched_constant(nodes, alts or [])

    def prepared(a: Column) -> Column:
        boxes = outermost(F.filter(nodes, lambda n: _meets(n, a["within"])))
        return F.struct(
            a.alias("alt"),
            F.when(a["within"].isNotNull() & ~a["within_parent"], boxes).alias("boxes"),
        )

    def meets(n: Column, p: Column) -> Column:
        a = p["alt"]
        parent = F.get(nodes, n["parent"])
        return _meets_alone(nodes, n, a) & (
            F.when(a["within"].isNull(), True)
            .when(a["within_parent"], _meets(parent, a["within"]))
            .otherwise(F.exists(p["boxes"], lambda b: inside(n, b)))
        )

    return let(
        F.transform(alts, prepared),
        lambda ready: F.filter(nodes, lambda n: F.exists(ready, lambda p: meets(n, p))),
    )


def first(items: Column) -> Column:
    return F.get(items, F.lit(0))


def matched_sets(nodes: Column, p: Column) -> Column:
    """What ``match`` and ``container`` of a pick match, as an array of two."""
    selectors = F.array(p["match"], p["container"])
    return F.transform(selectors, lambda alts: matched(nodes, alts))


def in_container(sets: Column, p: Column) -> Column:
    """The matches, limited to the first container of the page if the pick names one."""
    found, box = F.get(sets, F.lit(0)), first(F.get(sets, F.lit(1)))
    return F.when(p["container"].isNull(), found).otherwise(
        F.filter(found, lambda n: F.coalesce(inside(n, box), F.lit(False)))
    )


def _chosen(nodes: Column, candidates: Column, p: Column | Constant) -> Column:
    """The nth candidate with more than ``min_words`` words, else the first ``fallback`` match.

    The fallback is only looked for where it is needed.
    """
    if not isinstance(p, Constant) or p.values["min_words"] is not None:
        candidates = F.filter(
            candidates, lambda n: p["min_words"].isNull() | (n["words"] > p["min_words"])
        )
    nth = F.get(candidates, p["nth"])
    if isinstance(p, Constant) and p["fallback"] is None:
        return nth
    return F.coalesce(nth, first(matched(nodes, p["fallback"])))


def chosen_node(nodes: Column, sets: Column, p: Column) -> Column:
    """The element that a pick chooses from what it matches."""
    return _chosen(nodes, in_container(sets, p), p)


def pick_node(nodes: Column, p: Column | Constant) -> Column:
    if isinstance(p, Constant):
        return _chosen(nodes, _candidates(nodes, p), p)
    return let(matched_sets(nodes, p), lambda sets: chosen_node(nodes, sets, p))


def text_of(text: Column, node: Column) -> Column:
    """Text of an element: its slice of the text of the page."""
    return let(node, lambda n: F.substring(text, n["start"] + 1, n["len"]))


def pick_string(strings: Column, p: Column | Constant) -> Column:
    """First string of the page that matches ``string_pattern``, unstripped."""
    return first(F.filter(strings, lambda s: F.rlike(s["text"], p["string_pattern"])))["text"]
