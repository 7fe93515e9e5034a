"""Element selection over the list that :mod:`shelfline.functions.html` builds.

A :class:`Sel` names one element; ``a / b`` means "b somewhere inside a". Selectors are data:
they enter a query as one literal array, and one expression matches elements against it, so
the size of a plan does not grow with the number of selectors.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, fields, is_dataclass, replace

from pyspark.sql import Column, functions as F

from .text import blank_to_null, strip

_COMPOUND = (
    "tag:string,classes:array<string>,attr:string,equals:string,contains:string"
)
_RULES = f"array<struct<field:string,{_COMPOUND},outer:array<struct<{_COMPOUND}>>>>"
_MAX_OUTER = 2


@dataclass(frozen=True)
class Sel:
    tag: str | None = None
    classes: tuple[str, ...] = ()
    attr: str | None = None
    equals: str | None = None
    contains: str | None = None
    inside: "Sel | None" = None

    def __truediv__(self, inner: "Sel") -> "Sel":
        outer = self if inner.inside is None else self / inner.inside
        return replace(inner, inside=outer)

    def _compound(self) -> dict:
        return {
            "tag": self.tag, "classes": list(self.classes), "attr": self.attr,
            "equals": self.equals, "contains": self.contains,
        }

    def rule(self, field: str) -> dict:
        outer, at = [], self.inside
        while at is not None:
            outer.append(at._compound())
            at = at.inside
        if len(outer) > _MAX_OUTER:
            raise ValueError("a selector may have at most three steps")
        return {"field": field, **self._compound(), "outer": outer}


def tags_of(rules: object) -> frozenset[str]:
    """Every tag that selectors in ``rules`` name; rules may be nested in dataclasses and lists."""
    if isinstance(rules, Sel):
        return frozenset({rules.tag} - {None}) | tags_of(rules.inside)
    if is_dataclass(rules):
        rules = [getattr(rules, f.name) for f in fields(rules)]
    if isinstance(rules, (list, tuple)):
        return frozenset().union(*map(tags_of, rules))
    return frozenset()


def tag(name: str, *classes: str) -> Sel:
    return Sel(tag=name, classes=classes)


def cls(*names: str) -> Sel:
    return Sel(classes=names)


def attr(name: str, equals: str | None = None, contains: str | None = None,
         on: str | None = None) -> Sel:
    return Sel(tag=on, attr=name, equals=equals, contains=contains)


def _literal(rules: Mapping[str, Iterable[Sel]]) -> str:
    rows = [sel.rule(field) for field, sels in rules.items() for sel in sels]
    text = json.dumps(rows, ensure_ascii=False).replace("\\", "\\\\").replace("'", "\\'")
    return f"from_json('{text}', '{_RULES}')"


def _fits_itself(n: str, r: str) -> str:
    value = f"try_element_at({n}.attrs, {r}.attr)"
    return (
        f"(({r}.tag IS NULL OR {n}.tag = {r}.tag)"
        f" AND forall({r}.classes, k -> array_contains({n}.classes, k))"
        f" AND ({r}.attr IS NULL OR ({value} IS NOT NULL"
        f" AND ({r}.equals IS NULL OR {value} = {r}.equals)"
        f" AND ({r}.contains IS NULL OR contains({value}, {r}.contains)))))"
    )


def is_below(n: Column, root: Column) -> Column:
    return (n["pre"] > root["pre"]) & (n["pre"] <= root["post"])


@dataclass(frozen=True)
class Scope:
    """Elements and text to search, as names of columns or struct fields.

    ``root`` keeps hits below one element of ``nodes``; ``shift`` is the position in the page
    text at which ``text`` starts. Matching is written as SQL text: it is one expression with
    many small parts.
    """

    nodes: str
    text: str
    shift: str | None = None
    root: str | None = None

    def _around(self, n: str) -> str:
        """The elements around ``n``, by their places; nothing else is looked at.

        Below a ``root`` the list begins with the elements around the root, then the root.
        """
        if self.root is None:
            return f"transform({n}.up, i -> get({self.nodes}, i))"
        place = f"IF(i < {self.root}.pre, j, size({self.root}.up) + i - {self.root}.pre)"
        return f"transform({n}.up, (i, j) -> get({self.nodes}, {place}))"

    def _fits(self, n: str, r: str) -> str:
        hit = (
            f"({_fits_itself(n, r)} AND (size({r}.outer) = 0 OR exists({self._around(n)}, a ->"
            f" {_fits_itself('a', f'{r}.outer[0]')}"
            f" AND (size({r}.outer) = 1 OR exists({self._around('a')}, b -> {_fits_itself('b', f'{r}.outer[1]')})))))"
        )
        if self.root is None:
            return hit
        return f"({n}.pre > {self.root}.pre AND {n}.pre <= {self.root}.post AND {hit})"

    def all(self, sels: Iterable[Sel]) -> Column:
        """Elements that fit any of the selectors, in document order."""
        rules = _literal({"": sels})
        return F.expr(f"filter({self.nodes}, n -> exists({rules}, r -> {self._fits('n', 'r')}))")

    def all_by_rank(self, sels: Iterable[Sel]) -> Column:
        """Elements of the first selector that fits anything; NULL if none does."""
        found = f"filter({self.nodes}, n -> {self._fits('n', 'r')})"
        groups = f"transform({_literal({'': sels})}, r -> {found})"
        return F.expr(f"get(filter({groups}, g -> size(g) > 0), 0)")

    def picks(self, rules: Mapping[str, Iterable[Sel]]) -> Column:
        """``array<struct<field, node>>``: per selector its first element, in selector order."""
        first = f"get(filter({self.nodes}, n -> {self._fits('n', 'r')}), 0)"
        pairs = f"transform({_literal(rules)}, r -> named_struct('field', r.field, 'node', {first}))"
        return F.expr(f"filter({pairs}, p -> p.node IS NOT NULL)")

    def text_of(self, n: Column) -> Column:
        at = n["start"] if self.shift is None else n["start"] - F.col(self.shift)
        return strip(F.substr(F.col(self.text), at + 1, n["stop"] - n["start"]))

    def some_text(self, n: Column) -> Column:
        return blank_to_null(self.text_of(n))


def read(picks: Column, field: str, reader: Callable[[Column], Column]) -> Column:
    """First reading of a field's elements that is not NULL."""
    mine = F.filter(picks, lambda p: p["field"] == field)
    readings = F.transform(mine, lambda p: reader(p["node"]))
    return F.get(F.filter(readings, lambda v: v.isNotNull()), 0)


def picked(picks: Column, field: str) -> Column:
    """Does the page have an element for the field?"""
    return F.exists(picks, lambda p: p["field"] == field)


def attribute(n: Column, name: str) -> Column:
    return n["attrs"][name]


def some_attribute(n: Column, *names: str) -> Column:
    """First attribute of the element that is present and not empty."""
    return F.coalesce(*[blank_to_null(attribute(n, name)) for name in names])
