"""Geometry as well-known text, from GeoJSON held as text."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filigree.functions.money import plain_decimal

#: Brackets around the coordinates of each type, that make them lists of polygons of rings of points (fixed values).
DEPTH = {"Point": 3, "MultiPoint": 2, "LineString": 2, "Polygon": 1, "MultiPolygon": 0}


def bound(x: Column, body: Callable[[Column], Column]) -> Column:
    """body of x, with x evaluated once however often body names it."""
    return F.element_at(F.transform(F.array(x), body), 1)


def _point(p: Column) -> Column:
    """"x y" of a list of numbers; null where there are fewer than two."""
    numbers = F.transform(F.slice(p, 1, 2), lambda c: c.try_cast("double"))
    good = (F.size(p) >= 2) & ~F.exists(numbers, lambda t: t.isNull())
    return F.when(good, F.array_join(F.transform(numbers, plain_decimal), " "))


def _listed(texts: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(texts, ", "), F.lit(")"))


def _rings(rings: Column) -> Column:
    return F.transform(F.filter(rings, lambda r: F.size(r) >= 3), _listed)


def _text(kind: Column, polygons: Column) -> Column:
    points = polygons[0][0]
    several = F.filter(F.transform(polygons, _rings), lambda r: F.size(r) > 0)
    return (
        F.when((kind == "Point") & (F.size(points) > 0), F.concat(F.lit("POINT"), _listed(points)))
        .when((kind == "MultiPoint") & (F.size(points) > 0), F.concat(F.lit("MULTIPOINT"), _listed(points)))
        .when((kind == "LineString") & (F.size(points) >= 2), F.concat(F.lit("LINESTRING"), _listed(points)))
        .when((kind == "Polygon") & (F.size(several) > 0), F.concat(F.lit("POLYGON"), _listed(several[0])))
        .when((kind == "MultiPolygon") & (F.size(several) > 0), F.concat(F.lit("MULTIPOLYGON"), _listed(F.transform(several, _listed))))
    )


#: Numbers whose text is already the shortest (15 digits at the most), points of two, texts without marks of JSON, and points
#: of up to three numbers or those that are none.
_NUMBER = r"-?(?:0|[1-9][0-9]{0,14}|(?:0|[1-9][0-9]{0,2})\.[0-9]{0,11}[1-9]|[1-9][0-9]{0,6}\.[0-9]{0,7}[1-9]|[1-9][0-9]{0,10}\.[0-9]{0,3}[1-9])"
_POINT = rf"\[{_NUMBER},{_NUMBER}\]"
_TEXT = r'"[^"\\\[\],]*"'
_TEXTS = rf"{_TEXT}(?:,(?:{_NUMBER}|{_TEXT}))*"
_ANY_POINT = rf"\[(?:{_NUMBER}(?:,(?:{_NUMBER}(?:,{_NUMBER})?|{_TEXTS}))?|{_TEXTS})\]"


def _list_of(one: str, least: int = 1) -> str:
    return rf"\[{one}(?:,{one}){{{least - 1},}}\]"


def _coordinates(point: str, line: int, ring: int) -> dict[str, str]:
    """Patterns of the coordinates of each type; line and ring are how many points those have at least."""
    rings = _list_of(_list_of(point, ring))
    return {"Point": point, "MultiPoint": _list_of(point), "LineString": _list_of(point, line), "Polygon": rings, "MultiPolygon": _list_of(rings)}


#: How a geometry as JSON begins that has a type and coordinates in this order, without blanks.
_HEADS = {kind: f'{{"type":"{kind}","coordinates":' for kind in DEPTH}


def _rewriter():
    """Column function: the text of a geometry of plain numbers, with what isn't whole left out of it; empty where nothing is left, null where numbers or lists are other than these.

    It takes JSON that begins as in _HEADS, or type and coordinates set end to end. Patterns are matched in linear time, a batch at once.
    """
    whole, nested = _coordinates(_POINT, 2, 3), _coordinates(_ANY_POINT, 1, 1)
    marks = bytes.maketrans(b"[],", b"() ")

    def left(kind, x):
        """Coordinates without third numbers, points that are none, short rings and empty polygons; where nothing is left, they are an empty list, or empty."""
        tidy = lambda x: pc.replace_substring(x, ",]", "]")
        x = pc.replace_substring_regex(x, r"(\[[^\[\],]*,[^\[\],]*),[^\[\],]*\]", r"\1]")
        x = tidy(pc.replace_substring_regex(x, r'\[(?:[^\[\],]*|[^\[\]"]*"[^\[\]]*)\],?', ""))
        if kind in ("Polygon", "MultiPolygon"):
            x = tidy(pc.replace_substring_regex(x, r"\[(?:\[[^\[\]]+\](?:,\[[^\[\]]+\])?)?\],?", ""))
        if kind == "MultiPolygon":
            x = pc.replace_substring(pc.replace_substring(x, "[],", ""), ",[]", "")
        return x

    def nothing(kind, x):
        if kind == "LineString":
            return pc.invert(pc.match_substring(x, "],["))
        return pc.equal(x, "") if kind == "Point" else pc.match_substring(x, "[]")

    def text(kind, x):
        x = pc.utf8_slice_codeunits(x, 1, -1)
        _, offsets, data = x.buffers()
        x = pa.StringArray.from_buffers(len(x), offsets, pa.py_buffer((data.to_pybytes() if data else b"").translate(marks)))
        x = pc.replace_substring(x, ") (", ", ")  # points lose a bracket on either side, here or above
        return pc.binary_join_element_wise(kind.upper(), *(["(", x, ")"] if kind == "Point" else [x]), "")

    def rewrite(s: pa.Array) -> pa.Array:
        out, s = pa.nulls(len(s), pa.string()), s.fill_null("")
        for kind, head, tail in [(kind, *ends) for kind in whole for ends in ((_HEADS[kind], "}"), (kind, ""))]:
            here = pc.starts_with(s, f"{head}[")
            if not here.true_count:
                continue
            x = s.filter(here)
            fits = lambda x, of: pc.match_substring_regex(x, f"^{re.escape(head)}{of[kind]}{re.escape(tail)}$")  # noqa: B023, E731
            bare = lambda x: pc.utf8_slice_codeunits(x, len(head), -len(tail) or None)  # noqa: B023, E731
            known = fits(x, whole)
            if known.true_count == len(x):
                found = text(kind, bare(x))
            else:
                known = pc.or_(known, fits(x, nested))
                y = left(kind, bare(x.filter(known)))
                found = pc.replace_with_mask(pa.nulls(len(x), pa.string()), known, pc.if_else(nothing(kind, y), "", text(kind, y)))
            out = pc.replace_with_mask(out, here, found)
        return out

    return F.arrow_udf(rewrite, T.StringType())


_rewritten = _rewriter()


def _plain(s: Column) -> Column:
    """Whether a geometry can be rewritten as text."""
    return _rewritten(s) != ""


def _nested(s: Column) -> Column:
    """Whether a geometry could be, but nothing of it is left."""
    return _rewritten(s) == ""


def _short(g: Column) -> Column:
    """A geometry as _rewritten takes it. JSON is read only where it isn't such already."""
    kind = F.get_json_object(g, "$.type")
    usual = reduce(or_, [F.startswith(g, F.lit(head)) for head in _HEADS.values()])
    return F.when(usual, g).when(kind.isin(*DEPTH), F.concat(kind, F.get_json_object(g, "$.coordinates")))


def wkt(geometry: Column) -> Column:
    """POINT, MULTIPOINT, LINESTRING (2 points or more), POLYGON (rings of 3 or more), MULTIPOLYGON; null for anything else.

    Points that are no lists of two numbers or more, and rings of fewer than three points, are left out; a geometry with
    nothing left is null. Numbers are the shortest decimals that read back as the same double, without exponents.
    """
    depth = lambda kind, one: F.coalesce(*[F.when(kind == k, F.lit(one * n)) for k, n in DEPTH.items()], F.lit(""))

    def read(g: Column) -> Column:
        bare = F.regexp_replace(g["coordinates"], r'"(?:[^"\\]|\\.)*"', "null")  # text is no number, even where it reads like one
        nested = F.from_json(F.concat(depth(g["type"], "["), bare, depth(g["type"], "]")), "array<array<array<array<string>>>>")
        polygons = F.transform(nested, lambda p: F.transform(p, lambda r: F.filter(F.transform(r, _point), lambda x: x.isNotNull())))
        return bound(F.struct(g["type"].alias("kind"), polygons.alias("polygons")), lambda x: _text(x["kind"], x["polygons"]))

    # Most geometries are rewritten as text; only others are taken apart.
    s = _short(geometry)
    return F.when(_plain(s), _rewritten(s)).when(_nested(s), F.lit(None)).otherwise(bound(F.from_json(geometry, "type string, coordinates string"), read))
