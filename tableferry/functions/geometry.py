"""WKT text to a checked geometry struct and back.

A geometry is ``struct<type, srid, wkt, coords, parts>``; ``coords`` holds one
array of points per ring (a point or a line counts as one ring) and is NULL when
the text is malformed. ``parts`` counts the rings of each member. Points, lines
and polygons in two dimensions are read, and their multi-forms.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SRID = 4326
GEOMETRY = "geometry"
COORDS_DDL = "array<array<struct<x:double,y:double>>>"
GEOMETRY_DDL = f"struct<type:string,srid:int,wkt:string,coords:{COORDS_DDL},parts:array<int>>"
SHAPES = ("POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON")

# Java would also read 1d, 0x1 and NaN as numbers.
_NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_POINTS = rf"\A{_NUMBER} {_NUMBER}(?:,{_NUMBER} {_NUMBER})*+\z"
# White space on either side of a bracket or comma says nothing.
_TIGHT = (" (", "( ", " )", ") ", " ,", ", ")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once per row."""
    # this access keeps its type, and may be NULL whatever ``use`` gives, so that no row asks all of ``use`` for either
    return F.try_element_at(F.transform(F.array(value), use), F.lit(1))


def _point(text: Column) -> Column:
    x, y = (F.split_part(text, F.lit(" "), F.lit(i)).try_cast("double") for i in (1, 2))
    return F.struct(x.alias("x"), y.alias("y"))


def _inside(body: Column, brackets: int) -> Column:
    """What stands between so many brackets at either end, or NULL if they are not there."""
    held = body.startswith("(" * brackets) & body.endswith(")" * brackets)
    return F.when(held, F.substr(body, F.lit(brackets + 1), F.length(body) - 2 * brackets))


def _members(shape: Column, body: Column) -> Column:
    """The ring texts of each member, or NULL if brackets are misplaced."""
    one = F.array(F.array(_inside(body, 1)))
    polygon = F.array(F.split(_inside(body, 2), r"\),\("))
    each = F.transform(F.split(_inside(body, 2), r"\),\("), lambda line: F.array(line))
    points = F.transform(F.split(_inside(body, 1), ","), lambda point: F.array(point))
    polygons = F.transform(
        F.split(_inside(body, 3), r"\)\),\(\("), lambda polygon: F.split(polygon, r"\),\(")
    )
    return (
        F.when(shape.isin("POINT", "LINESTRING"), one)
        .when(shape == "POLYGON", polygon)
        .when((shape == "MULTILINESTRING") | body.startswith("((") & (shape == "MULTIPOINT"), each)
        .when(shape == "MULTIPOINT", points)
        .when(shape == "MULTIPOLYGON", polygons)
    )


def _coords(members: Column) -> Column:
    # A bracket left inside a ring, like any other slip, keeps it from matching.
    return let(
        F.flatten(members),
        lambda rings: F.when(
            F.forall(rings, lambda ring: ring.rlike(_POINTS)),
            F.transform(rings, lambda ring: F.transform(F.split(ring, ","), _point)),
        ),
    )


def parse_wkt(text: Column, srid: int = SRID) -> Column:
    """Read WKT into a geometry struct, NULL for NULL text."""
    plain = F.trim(F.regexp_replace(text, r"\s+", " "))
    for spaced in _TIGHT:
        plain = F.replace(plain, F.lit(spaced), F.lit(spaced.strip()))

    def geometry(shape: Column, members: Column) -> Column:
        return F.struct(
            shape.alias("type"),
            F.lit(srid).alias("srid"),
            text.alias("wkt"),
            _coords(members).alias("coords"),
            F.transform(members, F.size).alias("parts"),
        )

    def split_up(plain: Column, head: Column) -> Column:
        body = F.substr(plain, F.length(head) + 1)
        members = (
            F.when(head.isin([f"{s} EMPTY" for s in SHAPES]), F.array().cast("array<array<string>>"))
            .otherwise(let(body, lambda body: _members(head, body)))
        )
        return let(members, lambda m: geometry(F.substring_index(head, " ", 1), m))

    parsed = let(
        plain,
        lambda p: let(F.upper(F.substring_index(p, "(", 1)), lambda head: split_up(p, head)),
    )
    return F.when(text.isNotNull(), parsed).cast(GEOMETRY_DDL)


def _closed(ring: Column) -> Column:
    return (F.size(ring) >= 4) & (F.element_at(ring, 1) == F.element_at(ring, -1))


def is_valid(geometry: Column, geo_type: str = "GEOMETRY") -> Column:
    """True for NULL and for a sound geometry of the declared type."""
    declared = geo_type.upper()
    if declared not in (*SHAPES, "GEOMETRY"):
        raise ValueError(f"unsupported geometry type: {geo_type}")
    return let(geometry, lambda g: g.isNull() | _is_sound(g["type"], g["coords"], declared))


def _is_sound(shape: Column, coords: Column, declared: str) -> Column:
    sound = (
        F.when(coords.isNull(), False)
        .when(F.endswith(shape, F.lit("POINT")), F.forall(coords, lambda c: F.size(c) == 1))
        .when(F.endswith(shape, F.lit("LINESTRING")), F.forall(coords, lambda c: F.size(c) >= 2))
        .otherwise(F.forall(coords, _closed))
    )
    return sound if declared == "GEOMETRY" else (shape == declared) & sound


def _ring_text(ring: Column) -> Column:
    points = F.transform(
        ring, lambda p: F.concat(p["x"].cast("string"), F.lit(" "), p["y"].cast("string"))
    )
    text = F.concat(F.lit("("), F.array_join(points, ","), F.lit(")"))
    return F.regexp_replace(text, r"\.0(?=[ ,)])", "")


def _in_brackets(texts: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(texts, ","), F.lit(")"))


def to_wkt(geometry: Column | dict[str, Column], with_srid: bool = False) -> Column:
    """Write a geometry as WKT built from its coordinates (EWKT with the SRID)."""
    shape, coords, parts = geometry["type"], geometry["coords"], geometry["parts"]
    rings = F.transform(coords, _ring_text)

    def polygons(rings: Column) -> Column:
        return F.transform(
            parts,
            lambda size, i: _in_brackets(
                F.slice(rings, F.aggregate(F.slice(parts, 1, i), F.lit(1), lambda a, n: a + n), size)
            ),
        )

    body = (
        F.when(F.size(coords) == 0, F.lit(" EMPTY"))
        .when(shape.isin("POLYGON", "MULTILINESTRING", "MULTIPOINT"), _in_brackets(rings))
        .when(shape == "MULTIPOLYGON", _in_brackets(let(rings, polygons)))
        .otherwise(F.get(rings, F.lit(0)))
    )
    wkt = F.concat(shape, body)
    if with_srid:
        wkt = F.concat(F.lit("SRID="), geometry["srid"].cast("string"), F.lit(";"), wkt)
    return F.when(coords.isNotNull(), wkt)
