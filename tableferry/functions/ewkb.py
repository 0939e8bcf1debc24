"""Well-known binary, as a database sends it, to the geometry struct of ``geometry``.

All is done on the bytes of a cell by built-in functions; a slice of bytes costs its own
size, wherever it stands. A cell of a count and coordinates is walked by folds over its
counts, which give where each ring begins and how many points it has; then all points
are decoded at once. The bytes are kept in both directions, so that a number of either
byte order is one slice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tableferry.functions.geometry import GEOMETRY_DDL, SHAPES, SRID, let, parse_wkt, to_wkt

# Fixed value: the flag of a type word that an SRID follows.
_HAS_SRID = 0x20000000
_RINGS = "array<struct<at:bigint,n:bigint,little:boolean>>"
# Bytes of a count or type word, of a point, and of a byte order and a type word.
_WORD, _POINT, _HEAD = 4, 16, 5
# A character for each byte, so that text functions can turn bytes around.
_BYTES = "ISO-8859-1"
_LITTLE = b"\x01"


def _turned(data: Column) -> Column:
    """The same bytes, the last first."""
    return F.encode(F.reverse(F.decode(data, _BYTES)), _BYTES)


def _headed(data: Column) -> Column:
    """A cell's bytes in both directions, how many they are, and what its head says."""
    little = F.substr(data, F.lit(1), F.lit(1)) == F.lit(_LITTLE)
    word = F.substr(data, F.lit(2), F.lit(_WORD))
    return F.struct(
        data.alias("data"),
        _turned(data).alias("back"),
        F.length(data).cast("bigint").alias("size"),
        little.alias("little"),
        _whole(F.when(little, _turned(word)).otherwise(word)).alias("word"),
    )


def _whole(data: Column) -> Column:
    """The number that at most eight bytes stand for, the most significant first; eight have a sign."""
    return F.conv(F.hex(data), 16, -10).cast("bigint")


def _word(cell: Column, at: Column, little: Column) -> Column:
    """The count or type word at a place, or NULL where the cell ends before."""
    ahead = F.substr(cell["data"], at.cast("int"), F.lit(_WORD))
    behind = F.substr(cell["back"], (cell["size"] - at - _WORD + 2).cast("int"), F.lit(_WORD))
    return F.when(at + _WORD <= cell["size"] + 1, _whole(F.when(little, behind).otherwise(ahead)))


def _double(bits: Column) -> Column:
    """The number that 64 bits stand for in IEEE 754; NULL for an infinity or NaN."""
    exponent = F.shiftrightunsigned(bits, 52).bitwiseAND(F.lit(2047))
    fraction = bits.bitwiseAND(F.lit(2**52 - 1)).cast("double")
    # powers of two and the sums here are exact
    size = (
        F.when(exponent == 2047, None)
        .when(exponent == 0, fraction * F.lit(5e-324))
        .otherwise((1 + fraction / F.lit(2.0**52)) * F.pow(F.lit(2.0), exponent - 1023))
    )
    return F.when(bits < 0, -size).otherwise(size)


def _upto(count: Column) -> Column:
    """0, 1, ... for so many; a sequence of its own would count down to -1 for none."""
    return F.when(count > 0, F.sequence(F.lit(0).cast("int"), count - 1)).otherwise(F.array().cast("array<int>"))


def _state(at: Column, rings: Column, parts: Column) -> Column:
    return F.struct(at.alias("at"), rings.alias("rings"), parts.alias("parts"))


def _line(at: Column, n: Column, little: Column) -> Column:
    return F.struct(at.alias("at"), n.alias("n"), little.alias("little"))


def _body(cell: Column, kind: Column, at: Column, little: Column, state: Column) -> Column:
    """The state after a point, line or polygon whose coordinates or count stand at a place."""

    def ring(found: Column, _: Column) -> Column:
        return let(
            _word(cell, found["at"], little),
            lambda n: _state(
                found["at"] + _WORD + _POINT * n,
                F.array_append(found["rings"], _line(found["at"] + _WORD, n, little)),
                found["parts"],
            ),
        )

    def polygon(rings: Column) -> Column:
        start = _state(at + _WORD, state["rings"], F.array_append(state["parts"], rings.try_cast("int")))
        return F.aggregate(_upto(F.least(rings, cell["size"]).cast("int")), start, ring)

    one = F.lit(1)
    return (
        F.when(
            kind == 1,
            _state(
                at + _POINT,
                F.array_append(state["rings"], _line(at, F.lit(1).cast("bigint"), little)),
                F.array_append(state["parts"], one),
            ),
        )
        .when(
            kind == 2,
            let(
                _word(cell, at, little),
                lambda n: _state(
                    at + _WORD + _POINT * n,
                    F.array_append(state["rings"], _line(at + _WORD, n, little)),
                    F.array_append(state["parts"], one),
                ),
            ),
        )
        .when(kind == 3, let(_word(cell, at, little), polygon))
    )


def _members(cell: Column, kind: Column, at: Column, little: Column) -> Column:
    """The state after a whole geometry: the place after it, its rings, and rings per member."""
    nothing = _state(at, F.array().cast(_RINGS), F.array().cast("array<int>"))

    def member(found: Column, _: Column) -> Column:
        def inner(own: Column) -> Column:
            same = _word(cell, found["at"] + 1, own) == kind - 3
            return F.when(same, _body(cell, kind - 3, found["at"] + _HEAD, own, found))

        # a count that cannot be true may lead far beyond the end
        first = F.when(found["at"] <= cell["size"], F.substr(cell["data"], found["at"].cast("int"), F.lit(1)))
        return let(first == F.lit(_LITTLE), inner)

    many = let(
        _word(cell, at, little),
        lambda n: F.aggregate(
            _upto(F.least(n, cell["size"]).cast("int")),
            _state(at + _WORD, F.array().cast(_RINGS), F.array().cast("array<int>")),
            member,
        ),
    )
    # a line or polygon of nothing is empty, as in text
    empty = F.when(kind.isin(2, 3) & (_word(cell, at, little) == 0), _state(at + _WORD, nothing["rings"], nothing["parts"]))
    return F.coalesce(empty, F.when(kind <= 3, _body(cell, kind, at, little, nothing)).otherwise(many))


def _coords(cell: Column, rings: Column) -> Column:
    """The points of rings that lie within the cell."""

    def start(r: Column) -> Column:
        # read backwards, a point's first number stands behind its second
        return F.when(
            r["little"],
            F.struct(cell["back"].alias("data"), (cell["size"] - r["at"] - 6).cast("int").alias("at"), F.lit(-8).alias("step")),
        ).otherwise(F.struct(cell["data"].alias("data"), r["at"].cast("int").alias("at"), F.lit(8).alias("step")))

    def bits(s: Column, i: Column) -> Column:
        return _whole(F.substr(s["data"], s["at"] + s["step"] * i, F.lit(8)))

    def points(r: Column) -> Column:
        return let(
            start(r),
            lambda s: F.transform(
                F.transform(
                    _upto(r["n"].cast("int")), lambda i: F.struct(bits(s, 2 * i).alias("x"), bits(s, 2 * i + 1).alias("y"))
                ),
                lambda p: F.struct(_double(p["x"]).alias("x"), _double(p["y"]).alias("y")),
            ),
        )

    return F.transform(rings, points)


def parse_ewkb(written: Column, srid: int = SRID) -> Column:
    """Read binary geometry, given as hexadecimal text, into a geometry struct.

    Points, lines and polygons in two dimensions and their multi-forms, in either byte
    order, with an SRID or else ``srid``. NULL gives NULL. A damaged cell, as one that
    is cut off, goes on after its end, or holds other dimensions or numbers that are
    not finite, gives a struct without coordinates, as malformed text does; its ``wkt``
    is the cell. Elsewhere ``wkt`` is written from the coordinates. ``hex`` makes text
    of a binary column.
    """

    damaged = _struct(F.lit(None), F.lit(srid), written, F.lit(None), F.lit(None)).cast(GEOMETRY_DDL)

    def walked(cell: Column) -> Column:
        flagged = cell["word"].bitwiseAND(F.lit(_HAS_SRID)) != 0
        rest = F.substr(cell["data"], F.lit(_HEAD + 1), F.lit(_WORD))
        told = F.when(flagged, _whole(F.when(cell["little"], _turned(rest)).otherwise(rest))).otherwise(F.lit(srid))
        at = F.when(flagged, F.lit(_HEAD + 1 + _WORD)).otherwise(F.lit(_HEAD + 1)).cast("bigint")
        word = cell["word"].bitwiseAND(F.lit(0xFFFFFFFF ^ _HAS_SRID))
        kind = F.when(word.between(1, 6), word)
        return let(
            F.struct(kind.alias("kind"), at.alias("at"), told.try_cast("int").alias("srid")),
            lambda head: let(
                _members(cell, head["kind"], head["at"], cell["little"]),
                lambda state: _geometry(written, cell, head, state),
            ),
        )

    begun = F.startswith(written, F.lit("00")) | F.startswith(written, F.lit("01"))
    # two digits a byte; what is not hexadecimal gives NULL
    data = F.when(begun & (F.length(F.upper(written)) % 2 == 0), F.unhex(F.upper(written)))
    read = let(data, lambda data: F.when(F.length(data) >= _HEAD, let(_headed(data), walked)).otherwise(damaged))
    return F.when(written.isNotNull(), read)


def _struct(shape: Column, srid: Column, wkt: Column, coords: Column, parts: Column) -> Column:
    named = zip(("type", "srid", "wkt", "coords", "parts"), (shape, srid, wkt, coords, parts))
    return F.struct(*[value.alias(name) for name, value in named])


def _geometry(written: Column, cell: Column, head: Column, state: Column) -> Column:
    shape = F.get(F.array(*map(F.lit, SHAPES)), (head["kind"] - 1).cast("int"))
    whole = head["kind"].isNotNull() & (state["at"] == cell["size"] + 1)
    no_rings = F.array().cast("array<array<struct<x:double,y:double>>>")

    def refused(parts: Column) -> Column:
        return _struct(shape, head["srid"], written, F.lit(None), parts).cast(GEOMETRY_DDL)

    def made(coords: Column, parts: Column) -> Column:
        wkt = to_wkt({"type": shape, "coords": coords, "parts": parts})
        return _struct(shape, head["srid"], wkt, coords, parts)

    def checked(coords: Column) -> Column:
        finite = F.forall(coords, lambda c: F.forall(c, lambda p: p["x"].isNotNull() & p["y"].isNotNull()))
        # a point of two NaNs is how an empty one is written
        bare = (head["kind"] == 1) & F.forall(
            coords, lambda c: F.get(c, F.lit(0))["x"].isNull() & F.get(c, F.lit(0))["y"].isNull()
        )
        return (
            F.when(finite, made(coords, state["parts"]))
            .when(bare, made(no_rings, F.array().cast("array<int>")))
            .otherwise(refused(state["parts"]))
        )

    return F.when(whole, let(_coords(cell, state["rings"]), checked)).otherwise(refused(F.lit(None)))


def parse_geometry(cell: Column, srid: int = SRID) -> Column:
    """Read a cell of WKT or hexadecimal binary; the first begins with a letter, the other with 0."""
    return F.when(F.startswith(cell, F.lit("0")), parse_ewkb(cell, srid)).otherwise(parse_wkt(cell, srid))
