"""Planar geometry on GeoJSON polygons as Column expressions.

A polygon is held as ``rings: array<array<array<double>>>`` (outer ring and
holes; each vertex ``[lon, lat]``) and, once per polygon, as its ``edges:
array<struct<x1,y1,x2,y2>>``. Containment is the even-odd rule over every
edge of every ring, with points on an edge or vertex counted as outside (the
warehouse's ``ST_CONTAINS`` excludes the boundary). GeoJSON edges are planar
on input, so planar lon/lat arithmetic is the right model for forecast cells
a few km wide.

Spark has no polygon-containment expression, so the ray cast is a SQL
higher-order-function expression (``filter``/``exists`` over the edges),
built with one ``expr`` call: column arguments are column *names*. The
spatial join evaluates it only on bucket-matched candidate pairs, and an
axis-aligned rectangle takes a pure comparison path that stays in codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RING_TYPE = "array<array<array<double>>>"
EDGE_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def q(name: str) -> str:
    """Quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


GEOMETRY_TYPE = "struct<type:string,coordinates:string,geometries:array<string>>"
COLLECTION_DEPTH = 4


def parts_sql(geo_json: str) -> str:
    """The parts (arrays of rings) of a Polygon, a MultiPolygon or the polygons
    of a GeometryCollection; points and lines have no interior and give none.
    NULL for a text that is no geometry; collections nested deeper than
    COLLECTION_DEPTH fail the job."""
    members = f"array({geo_json})"
    for _ in range(COLLECTION_DEPTH):
        members = (f"flatten(transform({members}, t -> CASE WHEN from_json(t, '{GEOMETRY_TYPE}').type = "
                   f"'GeometryCollection' THEN coalesce(from_json(t, '{GEOMETRY_TYPE}').geometries, array()) "
                   "ELSE array(t) END))")
    polygons = (f"flatten(transform({members}, t -> CASE from_json(t, '{GEOMETRY_TYPE}').type "
                f"WHEN 'Polygon' THEN array(from_json(from_json(t, '{GEOMETRY_TYPE}').coordinates, '{RING_TYPE}')) "
                f"WHEN 'MultiPolygon' THEN from_json(from_json(t, '{GEOMETRY_TYPE}').coordinates, 'array<{RING_TYPE}>') "
                f"WHEN 'GeometryCollection' THEN raise_error('geometry collections nested too deep') "
                f"ELSE CAST(array() AS array<{RING_TYPE}>) END))")
    g = f"from_json({geo_json}, 'struct<type:string,coordinates:string>')"
    return (f"CASE {g}.type WHEN 'Polygon' THEN array(from_json({g}.coordinates, '{RING_TYPE}')) "
            f"WHEN 'MultiPolygon' THEN from_json({g}.coordinates, 'array<{RING_TYPE}>') "
            f"WHEN 'GeometryCollection' THEN {polygons} END")


def repaired_sql(rings: str) -> str:
    """Open rings closed, rings with no interior dropped."""
    closed = (f"transform({rings}, r -> CASE WHEN size(r) = 0 OR r[0] = r[size(r) - 1] THEN r "
              f"ELSE concat(r, array(r[0])) END)")
    return f"filter({closed}, r -> size(array_distinct(r)) >= 3)"


def rings_sql(geo_json: str) -> str:
    return repaired_sql(f"flatten({parts_sql(geo_json)})")


def edges_sql(rings: str) -> str:
    return ("flatten(transform(" + rings + ", ring -> transform("
            "IF(size(ring) >= 2, sequence(0, size(ring) - 2), CAST(array() AS array<int>)), "
            "i -> named_struct('x1', ring[i][0], 'y1', ring[i][1], 'x2', ring[i + 1][0], 'y2', ring[i + 1][1]))))")


def bbox_sql(rings: str) -> str:
    xs, ys = f"transform(flatten({rings}), p -> p[0])", f"transform(flatten({rings}), p -> p[1])"
    return (f"named_struct('xmin', array_min({xs}), 'ymin', array_min({ys}), "
            f"'xmax', array_max({xs}), 'ymax', array_max({ys}))")


def is_rect_sql(rings: str, edges: str) -> str:
    return (f"(size({rings}) = 1 AND size(array_distinct({rings}[0])) = 4 AND size({rings}[0]) = 5 "
            f"AND forall({edges}, e -> e.x1 = e.x2 OR e.y1 = e.y2))")


def point_in_edges_sql(edges: str, x: str, y: str) -> str:
    crosses = (f"((e.y1 > {y}) != (e.y2 > {y})) AND "
               f"({x} < e.x1 + ({y} - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1))")
    on_edge = (f"(e.x2 - e.x1) * ({y} - e.y1) - (e.y2 - e.y1) * ({x} - e.x1) = 0 "
               f"AND {x} >= least(e.x1, e.x2) AND {x} <= greatest(e.x1, e.x2) "
               f"AND {y} >= least(e.y1, e.y2) AND {y} <= greatest(e.y1, e.y2)")
    return (f"(CASE WHEN {x} IS NULL OR {y} IS NULL OR {edges} IS NULL THEN false "
            f"ELSE size(filter({edges}, e -> {crosses})) % 2 = 1 AND NOT exists({edges}, e -> {on_edge}) END)")


def point_in_polygon_sql(edges: str, box: str, rect: str, x: str, y: str) -> str:
    in_box = f"{x} > {box}.xmin AND {x} < {box}.xmax AND {y} > {box}.ymin AND {y} < {box}.ymax"
    return f"coalesce({in_box} AND ({rect} OR {point_in_edges_sql(edges, x, y)}), false)"


# ------------------------------------------------------------ repair

def unwrapped_sql(rings: str) -> str:
    """Rings in continuous longitudes: an edge takes the shorter way round, so
    a step over 180 degrees continues beyond the antimeridian. A ring that goes
    once round a pole is closed over that pole. Holes are moved by whole turns
    next to the outer ring."""
    turns = ("aggregate(sequence(1, i), 0, (a, j) -> a + CASE WHEN r[j][0] - r[j - 1][0] < -180 THEN 1 "
             "WHEN r[j][0] - r[j - 1][0] > 180 THEN -1 ELSE 0 END)")
    steps = "exists(sequence(1, size(r) - 1), i -> abs(r[i][0] - r[i - 1][0]) > 180)"
    flat = (f"transform({rings}, r -> CASE WHEN size(r) >= 2 AND {steps} THEN transform(r, (p, i) -> "
            f"array(p[0] + 360D * CASE WHEN i = 0 THEN 0 ELSE {turns} END, p[1])) ELSE r END)")
    pole = "CASE WHEN aggregate(r, 0D, (a, p) -> a + p[1]) >= 0 THEN 90D ELSE -90D END"
    closed = (f"transform({flat}, r -> CASE WHEN size(r) > 0 AND abs(r[0][0] - r[size(r) - 1][0]) > 180 THEN "
              f"concat(r, array(array(r[size(r) - 1][0], {pole}), array(r[0][0], {pole}), r[0])) ELSE r END)")
    middle = "(array_min(transform({0}, p -> p[0])) + array_max(transform({0}, p -> p[0]))) / 2"
    return (f"transform(array({closed}), all -> transform(all, r -> CASE WHEN abs({middle.format('all[0]')} - "
            f"{middle.format('r')}) > 180 THEN transform(r, p -> array(p[0] + 360D * round(({middle.format('all[0]')} - "
            f"{middle.format('r')}) / 360), p[1])) ELSE r END))[0]")


def shifts_sql(box: str) -> str:
    """By how many degrees a part is moved to lie where points are given
    (-180 to 180): a part across the antimeridian is there on both sides."""
    return (f"filter(array(0D, 360D, -360D), k -> k = 0 OR ({box}.xmin + k < 180 AND {box}.xmax + k > -180))")


def shifted_sql(rings: str, by: str) -> str:
    return f"transform({rings}, r -> transform(r, p -> array(p[0] + {by}, p[1])))"


def solid_edges_sql(rings: str) -> str:
    return f"filter({edges_sql(rings)}, e -> e.x1 != e.x2 OR e.y1 != e.y2)"


def slabs_sql(e: str, box: str) -> str:
    """Edges by horizontal strips, about as many as the root of their number:
    edges that meet share a strip."""
    n = f"CAST(greatest(1, ceil(sqrt(size({e})))) AS int)"
    return (f"transform(sequence(0, {n} - 1), s -> filter({e}, e -> {_slab('least(e.y1, e.y2)', e, box)} <= s "
            f"AND {_slab('greatest(e.y1, e.y2)', e, box)} >= s))")


def _slab(y: str, e: str, box: str) -> str:
    n = f"CAST(greatest(1, ceil(sqrt(size({e})))) AS int)"
    height = f"(({box}.ymax - {box}.ymin) / {n})"
    return (f"CASE WHEN {height} > 0 THEN least({n} - 1, greatest(0, CAST(floor(({y} - {box}.ymin) / {height}) AS int))) "
            "ELSE 0 END")


def _cross(e: str, x: str, y: str) -> str:
    return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1))"


def pieces_sql(e: str, slabs: str, box: str) -> str:
    """Planar noding: every edge cut where it meets another one (crossings, and
    vertices that lie on it), as pieces from their smaller end on, sorted."""
    lo, hi = _slab("least(e.y1, e.y2)", e, box), _slab("greatest(e.y1, e.y2)", e, box)
    sides = " AND ".join(f"{a} != 0 AND {b} != 0 AND ({a} > 0) != ({b} > 0)" for a, b in (
        (_cross("e", "f.x1", "f.y1"), _cross("e", "f.x2", "f.y2")),
        (_cross("f", "e.x1", "e.y1"), _cross("f", "e.x2", "e.y2"))))

    def at(a: str, b: str) -> str:  # both edges of a pair compute the point alike
        t = (f"((({b}.x1 - {a}.x1) * ({b}.y2 - {b}.y1) - ({b}.y1 - {a}.y1) * ({b}.x2 - {b}.x1)) / "
             f"(({a}.x2 - {a}.x1) * ({b}.y2 - {b}.y1) - ({a}.y2 - {a}.y1) * ({b}.x2 - {b}.x1)))")
        return f"struct({a}.x1 + {t} * ({a}.x2 - {a}.x1) AS x, {a}.y1 + {t} * ({a}.y2 - {a}.y1) AS y)"
    crossing = f"CASE WHEN {sides} THEN array(CASE WHEN e < f THEN {at('e', 'f')} ELSE {at('f', 'e')} END) ELSE array() END"
    on = (f"filter(array(struct(f.x1 AS x, f.y1 AS y), struct(f.x2 AS x, f.y2 AS y)), v -> {_cross('e', 'v.x', 'v.y')} = 0 "
          "AND v.x >= least(e.x1, e.x2) AND v.x <= greatest(e.x1, e.x2) AND v.y >= least(e.y1, e.y2) "
          "AND v.y <= greatest(e.y1, e.y2))")
    apart = ("greatest(f.x1, f.x2) < least(e.x1, e.x2) OR least(f.x1, f.x2) > greatest(e.x1, e.x2) OR "
             "greatest(f.y1, f.y2) < least(e.y1, e.y2) OR least(f.y1, f.y2) > greatest(e.y1, e.y2)")
    cuts = (f"flatten(transform(slice({slabs}, {lo} + 1, {hi} - {lo} + 1), fs -> flatten(transform("
            f"filter(fs, f -> NOT ({apart})), f -> concat({crossing}, {on})))))")
    ends = "array(struct(e.x1 AS x, e.y1 AS y), struct(e.x2 AS x, e.y2 AS y))"
    along = (f"array_distinct(array_sort(transform(concat({cuts}, {ends}), c -> struct((c.x - e.x1) * (e.x2 - e.x1) + "
             "(c.y - e.y1) * (e.y2 - e.y1) AS t, c.x AS x, c.y AS y))))")
    piece = ("CASE WHEN struct(p[i].x, p[i].y) < struct(p[i + 1].x, p[i + 1].y) THEN "
             "struct(p[i].x AS x1, p[i].y AS y1, p[i + 1].x AS x2, p[i + 1].y AS y2) ELSE "
             "struct(p[i + 1].x AS x1, p[i + 1].y AS y1, p[i].x AS x2, p[i].y AS y2) END")
    cut = f"flatten(transform(array({along}), p -> transform(sequence(0, size(p) - 2), i -> {piece})))"
    return f"array_sort(filter(flatten(transform({e}, e -> {cut})), p -> p.x1 != p.x2 OR p.y1 != p.y2))"


def odd_sql(pieces: str) -> str:
    """Of sorted pieces those that occur an odd number of times, once each: a
    piece that a ring goes along twice bounds nothing."""
    starts = f"filter(sequence(1, size({pieces})), i -> i = 1 OR {pieces}[i - 1] != {pieces}[i - 2])"
    odd = (f"transform(array({starts}), s -> transform(filter(sequence(1, size(s)), k -> "
           f"(coalesce(get(s, k), size({pieces}) + 1) - s[k - 1]) % 2 = 1), k -> {pieces}[s[k - 1] - 1]))[0]")
    return f"CASE WHEN size(array_distinct({pieces})) = size({pieces}) THEN {pieces} ELSE {odd} END"


# ------------------------------------------------------------ grid cells

def cell_meets_sql(edges: str, x: str, y: str, size: str) -> str:
    """Whether an edge may touch the closed square at (x, y); never false for
    one that does."""
    corners = [_cross("e", a, b) for a in (x, f"({x} + {size})") for b in (y, f"({y} + {size})")]
    slack = (f"1e-12 * (abs(e.x2 - e.x1) + abs(e.y2 - e.y1)) * (abs({x}) + abs({y}) + {size} + abs(e.x1) + abs(e.y1))")
    return (f"exists({edges}, e -> greatest(e.x1, e.x2) >= {x} AND least(e.x1, e.x2) <= {x} + {size} AND "
            f"greatest(e.y1, e.y2) >= {y} AND least(e.y1, e.y2) <= {y} + {size} AND "
            f"least({', '.join(corners)}) <= {slack} AND greatest({', '.join(corners)}) >= -({slack}))")


# ------------------------------------------------------------ sphere

ARC_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double,nx:double,ny:double,nz:double>>"
ON_ARC = 1e-15  # radians: a few nanometres on the ground


def _unit(x: str, y: str) -> tuple[str, str, str]:
    return (f"(cos(radians({y})) * cos(radians({x})))", f"(cos(radians({y})) * sin(radians({x})))", f"sin(radians({y}))")


def arcs_sql(edges: str) -> str:
    """Edges as great-circle arcs: their ends and the normal of their plane."""
    a, b = _unit("e.x1", "e.y1"), _unit("e.x2", "e.y2")
    n = [f"{a[(i + 1) % 3]} * {b[(i + 2) % 3]} - {a[(i + 2) % 3]} * {b[(i + 1) % 3]} AS {'n' + 'xyz'[i]}" for i in range(3)]
    return f"transform({edges}, e -> struct(e.x1, e.y1, e.x2, e.y2, {', '.join(n)}))"


def arc_box_sql(arcs: str) -> str:
    """Bounding box of arcs: an arc that climbs and falls goes beyond its ends,
    to the latitude of its plane."""
    climb = ["(a.nx * {y} - a.ny * {x})".format(x=_unit(f"a.x{i}", f"a.y{i}")[0], y=_unit(f"a.x{i}", f"a.y{i}")[1])
             for i in (1, 2)]
    top = "degrees(atan2(sqrt(a.nx * a.nx + a.ny * a.ny), abs(a.nz)))"
    north = f"CASE WHEN {climb[0]} > 0 AND {climb[1]} < 0 THEN {top} ELSE greatest(a.y1, a.y2) END"
    south = f"CASE WHEN {climb[0]} < 0 AND {climb[1]} > 0 THEN -({top}) ELSE least(a.y1, a.y2) END"
    return (f"named_struct('xmin', array_min(transform({arcs}, a -> least(a.x1, a.x2))), "
            f"'ymin', array_min(transform({arcs}, a -> {south})), "
            f"'xmax', array_max(transform({arcs}, a -> greatest(a.x1, a.x2))), "
            f"'ymax', array_max(transform({arcs}, a -> {north})))")


def unit_sql(x: str, y: str) -> str:
    """The point on the unit sphere, for :func:`point_in_arcs_sql`."""
    return f"struct({', '.join(f'{c} AS {n}' for c, n in zip(_unit(x, y), 'xyz'))})"


def point_in_arcs_sql(arcs: str, box: str, x: str, y: str, unit: str | None = None) -> str:
    """Containment on the sphere (``unit``: a column of :func:`unit_sql`, so
    that it is not worked out again per arc): how many arcs the meridian from the point to
    the north pole crosses, by the sign of the point against each arc's plane.
    A polygon round a pole is closed along that pole by ``unwrapped_sql``. The
    boundary is outside."""
    p = tuple(f"{unit}.{c}" for c in "xyz") if unit else _unit(x, y)
    def south(a: str) -> str:
        side = f"({a}.nx * {p[0]} + {a}.ny * {p[1]} + {a}.nz * {p[2]})"
        return (f"(({a}.x1 > {x}) != ({a}.x2 > {x})) AND CASE WHEN {pole(a)} THEN {y} < {a}.y1 "
                f"WHEN {a}.x2 > {a}.x1 THEN {side} < 0 ELSE {side} > 0 END")

    def pole(a: str) -> str:  # the closing edge of a polygon round a pole
        return f"{a}.y1 = {a}.y2 AND abs({a}.y1) = 90"

    def on(a: str) -> str:
        side = f"({a}.nx * {p[0]} + {a}.ny * {p[1]} + {a}.nz * {p[2]})"
        return (f"NOT ({pole(a)}) AND {x} >= least({a}.x1, {a}.x2) AND {x} <= greatest({a}.x1, {a}.x2) AND abs({side}) <= {ON_ARC} "
                f"AND ({a}.x1 != {a}.x2 OR ({y} >= least({a}.y1, {a}.y2) AND {y} <= greatest({a}.y1, {a}.y2)))")
    in_box = f"{x} >= {box}.xmin AND {x} <= {box}.xmax AND {y} >= {box}.ymin AND {y} <= {box}.ymax"
    # three or four arcs one by one: functions over arrays are not compiled
    few = " ".join(
        f"WHEN size({arcs}) = {n} THEN ({' + '.join(f'IF({south(f'{arcs}[{i}]')}, 1, 0)' for i in range(n))}) % 2 = 1 AND NOT ("
        f"{' OR '.join(f'({on(f'{arcs}[{i}]')})' for i in range(n))})" for n in (3, 4))
    return (f"coalesce({in_box} AND CASE {few} ELSE size(filter({arcs}, a -> {south('a')})) % 2 = 1 "
            f"AND NOT exists({arcs}, a -> {on('a')}) END, false)")


# ------------------------------------------------------------ Column API

def rings_from_geojson(geo_json: str) -> Column:
    """Closed rings of a GeoJSON Polygon or MultiPolygon text column; rings
    without interior are dropped; other types give NULL (no match). For a
    MultiPolygon whose parts may overlap, take its parts one by one
    (:func:`parts_from_geojson`): the even-odd rule holds within a part."""
    return F.expr(rings_sql(q(geo_json)))


def parts_from_geojson(geo_json: str) -> Column:
    """The parts of a GeoJSON Polygon (one) or MultiPolygon, as raw rings."""
    return F.expr(parts_sql(q(geo_json)))


def repaired(rings: str) -> Column:
    """Rings closed, those without interior dropped."""
    return F.expr(repaired_sql(q(rings)))


def edges(rings: str) -> Column:
    """All edges of all rings as ``struct(x1, y1, x2, y2)``."""
    return F.expr(edges_sql(q(rings)))


def bbox(rings: str) -> Column:
    """``struct(xmin, ymin, xmax, ymax)`` of all vertices."""
    return F.expr(bbox_sql(q(rings)))


def is_axis_rectangle(rings: str) -> Column:
    """True for a single ring of four distinct corners whose edges are all
    axis-parallel: then strict bbox comparison is exact containment."""
    return F.expr(is_rect_sql(q(rings), edges_sql(q(rings))))


def point_in_rings(rings: str, x: str, y: str) -> Column:
    """Even-odd containment of point (x, y); boundary and NULLs are outside."""
    return F.expr(point_in_edges_sql(edges_sql(q(rings)), q(x), q(y)))


def point_in_polygon(edges_col: str, bbox_col: str, rect_col: str, x: str, y: str) -> Column:
    """Containment with short cuts, on per-polygon precomputed columns:
    strict bbox reject first, accept for axis-aligned rectangles, else the
    exact ray cast over the polygon's edges."""
    return F.expr(point_in_polygon_sql(q(edges_col), q(bbox_col), q(rect_col), q(x), q(y)))
