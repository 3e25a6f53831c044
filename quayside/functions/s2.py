"""S2 cell tokens from coordinates, as column expressions, and the neighbours of a cell.

A point goes to a cube face, to (s, t) by the quadratic projection, to integers (i, j) of a level, and along the Hilbert curve
to a position. The token is the cell id in hexadecimal without trailing zeros."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The Hilbert curve's order of the four children in each orientation, and how a child turns it.
IJ_TO_POS = ((0, 1, 3, 2), (0, 3, 1, 2), (2, 3, 1, 0), (2, 1, 3, 0))
POS_TO_TURN = (1, 0, 0, 3)
#: By orientation * 4 + 2 * i + j: position * 4 + next orientation.
STEP = tuple(p * 4 + (o ^ POS_TO_TURN[p]) for o in range(4) for p in IJ_TO_POS[o])


def _st(u: Column) -> Column:
    return F.when(u >= 0, 0.5 * F.sqrt(1 + 3 * F.greatest(u, F.lit(0.0)))).otherwise(1 - 0.5 * F.sqrt(1 - 3 * F.least(u, F.lit(0.0))))


def face_ij(lat: Column, lon: Column, level: int) -> Column:
    """struct(face, i, j) of the cell that holds a point."""
    cos = F.cos(F.radians(lat))
    xyz = F.struct((cos * F.cos(F.radians(lon))).alias("x"), (cos * F.sin(F.radians(lon))).alias("y"), F.sin(F.radians(lat)).alias("z"))

    def on_face(p: Column) -> Column:
        x, y, z = p["x"], p["y"], p["z"]
        ax, ay, az = F.abs(x), F.abs(y), F.abs(z)
        axis = F.when(ax > ay, F.when(ax > az, 0).otherwise(2)).otherwise(F.when(ay > az, 1).otherwise(2))
        neg = F.when(axis == 0, x < 0).when(axis == 1, y < 0).otherwise(z < 0)
        face = axis + F.when(neg, 3).otherwise(0)
        u = F.when(face == 0, y / x).when(face == 1, -x / y).when(face == 2, -x / z).when(face == 3, z / x).when(face == 4, z / y).otherwise(-y / z)
        v = F.when(face == 0, z / x).when(face == 1, z / y).when(face == 2, -y / z).when(face == 3, y / x).when(face == 4, -x / y).otherwise(-x / z)
        return F.struct(face.cast("long").alias("face"), u.alias("u"), v.alias("v"))

    size = 1 << level
    cell = lambda s: F.least(F.lit(size - 1), F.greatest(F.lit(0), F.floor(size * s))).cast("long")
    to_ij = lambda q: F.struct(q["face"].alias("face"), cell(_st(q["u"])).alias("i"), cell(_st(q["v"])).alias("j"))
    # One-element arrays name intermediate results, so none is evaluated twice.
    return F.transform(F.transform(F.array(xyz), on_face), to_ij)[0]


def token_of(cell: Column, level: int) -> Column:
    """The token of struct(face, i, j)."""
    table = F.array(*[F.lit(x).cast("long") for x in STEP])

    def walk(c: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            i = F.call_function("shiftright", c["i"], k).bitwiseAND(F.lit(1).cast("long"))
            j = F.call_function("shiftright", c["j"], k).bitwiseAND(F.lit(1).cast("long"))
            at = (acc % 4) * 4 + 2 * i + j
            return F.floor(acc / 4).cast("long") * 16 + F.get(table, at.cast("int"))

        levels = F.array(*[F.lit(k) for k in range(level - 1, -1, -1)])
        state = F.aggregate(levels, (c["face"] % 2).cast("long"), step)
        return F.struct(c["face"].alias("face"), F.floor(state / 4).cast("long").alias("pos"))

    pad = -(2 * level + 4) % 4
    digits = (2 * level + 4 + pad) // 4
    number = lambda p: (p["face"] * (1 << (2 * level + 1)) + p["pos"] * 2 + 1) * (1 << pad)
    return F.transform(F.transform(F.array(cell), walk), lambda p: F.lpad(F.lower(F.hex(number(p))), digits, "0"))[0]


def s2_token(lat: Column, lon: Column, level: int) -> Column:
    return F.when(lat.isNotNull() & lon.isNotNull(), token_of(face_ij(lat, lon, level), level))


def _xyz(face: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    one = np.ones_like(u)
    forms = [(one, u, v), (-u, one, v), (-u, -v, one), (-one, -v, -u), (v, -one, -u), (v, u, -one)]
    return np.choose(face, [np.stack(f) for f in forms]) if face.ndim else np.stack(forms[int(face)])


def _faces(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x, y, z = p
    ax, ay, az = abs(x), abs(y), abs(z)
    axis = np.where(ax > ay, np.where(ax > az, 0, 2), np.where(ay > az, 1, 2))
    face = axis + 3 * (np.choose(axis, [x, y, z]) < 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        u = np.choose(face, [y / x, -x / y, -x / z, z / x, z / y, -y / z])
        v = np.choose(face, [z / x, z / y, -y / z, y / x, -x / y, -x / z])
    return face, u, v


def tokens(face: np.ndarray, i: np.ndarray, j: np.ndarray, level: int) -> list[str]:
    table = np.array(STEP)
    acc = (face % 2).astype(np.int64)
    for k in range(level - 1, -1, -1):
        acc = (acc >> 2) * 16 + table[(acc & 3) * 4 + 2 * ((i >> k) & 1) + ((j >> k) & 1)]
    pad = -(2 * level + 4) % 4
    number = (face.astype(np.int64) * (1 << (2 * level + 1)) + (acc >> 2) * 2 + 1) << pad
    return [f"{n:0{(2 * level + 4 + pad) // 4}x}" for n in number.tolist()]


def cells(lat: np.ndarray, lon: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    la, lo = np.radians(lat), np.radians(lon)
    face, u, v = _faces(np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)]))
    st = lambda x: np.where(x >= 0, 0.5 * np.sqrt(1 + 3 * np.maximum(x, 0)), 1 - 0.5 * np.sqrt(1 - 3 * np.minimum(x, 0)))
    at = lambda x: np.clip(np.floor((1 << level) * st(x)), 0, (1 << level) - 1).astype(np.int64)
    return face, at(u), at(v)


def _around(lat: np.ndarray, lon: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(face, i, j) of each point's cell and of all that touch it, across face edges too."""
    face, i, j = cells(lat, lon, level)
    size = 1 << level
    for di in (-1, 0, 1):
        for dj in (-1, 0, 1):
            a, b = i + di, j + dj
            out = (a < 0) | (a >= size) | (b < 0) | (b >= size)
            # Off the face: through a point just beyond its edge, in linear coordinates, which adjacency allows.
            lin = lambda n: np.clip((2 * n + 1 - size) / size, -1 - 1e-9, 1 + 1e-9)
            f2, u2, v2 = _faces(_xyz(face, lin(a), lin(b)))
            back = lambda x: np.clip(np.floor(size * 0.5 * (x + 1)), 0, size - 1).astype(np.int64)
            yield np.where(out, f2, face), np.where(out, back(u2), np.clip(a, 0, size - 1)), np.where(out, back(v2), np.clip(b, 0, size - 1))


def neighbourhood(lat: np.ndarray, lon: np.ndarray, level: int) -> list[list[str]]:
    """Tokens of each point's cell and of all that touch it; a cube corner has one fewer."""
    return [sorted(set(x)) for x in zip(*(tokens(*c, level) for c in _around(lat, lon, level)), strict=True)]


def neighbour_tokens(lat: Column, lon: Column, level: int) -> Column:
    """array of tokens; for the small side of a join."""

    @F.pandas_udf("array<string>")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in parts:
            yield pd.Series(neighbourhood(a.to_numpy(float), b.to_numpy(float), level), dtype=object)

    return run(lat, lon)


def cell_key(lat: Column, lon: Column, level: int) -> Column:
    """A cell as one long, for joins: it says what the token says without the walk along the curve."""
    c = face_ij(lat, lon, level)
    return F.when(lat.isNotNull() & lon.isNotNull(), F.transform(F.array(c), lambda x: x["face"] * (1 << 40) + x["i"] * (1 << 20) + x["j"])[0])


def neighbour_keys(lat: Column, lon: Column, level: int) -> Column:
    """array of cell_key of a point's cell and of all that touch it; for the small side of a join."""

    @F.pandas_udf("array<bigint>")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in parts:
            keys = [(f.astype(np.int64) << 40) + (i << 20) + j for f, i, j in _around(a.to_numpy(float), b.to_numpy(float), level)]
            yield pd.Series([sorted(set(x)) for x in zip(*(k.tolist() for k in keys), strict=True)], dtype=object)

    return run(lat, lon)
