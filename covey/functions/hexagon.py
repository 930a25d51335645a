"""The hierarchical hexagon index of the sphere, in numpy: cells of places, and centres, corners and neighbours of cells.

The sphere is cut into the twenty faces of an icosahedron. On a face's plane (a gnomonic projection) cells of
a resolution are a lattice of hexagons around whole numbers a + b * W, W a third of a turn; each finer level is
smaller by the root of 7, odd levels are turned by TWIST. A cell's number holds its resolution, the coarsest
cell above it (of 122, numbered from north to south) and a digit for each level, the direction from the centre
of the cell above, in the frame of that coarsest cell's home face. The twelve coarsest cells at the
icosahedron's vertices are pentagons: direction 1 isn't there.

All tables of faces, coarsest cells and turns are worked out from the faces' centres and axes when this is imported.
"""

from __future__ import annotations

import numpy as np

# Latitude and longitude of each face's centre, and the azimuth of its first axis, in radians.
FACE_CENTRES = (
    (0.803582649718989942, 1.248397419617396099), (1.307747883455638156, 2.536945009877921159), (1.054751253523952054, -1.347517358900396623),
    (0.600191595538186799, -0.450603909469755746), (0.491715428198773866, 0.401988202911306943), (0.172745327415618701, 1.678146885280433686),
    (0.605929321571350690, 2.953923329812411617), (0.427370518328979641, -1.888876200336285401), (-0.079066118549212831, -0.733429513380867741),
    (-0.230961644455383637, 0.506495587332349035), (0.079066118549212831, 2.408163140208925497), (0.230961644455383637, -2.635097066257444203),
    (-0.172745327415618701, -1.463445768309359553), (-0.605929321571350690, -0.187669323777381622), (-0.427370518328979641, 1.252716453253507838),
    (-0.600191595538186799, 2.690988744120037492), (-0.491715428198773866, -2.739604450678486295), (-0.803582649718989942, -1.893195233972397139),
    (-1.307747883455638156, -0.604647643711872080), (-1.054751253523952054, 1.794075294689396615),
)
FACE_AXES = (
    5.619958268523939882, 5.760339081714187279, 0.780213654393430055, 0.430469363979999913, 6.130269123335111400, 2.692877706530642877, 2.982963003477243874,
    3.532912002790141181, 3.494305004259568154, 3.003214169499538391, 5.930472956509811562, 0.138378484090254847, 0.448714947059150361, 0.158629650112549365,
    5.891865957979238535, 2.711123289609793325, 3.294508837434268316, 3.804819692245439833, 3.664438879055192436, 2.361378999196363184,
)
#: The plane's unit at resolution 0, and the turn of odd resolutions.
UNIT, TWIST = 0.38196601125010500003, float(np.arcsin(np.sqrt(3 / 28)))
ROOT7, SIN60, W = 7**0.5, 3**0.5 / 2, complex(-0.5, 3**0.5 / 2)
#: A digit's place on the lattice, (a, b), and what a sixth of a turn counter-clockwise makes of it.
DIGITS = np.array([(0, 0), (-1, -1), (0, 1), (-1, 0), (1, 0), (0, -1), (1, 1)])
TURNED = np.array([0, 5, 3, 1, 6, 4, 2])
K, JK, IK = 1, 3, 5
_DIGIT = np.full(9, -1)
_DIGIT[(DIGITS[:, 0] + 1) * 3 + DIGITS[:, 1] + 1] = np.arange(7)
_TURN = np.exp(1j * np.pi / 3 * np.arange(6))


def unit_vector(lat, lon) -> np.ndarray:
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], -1)


def _frames() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each face's centre, and the directions of its plane's x and y there."""
    lat, lon = np.array(FACE_CENTRES).T
    east = np.stack([-np.sin(lon), np.cos(lon), np.zeros(20)], -1)
    north = np.stack([-np.sin(lat) * np.cos(lon), -np.sin(lat) * np.sin(lon), np.cos(lat)], -1)
    way = lambda azimuth: np.cos(azimuth)[:, None] * north + np.sin(azimuth)[:, None] * east
    return unit_vector(lat, lon), way(np.array(FACE_AXES)), way(np.array(FACE_AXES) - np.pi / 2)


CENTRE, X, Y = _frames()


def to_sphere(face: np.ndarray, z: np.ndarray) -> np.ndarray:
    v = CENTRE[face] + UNIT * (z.real[..., None] * X[face] + z.imag[..., None] * Y[face])
    return v / np.linalg.norm(v, axis=-1, keepdims=True)


def to_plane(face: np.ndarray, v: np.ndarray) -> np.ndarray:
    depth = (v * CENTRE[face]).sum(-1)
    return ((v * X[face]).sum(-1) + 1j * (v * Y[face]).sum(-1)) / depth / UNIT


CORNERS = 2 * W ** np.arange(3)


def _neighbours() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Across each edge of a face, which lies opposite of corner k: the face there, and the turn and shift into its frame."""
    at = np.stack([to_sphere(np.full(3, f), CORNERS) for f in range(20)])
    face, turn, shift = (np.zeros((20, 3), t) for t in (int, int, complex))
    for f in range(20):
        for k in range(3):
            ends = [(k + 1) % 3, (k + 2) % 3]
            for g in range(20):
                own = [int(np.argmin(np.linalg.norm(at[g] - at[f][e], axis=1))) for e in ends]
                if g != f and all(np.linalg.norm(at[g][o] - at[f][e]) < 1e-6 for o, e in zip(own, ends)):
                    ratio = (CORNERS[own[1]] - CORNERS[own[0]]) / (CORNERS[ends[1]] - CORNERS[ends[0]])
                    face[f, k], turn[f, k] = g, round(np.angle(ratio) / (np.pi / 3)) % 6
                    shift[f, k] = CORNERS[own[0]] - _TURN[turn[f, k]] * CORNERS[ends[0]]
    return face, turn, shift


NEXT, NEXT_TURN, NEXT_SHIFT = _neighbours()


def _coarsest() -> tuple:
    """The 122 coarsest cells: centres, home faces and places there, pentagons, and (cell, turn into its home frame) by face and place."""
    places = [(a, b) for a in range(-2, 3) for b in range(-2, 3)]
    on = [p for p in places if max(*p, 0) - min(*p, 0) <= 2 and sum(np.array([*p, 0]) - min(*p, 0)) <= 2]
    seen: list[np.ndarray] = []
    where: dict[int, list[tuple[int, tuple[int, int]]]] = {}
    for f in range(20):
        for a, b in on:
            v = to_sphere(np.array(f), np.array(a + b * W))
            k = next((k for k, u in enumerate(seen) if np.linalg.norm(u - v) < 1e-6), len(seen))
            if k == len(seen):
                seen.append(v)
            where.setdefault(k, []).append((f, (a, b)))
    order = sorted(range(len(seen)), key=lambda k: -seen[k][2])
    centres, home, place, pentagons = np.stack([seen[k] for k in order]), [], [], []
    table: dict[tuple[int, int, int], tuple[int, int]] = {}
    steps: list[dict[int, int]] = []
    for cell, k in enumerate(order):
        held = dict(where[k])
        faces = sorted(held)
        if len(faces) == 5:  # a vertex: the face that has it on its first axis, the least or, in the south, the last such
            first = [f for f in faces if held[f] == (2, 0)]
            own = max(first) if min(first) >= 15 else min(first) if min(first) < 5 else first[0]
            pentagons.append(cell)
        elif len(faces) == 2:  # an edge, by the rows of faces that meet there
            (low, high), ends = faces, [held[f] for f in faces]
            if high < 5 or low >= 15:  # in a row at a pole: the one that has it between its first and second axis, or first and third
                own = next(f for f in faces if held[f] == ((1, 1) if high < 5 else (0, -1)))
            elif low < 5 <= high:
                own = low
            elif high >= 15:
                own = high
            else:  # the two rows at the equator
                own = high if ends[1] == (1, 1) else low
        else:
            own = faces[0]
        home.append(own)
        place.append(held[own])
        walk = {own: 0}
        if len(faces) == 5:  # around the vertex clockwise, away from the direction that isn't there
            f, corner, turn = own, 0, 0
            for n in range(1, 5):
                edge = (corner + 2) % 3  # of the two edges at this corner the one that is next clockwise
                turn += NEXT_TURN[f, edge]
                f, corner = NEXT[f, edge], next(c for c in range(3) if abs(_TURN[NEXT_TURN[f, edge]] * CORNERS[corner] + NEXT_SHIFT[f, edge] - CORNERS[c]) < 1e-6)
                walk[f] = -turn % 6
            steps.append({f: n for n, f in enumerate(walk)})
        elif len(faces) == 2:
            f = next(x for x in faces if x != own)
            walk[f] = int(NEXT_TURN[f, list(NEXT[f]).index(own)])
        for f in faces:
            table[f, *held[f]] = (cell, int(walk[f]))
    for f in range(20):  # places beyond an edge lie on the face there
        for a, b in places:
            if (f, a, b) not in table and max(a, b, 0) - min(a, b, 0) <= 2:
                z = a + b * W
                k = max(range(3), key=lambda k: (-z * W ** (-k)).real)
                to = _TURN[NEXT_TURN[f, k]] * z + NEXT_SHIFT[f, k]
                j = round(to.imag / SIN60)
                cell, turn = table[int(NEXT[f, k]), round(to.real + j / 2), j]
                table[f, a, b] = (cell, (turn + int(NEXT_TURN[f, k])) % 6)
    cells, turns = np.full((20, 5, 5), -1), np.zeros((20, 5, 5), int)
    for (f, a, b), (cell, turn) in table.items():
        cells[f, a + 2, b + 2], turns[f, a + 2, b + 2] = cell, turn
    step = np.zeros((122, 20), int)
    for cell, walk in zip(pentagons, steps):
        for f, n in walk.items():
            step[cell, f] = n
    return centres, np.array(home), np.array([a + b * W for a, b in place]), np.array(place), tuple(pentagons), cells, turns, step


BASE_CENTRES, HOME, HOME_Z, HOME_AB, PENTAGONS, BASE_CELL, BASE_TURN, STEP = _coarsest()
_IS_PENTAGON = np.isin(np.arange(122), PENTAGONS)


def _scale(resolution: int) -> complex:
    """What a lattice place at a resolution is multiplied by to be one of resolution 0."""
    return np.exp(1j * TWIST * (resolution % 2)) / ROOT7**resolution


def _nearest(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lattice place (a, b) nearest to z: one of the corners of the rhombus around it."""
    b = z.imag / SIN60
    a = z.real + b / 2
    low_a, low_b = np.floor(a), np.floor(b)
    best, out = np.full(z.shape, np.inf), [np.zeros(z.shape, np.int64), np.zeros(z.shape, np.int64)]
    for da in (0, 1):
        for db in (0, 1):
            x, y = a - low_a - da, b - low_b - db
            far = x * x + y * y - x * y
            nearer = far < best
            best = np.where(nearer, far, best)
            out = [np.where(nearer, low_a + da, out[0]).astype(np.int64), np.where(nearer, low_b + db, out[1]).astype(np.int64)]
    return out[0], out[1]


def _down(a, b, resolution: int):
    """A place's cell one level finer, at resolution, in whose middle it is."""
    return (2 * a + b, 3 * b - a) if resolution % 2 else (3 * a - b, a + 2 * b)


def _up(a, b, resolution: int):
    """The place at the level above resolution that is nearest."""
    x, y = ((3 * a - b), (a + 2 * b)) if resolution % 2 else ((2 * a + b), (3 * b - a))
    return np.rint(x / 7).astype(np.int64), np.rint(y / 7).astype(np.int64)


def _turned(digits: np.ndarray, times: np.ndarray) -> np.ndarray:
    for k in range(1, 6):
        digits = np.where((times >= k)[:, None], TURNED[digits], digits)
    return digits


def _leading(digits: np.ndarray) -> np.ndarray:
    """Each row's first digit that isn't 0, or 0."""
    if not digits.shape[1]:
        return np.zeros(len(digits), np.int64)
    first = np.argmax(digits != 0, 1)
    return digits[np.arange(len(digits)), first]


def _cells_of(v: np.ndarray, resolution: int) -> np.ndarray:
    face = np.argmax(v @ CENTRE.T, 1)
    a, b = _nearest(to_plane(face, v) / _scale(resolution))
    digits = np.zeros((len(v), resolution), np.int64)
    for r in range(resolution, 0, -1):
        up_a, up_b = _up(a, b, r)
        mid_a, mid_b = _down(up_a, up_b, r)
        digits[:, r - 1] = _DIGIT[(a - mid_a + 1) * 3 + b - mid_b + 1]
        a, b = up_a, up_b
    base, turn = BASE_CELL[face, a + 2, b + 2], BASE_TURN[face, a + 2, b + 2]
    digits = _turned(digits, turn)
    lost = _IS_PENTAGON[base] & (_leading(digits) == K)  # on the far side of what isn't there, or on the near side
    digits = _turned(digits, np.where(lost, np.where(STEP[base, face] == 0, 1, 5), 0))
    out = np.full(len(v), (1 << 59) | (resolution << 52), np.int64) | base.astype(np.int64) << 45
    for r in range(1, 16):
        out |= (digits[:, r - 1] if r <= resolution else np.full(len(v), 7)) << 3 * (15 - r)
    return out


def cell_of(lat: np.ndarray, lon: np.ndarray, resolution: int) -> np.ndarray:
    """The cells of places in degrees."""
    return _cells_of(unit_vector(np.radians(np.asarray(lat, float)), np.radians(np.asarray(lon, float))), resolution)


def resolution_of(cells: np.ndarray) -> np.ndarray:
    return cells >> 52 & 15


def _unfolded(face: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places beyond an edge of their face's plane, in the frame of the face that they are on."""
    face, z = face.copy(), z.copy()
    for _ in range(4):
        beyond = np.stack([(-z * W ** (-k)).real for k in range(3)], -1)  # how far towards the edge opposite of corner k
        k = beyond.argmax(-1)
        out = beyond.max(-1) > 1 + 1e-9
        if not out.any():
            break
        z = np.where(out, _TURN[NEXT_TURN[face, k]] * z + NEXT_SHIFT[face, k], z)
        face = np.where(out, NEXT[face, k], face)
    return face, z


def _lattice(cells: np.ndarray, resolution: int) -> tuple[np.ndarray, np.ndarray]:
    """(face, place as of resolution 0) of centres of cells of one resolution, on the face that holds them."""
    base = cells >> 45 & 127
    digits = np.stack([cells >> 3 * (15 - r) & 7 for r in range(1, resolution + 1)], 1) if resolution else np.zeros((len(cells), 0), np.int64)
    a, b = HOME_AB[base].T
    for r in range(1, resolution + 1):
        a, b = _down(a, b, r)
        a, b = a + DIGITS[digits[:, r - 1], 0], b + DIGITS[digits[:, r - 1], 1]
    face, z = HOME[base], (a + b * W) * _scale(resolution)
    around = _IS_PENTAGON[base]
    if around.any():
        way = z - HOME_Z[base]
        angle = np.round(np.degrees(np.angle(way)), 9) % 360
        gap, lead = around & (angle > 210) & (angle < 270), _leading(digits)
        way = np.where(gap, way * np.where(lead == IK, _TURN[5], _TURN[1]), way)
        z = np.where(around, HOME_Z[base] + way, z)
        angle = np.round(np.degrees(np.angle(way)), 9) % 360
        steps = np.where(around & (np.abs(way) > 1e-12), np.ceil((150 - angle) % 360 / 60).astype(int) % 6, 0)
        steps = np.where((angle >= 150) & (angle <= 210), 0, np.minimum(steps, 4))
        corner = np.zeros(len(cells), int)
        for n in range(1, 5):  # clockwise around the vertex, a face at a time
            on = steps >= n
            edge = (corner + 2) % 3
            turn, shift = _TURN[NEXT_TURN[face, edge]], NEXT_SHIFT[face, edge]
            vertex = turn * CORNERS[corner] + shift
            corner = np.where(on, np.abs(vertex[:, None] - CORNERS[None, :]).argmin(1), corner)
            z, face = np.where(on, turn * z + shift, z), np.where(on, NEXT[face, edge], face)
    flat = ~around
    moved_face, moved = _unfolded(face, z)
    return np.where(flat, moved_face, face), np.where(flat, moved, z)


def _by_resolution(cells: np.ndarray, one, shape: tuple) -> np.ndarray:
    cells = np.asarray(cells, np.int64)
    out = np.zeros((len(cells), *shape))
    level = resolution_of(cells)
    for r in np.unique(level):
        out[level == r] = one(cells[level == r], int(r))
    return out


def _degrees(v: np.ndarray) -> np.ndarray:
    return np.degrees(np.stack([np.arcsin(np.clip(v[..., 2], -1, 1)), np.arctan2(v[..., 1], v[..., 0])], -1))


def centre_of(cells: np.ndarray) -> np.ndarray:
    """Latitude and longitude of each cell's centre, in degrees."""
    return _by_resolution(cells, lambda c, r: _degrees(to_sphere(*_lattice(c, r))), (2,))


def is_pentagon(cells: np.ndarray) -> np.ndarray:
    cells, level = np.asarray(cells, np.int64), resolution_of(np.asarray(cells, np.int64))
    used = np.where(level == 15, cells, cells >> 3 * (15 - level) << 3 * (15 - level)) & (1 << 45) - 1
    return _IS_PENTAGON[cells >> 45 & 127] & (used == 0)


def corners_of(cells: np.ndarray) -> np.ndarray:
    """Latitude and longitude of each cell's six corners, counter-clockwise; a pentagon has one of its five twice.

    Corners only: where an edge bends, as it crosses from face to face, no point is added."""

    def one(c: np.ndarray, r: int) -> np.ndarray:
        face, z = _lattice(c, r)
        out = [to_sphere(*_unfolded(face, z + np.exp(1j * np.pi / 3 * (k + 0.5)) / 3**0.5 * _scale(r))) for k in range(6)]
        return _degrees(np.stack(out, 1))

    return _by_resolution(cells, one, (6, 2))


def beside(cells: np.ndarray) -> np.ndarray:
    """The six cells beside each cell; where a pentagon is or is met, some come twice or are the cell itself."""
    cells = np.asarray(cells, np.int64)
    out, level = np.zeros((len(cells), 6), np.int64), resolution_of(cells)
    for r in np.unique(level):
        at = level == r
        face, z = _lattice(cells[at], int(r))
        out[at] = np.stack([_cells_of(to_sphere(*_unfolded(face, z + _TURN[k] * _scale(int(r)))), int(r)) for k in range(6)], 1)
    return out


def disk(cells: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the cell, a cell at most k steps from it), in order."""
    cells = np.asarray(cells, np.int64)
    found = edge = np.stack([np.arange(len(cells)), cells], 1)
    for _ in range(k):
        more = np.stack([np.repeat(edge[:, 0], 6), beside(edge[:, 1]).ravel()], 1)
        grown = np.unique(np.concatenate([found, more]), axis=0)
        _, at, times = np.unique(np.concatenate([found, grown]), axis=0, return_inverse=True, return_counts=True)
        new = times[at.ravel()][len(found) :] == 1
        found, edge = grown, grown[new]
    found = found[np.lexsort((found[:, 1], found[:, 0]))]
    return found[:, 0], found[:, 1]
