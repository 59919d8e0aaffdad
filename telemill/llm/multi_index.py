"""Near-duplicate vectors by an inverted multi-index.

Both halves of the vectors have a codebook of their own, and the pairs of codes are the cells of a
grid. A vector visits cells in the order of how far it would have to move, in both halves together,
to be coded there: the multi-sequence order, a staircase over the two sorted lists of distances. It
stops at the distance within which the target share of neighbours at the very limit lies, which is
measured on a sample. What it meets is verified by its cosine in double precision.

Tight groups are not compared pair by pair. The vectors of a cell are first gathered in balls, whose
members all link with each other because each lies within half the limit's angle of one point. Two
balls link fully, or not at all, if their centres and radii say so; only where these leave a doubt
are members compared with the other ball, and then one by one. So a group of near copies that is a
third of all rows costs as many comparisons as it has balls, and no pair of it is ever emitted.

Work is dealt in blocks: runs of cells with at most `BLOCK` vectors, or parts of one larger cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from telemill.llm.components import components
from telemill.llm.common import stored

LIMIT = 0.9
#: Share of the neighbours at the limit whose cells a vector visits.
RECALL = 0.98
#: Vectors that the codebooks and the reach are fitted on, about.
SAMPLE = 8192
#: Vectors per cell that the codebooks aim at, and vectors of the sample behind each code at least.
PER_CELL = 256
PER_CODE = 16
#: Vectors or balls that a task compares with each other, and visitors that it takes besides.
BLOCK = 2048
VISITORS = 8 * BLOCK
#: Entries of a matrix of cosines.
ENTRIES = 1 << 22
#: Angles nearer than this to a bound are in doubt.
SLACK = 1e-6


def _floats(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors as rows of a matrix, filled up with zeros, and which of them can link at all."""
    sizes = np.asarray(pc.list_value_length(vectors).fill_null(0), dtype=np.int64)
    values = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    begins = np.cumsum(sizes) - sizes
    rows = np.repeat(np.arange(len(sizes)), sizes)
    matrix = np.zeros((len(sizes), dim))
    matrix[rows, np.arange(len(values)) - np.repeat(begins, sizes)] = values
    return matrix, np.isfinite(matrix).all(axis=1) & matrix.any(axis=1)


def units(matrix: np.ndarray) -> np.ndarray:
    """Rows of length 1, whatever their scale."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True, initial=0)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _unpacked(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return units(np.frombuffer(joined, dtype=kind).reshape(-1, dim).astype(np.float64))


def _angle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between unit rows; exact for small angles too."""
    return 2 * np.arcsin(np.minimum(1.0, np.linalg.norm(a - b, axis=-1) / 2))


def _codebook(points: np.ndarray, codes: int, rng: np.random.Generator) -> np.ndarray:
    """k-means; the zero half of one-dimensional vectors has one code."""
    distinct = np.unique(points, axis=0)
    codes = min(codes, len(distinct)) if points.shape[1] else 1
    book = distinct[rng.choice(len(distinct), codes, replace=False)].copy()
    for _ in range(12):
        nearest = np.argmax(points @ book.T - (book * book).sum(1) / 2, axis=1)
        sums = np.zeros_like(book)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=codes)
        book[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return book


@dataclass(frozen=True)
class Index:
    """Two codebooks, and how far from their own cells vectors visit others."""

    first: np.ndarray
    second: np.ndarray
    reach: float

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def _moves(self, unit: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per half the own code, and the squared distance to the border of every other code."""
        half, found = self.first.shape[1], []
        for part, book in ((unit[:, :half], self.first), (unit[:, half:], self.second)):
            far = (book * book).sum(1) - 2 * part @ book.T
            own = far.argmin(1)
            gaps = far - far[np.arange(len(part)), own][:, None]
            apart = np.linalg.norm(book[:, None] - book[None], axis=2)[own]
            moves = np.divide(gaps, 2 * apart, out=np.zeros_like(gaps), where=apart > 0)
            found.append((own, moves * moves))
        return found

    def own(self, unit: np.ndarray) -> np.ndarray:
        (one, _), (two, _) = self._moves(unit)
        return one * len(self.second) + two

    def distance(self, unit: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How far each vector is from being in the cell beside it."""
        at = np.arange(len(unit))
        (_, one), (_, two) = self._moves(unit)
        return one[at, cells // len(self.second)] + two[at, cells % len(self.second)]

    def visited(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cells within reach of each vector, its own included: places of vectors, and cells."""
        rows, cells = [], []
        step = max(1, ENTRIES // self.cells)
        for begin in range(0, len(unit), step):
            (_, one), (_, two) = self._moves(unit[begin : begin + step])
            order1, order2 = one.argsort(1), two.argsort(1)
            one, two = np.take_along_axis(one, order1, 1), np.take_along_axis(two, order2, 1)
            # The staircase: for each code of the first list, those of the second that are near enough.
            wide, high = [int((x <= self.reach).sum(1).max()) for x in (one, two)]
            at, i, j = np.nonzero(one[:, :wide, None] + two[:, None, :high] <= self.reach)
            rows.append(at + begin)
            cells.append(order1[at, i] * len(self.second) + order2[at, j])
        return np.concatenate(rows), np.concatenate(cells)


def fit(sample: np.ndarray, total: int, limit: float = LIMIT, recall: float = RECALL) -> Index:
    """Codebooks for `total` vectors from a sample of unit vectors, and the reach for `recall`.

    Each vector of the sample gets a neighbour at the limit's cosine, for half of them in any
    direction, for the others in the direction of some other vector, as the data spread.
    """
    rng = np.random.default_rng(0)
    most = max(1, len(sample) // PER_CODE)
    codes = min(most, max(1, math.ceil(math.sqrt(total / PER_CELL))))
    half = sample.shape[1] // 2
    index = Index(_codebook(sample[:, :half], codes, rng), _codebook(sample[:, half:], codes, rng), 0.0)
    ways = rng.normal(size=sample.shape)
    ways[::2] = (sample - sample[rng.permutation(len(sample))])[::2]
    ways -= (ways * sample).sum(1, keepdims=True) * sample
    length = np.linalg.norm(ways, axis=1, keepdims=True)
    ways = np.divide(ways, length, out=np.zeros_like(ways), where=length > 1e-9)
    near = units(limit * sample + math.sqrt(1 - limit * limit) * ways)
    reach = float(np.quantile(index.distance(sample, index.own(near)), recall))
    return Index(index.first, index.second, reach)


class Blocks:
    """How cells are dealt: runs of cells with up to `BLOCK` rows, and larger ones in parts."""

    def __init__(self, counts: np.ndarray) -> None:
        self.parts = -(-counts // BLOCK)  # none of an empty cell, which nobody visits
        self.first = np.zeros(len(counts), dtype=np.int64)
        block, filled = -1, BLOCK
        for cell, n in enumerate(counts.tolist()):
            if filled + n > BLOCK:
                block, filled = block + 1, 0
            self.first[cell] = block
            filled += n
            if self.parts[cell] > 1:
                block, filled = block + int(self.parts[cell]) - 1, BLOCK
        self.number = block + 1

    def of(self, cells: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The block of each row; `numbers` deals the rows of a cell over its parts."""
        return self.first[cells] + numbers % self.parts[cells]


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Row numbers stirred, so that neighbours are dealt apart."""
    stirred = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (stirred >> np.uint64(33)).astype(np.int64)


def _counts(rows: DataFrame, name: str, size: int) -> np.ndarray:
    """Rows per cell or block: at most `size` numbers, which do not grow with the rows of a cell."""
    found = rows.groupBy(name).agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, dtype=np.int64)
    counts[np.asarray(found.column(name))] = np.asarray(found.column("n"))
    return counts


# One row per vector that can link. The row of a ball's first member speaks for the ball: `n`
# members, `centre`, `radius`, `least` id, and the cells that members visit; a lone one's centre is it.
MEMBERS = (
    "row bigint, id bigint, cell int, ball bigint, vector binary, is_first boolean, n bigint, "
    "centre binary, radius double, least bigint, visits array<int>"
)
MEMBERS_NAMES = [field.split()[0] for field in MEMBERS.split(", ")]


def _gathered(unit: np.ndarray, tight: float) -> np.ndarray:
    """For each vector the place of the first of its ball: itself, or one within the tight cosine.

    Vectors with many others near them come first.
    """
    near = unit @ unit.T >= tight
    crowd = near.sum(1)
    ball = np.arange(len(unit))
    free = np.ones(len(unit), dtype=bool)
    for place in np.argsort(-crowd, kind="stable"):
        if crowd[place] == 1:
            break
        if free[place]:
            own = near[place] & free
            ball[own] = place
            free[own] = False
    return ball


def _balls(index: Index, dim: int, kind: str, limit: float):
    tight = math.sqrt((1 + limit) / 2) + 1e-12

    def gather(table: pa.Table) -> pa.Table:
        unit = _unpacked(table.column("vector"), dim, kind)
        rows, cells = (np.asarray(table.column(c)) for c in ("row", "cell"))
        ids = table.column("id").to_pylist()
        order = np.lexsort((rows, cells))
        places = np.split(order, np.flatnonzero(np.diff(cells[order])) + 1)
        ball = np.empty(len(rows), dtype=np.int64)
        for own in places:
            ball[own] = own[_gathered(unit[own], tight)]
        at, visited = index.visited(unit)
        # Distinct cells per ball.
        keys = np.unique(ball[at] * index.cells + visited)
        by_ball = np.split(keys % index.cells, np.flatnonzero(np.diff(keys // index.cells)) + 1)
        visits = dict(zip(np.unique(keys // index.cells).tolist(), by_ball))
        members = np.argsort(ball, kind="stable")
        groups = np.split(members, np.flatnonzero(np.diff(ball[members])) + 1)
        columns = {name: [None] * len(rows) for name in ("n", "centre", "radius", "least", "visits")}
        for group in groups:
            first = int(ball[group[0]])
            known = [ids[i] for i in group if ids[i] is not None]
            columns["n"][first] = len(group)
            columns["least"][first] = min(known, default=None)
            columns["visits"][first] = visits[first].tolist()
            columns["radius"][first] = 0.0
            if len(group) > 1:
                packed = units(unit[group].mean(axis=0, keepdims=True)).astype(kind)
                centre = units(packed.astype(np.float64))
                columns["centre"][first] = packed.tobytes()
                columns["radius"][first] = float(_angle(unit[group], centre).max())
        own = [table.column(c).combine_chunks() for c in ("row", "id", "cell")]
        return pa.Table.from_arrays(
            [*own, pa.array(rows[ball]), table.column("vector").combine_chunks(),
             pa.array(ball == np.arange(len(rows))), pa.array(columns["n"], pa.int64()),
             pa.array(columns["centre"], pa.binary()), pa.array(columns["radius"], pa.float64()),
             pa.array(columns["least"], pa.int64()), pa.array(columns["visits"], pa.list_(pa.int32()))],
            MEMBERS_NAMES,
        )

    return gather


# A ball in a block: as one of its own, or as a visitor of some cells.
DEALT = (
    "block bigint, slot bigint, is_own boolean, ball bigint, cell int, n bigint, vector binary, "
    "radius double, visits array<int>"
)


def _visits(batch: pa.RecordBatch, blocks: Blocks):
    """(place of a ball, block, cell) for each cell of a block that a ball visits or is in.

    Of two cells the lower one's balls visit the higher one; of parts of a cell, likewise.
    """
    cells = np.asarray(batch.column("cell"), dtype=np.int64)
    own = blocks.of(cells, _mixed(np.asarray(batch.column("ball"))))
    lists = batch.column("visits")
    at = np.repeat(np.arange(len(cells)), np.asarray(pc.list_value_length(lists)))
    to = np.asarray(lists.flatten(), dtype=np.int64)
    higher = to > cells[at]
    at, to = at[higher], to[higher]
    # A ball's own cell: all its parts from its own one on.
    at, to = np.concatenate([at, np.arange(len(cells))]), np.concatenate([to, cells])
    parts = blocks.parts[to]
    place = np.repeat(np.arange(len(at)), parts)
    inner = np.arange(len(place)) - np.repeat(np.cumsum(parts) - parts, parts)
    at, to, block = at[place], to[place], blocks.first[to[place]] + inner
    wanted = (to != cells[at]) | (block >= own[at])
    return own, at[wanted], block[wanted], to[wanted]


def _visitors(blocks: Blocks):
    """How many balls from elsewhere visit each block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, at, block, _ = _visits(batch, blocks)
            pairs = np.unique(at * blocks.number + block)
            outside = pairs % blocks.number != own[pairs // blocks.number]
            found, n = np.unique(pairs[outside] % blocks.number, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["block", "n"])

    return count


def _deal(blocks: Blocks, slots: np.ndarray):
    """Each ball once to every slot of its own block, and to one slot of each block it visits."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, at, block, to = _visits(batch, blocks)
            mixed = _mixed(np.asarray(batch.column("ball")) + 1)
            order = np.lexsort((to, block, at))
            at, block, to = at[order], block[order], to[order]
            new = np.flatnonzero(np.r_[True, (np.diff(at) != 0) | (np.diff(block) != 0)])
            visits = pa.ListArray.from_arrays(
                pa.array(np.r_[new, len(to)], pa.int32()), pa.array(to, pa.int32())
            )
            at, block = at[new], block[new]
            is_own = block == own[at]
            # Own balls go to all slots of their block.
            times = np.where(is_own, slots[block], 1)
            place = np.repeat(np.arange(len(at)), times)
            inner = np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)
            is_own, at, block = is_own[place], at[place], block[place]
            slot = np.where(is_own, inner, mixed[at] % slots[block])
            ball = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), pa.array(slot), pa.array(is_own),
                 *(ball.column(c) for c in ("ball", "cell", "n", "vector", "radius")),
                 visits.take(pa.array(place))],
                ["block", "slot", "is_own", "ball", "cell", "n", "vector", "radius", "visits"],
            )

    return deal


class Groups:
    """Sets that links join."""

    def __init__(self, size: int) -> None:
        self.parent = np.arange(size)

    def roots(self) -> np.ndarray:
        """The first member of the set of each."""
        return self._roots(np.arange(len(self.parent)))

    def _roots(self, at: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[at]
            if (up == at).all():
                return at
            at = up

    def join(self, one: np.ndarray, two: np.ndarray) -> None:
        while len(one):
            one, two = self._roots(one), self._roots(two)
            apart = one != two
            one, two = one[apart], two[apart]
            np.minimum.at(self.parent, np.maximum(one, two), np.minimum(one, two))

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """A link for each member but the first of a set."""
        roots = self.roots()
        rest = np.flatnonzero(roots != np.arange(len(roots)))
        return rest, roots[rest]


# What a comparison finds. COUNT: all members of ball u link with n more vectors. ROW: vector u does.
# EDGE: balls u and v are connected. DOUBT: members of u and v have to be compared.
COUNT, ROW, EDGE, DOUBT = range(4)
FOUND = "kind int, u bigint, v bigint, n bigint"


def _found(*parts: tuple[int, np.ndarray, np.ndarray | None, np.ndarray | None]) -> list[pa.Array]:
    kinds, us, vs, ns = [], [], [], []
    for kind, u, v, n in parts:
        kinds.append(np.full(len(u), kind, dtype=np.int32))
        us.append(u)
        vs.append(np.zeros(len(u), dtype=np.int64) if v is None else v)
        ns.append(np.zeros(len(u), dtype=np.int64) if n is None else n)
    return [pa.array(np.concatenate(x)) for x in (kinds, us, vs, ns)]


FOUND_NAMES = ["kind", "u", "v", "n"]


def _compare(dim: int, kind: str, limit: float):
    angle_limit = math.acos(limit)

    def compare(table: pa.Table) -> pa.Table:
        table = table.take(np.argsort(~np.asarray(table.column("is_own")), kind="stable"))
        unit = _unpacked(table.column("vector"), dim, kind)
        balls, cells, sizes, radii = (
            np.asarray(table.column(c)) for c in ("ball", "cell", "n", "radius")
        )
        own = int(np.count_nonzero(np.asarray(table.column("is_own"))))
        first_slot = table.num_rows and table.column("slot")[0].as_py() == 0
        visits = table.column("visits").combine_chunks()
        by = np.repeat(np.arange(len(balls)), np.asarray(pc.list_value_length(visits)))
        to = np.asarray(visits.flatten())
        if not first_slot:  # what own balls have with each other is found once
            by, to = by[by >= own], to[by >= own]
        order = np.lexsort((by, to))
        by, to = by[order], to[order]
        counts = np.zeros(len(balls), dtype=np.int64)
        groups, doubts = Groups(len(balls)), []
        for cell in np.unique(cells[:own]):
            there = np.flatnonzero(cells[:own] == cell)
            begin, end = np.searchsorted(to, [cell, cell + 1])
            step = max(1, ENTRIES // len(there))
            for at in range(begin, end, step):
                who = by[at : min(at + step, end)]
                cosines = unit[who] @ unit[there].T
                far = np.minimum(np.pi, angle_limit + radii[who][:, None] + radii[there] + SLACK)
                i, j = np.nonzero(cosines >= np.cos(far) - SLACK)
                q, t = who[i], there[j]
                # Balls of one cell and block meet as visitor and as visited; one order counts.
                kept = (q >= own) | (cells[q] != cell) | (q < t)
                q, t, cosine = q[kept], t[kept], cosines[i, j][kept]
                spread = radii[q] + radii[t]
                angle = _angle(unit[q], unit[t])
                single = spread == 0
                linked = np.where(single, cosine >= limit, angle + spread <= angle_limit - SLACK)
                doubtful = ~single & ~linked & (angle - spread <= angle_limit + SLACK)
                np.add.at(counts, q[linked], sizes[t[linked]])
                np.add.at(counts, t[linked], sizes[q[linked]])
                groups.join(q[linked], t[linked])
                doubts.append(np.stack([balls[q[doubtful]], balls[t[doubtful]]]))
        doubt = np.concatenate(doubts, axis=1) if doubts else np.zeros((2, 0), dtype=np.int64)
        some = np.flatnonzero(counts)
        one, two = groups.edges()
        return pa.Table.from_arrays(
            _found(
                (COUNT, balls[some], None, counts[some]),
                (EDGE, balls[one], balls[two], None),
                (DOUBT, doubt[0], doubt[1], None),
            ),
            FOUND_NAMES,
        )

    return compare


def _member_against_ball(dim: int, kind: str, limit: float):
    """Single vectors against whole balls; what stays in doubt goes on with the vector."""
    angle_limit = math.acos(limit)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (_unpacked(batch.column(c), dim, kind) for c in ("x", "centre"))
            row, u, v, n, radius = (np.asarray(batch.column(c)) for c in ("row", "u", "v", "n", "radius"))
            angle = _angle(one, two)
            single = radius == 0
            linked = np.where(single, (one * two).sum(1) >= limit, angle + radius <= angle_limit - SLACK)
            doubtful = ~single & ~linked & (angle - radius <= angle_limit + SLACK)
            found = _found(
                (ROW, row[linked], None, n[linked]),
                (COUNT, v[linked], None, np.ones(int(linked.sum()), dtype=np.int64)),
                (EDGE, u[linked], v[linked], None),
                (DOUBT, u[doubtful], v[doubtful], row[doubtful]),
            )
            none = pa.nulls(len(found[0]) - int(doubtful.sum()), pa.binary())
            left = batch.column("x").filter(pa.array(doubtful))
            yield pa.RecordBatch.from_arrays(
                [*found, pa.concat_arrays([none, left])], [*FOUND_NAMES, "x"]
            )

    return compare


def _member_against_member(dim: int, kind: str, limit: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (_unpacked(batch.column(c), dim, kind) for c in ("x", "y"))
            linked = (one * two).sum(1) >= limit
            row, other, u, v = (np.asarray(batch.column(c))[linked] for c in ("row", "other", "u", "v"))
            ones = np.ones(len(row), dtype=np.int64)
            edges = np.unique(np.stack([u, v]), axis=1) if len(u) else np.zeros((2, 0), dtype=np.int64)
            found = _found((ROW, row, None, ones), (ROW, other, None, ones), (EDGE, *edges, None))
            yield pa.RecordBatch.from_arrays(found, FOUND_NAMES)

    return compare


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    limit: float = LIMIT,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of `vectors`: id, n_links, component_id and kept.

    n_links counts the other vectors with a cosine of `limit` or more that were found, component_id
    is the smallest id that links reach, and kept says that it is the row's own. No pair below the
    limit counts, and no pair within a ball is missed; between cells, a pair is found if the vector
    in the lower cell visits the higher one.

    Vectors that are null, empty, zero or hold a null or a component that is not finite link with
    nothing. A shorter vector counts as filled up with zeros. Rows that repeat an id are vectors of
    their own. A row without an id links as others do, but names no component: the smallest id known
    does, and if there is none, component_id is null and kept true. An empty table gives no rows. Other
    columns are not read.
    """
    spark = vectors.sparkSession
    element = vectors.schema[vector_column].dataType
    is_float = isinstance(element, ArrayType) and isinstance(element.elementType, FloatType)
    kind = "<f4" if is_float else "<f8"
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("bigint").alias("id"),
        F.col(vector_column).alias("vector"),
    )
    total, dim = rows.agg(F.count("vector"), F.max(F.size("vector"))).first()
    dim = max(dim or 0, 1)
    wide = F.transform("vector", lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    is_able = F.coalesce(finite & F.exists(wide, lambda x: x != 0), F.lit(False))

    share = min(1.0, SAMPLE / max(total, 1))
    drawn = (F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30))) | F.lit(share >= 1)
    taken = rows.filter(is_able & drawn).select("vector").limit(2 * SAMPLE).toArrow().column(0)
    alone = rows.filter(~is_able).select(
        F.col("id").alias(id_column),
        F.lit(0).cast("bigint").alias("n_links"),
        F.col("id").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    if not len(taken):
        # No vector of the sample can link. With a sample of all rows there is none.
        if share >= 1:
            return alone
        taken = rows.filter(is_able).select("vector").limit(SAMPLE).toArrow().column(0)
        if not len(taken):
            return alone
    matrix, _ = _floats(taken.combine_chunks(), dim)
    index = fit(units(matrix), total, limit, recall)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix, _ = _floats(batch.column("vector"), dim)
            cells = index.own(units(matrix)) if len(matrix) else np.zeros(0, dtype=np.int64)
            packed = [row.tobytes() for row in matrix.astype(kind)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(packed, pa.binary()),
                 pa.array(cells, pa.int32())],
                ["row", "id", "vector", "cell"],
            )

    cells = rows.filter(is_able).mapInArrow(coded, "row bigint, id bigint, vector binary, cell int")
    blocks = Blocks(_counts(cells.select("cell", F.lit(1).alias("n")), "cell", index.cells))

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = blocks.of(np.asarray(batch.column("cell")), _mixed(np.asarray(batch.column("row"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], [*batch.schema.names, "block"])

    dealt = cells.mapInArrow(blocked, "row bigint, id bigint, vector binary, cell int, block bigint")
    members = stored(
        dealt.groupBy("block").applyInArrow(_balls(index, dim, kind, limit), MEMBERS), "members"
    )
    balls = members.filter("is_first").select(
        "ball", "cell", "n", F.coalesce("centre", "vector").alias("vector"), "radius", "least", "visits"
    )
    found = stored(_compared(balls, index, dim, kind, limit), "found")
    doubts = found.filter(F.col("kind") == DOUBT).select("u", "v")
    rest = []
    if not doubts.isEmpty():
        rest = _doubts(doubts, members, balls, dim, kind, limit)
    for more in rest:
        found = found.unionByName(more)

    def summed(which: int, name: str) -> DataFrame:
        return (
            found.filter(F.col("kind") == which)
            .groupBy(F.col("u").alias(name))
            .agg(F.sum("n").alias(f"{name}_links"))
        )

    edges = found.filter((F.col("kind") == EDGE) & (F.col("u") != F.col("v"))).select("u", "v")
    parts = components(edges).select(F.col("node").alias("ball"), "component")
    own = (
        balls.select("ball", "n", "least")
        .join(parts.hint("merge"), "ball", "left")
        .withColumn("component", F.coalesce("component", "ball"))
        .join(summed(COUNT, "ball").hint("merge"), "ball", "left")
    )
    named = own.groupBy("component").agg(F.min("least").alias("component_id"))
    of_ball = own.join(named.hint("merge"), "component").select(
        "ball", "component_id", (F.col("n") - 1 + F.coalesce("ball_links", F.lit(0))).alias("links")
    )
    linked = members.select("row", "id", "ball").join(of_ball.hint("merge"), "ball")
    if rest:
        linked = linked.join(summed(ROW, "row").hint("merge"), "row", "left").withColumn(
            "links", F.col("links") + F.coalesce("row_links", F.lit(0))
        )
    return linked.select(
        F.col("id").alias(id_column),
        F.col("links").alias("n_links"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    ).unionByName(alone)


def _compared(balls: DataFrame, index: Index, dim: int, kind: str, limit: float) -> DataFrame:
    """What balls find in the cells they visit (see `FOUND`)."""
    per_cell = balls.select("cell", F.lit(1).alias("n"))
    blocks = Blocks(_counts(per_cell, "cell", index.cells))
    visitors = balls.select("ball", "cell", "visits").mapInArrow(
        _visitors(blocks), "block bigint, n bigint"
    )
    slots = np.maximum(1, -(-_counts(visitors, "block", blocks.number) // VISITORS))
    dealt = balls.drop("least").mapInArrow(_deal(blocks, slots), DEALT)
    return dealt.groupBy("block", "slot").applyInArrow(_compare(dim, kind, limit), FOUND)


def _doubts(
    doubts: DataFrame, members: DataFrame, balls: DataFrame, dim: int, kind: str, limit: float
) -> list[DataFrame]:
    """Balls in doubt: the members of one against the other ball, then one by one."""
    each = members.select("row", "ball", F.col("vector").alias("x"))
    centres = balls.select(F.col("ball").alias("v"), "n", "radius", F.col("vector").alias("centre"))
    pairs = doubts.join(each.withColumnRenamed("ball", "u").hint("merge"), "u").join(
        centres.hint("merge"), "v"
    )
    halfway = stored(
        pairs.mapInArrow(_member_against_ball(dim, kind, limit), FOUND + ", x binary"), "found"
    )
    others = each.select(F.col("ball").alias("v"), F.col("row").alias("other"), F.col("x").alias("y"))
    left = (
        halfway.filter(F.col("kind") == DOUBT)
        .select("u", "v", F.col("n").alias("row"), "x")
        .join(others.hint("merge"), "v")
    )
    last = stored(left.mapInArrow(_member_against_member(dim, kind, limit), FOUND), "found")
    return [halfway.filter(F.col("kind") != DOUBT).drop("x"), last]
