"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors become integers (``floor(scale * x)``).  The candidates are written as
Parquet in the order of (label, place on a Hilbert curve), in blocks of
``BLOCK_ROWS`` rows; each block has a zone map: the least and the greatest value
of every dimension, and of the label.  By interval arithmetic a zone map bounds
the inner products of an anchor with all rows of its block, so it tells which
blocks a window (a range of scores of which the best k are wanted) must read:

1. pilot: each window reads its ``PILOT`` most promising blocks; the k-th best
   score found is a floor;
2. whole search: it reads every block whose bounds reach the window above its
   floor, and no other.  What the pilot read is read again, so this step alone
   makes the result, and nothing can be missed.

The search runs twice: the positives (window: everything, same label), then the
negatives (window: the given share of the positive's score, other labels).

Work is dealt in tiles: up to ``SLICE`` anchors, neighbours on the curve, by a
stretch of up to ``STRETCH`` neighbouring blocks.  An anchor's vector goes to
the stretches it must read, a block to the slices that ask for it, so no task
holds more than a tile however many rows share a label or a vector.  Bounds and
scores are exact: floats while all sums stay below 2^53, integers beyond.

Defined results: rows with a null id, label or vector, an empty vector, or a
null or non-finite component take no part; vectors of another length than the
anchor's are no partners of it; a row is never a partner of an anchor with its
id; rows that repeat an id are candidates each, and count once as anchors (the
smallest label, then vector); ties go to the smaller id; anchors without a
positive, and positives without a negative in their window (always so where
the positive's score is below 0), give no rows; components of 2^54 / scale or
more and scores beyond 64 bits are errors; other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import materialise, read_table, with_row_index

BLOCK_ROWS = 2048
SLICE = 4096
STRETCH = 8
ZONES = 4096             # zone maps that a bounding task holds, in whole stretches
PILOT = 2
CURVE_DIMS, CURVE_BITS = 64, 5
_LEAST, _MOST = -(1 << 63) + 1, (1 << 63) - 1
_STEP = 512              # anchors multiplied at once


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve of a grid with 2^bits cells a side, as big-endian bytes.

    Works for all rows at once, one dimension and bit plane after the other (the curve as a chain of
    reflections and swaps of axes, then a Gray code over all bits).
    """
    x = cells.astype(np.uint32).T.copy()
    top = 1 << (bits - 1)
    plane = top
    while plane > 1:
        below = np.uint32(plane - 1)
        for d in range(len(x)):
            flip = (x[d] & plane) != 0
            swap = np.where(flip, 0, (x[0] ^ x[d]) & below).astype(np.uint32)
            x[0] ^= np.where(flip, below, swap)
            if d:
                x[d] ^= swap
        plane >>= 1
    for d in range(1, len(x)):
        x[d] ^= x[d - 1]
    turn, plane = np.zeros(x.shape[1], np.uint32), top
    while plane > 1:
        turn ^= np.where((x[-1] & plane) != 0, plane - 1, 0).astype(np.uint32)
        plane >>= 1
    x ^= turn
    planes = np.stack([(x >> b) & 1 for b in range(bits - 1, -1, -1)])        # bits x dims x rows
    packed = np.packbits(planes.reshape(bits * len(x), -1).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def products(a: np.ndarray, b: np.ndarray, wanted: np.ndarray | None = None) -> np.ndarray:
    """Exact inner products of all rows of two integer matrices; an error where a wanted one is beyond 64 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = a.shape[1] * int(np.abs(a).max()) * int(np.abs(b).max())
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 62:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    over = (exact >= _MOST) | (exact <= _LEAST)
    if (over if wanted is None else over & wanted).any():
        raise OverflowError("a score does not fit into 64 bits")
    return np.where(over, 0, exact).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of ``a`` with anything between ``low`` and ``high``."""
    plus, minus = np.maximum(a, 0), np.minimum(a, 0)
    size = a.shape[1] * int(np.abs(a).max()) * max(int(np.abs(low).max()), int(np.abs(high).max())) if a.size and low.size else 0
    if size < 1 << 52:
        return (products(plus, low) + products(minus, high)), (products(plus, high) + products(minus, low))
    f = lambda x, y: x.astype(np.float64) @ y.astype(np.float64).T
    slack = 1e-9 * f(np.abs(a), np.maximum(np.abs(low), np.abs(high)))   # far above what rounding can do
    return f(plus, low) + f(minus, high) - slack, f(plus, high) + f(minus, low) + slack


def _lists(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A column of integer lists by their length: length -> (rows, matrix)."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths, out = np.diff(ends), {}
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        out[int(n)] = at, flat[ends[:-1][at][:, None] + np.arange(n)[None, :]]
    return out


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _windows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the windows, anchors x most windows; those an anchor does not have are empty."""
    listed = table.column("windows").to_pylist()
    most = max((x["w"] + 1 for xs in listed for x in xs), default=0)
    low, high = np.full((len(listed), most), _MOST), np.full((len(listed), most), _LEAST)
    for i, xs in enumerate(listed):
        for x in xs:
            low[i, x["w"]], high[i, x["w"]] = x["lo"], x["hi"]
    return low, high


def _partner(label: np.ndarray, least: np.ndarray, most: np.ndarray, same: bool) -> np.ndarray:
    """May a block with labels from least to most hold partners of an anchor with this label?"""
    if same:
        return (least[None, :] <= label[:, None]) & (label[:, None] <= most[None, :])
    return ~((least[None, :] == label[:, None]) & (most[None, :] == label[:, None]))


def _zones_of(batches):
    """The zone maps of what a batch holds of each block."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        blocks, labels, rows = _ints(table, "block"), _ints(table, "label"), []
        for n, (at, v) in _lists(table.column("v")).items():
            for b in np.unique(blocks[at]):
                here = blocks[at] == b
                rows.append((int(b), n, int(labels[at][here].min()), int(labels[at][here].max()),
                             v[here].min(axis=0).tolist(), v[here].max(axis=0).tolist()))
        cols = list(zip(*rows, strict=True)) or [()] * 6
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, _ZONE_TYPES, strict=True)], names=_ZONE_NAMES)


_ZONE = "block long, length int, label_lo long, label_hi long, lo array<long>, hi array<long>"
_ZONE_NAMES = [x.split()[0] for x in _ZONE.split(", ")]
_ZONE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def _merge_zones(table: pa.Table) -> pa.Table:
    (_, low), = _lists(table.column("lo")).values()
    (_, high), = _lists(table.column("hi")).values()
    row = (_ints(table, "block")[0], _ints(table, "length")[0], _ints(table, "label_lo").min(), _ints(table, "label_hi").max(),
           low.min(axis=0).tolist(), high.max(axis=0).tolist())
    return pa.table([pa.array([x], t) for x, t in zip(row, _ZONE_TYPES, strict=True)], names=_ZONE_NAMES)


def write_blocks(rows: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """(candidates: id, label, v, asks, row, block in the order of label and curve; their zone maps)."""
    spread = rows.agg(F.avg(F.expr("aggregate(v, 0D, (s, x) -> s + abs(x)) / size(v)"))).first()[0] or 1.0
    side, reach = 1 << CURVE_BITS, 3.0 * spread + 1.0

    @F.arrow_udf("binary")
    def place(vectors: pa.Array) -> pa.Array:
        out: list[bytes] = [b""] * len(vectors)
        for _, (at, v) in _lists(pa.chunked_array([vectors])).items():
            cells = np.clip((v[:, :CURVE_DIMS] + reach) / (2 * reach) * side, 0, side - 1)
            for i, key in zip(at.tolist(), hilbert_keys(cells, CURVE_BITS), strict=True):
                out[i] = key
        return pa.array(out, pa.binary())

    placed = with_row_index(rows.withColumn("curve", place("v")), F.size("v"), F.col("label"), F.col("curve"), F.col("id"),
                            index="row")
    blocks = materialise(placed.select("id", "label", "v", "asks", "row", F.floor(F.col("row") / block_rows).alias("block")),
                         "negatives-blocks")
    zones = (blocks.mapInArrow(_zones_of, _ZONE).groupBy("block", "length").applyInArrow(_merge_zones, _ZONE))
    return blocks, materialise(zones, "negatives-zones")


class Search:
    """Windows of anchors against the blocks of one table."""

    def __init__(self, blocks: DataFrame, zones: DataFrame):
        spark = blocks.sparkSession
        self.blocks = blocks
        last = zones.agg(F.max("block")).first()[0]
        n = 0 if last is None else last + 1
        stretch = self.stretch = max(1, min(STRETCH, n // (4 * spark.sparkContext.defaultParallelism)))
        chunk = max(1, ZONES // stretch) * stretch
        self.chunks = max(1, math.ceil(n / chunk))
        self.zones = zones.withColumn("chunk", F.floor(F.col("block") / chunk))

    def choose(self, anchors: DataFrame, slices: int, same: bool, pilot: int) -> DataFrame:
        """(slice, stretch, blocks, anchors' numbers): the blocks that the windows must read; with ``pilot`` so many at most."""
        stretch = self.stretch

        def reach(left: pa.Table, right: pa.Table) -> pa.Table:
            out = []
            if left.num_rows and right.num_rows:
                no, label, of = _ints(left, "no"), _ints(left, "label"), _ints(left, "slice")[0]
                low, high = _windows(left)
                block, least, most = _ints(right, "block"), _ints(right, "label_lo"), _ints(right, "label_hi")
                lows, highs = _lists(right.column("lo")), _lists(right.column("hi"))
                need: dict[int, tuple[set, set]] = {}        # stretch -> its blocks, the anchors that read some of them
                for n, (at, x) in _lists(left.column("v")).items():
                    if n not in lows:
                        continue
                    z, zl = lows[n]
                    zh = highs[n][1]
                    may = _partner(label[at], least[z], most[z], same)
                    under, over = bounds(x, zl, zh)
                    read = np.zeros(may.shape, bool)
                    for w in range(low.shape[1]):
                        lo, hi = low[at, w][:, None], high[at, w][:, None]
                        hit = may & (over >= lo) & (under <= hi) & (lo <= hi)
                        if pilot:
                            middle = under.astype(np.float64) / 2 + over.astype(np.float64) / 2
                            far = np.abs(middle - np.minimum(hi.astype(np.float64), over.max() if over.size else 0.0))
                            order = np.argsort(np.where(hit, far, np.inf), axis=1, kind="stable")[:, :pilot]
                            best = np.zeros(hit.shape, bool)
                            np.put_along_axis(best, order, True, axis=1)
                            hit &= best
                        read |= hit
                    for s in np.unique(block[z] // stretch):
                        cols = np.flatnonzero(block[z] // stretch == s)
                        asked = read[:, cols]
                        if asked.any():
                            pair = need.setdefault(int(s), (set(), set()))
                            pair[0].update(block[z[cols[asked.any(axis=0)]]].tolist())
                            pair[1].update(no[at[asked.any(axis=1)]].tolist())
                out = [(int(of), s, sorted(b), sorted(a)) for s, (b, a) in sorted(need.items())]
            cols = list(zip(*out, strict=True)) or [()] * 4
            return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                             pa.array(cols[2], pa.list_(pa.int64())), pa.array(cols[3], pa.list_(pa.int32()))],
                            names=["slice", "stretch", "blocks", "nos"])

        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        asks = anchors.select("slice", "no", "label", "v", "windows", every(self.chunks).alias("chunk"))
        given = self.zones.withColumn("slice", every(max(1, slices)))
        return (asks.groupBy("slice", "chunk").cogroup(given.groupBy("slice", "chunk"))
                .applyInArrow(reach, "slice long, stretch long, blocks array<long>, nos array<int>"))

    def read(self, anchors: DataFrame, wanted: DataFrame, same: bool, k: int) -> DataFrame:
        """(anchor, w, score, id): the best k of each tile for each window."""
        asks = (wanted.select("slice", "stretch", F.explode("nos").alias("no"))
                .join(anchors.select("slice", "no", F.col("id").alias("anchor"), "label", "v", "windows"), ["slice", "no"]))
        given = (wanted.select(F.col("slice").alias("of_slice"), F.col("stretch").alias("of_stretch"), F.explode("blocks").alias("block"))
                 .join(self.blocks.select("block", "id", "label", "v"), "block"))

        def tile(left: pa.Table, right: pa.Table) -> pa.Table:
            found = _search_tile(left, right, same, k) if left.num_rows and right.num_rows else [()] * 4
            return pa.table([pa.array(c, t) for c, t in zip(found, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                            names=["anchor", "w", "score", "id"])

        return (asks.groupBy("slice", "stretch").cogroup(given.groupBy("of_slice", "of_stretch"))
                .applyInArrow(tile, "anchor long, w int, score long, id long"))

    def run(self, anchors: DataFrame, same: bool, k: int) -> DataFrame:
        """(anchor, w, rank, id, score): the best k rows of each window; ``anchors``: slice, no, id, label, v, windows."""
        last = anchors.agg(F.max("slice")).first()[0]
        slices = 0 if last is None else last + 1
        place = F.row_number().over(W.partitionBy("anchor", "w").orderBy(F.desc("score"), "id"))
        first = materialise(self.read(anchors, materialise(self.choose(anchors, slices, same, PILOT), "negatives-pilot"), same, k),
                            "negatives-first")
        floors = (first.withColumn("rank", place).where(F.col("rank") <= k).groupBy("anchor", "w")
                  .agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") == k))
        each = anchors.select("slice", "no", F.col("id").alias("anchor"), F.inline("windows"))
        raised = (each.join(floors, ["anchor", "w"], "left")
                  .groupBy("slice", "no").agg(F.sort_array(F.collect_list(F.struct(
                      "w", F.greatest("lo", "floor").alias("lo"), "hi"))).alias("windows")))
        anchors = materialise(anchors.drop("windows").join(raised, ["slice", "no"]), "negatives-floors")
        wanted = materialise(self.choose(anchors, slices, same, 0), "negatives-wanted")
        best = materialise(self.read(anchors, wanted, same, k), "negatives-best")
        return best.withColumn("rank", place).where(F.col("rank") <= k).select("anchor", "w", "rank", "id", "score")


def _search_tile(left: pa.Table, right: pa.Table, same: bool, k: int) -> list:
    """Columns anchor, w, score, id of the k best rows for each window."""
    anchor, label = _ints(left, "anchor"), _ints(left, "label")
    low, high = _windows(left)
    ids, labels, blocks = _ints(right, "id"), _ints(right, "label"), _ints(right, "block")
    theirs, out = _lists(right.column("v")), [[], [], [], []]
    for n, (at, x) in _lists(left.column("v")).items():
        if n not in theirs:
            continue
        rows, v = theirs[n]
        floor = low[at]
        score = np.full((len(at), low.shape[1], k), _LEAST)
        row_id = np.full(score.shape, _MOST)
        for b in np.unique(blocks[rows]):
            here = np.flatnonzero(blocks[rows] == b)
            here = here[np.argsort(ids[rows][here], kind="stable")]
            y, y_id, y_label = v[here], ids[rows][here], labels[rows][here]
            under, over = bounds(x, y.min(axis=0)[None, :], y.max(axis=0)[None, :])
            asking = np.flatnonzero(((over >= floor) & (under <= high[at]) & (floor <= high[at])).any(axis=1))
            for some in (asking[s:s + _STEP] for s in range(0, len(asking), _STEP)):
                of = anchor[at[some]][:, None]
                ok = ((y_label[None, :] == label[at[some]][:, None]) == same) & (y_id[None, :] != of)
                p = products(x[some], y, ok)
                for w in range(low.shape[1]):
                    fits = ok & (p >= floor[some, w][:, None]) & (p <= high[at[some], w][:, None])
                    s, i = _best(p, fits, y_id, k)
                    s, i = np.concatenate([score[some, w], s], axis=1), np.concatenate([row_id[some, w], i], axis=1)
                    order = np.lexsort((i, -s), axis=-1)[:, :k]
                    score[some, w], row_id[some, w] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
                    floor[some, w] = np.maximum(floor[some, w], score[some, w, k - 1])
        i, w, r = np.nonzero(score > _LEAST)
        for col, x in zip(out, (anchor[at[i]], w.astype(np.int32), score[i, w, r], row_id[i, w, r]), strict=True):
            col.append(x)
    return [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]


def _best(p: np.ndarray, fits: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest fitting products of each row (ids ascend: ties go to the first); unused places are empty."""
    if p.shape[1] > k:
        m = np.where(fits, p, _LEAST)
        kth = np.partition(m, p.shape[1] - k, axis=1)[:, p.shape[1] - k][:, None]
        above, level = m > kth, fits & (m == kth)
        fits = above | (level & (level.cumsum(axis=1) <= k - above.sum(axis=1, keepdims=True)))
    i, j = np.nonzero(fits)
    nth = np.arange(len(i)) - np.searchsorted(i, i, side="left")
    score, row_id = np.full((len(p), k), _LEAST), np.full((len(p), k), _MOST)
    score[i, nth], row_id[i, nth] = p[i, j], ids[j]
    return score, row_id


def mine(vectors: DataFrame, anchors: Column, label: Column | str = "label", id_col: str = "vec_id",
         vector_col: str = "embedding", scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         block_rows: int = BLOCK_ROWS, slice_rows: int = SLICE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` selects rows.  Negatives score from ``low`` to ``high`` percent of their positive.
    """
    v = F.col(vector_col)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(math.inf))
    whole = lambda x: F.when(F.abs(x.cast("double") * scale) < F.lit(float(1 << 54)), F.floor(x.cast("double") * scale)).otherwise(
        F.raise_error(F.lit("a component is too large for exact scores")).cast("long"))
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label)
                           .cast("long").alias("label"), v.alias("v"), F.coalesce(anchors, F.lit(False)).alias("asks"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
            .where(F.coalesce(F.forall("v", finite), F.lit(False)))
            .withColumn("v", F.transform("v", whole)))
    blocks, zones = write_blocks(rows, block_rows)
    search = Search(blocks, zones)
    # Anchors stand in the order of the blocks, so that a slice holds neighbours.
    own = (blocks.where("asks").groupBy("id").agg(F.min(F.struct("label", "v", "row")).alias("first")).select("id", "first.*"))
    everything = F.array(F.struct(F.lit(0).alias("w"), F.lit(_LEAST).alias("lo"), F.lit(_MOST).alias("hi")))
    own = materialise(with_row_index(own, F.col("row"), index="nth")
                      .select(F.floor(F.col("nth") / slice_rows).alias("slice"), (F.col("nth") % slice_rows).cast("int").alias("no"),
                              "id", "label", "v", everything.alias("windows")), "negatives-anchors")
    pos = materialise(search.run(own, True, positives), "negatives-positives")
    floor100 = lambda c: F.expr(f"({c} - pmod({c}, 100)) div 100")
    ranges = (pos.select(F.col("anchor").alias("id"), (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
              .withColumn("lo", -floor100(f"(-{low} * positive_score)")).withColumn("hi", floor100(f"({high} * positive_score)")))
    wanted = (ranges.where(F.col("lo") <= F.col("hi")).groupBy("id")
              .agg(F.sort_array(F.collect_list(F.struct("w", "lo", "hi"))).alias("windows")))
    found = search.run(materialise(own.drop("windows").join(wanted, "id"), "negatives-windows"), False, negatives)
    return (found.select(F.col("anchor"), F.col("w"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(ranges.select(F.col("id").alias("anchor"), "w", "positive_id", "positive_score"), ["anchor", "w"])
            .select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op13_query(spark, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, F.col("vec_id") % 50 == 0, label)


ORACLE_SQL = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (
  SELECT * FROM v WHERE vec_id % 50 = 0 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, e) = 1),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
         CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score
  FROM a JOIN v r ON a.vec_id <> r.vec_id AND len(a.e) = len(r.e)),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place
  FROM s WHERE same QUALIFY place <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
