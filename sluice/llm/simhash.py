"""SimHash near-de-duplication with covering locality-sensitive hashing.

A document's fingerprint has a bit set where more than half of its shingles'
64-bit hashes have it.  Documents link at ``radius`` or fewer differing bits.

Covering masks: bit i gets a non-zero vector m(i) of radius + 1 bits, and table
v (every non-zero vector) compares the bits with <m(i), v> odd.  The vectors of
``radius`` differing bits cannot span the space, so some v is orthogonal to
all of them: every pair within the radius shares a bucket of some table, no
link is missed.  Buckets hold distinct fingerprints only, so exact copies cost
nothing.

Buckets of any size: rows are range-partitioned by (table, bucket,
fingerprint), so a large bucket spreads over tasks; it is compared in chunks of
``CHUNK`` and each chunk gives a spanning forest of its links, not its pairs.
What chunks cannot see - pairs across chunks - is then needed only for buckets
whose members ended in different components: there, the members outside
the largest component are compared with all members, block by block.

Defined results: a text without words (or null) has fingerprint zero and links
like any other; fewer words than a shingle make one shingle; ids may be null
(ignored for the smallest id; a group of null ids only has a null
component_id) or repeat; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import byte_slices, keep_rows, materialise, read_table, shuffle_partitions, texts_as_bytes
from sluice.llm.components import components

BITS = 64
CHUNK = 1024
SEED = 42


def fingerprint(raw: bytes, shingle: int) -> int:
    """SimHash (unsigned) of the word shingles of a UTF-8 text, A-Z lower-cased."""
    words = raw.lower().split()
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    text, n, counts = b" ".join(words), len(starts), np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 15):
        parts = [text[a:b] for a, b in zip(starts[at:at + (1 << 15)].tolist(), ends[at:at + (1 << 15)].tolist(), strict=True)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(parts))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def covering_masks(radius: int) -> list[int]:
    """One mask of 64 bits for each table; any set of ``radius`` bits misses one of them entirely."""
    size = 1 << (radius + 1)
    vector = [1 + i % (size - 1) for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (vector[i] & v).bit_count() & 1) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(key, digest, fp) per row; ``digest`` is a 64-bit hash of the text, ``fp`` the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).alias("key"), F.xxhash64(F.col(text_col)).alias("digest"),
                       F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, 2):
                fps = np.array([fingerprint(t, shingle) for t in texts_as_bytes(batch.column(2))], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                                 names=["key", "digest", "fp"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, digest long, fp long")


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints within ``radius`` of each other."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    left, links = np.ones(len(fps), bool), []
    for seed in np.flatnonzero(near.sum(axis=1) > 1):
        if not left[seed]:
            continue
        left[seed], todo = False, [int(seed)]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(near[at] & left)
            left[new] = False
            links += [(int(fps[at]), int(fps[k])) for k in new]
            todo += new.tolist()
    return links


def _bucket_links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted (t, bucket, fp) -> links (t = -1), and the members of buckets not seen whole (their t)."""
        rest: tuple[np.ndarray, ...] | None = None
        first, open_bucket = True, None

        def out(links: list[tuple[int, int]], cut: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            a = np.array([x[0] for x in links], np.uint64).view(np.int64)
            b = np.array([x[1] for x in links], np.uint64).view(np.int64)
            t = np.concatenate([np.full(len(a), -1, np.int32), *[c[0] for c in cut]])
            bucket = np.concatenate([b, *[c[1] for c in cut]])
            fp = np.concatenate([a, *[c[2].view(np.int64) for c in cut]])
            return pa.RecordBatch.from_arrays([pa.array(t), pa.array(fp), pa.array(bucket)], names=["t", "a", "b"])

        def whole_buckets(t: np.ndarray, bucket: np.ndarray, fp: np.ndarray, last: bool) -> pa.RecordBatch:
            nonlocal first, open_bucket
            start = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (bucket[1:] != bucket[:-1])])
            end = np.r_[start[1:], len(t)]
            links, cut = [], []
            two = start[end - start == 2]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius]
            links += zip(fp[two].tolist(), fp[two + 1].tolist(), strict=True)
            for i in np.flatnonzero(end - start > 2):
                links += forest(fp[start[i]:end[i]], radius)
            for i in {0, len(start) - 1}:
                a, b = start[i], end[i]
                name = (int(t[a]), int(bucket[a]))
                # The partition's first and last bucket, and one cut for its size, may have more members elsewhere.
                if (first and i == 0) or (last and i == len(start) - 1) or name == open_bucket:
                    cut.append((t[a:b], bucket[a:b], fp[a:b]))
            first = False
            return out(links, cut)

        for batch in batches:
            new = tuple(batch.column(k).to_numpy() for k in range(3))
            new = (new[0], new[1], new[2].view(np.uint64))
            rest = new if rest is None else tuple(np.concatenate(x) for x in zip(rest, new, strict=True))
            while len(rest[0]):
                t, bucket = rest[0], rest[1]
                change = np.flatnonzero((t[1:] != t[:-1]) | (bucket[1:] != bucket[:-1])) + 1
                if len(change) and change[-1] > 0:
                    big = np.flatnonzero(np.diff(np.r_[0, change]) > CHUNK)
                    n = int(change[-1]) if not len(big) else (int(change[big[0] - 1]) if big[0] else 0)
                    if n:
                        yield whole_buckets(*[x[:n] for x in rest], last=False)
                        open_bucket = None
                        rest = tuple(x[n:] for x in rest)
                        continue
                run_end = int(change[0]) if len(change) else len(t)
                if run_end <= CHUNK:
                    break  # wait for more rows of this bucket
                # A bucket larger than a chunk: compare a chunk, note its members for the second round.
                open_bucket = (int(t[0]), int(bucket[0]))
                yield whole_buckets(*[x[:CHUNK] for x in rest], last=False)
                rest = tuple(x[CHUNK:] for x in rest)
        if rest is not None and len(rest[0]):
            yield whole_buckets(*rest, last=True)
    return run


def _across(radius: int):
    def run(table: pa.Table) -> pa.Table:
        """One pair of blocks: the probes against the members, a link for each probe and other component."""
        role, fp, label = (table.column(k).to_numpy() for k in ("role", "fp", "label"))
        p, m = role == 0, role == 1
        x, y = fp[p].view(np.uint64), fp[m].view(np.uint64)
        i, j = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= radius)
        keep = label[p][i] != label[m][j]
        i, j = i[keep], j[keep]
        if len(i):
            _, one = np.unique(np.stack([i, label[m][j]]), axis=1, return_index=True)
            i, j = i[one], j[one]
        return pa.table({"a": fp[p][i], "b": fp[m][j]})
    return run


def _cut_bucket_links(cut: DataFrame, comp: DataFrame, radius: int) -> DataFrame:
    """Links across the chunks of buckets that were not compared whole."""
    rows = (cut.join(comp, cut["fp"] == comp["node"], "left")
            .select("t", "bucket", "fp", F.coalesce("root", "fp").alias("label")).distinct())
    rows = materialise(rows, "simhash-cut")
    top = (rows.groupBy("t", "bucket", "label").count().groupBy("t", "bucket")
           .agg(F.max(F.struct("count", "label")).alias("top"), F.sum("count").alias("n"))
           .select("t", "bucket", F.col("top.label").alias("main"), "n", (F.col("n") - F.col("top.count")).alias("others"))
           .where("others > 0"))
    rows = materialise(rows.join(top, ["t", "bucket"]), "simhash-mixed")
    blocks = lambda c: F.ceil(F.col(c) / CHUNK).cast("int")
    block = lambda c: F.pmod(F.xxhash64("fp"), blocks(c)).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    members = (rows.withColumn("j", block("n")).withColumn("i", each("others")).withColumn("role", F.lit(1)))
    probes = (rows.where("label != main").withColumn("i", block("others")).withColumn("j", each("n"))
              .withColumn("role", F.lit(0)))
    pairs = members.select("t", "bucket", "i", "j", "role", "fp", "label").unionAll(
        probes.select("t", "bucket", "i", "j", "role", "fp", "label"))
    return pairs.groupBy("t", "bucket", "i", "j").applyInArrow(_across(radius), "a long, b long")


def _components_of(prints: DataFrame, radius: int) -> DataFrame:
    """(node, root) of the linked fingerprints."""
    spark = prints.sparkSession
    distinct = materialise(prints.select("fp").distinct(), "simhash-distinct")
    keys = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bucket"))
            for t, m in enumerate(covering_masks(radius))]
    rows = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.t", "k.bucket", "fp")
    order = ["t", "bucket", "fp"]
    found = materialise(rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
                        .mapInArrow(_bucket_links(radius), "t int, a long, b long"), "simhash-links")
    links = materialise(found.where("t = -1").select("a", "b").distinct(), "simhash-forest")
    comp = components(links)
    cut = found.where("t >= 0").select("t", F.col("b").alias("bucket"), F.col("a").alias("fp"))
    more = materialise(_cut_bucket_links(cut, comp, radius), "simhash-across")
    if more.isEmpty():
        return comp
    return components(comp.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(more))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    radius: int = 4) -> DataFrame:
    """One row per row of ``docs``: id, digest, fp, component_id, stays (the row with the group's smallest id), twin."""
    prints = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    comp = _components_of(prints, radius)
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "fp", "digest"))
    per = materialise(prints.groupBy("fp").agg(first.alias("m"))
                      .join(comp, F.col("fp") == F.col("node"), "left")
                      .select("fp", F.coalesce("root", "fp").alias("label"), "m"), "simhash-labels")
    ids = materialise(per.groupBy(F.col("label").alias("of")).agg(F.min("m").alias("best")), "simhash-ids")
    per = materialise(per.hint("merge").join(ids.hint("merge"), F.col("label") == F.col("of"))
                      .select(F.col("fp").alias("print"), "best"), "simhash-groups")
    out = prints.hint("merge").join(per.hint("merge"), F.col("fp") == F.col("print"))
    stays = (F.col("key").eqNullSafe(F.col("best.key")) & (F.col("fp") == F.col("best.fp"))
             & (F.col("digest") == F.col("best.digest")))
    return out.select(F.col("key").alias(id_col), "digest", "fp", F.col("best.key").alias("component_id"),
                      stays.alias("stays"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                  radius: int = 4) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each group, one for each group, all columns."""
    kept = (near_duplicates(docs, id_col, text_col, shingle, radius).where("stays")
            .groupBy(F.col(id_col).alias("key"), "digest").agg((F.count("*") > 1).alias("twin")))
    return keep_rows(docs, id_col, F.xxhash64(F.col(text_col)), materialise(kept, "simhash-kept"))


def op2_query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
