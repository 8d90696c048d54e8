"""Exact de-duplication by sorting the contents.

Sampled splitters range-partition the normalised texts (A-Z lower-cased, null
as empty), an external sort puts equal texts next to each other and every text
is compared in full with its neighbour.  The sort key is the text's first
``LEAD`` characters, its SHA-256 and the id: splitters stay small however
long the texts are, and a group of copies of any size spreads over as many
partitions as it needs, since its ids are part of the key.

Groups cut by a partition border are put together from one row for each cut
piece: at most two groups for each partition, so that table is broadcast.

Defined results: null equals the empty text; rows that repeat an id are rows
of their own, and exactly one row of a group stays; a null id sorts before all
others (last with ``keep="smallest"``), so it stays only if its group has no
other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ascii_lower, keep_rows, materialise, read_table, shuffle_partitions

LEAD = 64


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (sha, norm, key) rows -> each row with the figures of its run of equal texts.

    Ids of a run wait until the run ends; texts are dropped once compared.
    """
    pid = TaskContext.get().partitionId()
    last_sha = last_norm = None
    run, first = -1, True
    keys: list[pa.Array] = []
    runs: list[np.ndarray] = []
    shas: list[pa.Array] = []

    def close(edge: bool, n: int | None = None) -> pa.RecordBatch:
        key, of, sha = pa.concat_arrays(keys), np.concatenate(runs), pa.concat_arrays(shas)
        keys.clear(), runs.clear(), shas.clear()
        if n is not None and n < len(of):
            keys.append(key.slice(n)), runs.append(of[n:]), shas.append(sha.slice(n))
            key, of, sha = key.slice(0, n), of[:n], sha.slice(0, n)
        start = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        size = np.diff(np.r_[start, len(of)])
        last = start + size - 1
        keep, other = key.take(pa.array(last)), key.take(pa.array(np.maximum(last - 1, start)))
        twin = pc.or_(pc.fill_null(pc.equal(keep, other), False), pc.and_(pc.is_null(keep), pc.is_null(other)))
        twin = twin.to_numpy(zero_copy_only=False) & (size > 1)
        rows = np.repeat(np.arange(len(start)), size)
        return pa.RecordBatch.from_arrays(
            [key, sha, pa.array(np.full(len(of), pid, np.int32)), pa.array(of), keep.take(pa.array(rows)),
             pa.array(size[rows]), pa.array(np.arange(len(of)) == last[rows]), pa.array(twin[rows]),
             pa.array(np.full(len(of), edge))],
            names=["key", "sha", "pid", "run", "run_keep", "run_size", "ends", "twin", "edge"])

    def waiting() -> int:
        """Rows of the first digest among those that wait."""
        sha = pa.concat_arrays(shas)
        return int(np.argmin(np.r_[pc.equal(sha, sha[0]).to_numpy(zero_copy_only=False), False]))

    for batch in batches:
        if not batch.num_rows:
            continue
        sha, norm, key = (batch.column(i) for i in range(3))
        sha_before = pa.concat_arrays([pa.array([last_sha], sha.type), sha.slice(0, len(sha) - 1)])
        same_sha = pc.fill_null(pc.equal(sha, sha_before), False).to_numpy(zero_copy_only=False)
        same = same_sha.copy()
        at = np.flatnonzero(same_sha)  # neighbours with equal digests: compare the texts themselves
        if len(at):
            inner = at[at > 0]
            same[inner] = pc.equal(norm.take(pa.array(inner)), norm.take(pa.array(inner - 1))).to_numpy(zero_copy_only=False)
            if at[0] == 0:
                same[0] = norm[0].as_py() == last_norm
        of = run + np.cumsum(~same)
        run = int(of[-1])
        cut = np.flatnonzero(~same_sha)
        cut = int(cut[-1]) if len(cut) else -1  # rows from here on wait for the next batch
        if cut >= 0:
            if cut or keys:
                keys.append(key.slice(0, cut)), runs.append(of[:cut]), shas.append(sha.slice(0, cut))
                if first:  # the partition's first digest may go on in the partition before
                    yield close(True, waiting())
                    first = False
                if keys:
                    yield close(False)
            keys.append(key.slice(cut)), runs.append(of[cut:]), shas.append(sha.slice(cut))
        else:
            keys.append(key), runs.append(of), shas.append(sha)
        last_sha, last_norm = sha[-1].as_py(), norm[-1].as_py()
    if keys:
        yield close(True)


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "smallest", partitions: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, twin.

    ``twin`` marks rows that stay although their group may hold their id again.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    spark = docs.sparkSession
    rows = (docs.select(F.col(id_col).alias("key"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
            .select(F.substring("norm", 1, LEAD).alias("lead"), F.sha2("norm", 256).alias("sha"), "norm", "key"))
    order = [F.col("lead"), F.col("sha"),
             F.col("key").asc_nulls_first() if keep == "largest" else F.col("key").desc_nulls_first()]
    within = [F.col("lead"), F.col("sha"), F.col("norm"), order[2]]
    kind = rows.schema["key"].dataType.simpleString()
    found = (rows.repartitionByRange(partitions or shuffle_partitions(spark), *order).sortWithinPartitions(*within)
             .select("sha", "norm", "key")
             .mapInArrow(_runs, f"key {kind}, sha string, pid int, run long, run_keep {kind}, run_size long, "
                                "ends boolean, twin boolean, edge boolean"))
    found = materialise(found, "exact-runs")
    # At most the first and the last digest of each partition: bounded by the number of partitions.
    cut = (found.where("edge and ends").groupBy(F.col("sha").alias("cut_sha"))
           .agg(F.max(F.struct("pid", "run", F.col("run_keep").alias("keep"))).alias("m"),
                F.sum("run_size").alias("cut_size"), F.count("*").alias("pieces")))
    out = found.join(F.broadcast(cut), F.when(F.col("edge"), F.col("sha")) == F.col("cut_sha"), "left")
    whole = F.col("m").isNull()
    keep_id = F.when(whole, F.col("run_keep")).otherwise(F.col("m.keep"))
    stays = F.col("ends") & (whole | ((F.col("pid") == F.col("m.pid")) & (F.col("run") == F.col("m.run"))))
    return out.select(F.col("key").alias(id_col), keep_id.alias("keep_id"),
                      F.coalesce("cut_size", "run_size").alias("group_size"), stays.alias("kept"),
                      F.col("sha").alias("text_sha256"),
                      (stays & (F.col("twin") | (~whole & (F.col("pieces") > 1) & (F.col("run_size") == 1)))).alias("twin"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, all columns.

    Of rows equal in id and text any one stays.
    """
    kept = materialise(duplicate_groups(docs, id_col, text_col, keep).where("kept")
                       .select(F.col(id_col).alias("key"), F.col("text_sha256").alias("digest"), "twin"), "exact-kept")
    return keep_rows(docs, id_col, F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256), kept)


def op5_query(spark, sf_dir: str) -> DataFrame:
    return duplicate_groups(read_table(spark, sf_dir, "documents"), keep="largest").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
