"""Mixing sources to target weights by pivotal dependent rounding."""

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, beside_rows, columns, fresh, row_key

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a block at the leaves of the reduction tree, and blocks that one inner task combines.
LEAF, FAN_IN = 4096, 1024
#: Sources that the driver can hold, and equal rows that are listed at a time.
SOURCES, RUN = 100_000, 1 << 16


def source_targets(sizes: dict, weights=(1, 2, 3), most: float = 3.0) -> dict:
    """Target words of each source: shares of the total by weight, capped at `most` times the source's size.

    Sources stand by code point, null last, and take the weights in turn. The excess over a cap
    goes to the others by weight until none is above its cap.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    target, left, free = {}, float(sum(sizes.values())), list(order)
    while free:
        share = math.fsum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / share > most * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / share for s in free}
            break
        target |= {s: most * sizes[s] for s in over}
        left -= math.fsum(target[s] for s in over)
        free = [s for s in free if s not in target]
    return target


def pivotal(p: np.ndarray, size: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """One pass of size-weighted pivotal rounding; at most one entry of the result is fractional.

    Two fractional entries meet at a time. Words move from one to the other, in a direction drawn
    so that each probability keeps its mean, until one of the two is 0 or 1; the sum of p * size
    never changes.
    """
    p, size = p.tolist(), size.tolist()
    open_ = None
    for i, u in enumerate(draws.tolist()):
        if not 0.0 < p[i] < 1.0:
            continue
        if open_ is None:
            open_ = i
            continue
        a, b = open_, i
        up_a, up_b = (1 - p[a]) * size[a], p[b] * size[b]
        down_a, down_b = p[a] * size[a], (1 - p[b]) * size[b]
        up, down = min(up_a, up_b), min(down_a, down_b)
        if u * (up + down) < down:
            done_a, done_b = up_a <= up_b, up_b <= up_a
            p[a] = 1.0 if done_a else p[a] + up / size[a]
            p[b] = 0.0 if done_b else p[b] - up / size[b]
        else:
            done_a, done_b = down_a <= down_b, down_b <= down_a
            p[a] = 0.0 if done_a else p[a] - down / size[a]
            p[b] = 1.0 if done_b else p[b] + down / size[b]
        open_ = a if not done_a else b if not done_b else None
    return np.array(p)


def _reduce(level: int, last: bool, seed: int):
    def block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "row_hash", "doc_id"], kind="stable", ignore_index=True)
        name = f"{seed}/{level}/{key[0]!r}/{key[1]}".encode()
        rng = np.random.default_rng([zlib.crc32(name), zlib.adler32(name)])
        p = pivotal(rows["p"].to_numpy(), rows["size"].to_numpy(), rng.random(len(rows)))
        open_ = (p > 0) & (p < 1)
        if last:  # the one residual of a source lands
            p[open_] = rng.random(int(open_.sum())) < p[open_]
            open_[:] = False
        return rows.assign(p=p, decided=~open_, block=key[1])

    return block


def _shares(docs: DataFrame, weights, most: float, seed: int, tables: Scratch) -> DataFrame:
    """doc_id, source, row_hash, size, source_size, target, equal (rows that are the same) and taken (copies of all of these together)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), row_key(docs, "source").alias("row_hash"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
    rows = tables.put(each.groupBy("doc_id", "source", "row_hash", "size").agg(F.count("*").alias("equal")), "rows")
    groups = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("equal")).alias("words"), F.count("*").alias("n")).limit(SOURCES + 1).collect()
    if len(groups) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources")
    sizes = {r["source"]: r["words"] for r in groups}
    target = source_targets(sizes, weights, most)
    plan = [(s, int(sizes[s]), float(target[s]), max(1, -(-r["n"] // LEAF))) for r in groups for s in [r["source"]]]
    sources = docs.sparkSession.createDataFrame(plan, "src string, source_size long, target double, blocks long")
    joined = rows.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("src"))).drop("src")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    due = F.col("equal") * F.when(F.col("size") > 0, rate).otherwise((rate >= 1).cast("double"))
    joined = joined.withColumn("whole", F.floor(due)).withColumn("p", due - F.floor(due))
    joined = joined.withColumn("block", F.pmod(F.xxhash64("row_hash", F.lit(seed)), F.col("blocks")))
    levels, blocks, most_blocks, level = [], joined, max([p[3] for p in plan], default=1), 0
    schema = "doc_id long, source string, row_hash long, size long, equal long, source_size long, target double, whole long, block long, p double, decided boolean"
    names = ["doc_id", "source", "row_hash", "size", "equal", "source_size", "target", "whole", "block", "p"]
    while True:
        done = tables.put(blocks.select(names).groupBy("source", "block").applyInPandas(_reduce(level, most_blocks == 1, seed), schema), f"level{level}")
        levels.append(done.where("decided"))
        if most_blocks == 1:
            break
        blocks = done.where("NOT decided").withColumn("block", F.expr(f"block div {FAN_IN}"))
        most_blocks, level = -(-most_blocks // FAN_IN), level + 1
    decided = levels[0]
    for more in levels[1:]:
        decided = decided.unionByName(more)
    tables.drop("rows")
    return decided.select("doc_id", "source", "row_hash", "size", "source_size", "target", "equal", (F.col("whole") + F.round("p").cast("long")).alias("taken"))


def _of_each(nth):
    """Copies of the nth (from 1) of `equal` rows that share `taken` copies."""
    return F.expr("taken div equal") + (nth <= F.expr("taken % equal")).cast("long")


def mixed_copies(docs: DataFrame, weights=(1, 2, 3), most: float = 3.0, seed: int = 7) -> DataFrame:
    """How often the mix takes each document.

    A document's size is its words between ASCII blanks (null text: 0). A source's target over its
    size is the expected number of copies of each of its documents; the whole part is taken as it
    is and the fraction is rounded by `pivotal`. Blocks of about 4,096 documents, dealt by hash
    within a source (so a source with a third of all rows makes more blocks, not larger ones),
    leave one fractional document each; these residuals meet in a tree of 1,024 blocks to a node
    until each source has one, which lands at random. A source's words so miss its target by less
    than one document's size, and no document is taken more than ceil(most) times.
    Draws follow from the seed and the rows' hashes: reruns agree, however the rows are dealt.

    Rows: doc_id, source, row_hash (of doc_id, source and text), size, source_size, target, copies.
    Every input row has one; rows with the same doc_id, source and text are rounded together and share their copies
    as evenly as they go, so however many they are, they are one row of a block. Null doc_id or source are
    values like others; documents of size 0 are taken once where the target is at least the
    source's size, else never; an empty table gives none. Other columns are ignored.
    The word total of each source reaches the driver: over 100,000 sources are an error.
    """
    shares = _shares(docs, weights, most, seed, Scratch(docs.sparkSession, "mixing"))
    runs = shares.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(equal - 1) div {RUN}"))))
    each = runs.withColumn("nth", F.explode(F.sequence(F.expr(f"run * {RUN} + 1"), F.expr(f"least(equal, (run + 1) * {RUN})"))))
    return each.select("doc_id", "source", "row_hash", "size", "source_size", "target", _of_each(F.col("nth")).alias("copies"))


def mix_documents(docs: DataFrame, weights=(1, 2, 3), most: float = 3.0, seed: int = 7) -> DataFrame:
    """The documents as the mix takes them: each row as often as `mixed_copies` says, with all its columns, whatever their names.

    Nulls, repeated rows, empty texts and empty tables as there. Each text moves once, to meet its number of copies.
    """
    shares = _shares(docs, weights, most, seed, Scratch(docs.sparkSession, "mixing")).where("taken > 0")
    joined, name = beside_rows(docs, row_key(docs, "source"), shares.select("doc_id", "row_hash", "equal", "taken"), "inner")
    equal, taken, nth = (F.col(name[c]) for c in ("equal", "taken", "nth"))
    times = F.floor(taken / equal) + (nth <= taken % equal).cast("long")
    copy = fresh(joined, "_copy")
    return joined.withColumn(copy, F.explode(F.when(times > 0, F.sequence(F.lit(1).cast("long"), times)))).select(columns(docs))


def op3_mix_pivotal(spark, sf_dir: str) -> DataFrame:
    copies = mixed_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return copies.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
