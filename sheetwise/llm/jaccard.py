"""N-gram Jaccard self-join with rare-first prefixes, and the classes its links make."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import BLOOM, SORTED, Scratch, beside_rows, columns, row_key
from .words import gather, mix, owner, per_text, run_hashes, slices, texts_of, word_codes, word_hashes

#: The share of tokens, by hash, that stands first in the order: at least FIRST, and SLACK times a prefix.
FIRST, SLACK, SCALE = 0.2, 1.5, 1 << 20
#: Posting lists of up to so many sets are paired; longer ones are joined block by block.
SHORT = 8
#: Sets of a block.
BLOCK = 256
#: Parts of the hash range whose sizes the suffix filter compares.
PARTS = 16


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text (fewer words: all of them as one), and their bounds."""
    codes, bounds, words = word_codes(texts)
    hashes, size = word_hashes(words)[codes], np.diff(bounds)
    count = np.where(size == 0, 0, np.maximum(size - n + 1, 1))
    starts = gather(bounds[:-1], count)
    of = np.repeat(np.arange(len(size)), count)
    tokens = run_hashes(hashes, starts, np.minimum(starts + n, bounds[of + 1]))
    order = np.lexsort((tokens, of))
    tokens, of = tokens[order], of[order]
    fresh = np.append(True, (tokens[1:] != tokens[:-1]) | (of[1:] != of[:-1]))[: len(tokens)]
    return tokens[fresh], np.concatenate([[0], np.cumsum(np.bincount(of[fresh], minlength=len(size)))]).astype(np.int64)


def _prints(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    a, b = bounds[:-1], bounds[1:]
    return run_hashes(tokens, a, b).astype(np.int64), run_hashes(mix(tokens ^ np.uint64(0xD6E8FEB86659FD93)), a, b).astype(np.int64)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(values.view(np.int64))).cast(pa.list_(pa.int64()))


def first_class(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Whether a token is among those that stand first in the order, rare before frequent."""
    return (tokens >> np.uint64(20)) % np.uint64(SCALE) < np.uint64(max(FIRST, SLACK * (100 - percent) / 100) * SCALE)


def _describe(batches: Iterator[pa.RecordBatch], n: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Size, hashes and part sizes of each set, and the tokens that its prefix is taken from: the first class, or with fewer than a prefix of these also the least others."""
    for whole in batches:
        for batch in slices(whole, "text", 2 << 20):
            tokens, bounds = shingle_sets(texts_of(batch, lower=True), n)
            first, second = _prints(tokens, bounds)
            size, of = np.diff(bounds), owner(bounds)
            front = first_class(tokens, percent)
            lead = per_text(front, bounds)
            prefix = np.where(size > 0, size - -(-percent * size // 100) + 1, 0)
            rest = np.cumsum(~front) - np.concatenate([[0], np.cumsum(~front)])[bounds[:-1]][of]  # 1, 2, ... over the others of a text
            chosen = front | (rest <= (prefix - lead)[of])
            cut = np.concatenate([[0], np.cumsum(chosen)])[bounds]
            part = (tokens % np.uint64(PARTS)).astype(np.int64)
            parts = np.bincount(of * PARTS + part, minlength=len(size) * PARTS).astype(np.int32)
            parts = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * PARTS), pa.array(parts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size), pa.array(first), pa.array(second), parts, pa.array(lead), _lists(tokens[chosen], cut), batch.column("row_hash")], ["doc_id", "n", "print1", "print2", "parts", "lead", "sample", "row_hash"])


def _fetch(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """The sets of rows whose text is the one that was asked for."""
    for whole in batches:
        for batch in slices(whole, "text", 2 << 20):
            tokens, bounds = shingle_sets(texts_of(batch, lower=True), n)
            first, second = _prints(tokens, bounds)
            same = (first == batch.column("print1").to_numpy()) & (second == batch.column("print2").to_numpy())
            keep = pa.array(same)
            told = ["sid", "copies", "alone", "parts", "prefix"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).filter(keep) for c in told], pa.array(np.diff(bounds)).filter(keep), _lists(tokens, bounds).filter(keep)], [*told, "n", "tokens"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 2048) -> np.ndarray:
    """Intersection sizes of every set on the left with every one on the right, by products of 0/1 matrices."""
    out = np.zeros((len(left), len(right)), np.float32)
    a, b = np.concatenate([*left, np.zeros(0, np.int64)]), np.concatenate([*right, np.zeros(0, np.int64)])
    shared = np.intersect1d(a, b)
    rows_a, rows_b = np.repeat(np.arange(len(left)), [len(x) for x in left]), np.repeat(np.arange(len(right)), [len(x) for x in right])
    at_a, at_b = np.searchsorted(shared, a), np.searchsorted(shared, b)
    in_a, in_b = shared[np.minimum(at_a, len(shared) - 1)] == a if len(shared) else np.zeros(len(a), bool), shared[np.minimum(at_b, len(shared) - 1)] == b if len(shared) else np.zeros(len(b), bool)
    rows_a, at_a, rows_b, at_b = rows_a[in_a], at_a[in_a], rows_b[in_b], at_b[in_b]
    order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
    rows_a, at_a, rows_b, at_b = rows_a[order_a], at_a[order_a], rows_b[order_b], at_b[order_b]
    for start in range(0, len(shared), columns):
        ends = [start, start + columns]
        i, j = np.searchsorted(at_a, ends), np.searchsorted(at_b, ends)
        x, y = np.zeros((len(left), columns), np.float32), np.zeros((len(right), columns), np.float32)
        x[rows_a[i[0] : i[1]], at_a[i[0] : i[1]] - start] = 1
        y[rows_b[j[0] : j[1]], at_b[j[0] : j[1]] - start] = 1
        out += x @ y.T
    return out


def _spanning(links: np.ndarray, ids_a: list[int], ids_b: list[int]) -> list[tuple[int, int]]:
    """A spanning forest of the links of a block pair."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for i, j in zip(*np.nonzero(links), strict=True):
        a, b = root(ids_a[i]), root(ids_b[j])
        if a != b:
            parent[a] = b
            out.append((ids_a[i], ids_b[j]))
    return out


def candidates(a: pd.DataFrame, b: pd.DataFrame, percent: int) -> np.ndarray:
    """Which pairs of sets pass the length, prefix, positional and suffix filters; all that are similar do."""
    na, nb = a["n"].to_numpy(np.int64), b["n"].to_numpy(np.int64)
    need = -(-percent * (na[:, None] + nb[None, :]) // (100 + percent))
    size = 100 * np.minimum(na[:, None], nb[None, :]) >= percent * np.maximum(na[:, None], nb[None, :])
    both, left, right = np.zeros_like(size), _positions(a), _positions(b)
    for token in left.keys() & right.keys():
        (i, at_i, rest_i), (j, at_j, rest_j) = left[token], right[token]
        most = np.minimum(at_i[:, None], at_j[None, :]) + np.minimum(rest_i[:, None], rest_j[None, :])
        both[np.ix_(i, j)] |= most >= need[np.ix_(i, j)]
    out = size & both
    if out.any():
        parts_a, parts_b = np.array(a["parts"].tolist()), np.array(b["parts"].tolist())
        out &= sum(np.minimum(parts_a[:, k][:, None], parts_b[:, k][None, :]) for k in range(parts_a.shape[1])) >= need
    return out


def _positions(sets: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each prefix token: the sets that have it, how many prefix tokens stand before it in them, and how many tokens from it on could be shared."""
    length = np.array([len(x) for x in sets["prefix"]], np.int64)
    tokens = np.concatenate([*[np.asarray(x, np.int64) for x in sets["prefix"]], np.zeros(0, np.int64)])
    of = np.repeat(np.arange(len(sets)), length)
    at = np.arange(len(tokens)) - np.repeat(np.cumsum(length) - length, length)
    rest = (sets["n"].to_numpy(np.int64) - sets["alone"].to_numpy(np.int64))[of] - at
    order = np.argsort(tokens, kind="stable")
    edges = np.append(np.flatnonzero(np.append(True, tokens[order][1:] != tokens[order][:-1]))[: len(order)], len(order)) if len(order) else np.zeros(1, np.int64)
    return {int(tokens[order[x]]): (of[order[x:y]], at[order[x:y]], rest[order[x:y]]) for x, y in zip(edges[:-1], edges[1:], strict=True)}


def _blocks(percent: int):
    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
        rows = rows.drop_duplicates("sid")
        a, b = rows[rows["block"] == i], rows[rows["block"] == j]
        some = candidates(a, b, percent)
        if i == j:
            some = np.triu(some, 1)
        links = np.zeros_like(some)
        x, y = np.flatnonzero(some.any(axis=1)), np.flatnonzero(some.any(axis=0))
        if len(x):
            both = overlaps([np.asarray(t) for t in a["tokens"].iloc[x]], [np.asarray(t) for t in b["tokens"].iloc[y]]).astype(np.int64)
            na, nb = a["n"].to_numpy(np.int64)[x], b["n"].to_numpy(np.int64)[y]
            links[np.ix_(x, y)] = some[np.ix_(x, y)] & (100 * both >= percent * (na[:, None] + nb[None, :] - both))
        forest = pd.DataFrame(_spanning(links, a["sid"].tolist(), b["sid"].tolist()), columns=["a", "b"], dtype="int64").assign(n_a=0, n_b=0)
        counts = pd.concat([pd.DataFrame({"a": a["sid"], "n_a": links @ b["copies"].to_numpy(np.int64)}), pd.DataFrame({"a": b["sid"], "n_a": links.T @ a["copies"].to_numpy(np.int64)})]).groupby("a", as_index=False).sum()
        counts = counts[counts["n_a"] > 0].assign(b=None, n_b=None)
        return pd.concat([forest, counts]).astype({"a": "Int64", "b": "Int64", "n_a": "Int64", "n_b": "Int64"})[["a", "b", "n_a", "n_b"]]

    return joined


def rare_prefixes(described: DataFrame, percent: int, tables: Scratch) -> DataFrame:
    """print1, print2, row, n, alone, parts, prefix for each distinct set whose prefix has a token of another row.

    The order of tokens: those of the first class, by the number of rows that have them and then by
    hash, then all others by hash. A set's prefix are its first n - ceil(t n) + 1 tokens; two sets with
    similarity t have a token of both prefixes in common. Tokens of one row alone hold their places but are left out.
    """
    sampled = described.where("n > 0").select("row", F.explode("sample").alias("token"))
    shared = sampled.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    front = f"pmod(shiftrightunsigned(token, 20), {SCALE}) < {int(max(FIRST, SLACK * (100 - percent) / 100) * SCALE)}"
    ranked = sampled.join(shared, "token").select("row", F.struct(F.expr(f"cast(CASE WHEN {front} THEN df ELSE {1 << 62} END AS bigint)").alias("df"), F.expr(f"token ^ {-(1 << 63)}").alias("order"), "token").alias("k"))
    ranked = ranked.groupBy("row").agg(F.array_sort(F.collect_list("k")).alias("known"))
    about = described.where("n > 0").select("row", "print1", "print2", "n", "lead", "parts", F.size("sample").alias("looked"))
    keep = f"n - cast(ceil({percent} * n / 100.0D - 1e-9) AS int) + 1 - (looked - size(known))"
    joined = about.join(ranked, "row").withColumn("keep", F.expr(keep)).where("keep > 0")
    prefix = F.transform(F.slice("known", F.lit(1), F.greatest(F.col("keep"), F.lit(0)).cast("int")), lambda k: k["token"])
    one = joined.groupBy("print1", "print2").agg(F.min_by(F.struct("row", "n", "parts", F.when(F.col("lead") == F.col("looked"), F.col("looked") - F.size("known")).otherwise(0).alias("alone"), prefix.alias("prefix")), "row").alias("s"))
    return tables.put(one.select("print1", "print2", "s.*"), "prefixes")


def candidate_posts(prefixes: DataFrame, tables: Scratch) -> DataFrame:
    """Prefix tokens that two distinct sets or more have, with the length and the first set of their lists."""
    posts = prefixes.select(F.col("row").alias("sid"), "n", "alone", "parts", F.posexplode("prefix").alias("at", "token"))
    lists = posts.groupBy("token").agg(F.count("*").alias("len"), F.min("sid").alias("head")).where("len > 1")
    return tables.put(posts.join(lists, "token"), "posts")


def _least(percent: int) -> str:
    """SQL for the intersection that two sets of n_a and n_b tokens need."""
    return f"ceil({percent} * (n_a + n_b) / {100 + percent}.0D - 1e-9)"


def jaccard_links(posts: DataFrame, sets: DataFrame, percent: int, tables: Scratch) -> DataFrame:
    """Links (a, b) that connect every two sets with Jaccard similarity of at least `percent` / 100, directly or in steps, and counts of all links.

    The sum of n_a by a and n_b by b is the number of documents (copies) in sets that link with a set; rows of counts alone have a null b.

    Lists of up to SHORT sets are paired, with length, positional and suffix filters (the suffix
    filter compares the sizes of hash parts), and each distinct pair is verified once. Longer
    lists mark families of near copies; a family is cut into blocks, and each pair of
    blocks is joined in one task, without rows for pairs: the same filters on the same prefixes leave candidates, and
    these are verified by matrix products. Every pair is so verified once, in its family's blocks or, if it
    has no common family, from short lists. A family of G sets has G / BLOCK blocks, and from G = BLOCK ** 2 / 4 on
    sqrt(G) / 2 larger ones, so that its tokens are copied sqrt(G) / 2 times then, and no task holds more than two blocks.
    """
    # long lists: families, blocks, matrix products
    stars = posts.where(f"len > {SHORT} AND sid <> head").select("sid", "head")
    family = tables.put(components(stars, "sid", "head", tables, "family"), "families")
    count = family.groupBy("root").agg(F.expr(f"cast(ceil(least(count(*) / {BLOCK}.0D, greatest(sqrt(count(*)) / 2, 1.0D * {BLOCK} / 4))) AS int)").alias("blocks"))
    dealt = family.join(count, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.select(F.col("node").alias("sid"), "root", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("sid", "root", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    within = dealt.join(sets, "sid").groupBy("root", "i", "j").applyInPandas(_blocks(percent), "a long, b long, n_a long, n_b long")
    # short lists: filtered pairs, each once
    some = posts.where(f"len <= {SHORT}")
    a, b = (some.select("token", *[F.col(c).alias(f"{c}_{k}") for c in ("sid", "n", "alone", "parts", "at")]) for k in "ab")
    pairs = a.join(b, "token").where("sid_a < sid_b").withColumn("need", F.expr(_least(percent)))
    pairs = pairs.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    pairs = pairs.where("least(at_a, at_b) + least(n_a - alone_a - at_a, n_b - alone_b - at_b) >= need")
    pairs = pairs.where("aggregate(zip_with(parts_a, parts_b, (x, y) -> least(x, y)), 0, (s, x) -> s + x) >= need")
    pairs = pairs.select("sid_a", "sid_b", "need").distinct()
    for k in "ab":
        pairs = pairs.join(family.select(F.col("node").alias(f"sid_{k}"), F.col("root").alias(f"root_{k}")), f"sid_{k}", "left")
    pairs = tables.put(pairs.where("root_a IS NULL OR root_b IS NULL OR root_a <> root_b").select("sid_a", "sid_b", "need"), "pairs")
    left, right = (sets.select(F.col("sid").alias(f"sid_{k}"), F.col("copies").alias(f"copies_{k}"), F.col("tokens").alias(f"tokens_{k}")) for k in "ab")
    checked = pairs.join(left, "sid_a").join(right, "sid_b").where(F.size(F.array_intersect("tokens_a", "tokens_b")) >= F.col("need"))
    # a text that stands in several rows was read as often
    checked = checked.select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b"), F.col("copies_b").alias("n_a"), F.col("copies_a").alias("n_b")).distinct()
    return tables.put(within.unionByName(checked), "links")


def near_duplicate_classes(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Every document with its number of shingles and its class under links of Jaccard similarity `percent` / 100 or more.

    A document's set has the distinct n-word shingles of its whole lower-cased (A-Z) text between
    ASCII blanks; with fewer words all of them make one, and a text without words (or null) has
    none and links with nothing. Equal sets are linked as one group, by two 64-bit hashes, without
    being paired. Prefixes are rare first over the share of tokens, by hash, that stands first in the
    order; a document whose prefix nobody shares is done. The texts of the others are read again and
    joined by `jaccard_links`; similarity is that of the sets of 64-bit hashes.

    Rows: doc_id, n_shingles, component_id (the smallest doc_id that links lead to), row_hash (of doc_id and
    text), first_id and first_hash (doc_id and row_hash of the first row of the class, by doc_id, nulls last, and row_hash), n_links (the other rows whose set
    is equal or has that similarity, each counted whether or not its link was needed for the class). One row for every input
    row: repeated rows share a class; a null doc_id is never a class's smallest unless all are
    null; other columns are ignored; an empty table gives no rows.
    Groups, pairs and classes stay in tables; the driver sees counts alone, and no join is broadcast through it.
    """
    spark = docs.sparkSession
    tables = Scratch(spark, "jaccard", SORTED)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, n long, print1 long, print2 long, parts array<int>, lead long, sample array<long>, row_hash long"
    described = tables.put(rows.withColumn("row_hash", row_key(docs)).mapInArrow(lambda it: _describe(it, n, percent), schema).withColumn("row", F.monotonically_increasing_id()), "described")
    prefixes = rare_prefixes(described, percent, tables)
    posts = candidate_posts(prefixes, tables)
    narrow = tables.put(described.select("row", "doc_id", "n", "print1", "print2", "row_hash"), "rows")
    tables.drop("described")
    order = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), F.col("doc_id").isNull().alias("none"), F.col("row_hash").alias("hash"))
    groups = tables.put(narrow.where("n > 0").groupBy("print1", "print2").agg(F.min(order).alias("least"), F.count("*").alias("copies")), "groups")
    some = posts.select("sid").distinct()
    wanted = prefixes.select("print1", "print2", F.col("row").alias("sid"), "alone", "parts", "prefix").join(some, "sid").join(narrow.select(F.col("row").alias("sid"), "row_hash"), "sid")
    wanted = tables.put(wanted.join(groups.select("print1", "print2", "copies"), ["print1", "print2"]), "wanted")
    # the filter on sid holds for all rows: without one Spark makes no Bloom filter
    texts = rows.withColumn("row_hash", row_key(docs)).join(wanted.where("sid >= 0"), "row_hash")
    told = "sid long, copies long, alone int, parts array<int>, prefix array<long>, n long, tokens array<long>"
    sets = tables.put(texts.select("sid", "copies", "alone", "parts", "prefix", "print1", "print2", "text").mapInArrow(lambda it: _fetch(it, n), told), "sets", BLOOM)
    links = jaccard_links(posts, sets, percent, tables)
    classes = components(links.where("b IS NOT NULL"), "a", "b", tables, "class")
    degrees = links.select(F.col("a").alias("sid"), F.col("n_a").alias("n")).unionAll(links.select("b", "n_b")).where("n > 0").groupBy("sid").agg(F.sum("n").alias("others"))
    linked = wanted.select("print1", "print2", "sid").join(classes.withColumnRenamed("node", "sid"), "sid").join(degrees, "sid").drop("sid")
    named = groups.join(linked, ["print1", "print2"], "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("others", F.lit(0)))
    named = tables.put(named.where("root IS NOT NULL OR copies > 1").select("print1", "print2", "least", "root", "n_links"), "named")
    of_root = named.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("least"))
    linked = named.drop("least").where("root IS NOT NULL").join(of_root, "root").select("print1", "print2", "least", "n_links")
    final = tables.put(linked.unionByName(named.where("root IS NULL").select("print1", "print2", "least", "n_links")), "final")
    tables.drop("prefixes", "posts", "wanted", "sets", "families", "pairs", "links", "groups", "named")
    out = narrow.join(final.hint("merge"), ["print1", "print2"], "left")
    known = F.col("least").isNotNull()
    first = F.when(known, F.when(~F.col("least.none"), F.col("least.id"))).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), first.alias("component_id"), "row_hash", first.alias("first_id"), F.coalesce("least.hash", "row_hash").alias("first_hash"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The documents without those that have a smaller doc_id (nulls last) in their class of `near_duplicate_classes`; of repeated rows one stays.

    Same columns, whatever their names; rows without words (or text) all stay; an empty table stays empty. The first
    row of a class stands beside each of its rows, so no class is gathered; each text moves once.
    """
    first = (F.col("doc_id").eqNullSafe(F.col("first_id"))) & (F.col("row_hash") == F.col("first_hash"))
    several = classes.where("n_links > 0").groupBy("doc_id", "row_hash").agg(F.max(first).alias("first"))
    held = Scratch(docs.sparkSession, "kept").put(several, "held")
    joined, name = beside_rows(docs, row_key(docs), held, "left")
    stays = F.col(name["first"]).isNull() | (F.col(name["first"]) & (F.col(name["nth"]) == 1))
    return joined.where(stays).select(columns(docs))


def op6_jaccard(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=3, percent=90).select("doc_id", "n_shingles", "component_id", "n_links")
