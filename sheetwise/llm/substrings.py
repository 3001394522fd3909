"""Repeated passages over documents, by sparse suffix arrays at minimiser positions."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import BLOOM, Scratch, beside_rows, columns, map_whole, partitions, row_key
from .words import _BASE, gather, mix, owner, powers, rebased, run_hashes, slices, texts_of, word_codes, word_hashes

#: Words of the shortest passage, of the grams that are drawn, and how many grams the draw is among.
LEAST, GRAM, AMONG = 50, 8, 25
#: Suffixes of one key that a task takes together; keys with more are dealt out by document and place.
GROUP = 1024


def minimisers(hashes: np.ndarray, bounds: np.ndarray, least: int = LEAST, gram: int = GRAM, among: int = AMONG) -> tuple[np.ndarray, np.ndarray]:
    """For each window of `least` words inside a text: its start, and the position that its content draws.

    Of the first `among` grams of the window the one with the least hash is drawn (the first of equals), so equal
    windows draw the same place. At least `least` - `among` + 1 words of the window lie from there on.
    """
    n = len(hashes)
    size = np.diff(bounds)
    starts = gather(bounds[:-1], np.maximum(size - least + 1, 0))
    if not len(starts):
        return starts, starts
    at = np.arange(n)
    low = mix(run_hashes(hashes, at, np.minimum(at + gram, n)) ^ np.uint64(0x5851F42D4C957F2D))
    place, width = at.copy(), 1

    def better(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.where(low[j] < low[i], j, i)

    while 2 * width <= among:
        place = better(place, place[np.minimum(at + width, n - 1)])
        width *= 2
    return starts, better(place[starts], place[starts + among - width])


def _keys(hashes: np.ndarray, places: np.ndarray, words: int) -> np.ndarray:
    return run_hashes(hashes, places, places + words).astype(np.int64)


def _suffixes(batches: Iterator[pa.RecordBatch], least: int, among: int) -> Iterator[pa.RecordBatch]:
    """The retained suffixes: place and key, the hash of the words that any passage drawing the place has from there on."""
    for whole in batches:
        for batch in slices(whole, "text", 2 << 20):
            codes, bounds, words = word_codes(texts_of(batch))
            hashes = word_hashes(words)[codes]
            places = np.unique(minimisers(hashes, bounds, least, GRAM, among)[1])
            row = owner(bounds)[places] if len(places) else np.zeros(0, np.int64)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("row_hash").take(take), pa.array((places - bounds[row]).astype(np.int32)), pa.array(_keys(hashes, places, least - among + 1))], ["doc_id", "row_hash", "place", "key"])


def _contexts(batches: Iterator[pa.RecordBatch], least: int, among: int) -> Iterator[pa.RecordBatch]:
    """The suffixes that are shared, with the words around them that decide about passages of `least` words."""
    for whole in batches:
        for batch in slices(whole, "text", 2 << 20):
            codes, bounds, words = word_codes(texts_of(batch))
            hashes = word_hashes(words)[codes]
            starts, places = minimisers(hashes, bounds, least, GRAM, among)
            shared = batch.column("shared")
            offsets = shared.offsets.to_numpy()
            flat = shared.values.slice(offsets[0], offsets[-1] - offsets[0])
            row = owner(offsets - offsets[0])
            at = np.asarray(flat.field("place")).astype(np.int64) + bounds[row]
            parts = np.asarray(flat.field("parts")).astype(np.int64)
            order = np.argsort(at, kind="stable")
            row, at, parts = row[order], at[order], parts[order]
            first, last = np.full(len(codes) + 1, len(codes)), np.full(len(codes) + 1, -1)
            np.minimum.at(first, places, starts)
            np.maximum.at(last, places, starts)
            word = np.concatenate([np.zeros(among - 1, np.uint32), (hashes >> np.uint64(32)).astype(np.uint32), np.zeros(least, np.uint32)])
            doc = batch.column("row_hash").to_numpy()
            for k in range(0, len(at), 8192):
                a, r, p = at[k : k + 8192], row[k : k + 8192], parts[k : k + 8192]
                around = np.ascontiguousarray(word[a[:, None] + np.arange(among - 1 + least)])
                blob = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * around.shape[1]), len(a), [None, pa.py_buffer(around)]).cast(pa.binary())
                part = (mix(doc[r].astype(np.uint64) ^ mix((a - bounds[r]).astype(np.uint64))) % p.astype(np.uint64)).astype(np.int64)
                take = pa.array(r)
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(_keys(hashes, a, least - among + 1)), "part": pa.array(part), "parts": pa.array(p), "doc_id": batch.column("doc_id").take(take), "row_hash": batch.column("row_hash").take(take),
                    "place": pa.array(a - bounds[r]), "low": pa.array(first[a] - bounds[r]), "high": pa.array(last[a] - bounds[r]), "around": blob,
                })


def _window_hashes(around: np.ndarray, least: int) -> np.ndarray:
    """Hashes of all windows of `least` words of each context, by start."""
    total = np.concatenate([np.zeros((len(around), 1), np.uint64), np.cumsum(around.astype(np.uint64) * powers(_BASE, around.shape[1]), axis=1, dtype=np.uint64)], axis=1)
    count = around.shape[1] - least + 1
    return mix((total[:, least:] - total[:, :count]) * powers(pow(_BASE, -1, 1 << 64), count))


def sorted_runs(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts rows of words inside their groups. Returns the order, and for each place in it how many first words the row has in common with the one before (-1 in another group)."""
    n, wide = words.shape
    big = np.empty((n, wide + 1), ">u4")
    big[:, 0], big[:, 1:] = group, words
    order = np.argsort(np.ascontiguousarray(big).view(f"S{4 * (wide + 1)}")[:, 0], kind="stable")
    common = np.full(n, -1)
    if n > 1:
        here, before = order[1:], order[:-1]
        equal = words[here] == words[before]
        common[1:] = np.where(group[here] != group[before], -1, np.where(equal.all(axis=1), wide, equal.argmin(axis=1)))
    return order, common


def intervals(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """For each row the number of its interval: neighbours in the order that share at least `depth` words are in the same one."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < depth)
    return out


def window_classes(around: np.ndarray, group: np.ndarray, of: np.ndarray, k: np.ndarray, least: int, among: int) -> np.ndarray:
    """A number for each window (context `of`, start `k` in it) that equal windows of the same group share, and no others.

    The suffixes of a group are sorted by their words from the drawn place on, and again by the words before it, nearest
    first; neighbours' common words bound the intervals of each depth. A window with L words before the
    place and R from there on is the interval of depth R to the right and the one of depth L to the left.
    """
    right, left = sorted_runs(around[:, among - 1 :], group), sorted_runs(around[:, among - 2 :: -1], group)
    out = np.empty(len(of), np.int64)
    for start in range(among):
        mine = np.flatnonzero(k == start)
        if len(mine):
            after, before = intervals(*right, least - (among - 1 - start)), intervals(*left, among - 1 - start)
            row = of[mine]
            out[mine] = ((start * (len(group) + 1)) + after[row]) * (len(group) + 1) + before[row]
    return out


def _classes(number: np.ndarray, doc: np.ndarray, row_hash: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorts windows so that equal ones are neighbours, in order of document and start within. Returns that order without repeated rows, the head of each one's class in it, and the class sizes by window."""
    order = np.lexsort((start, row_hash, doc, number))
    h, d, r, s = number[order], doc[order], row_hash[order], start[order]
    same = np.append(False, (h[1:] == h[:-1]) & (d[1:] == d[:-1]) & (r[1:] == r[:-1]) & (s[1:] == s[:-1]))[: len(h)]
    order, h = order[~same], h[~same]
    head = np.flatnonzero(np.append(True, h[1:] != h[:-1]))[: len(h)]
    size = np.diff(np.append(head, len(h)))
    return order, np.repeat(head, size), np.repeat(size, size)


MEMBERS = pa.list_(pa.struct([("doc_id", pa.int64()), ("row_hash", pa.int64()), ("low", pa.int64())]))
SPANS = "doc_id long, row_hash long, low long, high long, again boolean, first_doc long, window long, head long, members array<struct<doc_id: long, row_hash: long, low: long>>"
#: Runs that share the first document's places stand in one row, up to so many.
TOGETHER = 256


def _compare(batches: Iterator[pa.RecordBatch], least: int, among: int) -> Iterator[pa.RecordBatch]:
    """The suffixes of a key, sorted, compared with their neighbours and extended to the left and right.

    A match that reaches the edge of a context goes on in the next: equal passages draw equal places, so the windows there
    are found from that place, and the runs of windows join.

    Rows: runs of window starts that stand elsewhere too, with their first document. For keys dealt over
    several parts, for the parts to be put together: the first window of each class in the part (window not
    null; again: whether others of the class are in the part) with its suffix as head, and the runs of the others as members of
    rows with the suffix of their first windows as head, which stand there from low to high.
    """
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None and rest.num_rows else table
        key, part = table["key"].to_numpy(), table["part"].to_numpy()
        edge = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
        cut = int(edge[-1]) if len(edge) else 0
        rest = table.slice(cut)
        if cut:
            yield from _runs(table.slice(0, cut), least, among)
    if rest is not None and rest.num_rows:
        yield from _runs(rest, least, among)


def _runs(table: pa.Table, least: int, among: int) -> Iterator[pa.RecordBatch]:
    column = {c: table[c].to_numpy() for c in ("key", "part", "parts", "row_hash", "place", "low", "high")}
    doc_ids = table["doc_id"].combine_chunks()
    doc = doc_ids.fill_null(np.iinfo(np.int64).max).to_numpy()
    wide = among - 1 + least
    around = np.concatenate([np.frombuffer(x.buffers()[2], np.uint32, len(x) * wide, np.frombuffer(x.buffers()[1], np.int32)[x.offset]).reshape(len(x), wide) for x in table["around"].chunks if len(x)])
    group = np.cumsum(np.append(True, (column["key"][1:] != column["key"][:-1]) | (column["part"][1:] != column["part"][:-1])))
    start = column["place"][:, None] - (among - 1) + np.arange(among)
    valid = (start >= column["low"][:, None]) & (start <= column["high"][:, None])
    of, k = np.nonzero(valid)
    at = start[of, k]
    order, head, size = _classes(window_classes(around, group, of, k, least, among), doc[of], column["row_hash"][of], at)
    found, begins = of[order], at[order]
    again, dealt = head != np.arange(len(order)), column["parts"][found] > 1
    first = found[head]
    named = mix(column["key"].astype(np.uint64) ^ mix(column["part"].astype(np.uint64)))
    suffix = mix(named ^ mix(column["row_hash"].astype(np.uint64) ^ mix(column["place"].astype(np.uint64)))).astype(np.int64)
    pick = np.flatnonzero((size > 1) & (again | ~dealt))
    if len(pick):  # runs of starts with the same suffix, state and first document; in dealt keys also the same first suffix, in step
        s = pick[np.lexsort((begins[pick], found[pick]))]
        other, step = column["row_hash"][first[s]], begins[s] - begins[head[s]]
        new = np.append(True, (found[s][1:] != found[s][:-1]) | (begins[s][1:] != begins[s][:-1] + 1) | (again[s][1:] != again[s][:-1]) | (other[1:] != other[:-1]) | (dealt[s][1:] & ((first[s][1:] != first[s][:-1]) | (step[1:] != step[:-1]))))
        lo = np.flatnonzero(new)
        hi = np.append(lo[1:], len(s)) - 1
        here = ~dealt[s[lo]]
        x, y = s[lo[here]], s[hi[here]]
        yield _spans(doc_ids, column, found[x], begins[x], begins[y], again[x], first[x], None, None)
        x, y = s[lo[~here]], s[hi[~here]]
        yield from _members(doc_ids, column["row_hash"], found[x], begins[x], suffix[first[x]], begins[head[x]], begins[y] - begins[x])
    pick = np.flatnonzero(dealt & ~again)
    if len(pick):
        rows, at_row = np.unique(found[pick], return_inverse=True)
        key = _window_hashes(around[rows], least)[at_row, k[order[pick]]] ^ mix(column["key"][found[pick]].astype(np.uint64))
        yield _spans(doc_ids, column, found[pick], begins[pick], begins[pick], size[pick] > 1, first[pick], key, suffix[found[pick]])


def _spans(doc_ids, column, row, low, high, again, first, window, head) -> pa.RecordBatch:
    none = pa.nulls(len(row), pa.int64())
    return pa.RecordBatch.from_arrays(
        [doc_ids.take(pa.array(row)), pa.array(column["row_hash"][row]), pa.array(low), pa.array(high), pa.array(again), doc_ids.take(pa.array(first)), none if window is None else pa.array(window.astype(np.int64)), none if head is None else pa.array(head), pa.nulls(len(row), MEMBERS)],
        ["doc_id", "row_hash", "low", "high", "again", "first_doc", "window", "head", "members"],
    )


def _members(doc_ids, row_hash, row, low, head, head_low, longer) -> Iterator[pa.RecordBatch]:
    """Runs of the same length with the same first windows, together in rows."""
    if not len(row):
        return
    order = np.lexsort((longer, head_low, head))
    row, low, head, head_low, longer = row[order], low[order], head[order], head_low[order], longer[order]
    new = np.append(True, (head[1:] != head[:-1]) | (head_low[1:] != head_low[:-1]) | (longer[1:] != longer[:-1]))
    since = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
    at = np.flatnonzero(since % TOGETHER == 0)
    each = pa.StructArray.from_arrays([doc_ids.take(pa.array(row)), pa.array(row_hash[row]), pa.array(low)], fields=list(MEMBERS.value_type))
    none = pa.nulls(len(at), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [none, none, pa.array(head_low[at]), pa.array((head_low + longer)[at]), pa.array(np.ones(len(at), bool)), none, none, pa.array(head[at]), pa.ListArray.from_arrays(pa.array(np.append(at, len(row)).astype(np.int32)), each)],
        ["doc_id", "row_hash", "low", "high", "again", "first_doc", "window", "head", "members"],
    )


def repeated_passages(docs: DataFrame, least: int = LEAST, among: int = AMONG) -> DataFrame:
    """All passages of `least` words or more that stand in more than one place, whole texts of all documents.

    Words stand between ASCII blanks. Every window of `least` words draws a minimiser among its
    first grams; only suffixes from drawn places are retained (about two in `among` + 1). They are
    dealt by their next words, all that a passage has at least from there; suffixes alone there
    are dropped. The others are sorted by their words, neighbours' common words are counted to the right and to the left,
    and the intervals of both orders tell which windows that draw the place are equal, so that every repeated
    window is found, and longer passages as runs of them. A key with
    over 1,024 suffixes is dealt out by document and place, and the first window of each class of a part is
    compared with the other parts', so no task holds a hot passage whole, even one that a document repeats.

    One row for each document with a repeated passage: doc_id, row_hash (of doc_id and text),
    spans (array of first word, words: the union of repeated windows; also_in: the doc_ids of the first
    documents of all these windows, ascending, null last for a null doc_id; of a window that stands here first, the document's own),
    removed (the words of them that are not the first occurrence in the order of doc_id, nulls last, and
    place). Null doc_id is a document like others; repeated rows
    (same doc_id and text) count as one document; null, empty or short texts and an empty table have
    no passages; other columns are ignored.
    """
    spark = docs.sparkSession
    tables = Scratch(spark, "passages")
    rows = docs.select(F.col("doc_id").cast("long"), row_key(docs).alias("row_hash"), F.col("text").cast("string"))
    suffixes = tables.put(rows.mapInArrow(lambda it: _suffixes(it, least, among), "doc_id long, row_hash long, place int, key long"), "suffixes")
    # written before the join, so that Spark can split the suffixes of a hot key in it
    counts = tables.put(suffixes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    shared = suffixes.join(counts.hint("merge"), "key").select("doc_id", "row_hash", F.struct("place", F.expr(f"cast(ceil(n / {GROUP}.0D) AS int)").alias("parts")).alias("one"))
    shared = tables.put(shared.groupBy("doc_id", "row_hash").agg(F.collect_set("one").alias("shared")), "shared").withColumnRenamed("doc_id", "id").withColumnRenamed("row_hash", "hash")
    tables.drop("suffixes", "counts")
    # the filter on hash holds for all rows: without one Spark makes no Bloom filter
    texts = rows.join(shared.where(F.col("hash") >= F.lit(-(1 << 63))), (F.col("row_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("doc_id", "row_hash", "text", "shared")
    schema = "key long, part long, parts long, doc_id long, row_hash long, place long, low long, high long, around binary"
    sorted_ = texts.mapInArrow(lambda it: _contexts(it, least, among), schema).repartition("key", "part").sortWithinPartitions("key", "part")
    runs = tables.put(sorted_.mapInArrow(lambda it: _compare(it, least, among), SPANS), "runs", BLOOM)
    # the parts of keys that were dealt out
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), "row_hash", "low")
    heads = runs.where("window IS NOT NULL").withColumn("order", order)
    firsts = heads.groupBy("window").agg(F.min("order").alias("least"), F.count("*").alias("n"))
    heads = tables.put(heads.join(firsts, "window").select("doc_id", "row_hash", "low", "high", (F.col("order") != F.col("least")).alias("later"), F.expr("n > 1 OR again").alias("counts"), "head", F.col("least.doc").alias("first_doc")), "heads")
    of_head = heads.groupBy("head").agg(F.collect_list(F.struct("low", "first_doc")).alias("known"))
    known = F.expr("array_distinct(transform(filter(known, x -> x.low BETWEEN low AND high), x -> x.first_doc))")
    spans = runs.where("window IS NULL AND head IS NULL").select("doc_id", "row_hash", "low", "high", "again", F.array("first_doc").alias("also_in"))
    # rows of many runs, dealt evenly before they are taken apart
    shared = runs.where("window IS NULL AND head IS NOT NULL").join(of_head, "head").select(known.alias("also_in"), (F.col("high") - F.col("low")).alias("longer"), "members")
    each = shared.repartition(partitions(spark)).select("also_in", "longer", F.explode("members").alias("m"))
    spans = spans.unionByName(each.select("m.doc_id", "m.row_hash", "m.low", (F.col("m.low") + F.col("longer")).alias("high"), F.lit(True).alias("again"), "also_in"))
    spans = spans.unionByName(heads.where("counts").select("doc_id", "row_hash", "low", "high", F.col("later").alias("again"), F.array("first_doc").alias("also_in")))
    grouped = spans.groupBy("doc_id", "row_hash").agg(F.collect_list(F.struct("low", "high", "again", "also_in")).alias("runs"))
    out = tables.put(grouped.mapInArrow(lambda it: _unions(it, least), "doc_id long, row_hash long, spans array<struct<start: long, words: long, also_in: array<long>>>, removed array<struct<start: long, words: long>>"), "out")
    tables.drop("shared", "runs", "heads")
    return out


def _unions(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The words of each document's runs of windows, and those that are not the first occurrence; the documents of a batch lie side by side on one axis."""
    plain = pa.struct([("start", pa.int64()), ("words", pa.int64())])
    named = pa.struct([("start", pa.int64()), ("words", pa.int64()), ("also_in", pa.list_(pa.int64()))])
    for batch in batches:
        offsets = batch.column("runs").offsets.to_numpy()
        runs = batch.column("runs").values.slice(offsets[0], offsets[-1] - offsets[0])
        doc, n = owner(offsets - offsets[0]), batch.num_rows
        low, high = (runs.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("low", "high"))
        again = runs.field("again").to_numpy(zero_copy_only=False).astype(bool)
        base, end = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
        np.minimum.at(base, doc, low)
        np.maximum.at(end, doc, high + least)
        width = end - base + 1  # the last word of each is never covered
        begin = np.cumsum(width) - width
        total, first = int(width.sum()), begin[doc] + low - base[doc]

        def windows(mine: np.ndarray, first=first, last=first + high - low, total=total) -> np.ndarray:
            step = np.zeros(total + 1, np.int32)
            np.add.at(step, first[mine], 1)
            np.add.at(step, last[mine] + 1, -1)
            return np.cumsum(step)[:total] > 0

        def words(starts: np.ndarray, total=total) -> np.ndarray:
            at, step = np.flatnonzero(starts), np.zeros(total + least + 1, np.int32)
            step[at] += 1
            step[at + least] -= 1
            return np.cumsum(step)[:total] > 0

        def lists(covered: np.ndarray, begin=begin, base=base, n=n) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
            lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            of = np.searchsorted(begin, lo, side="right") - 1
            return lo, lo - begin[of] + base[of], hi - lo, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int32)

        # a window that was first in its part may not be so in the whole table
        later = windows(again)
        kept = windows(~again) & ~later
        at, start, size, bounds = lists(words(later | kept))
        _, gone_start, gone_size, gone_bounds = lists(words(later) & ~words(kept))
        also = runs.field("also_in")
        also_at = also.offsets.to_numpy()
        docs = also.values.slice(also_at[0], also_at[-1] - also_at[0])
        span = (np.searchsorted(at, first, side="right") - 1)[owner(also_at - also_at[0])]
        none, value = docs.is_null().to_numpy(zero_copy_only=False), docs.fill_null(0).to_numpy()
        order = np.lexsort((value, none, span))
        span, none, value = span[order], none[order], value[order]
        new = np.append(True, (span[1:] != span[:-1]) | (none[1:] != none[:-1]) | (value[1:] != value[:-1]))[: len(span)]
        span, none, value = span[new], none[new], value[new]
        partners = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(span, minlength=len(at)))]).astype(np.int32)), pa.array(value, mask=none))
        found = pa.StructArray.from_arrays([pa.array(start), pa.array(size), partners], fields=list(named))
        removed = pa.StructArray.from_arrays([pa.array(gone_start), pa.array(gone_size)], fields=list(plain))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_hash"), pa.ListArray.from_arrays(pa.array(bounds), found), pa.ListArray.from_arrays(pa.array(gone_bounds), removed)], ["doc_id", "row_hash", "spans", "removed"])


def _cut(batches: Iterator[pa.RecordBatch], removed_in: str) -> Iterator[pa.RecordBatch]:
    """Takes the words named in the column `removed_in` out of the texts, and the rows without a word left; rows that name none pass as they are."""
    blank = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
    for whole in batches:
        for batch in slices(whole, "text", 4 << 20):
            gone = batch.column(removed_in)
            batch = batch.drop_columns([removed_in])
            if gone.null_count == len(gone):
                yield batch
                continue
            bounds, data = rebased(texts_of(batch))
            out, stays = [], np.ones(batch.num_rows, bool)
            for i, removed in enumerate(gone.to_pylist()):
                text = data[bounds[i] : bounds[i + 1]]
                if removed:
                    inside = ~blank[text]
                    word = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
                    keep = np.ones(len(text), bool)
                    for r in removed:
                        end = r["start"] + r["words"]
                        keep[word[r["start"]] : word[end] if end < len(word) else len(text)] = False
                    stays[i] = bool((inside & keep).any())
                    text = text[keep]
                out.append(text.tobytes())
            texts = pa.array(out, pa.large_binary()).cast(pa.large_string())
            texts = pc.if_else(pc.is_null(batch.column("text")), None, texts).cast(batch.schema.field("text").type)
            yield batch.set_column(batch.schema.get_field_index("text"), "text", texts).filter(pa.array(stays))


def remove_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """The documents without the `removed` words of `repeated_passages`, same columns, whatever their names; documents left without a word go, all others stay.

    A text keeps its bytes but for the removed words and the blanks after them. Null and empty texts, null doc_id and
    repeated rows stay as they are but for their removed words; an empty table stays empty. Each text moves once.
    """
    gone = passages.where(F.size("removed") > 0).select("doc_id", "row_hash", "removed")
    joined, name = beside_rows(docs, row_key(docs), gone, "left")
    return map_whole(joined.select(*columns(docs), name["removed"]), lambda it: _cut(it, name["removed"]), without=name["removed"])


def op9_passages(spark, sf_dir: str) -> DataFrame:
    found = repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    one = found.select("doc_id", F.explode("spans").alias("span"), F.expr("aggregate(removed, 0L, (s, r) -> s + r.words)").alias("removed_words"))
    return one.select("doc_id", F.col("span.start").alias("start_word"), F.col("span.words").alias("n_words"), "removed_words", F.col("span.also_in").alias("match_doc_ids"))
