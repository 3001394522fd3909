"""Cross-entropy difference of two n-gram models."""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .tokens import WordTokenizer, tokenizer_path
from .words import release_memory, slices, texts_of

#: Bytes of text of a chunk: the documents whose bigrams are asked for together.
CHUNK = 6 << 20
#: Bytes of text that are tokenised at once.
SLICE = 2 << 20
#: Tokens that are scored at once, or one text.
AT_ONCE = 1 << 14
#: The history of a text's first token.
BEGIN = (1 << 16) - 1


def bigrams(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """history * 65536 + token of every token."""
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1]
    before[bounds[:-1][np.diff(bounds) > 0]] = BEGIN
    return before << 16 | ids.astype(np.int64)


def _encoded(tokenizer: WordTokenizer, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids, bounds, *_ = tokenizer.encode(texts_of(batch))
    if ids.max(initial=0) >= BEGIN:
        raise ValueError("the vocabulary must have fewer than 65,535 ids")
    return ids, bounds


def _chunks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """One row for each chunk: the rows' doc_ids, the bounds and the 16-bit ids of their texts."""
    from pyspark import TaskContext

    tokenizer, task, number = WordTokenizer(path), TaskContext.get().partitionId(), 0
    held, size = [], 0

    def chunk() -> pa.RecordBatch:
        columns = {
            "chunk": pa.array([(task << 32) | number]), "doc_ids": pa.array([[x for d, _, _ in held for x in d]], pa.list_(pa.int64())),
            "bounds": pa.array([np.concatenate([[0], np.cumsum(np.concatenate([n for _, n, _ in held]))])], pa.list_(pa.int64())), "ids": pa.array([b"".join(i for _, _, i in held)], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(columns)

    for whole in batches:
        for batch in slices(whole, "text", SLICE):
            ids, bounds = _encoded(tokenizer, batch)
            held.append((batch.column("doc_id").to_pylist(), np.diff(bounds), ids.astype("<u2").tobytes()))
            size += batch.column("text").nbytes
            if size >= CHUNK:
                yield chunk()
                held, size, number = [], 0, number + 1
    if held:
        yield chunk()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's distinct bigrams and their counts."""
    for batch in batches:
        for k in range(batch.num_rows):
            ids, bounds = np.frombuffer(batch.column("ids")[k].as_py(), "<u2"), np.asarray(batch.column("bounds")[k].values)
            distinct, n = np.unique(bigrams(ids, bounds), return_counts=True)
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(np.full(len(distinct), batch.column("chunk")[k].as_py())), "bigram": pa.array(distinct), "n": pa.array(n)})
            release_memory()


def _count_marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct bigrams and counts of the texts of each chunk that are marked."""
    for batch in batches:
        for k in range(batch.num_rows):
            ids, bounds = np.frombuffer(batch.column("ids")[k].as_py(), "<u2"), np.asarray(batch.column("bounds")[k].values)
            marked = np.zeros(len(bounds) - 1, bool)
            marked[np.asarray(batch.column("marks")[k].values)] = True
            distinct, n = np.unique(bigrams(ids, bounds)[np.repeat(marked, np.diff(bounds))], return_counts=True)
            yield pa.RecordBatch.from_pydict({"bigram": pa.array(distinct, pa.int64()), "t": pa.array(n)})
            release_memory()


def kinds_left(n: np.ndarray, rate: float) -> np.ndarray:
    """How many of n equal things a sample at `rate` is expected to hold at least one of: 1 - (1 - rate) ** n."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, -np.expm1(n * np.log1p(-rate)), 0.0)


class Totals:
    """What both models know of each id of the vocabulary, and of all: as word (w), as history (h), kinds that follow it (k); n: all documents, t: the target."""

    def __init__(self, words: list, before: list, rate: float):
        self.rate = rate
        self.wn, self.wt, self.hn, self.ht, self.kt = (np.zeros(BEGIN + 1, np.int64) for _ in range(5))
        self.kn = np.zeros(BEGIN + 1)
        for token, wn, wt in words:
            self.wn[token], self.wt[token] = wn, wt
        for history, hn, ht, kn, kt in before:
            self.hn[history], self.ht[history], self.kn[history], self.kt[history] = hn, ht, kn, kt
        self.size, self.all_n, self.all_t = max(len(words), 1), int(self.wn.sum()), int(self.wt.sum())
        self.kinds_t, self.kinds_n = int((self.wt > 0).sum()), float(kinds_left(self.wn, rate).sum())


class _Groups:
    """The tokens of each document with the same key (below 2 ** 32)."""

    def __init__(self, keys: np.ndarray, doc: np.ndarray):
        joined = doc << 32 | keys
        self.order = np.argsort(joined)
        ranked = joined[self.order]
        self.new = np.append(True, ranked[1:] != ranked[:-1])[: len(keys)]
        self.run = np.cumsum(self.new) - 1

    def spread(self, sums: np.ndarray) -> np.ndarray:
        """A value of each group at each of its tokens."""
        out = np.empty(len(self.order), sums.dtype)
        out[self.order] = sums[self.run] if len(self.order) else 0
        return out

    def sizes(self) -> np.ndarray:
        return self.spread(np.bincount(self.run))

    def firsts(self) -> np.ndarray:
        """One token of each group."""
        return self.order[self.new]

    def sums(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        """At each token the sum of its group's values, given at some tokens."""
        place = np.empty(len(self.order), np.int64)
        place[self.order] = self.run
        return self.spread(np.bincount(place[at], values, minlength=int(self.run[-1]) + 1 if len(self.run) else 0))


def losses(keys: np.ndarray, bounds: np.ndarray, n: np.ndarray, t: np.ndarray, aimed: np.ndarray, of: Totals) -> tuple[np.ndarray, np.ndarray]:
    """Sums of target and background losses of each text, by models that have not counted it.

    keys: bigram of each token; n, t: its counts in all documents and in the target; aimed: whether the text is in the target.
    """
    size, rate = np.diff(bounds), of.rate
    doc = np.repeat(np.arange(len(size)), size)
    word, history = keys & 0xFFFF, keys >> 16
    inside = aimed[doc].astype(np.int64)
    pairs, words, histories = _Groups(keys, doc), _Groups(word, doc), _Groups(history, doc)
    own, own_w, own_h = pairs.sizes(), words.sizes(), histories.sizes()
    p, w = pairs.firsts(), words.firsts()
    uniform = 1.0 / of.size
    # the target without the text
    t_b, ht, wt = t - own * inside, of.ht[history] - own_h * inside, of.wt[word] - own_w * inside
    kt = of.kt[history] - histories.sums(p, ((t[p] == own[p]) & (inside[p] > 0)).astype(float))
    gone = np.bincount(doc[w], (of.wt[word[w]] == own_w[w]) & (inside[w] > 0), minlength=len(size))
    kinds, every = (of.kinds_t - gone)[doc], (of.all_t - size * aimed)[doc]
    low = np.where(every > 0, (wt + kinds * uniform) / np.maximum(every + kinds, 1), uniform)
    with np.errstate(invalid="ignore", divide="ignore"):
        target = -np.log(np.where(ht > 0, (t_b + kt * low) / (ht + kt), low))
    # all documents without the text, as a sample of the target's size is expected to be
    n_b, hn, wn = rate * (n - own), rate * (of.hn[history] - own_h), rate * (of.wn[word] - own_w)
    kn = np.maximum(of.kn[history] - histories.sums(p, kinds_left(n[p], rate) - kinds_left(n[p] - own[p], rate)), 0)
    gone = np.bincount(doc[w], kinds_left(of.wn[word[w]], rate) - kinds_left(of.wn[word[w]] - own_w[w], rate), minlength=len(size))
    kinds, every = (of.kinds_n - gone)[doc], (rate * (of.all_n - size))[doc]
    low = np.where(every > 0, (wn + kinds * uniform) / np.maximum(every + kinds, 1e-12), uniform)
    with np.errstate(invalid="ignore", divide="ignore"):
        background = -np.log(np.where(hn > 0, (n_b + kn * low) / (hn + kn), low))
    return np.bincount(doc, target, minlength=len(size)), np.bincount(doc, background, minlength=len(size))


def _score(totals):
    def score(key: tuple, chunks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        of, asked = totals.value, answers.sort_values("bigram")
        bigram, n, t = (asked[c].to_numpy() for c in ("bigram", "n", "t"))
        marks = int(np.searchsorted(bigram, 0))
        bigram, n, t, named = bigram[marks:], n[marks:], t[marks:], -1 - bigram[:marks]
        out = []
        for row in chunks.itertuples():
            bounds = np.asarray(row.bounds)
            ids, size, aimed = np.frombuffer(row.ids, "<u2"), np.diff(bounds), np.zeros(len(bounds) - 1, bool)
            aimed[named] = True
            target, background, begin = np.zeros(len(size)), np.zeros(len(size)), 0
            while begin < len(size):  # some texts at a time, as arrays of all tokens are large
                end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + AT_ONCE, side="right")) - 1)
                inner = bounds[begin : end + 1] - bounds[begin]
                keys = bigrams(ids[bounds[begin] : bounds[end]], inner)
                at = np.searchsorted(bigram, keys)
                target[begin:end], background[begin:end] = losses(keys, inner, n[at] if len(keys) else keys, t[at] if len(keys) else keys, aimed[begin:end], of)
                begin = end
            release_memory()
            some = np.maximum(size, 1)
            out.append(pd.DataFrame({"doc_id": pd.array(list(row.doc_ids), "Int64"), "n_tokens": size, "target_loss": target / some, "background_loss": background / some, "in_target": aimed}))
        return pd.concat(out)

    return score


def cross_entropy_difference(docs: DataFrame, target: DataFrame, path: str | None = None) -> DataFrame:
    """Loss of every document under a target and a background bigram model, and their difference.

    The background model counts the bigrams of all documents, the target model those of documents
    whose doc_id is in `target`; both use the ids of one public tokenizer (under 65,535 of them) as
    vocabulary, in texts of their own (a text's first token follows a begin mark). Both are
    Witten-Bell mixtures of bigrams, unigrams and a uniform share of the tokens seen anywhere.
    The models are matched: the background is what a sample of all tokens, as large as the target, is expected to
    be (counts times the rate, kinds 1 - (1 - rate) ** count), worked out from all counts without drawing a sample, so
    losses don't differ by the size of what was counted. A document is scored by models without it:
    its own counts are taken out of the background and, if it is in the target, out of the target, so
    the score doesn't tell who was in the target. Nothing is cut off, capped or sampled. Bigrams are counted by chunks of
    about 6 MB of text, so a frequent one has a row for each chunk, not for each place; each chunk gets
    the counts of its own distinct bigrams back. What is gathered grows with the corpus; only the
    totals of each id of the vocabulary reach the driver and all executors.

    Rows: doc_id, n_tokens, target_loss, background_loss (mean nats a token), in_target, score (the difference of the
    losses; low: like the target), one for each input row. Null texts and texts without tokens: n_tokens 0, losses
    and score 0. Null doc_id is never in the target; repeated doc_id in `target` count once;
    repeated rows count and are scored each, without themselves but with each other; other columns are ignored; without a
    target its model is uniform and the background is not scaled; an empty table gives no rows.
    """
    spark = docs.sparkSession
    tables, path = Scratch(spark, "lm"), path or tokenizer_path()
    named = tables.put(target.select(F.col("doc_id").cast("long").alias("id")).where("id IS NOT NULL").distinct(), "named")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    chunks = tables.put(rows.mapInArrow(lambda it: _chunks(it, path), "chunk long, doc_ids array<long>, bounds array<long>, ids binary"), "chunks")
    asked = tables.put(chunks.mapInArrow(_count, "chunk long, bigram long, n long"), "asked")
    places = chunks.select("chunk", F.posexplode("doc_ids").alias("place", "id")).join(named, "id").select("chunk", "place")
    marks = tables.put(places.groupBy("chunk").agg(F.collect_list("place").alias("marks")), "marks")  # at most the texts of a chunk
    aimed = tables.put(chunks.join(marks, "chunk").select("bounds", "ids", "marks").mapInArrow(_count_marked, "bigram long, t long"), "aimed")
    both = asked.select("bigram", "n", F.lit(0).cast("long").alias("t")).unionAll(aimed.select("bigram", F.lit(0).cast("long"), "t"))
    counts = tables.put(both.groupBy("bigram").agg(F.sum("n").alias("n"), F.sum("t").alias("t")), "counts")
    token, history = F.expr("cast(bigram & 65535 AS int)").alias("token"), F.expr("cast(shiftright(bigram, 16) AS int)").alias("history")
    # a row for each id of the vocabulary at most
    words = [tuple(r) for r in counts.groupBy(token).agg(F.sum("n"), F.sum("t")).collect()]
    all_n, all_t = sum(w[1] for w in words), sum(w[2] for w in words)
    rate = min(1.0, all_t / all_n) if all_t else 1.0
    kept = F.lit(1.0) if rate == 1.0 else -F.expm1(F.col("n") * F.lit(math.log1p(-rate)))
    before = counts.groupBy(history).agg(F.sum("n"), F.sum("t"), F.sum(kept), F.sum((F.col("t") > 0).cast("long"))).collect()
    totals = spark.sparkContext.broadcast(Totals(words, [tuple(r) for r in before], rate))
    answers = asked.select("chunk", "bigram").join(counts, "bigram").select("chunk", "bigram", "n", "t")
    zero = F.lit(0).cast("long")
    marked = marks.select("chunk", F.explode("marks").alias("place")).select("chunk", (-1 - F.col("place")).cast("long").alias("bigram"), zero.alias("n"), zero.alias("t"))
    tables.drop("aimed")
    schema = "doc_id long, n_tokens long, target_loss double, background_loss double, in_target boolean"
    scored = chunks.select("chunk", "doc_ids", "bounds", "ids").groupBy("chunk").cogroup(answers.unionAll(marked).groupBy("chunk")).applyInPandas(_score(totals), schema)
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss"))


def op4_lm_difference(spark, sf_dir: str) -> DataFrame:
    """Target: the documents labelled good and not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return cross_entropy_difference(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels.where("quality = 1 AND coalesce(toxic, 0) = 0"))
