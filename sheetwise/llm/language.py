"""Language ID: each document as a mixture of languages."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_whole
from .words import owner, per_text, slices, texts_of, word_codes

#: Documents of each language that the n-gram models are fitted on, about.
SAMPLE = 3000
#: Languages that models can be made of; more are an error, as the counts of all reach the driver.
LANGUAGES = 1000
UNDETERMINED = "und"
#: Marks put around a word, and the least length of a word that has letters with them.
START, STOP = "\x02", "\x03"


@dataclass
class NgramModels:
    """Character trigram models of several languages over one alphabet; tables are sorted by gram, one column a language."""

    languages: list[str]
    alphabet: np.ndarray
    grams: dict[int, np.ndarray]  # by order: sorted gram keys
    logp: dict[int, np.ndarray]  # by order: log p of the last character after the others
    back: dict[int, np.ndarray]  # by order: log weight of the lower order after this context

    @classmethod
    def fit(cls, counts: list[tuple[str, str, int]]) -> "NgramModels | None":
        """From (language, trigram, count); Witten-Bell interpolation down to uniform."""
        if not counts:
            return None
        languages = sorted({c[0] for c in counts})
        column = {x: i for i, x in enumerate(languages)}
        alphabet = np.unique(np.frombuffer("".join(c[1] for c in counts).encode("utf-32-le"), np.uint32))
        base = len(alphabet) + 1
        points = np.frombuffer("".join(c[1] for c in counts).encode("utf-32-le"), np.uint32).reshape(-1, 3)
        code = np.searchsorted(alphabet, points).astype(np.int64) + 1
        lang, n = np.array([column[c[0]] for c in counts]), np.array([c[2] for c in counts], np.float64)

        def table(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            grams, at = np.unique(keys, return_inverse=True)
            out = np.zeros((len(grams), len(languages)))
            np.add.at(out, (at, lang), weight)
            return grams, out

        grams, count = {}, {}
        for order in (1, 2, 3):
            key = np.zeros(len(code), np.int64)
            for k in range(3 - order, 3):
                key = key * base + code[:, k]
            grams[order], count[order] = table(key, n)
        prob, logp, back = np.full((1, len(languages)), 1.0 / base), {}, {}
        for order in (1, 2, 3):
            g, c = grams[order], count[order]
            if order == 1:
                ctx, at = np.zeros(1, np.int64), np.zeros(len(g), np.int64)
            else:
                ctx, at = np.unique(g // base, return_inverse=True)
            total, kinds = np.zeros((len(ctx), len(languages))), np.zeros((len(ctx), len(languages)))
            np.add.at(total, at, c)
            np.add.at(kinds, at, c > 0)
            seen = total + kinds
            weight = np.where(seen > 0, kinds / np.maximum(seen, 1), 1.0)
            lower = prob if order == 1 else prob[np.searchsorted(grams[order - 1], g % base ** (order - 1))]
            prob = np.where(seen[at] > 0, (c + kinds[at] * lower) / np.maximum(seen[at], 1), lower)
            logp[order] = np.log(prob)
            back[order - 1] = np.log(weight)
            if order > 1:
                grams[-(order - 1)] = ctx  # contexts of this order
        return cls(languages, alphabet, grams, logp | {0: np.full((1, len(languages)), -np.log(base))}, back)

    def _trigrams(self, keys: np.ndarray) -> np.ndarray:
        """Log p by language of the last character of each trigram after the other two."""
        base = len(self.alphabet) + 1
        c, b, a = keys % base, keys // base % base, keys // base**2
        grams, context = {1: c, 2: b * base + c, 3: keys}, {1: b, 2: a * base + b}
        out = np.broadcast_to(self.logp[0], (len(keys), len(self.languages))) + self.back[0]
        for order in (1, 2, 3):
            if order > 1:
                ctx = self.grams[-(order - 1)]
                i = np.minimum(np.searchsorted(ctx, context[order - 1]), len(ctx) - 1)
                out = out + np.where((ctx[i] == context[order - 1])[:, None], self.back[order - 1][i], 0.0)
            g = self.grams[order]
            i = np.minimum(np.searchsorted(g, grams[order]), len(g) - 1)
            out = np.where((g[i] == grams[order])[:, None], self.logp[order][i], out)
        return out

    def score(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood of each word by language (rows of zeros for words without letters), and whether it has letters."""
        letters = pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}\p{M}]+", "")
        has = pc.match_substring_regex(letters, r"\p{L}").to_numpy(zero_copy_only=False)
        text = "".join(START + START + w + STOP for w in letters.to_pylist())
        point = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, point), len(self.alphabet) - 1)
        code = np.where(self.alphabet[at] == point, at + 1, 0).astype(np.int64)
        size = pc.utf8_length(letters).to_numpy(zero_copy_only=False).astype(np.int64) + 3
        last = np.arange(len(point)) - np.repeat(np.cumsum(size) - size, size) >= 2
        here = np.flatnonzero(last)
        base = len(self.alphabet) + 1
        kinds, at = np.unique((code[here - 2] * base + code[here - 1]) * base + code[here], return_inverse=True)
        out = self._trigrams(kinds)[at]
        bounds = np.concatenate([[0], np.cumsum(np.maximum(size - 2, 0))])
        return per_text(out, bounds, np.float64) * has[:, None], has


def word_grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams (three code points of 21 bits in one number) of the marked words, and the word of each."""
    letters = pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}\p{M}]+", "").to_pylist()
    marked = [START + START + w + STOP if w else "" for w in letters]
    point = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.int64)
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    begin = np.repeat(np.cumsum(size) - size, size)
    here = np.flatnonzero(np.arange(len(point)) - begin >= 2)
    return point[here - 2] << 42 | point[here - 1] << 21 | point[here], np.repeat(np.arange(len(size)), size)[here]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", 1 << 20):
            codes, bounds, words = word_codes(texts_of(batch))
            langs = batch.column("lang").dictionary_encode()
            grams, word = word_grams(words)
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                n = np.bincount(codes[langs.indices.to_numpy()[owner(bounds)] == k], minlength=len(words))
                kinds, at = np.unique(grams[n[word] > 0], return_inverse=True)
                total = np.bincount(at, weights=n[word][n[word] > 0], minlength=len(kinds)).astype(np.int64)
                text = (kinds[:, None] >> np.array([42, 21, 0]) & ((1 << 21) - 1)).astype("<u4").tobytes().decode("utf-32-le")
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(kinds), pa.string()), "gram": pa.array([text[i : i + 3] for i in range(0, len(text), 3)], pa.string()), "n": pa.array(total)})


def fit_languages(labelled: DataFrame, sample: int = SAMPLE) -> NgramModels | None:
    """Trigram models from rows with doc_id, text and lang (null lang: left out).

    Fitted on about `sample` documents of each language, chosen by a hash of doc_id; the trigram
    counts of that bounded sample are all that reaches the driver.
    """
    rows = labelled.where("lang IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not sizes:
        return None
    limit = F.element_at(F.create_map(*[F.lit(x) for s, n in sizes.items() for x in (s, min(1.0, sample / n))]), F.col("lang"))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < limit * (1 << 20))
    grams = chosen.mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return NgramModels.fit(sorted((r["lang"], r["gram"], r["n"]) for r in grams.collect()))


def mixture(relative: np.ndarray, bounds: np.ndarray, rounds: int = 8, penalty: float = 1.0) -> np.ndarray:
    """Language shares (texts, languages) from the words' likelihoods relative to their best language.

    Expectation-maximisation over all languages; then for k = 1, 2, ... the k largest shares are
    fitted again alone, and each text keeps the set with the greatest log likelihood less
    `penalty` * log(words) for each language after the first.
    """
    languages, size = relative.shape[1], np.diff(bounds)
    out = np.full((len(size), languages), 1.0 / languages, np.float32)
    some = np.flatnonzero(size > 0)
    if not len(some):
        return out
    likely, size = np.ascontiguousarray(relative.T), size[some]  # a row for each language
    starts, n = bounds[:-1][some], size.astype(np.float64)

    def per(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, starts, axis=-1, dtype=np.float64)

    def fit(share: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(steps):
            joint = likely * np.repeat(share, size, axis=1)
            joint /= joint.sum(axis=0)
            share = (per(joint) / n).astype(np.float32)
            share /= np.maximum(share.sum(axis=0), 1e-9)
        return share, per(np.log((likely * np.repeat(share, size, axis=1)).sum(axis=0)))

    full, _ = fit(np.full((languages, len(some)), 1.0 / languages, np.float32), rounds)
    place = np.argsort(np.argsort(-full, axis=0, kind="stable"), axis=0, kind="stable")
    best, best_score = full, np.full(len(some), -np.inf)
    for k in range(1, languages + 1):
        start = np.where(place < k, np.maximum(full, 1e-3), 0).astype(np.float32)
        share, ll = fit(start / start.sum(axis=0), 0 if k == 1 else 3)
        score = ll - penalty * (k - 1) * np.log(n + 1)
        better = score > best_score
        best, best_score = np.where(better, share, best), np.where(better, score, best_score)
    out[some] = best.T
    return out


def _predict(batch: pa.RecordBatch, models: NgramModels | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, its share and the set with shares, of each row."""
    codes, bounds, words = word_codes(texts_of(batch))
    size = batch.num_rows
    pred, score, sets = np.full(size, UNDETERMINED, object), np.zeros(size), np.full(size, "", object)
    if models is not None and len(words):
        ll, has = models.score(words)
        keep = has[codes]
        codes, bounds = codes[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]
        relative = np.maximum(np.exp(ll - ll.max(axis=1, keepdims=True)), 1e-12).astype(np.float32)[codes]
        share, some = mixture(relative, bounds), np.diff(bounds) > 0
        best = share.argmax(axis=1)
        pred[some] = np.array(models.languages, object)[best[some]]
        score[some] = share.max(axis=1)[some]
        for i in np.flatnonzero(some):
            sets[i] = ",".join(f"{models.languages[k]}:{share[i, k]:.3f}" for k in np.argsort(-share[i], kind="stable") if share[i, k] > 0)
    return pred, np.clip(score, 0, 1), sets


def _identified(batches: Iterator[pa.RecordBatch], models: NgramModels | None) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", 1 << 20):
            pred, score, sets = _predict(batch, models)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score), pa.array(sets, pa.string())], ["doc_id", "lang_pred", "score", "languages"])


def _accepted(batches: Iterator[pa.RecordBatch], models: NgramModels | None, least: float) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", 1 << 20):
            pred, score, _ = _predict(batch, models)
            yield batch.filter(pa.array((pred != UNDETERMINED) & (score >= least)))


def identify_languages(docs: DataFrame, models: NgramModels | None) -> DataFrame:
    """doc_id, lang_pred, score (its share, 0 to 1) and languages (the chosen set with shares) of every row.

    The whole text counts. lang_pred is `und` with score 0 where the text is null or has no letter,
    or nothing was learned. Row by row, without a shuffle: null or repeated doc_id, repeated rows
    and an empty table pass as they are; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(lambda it: _identified(it, models), "doc_id long, lang_pred string, score double, languages string")


def accept_languages(docs: DataFrame, models: NgramModels | None, least: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whatever their names, whose language is determined with a share of at least `least`.

    Null texts, those without a letter and, without models, all go; repeated rows and null doc_id are judged as any row; an empty table stays empty.
    """
    return map_whole(docs, lambda it: _accepted(it, models, least))


def held_out(docs: DataFrame):
    """Whether crc32(doc_id as text) mod 4 is 2; null doc_id: null."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def learned(docs: DataFrame, sample: int = SAMPLE) -> NgramModels | None:
    """Models of the documents that aren't held out (null doc_id: neither held out nor learned from).

    Null lang is left out, null or empty texts add nothing, a repeated row counts as often as it stands, other columns are not read; None for a table without a labelled row.
    """
    return fit_languages(docs.where(~held_out(docs)), sample)


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify_languages(docs, learned(docs))
    return out.select("doc_id", F.coalesce(held_out(out), F.lit(False)).alias("held_out"), "lang_pred", "score", "languages")
