"""Quality rules on repetition inside a document, from suffix arrays."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import BLANKS, owner, per_text, rebased, slices, texts_of, word_codes

SYMBOLS = b"#*$%&|<>"


def suffix_array(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of every text at once, and the common prefix of each entry with the one before it (0 across texts).

    Prefix doubling over word codes. Suffixes end with their text, so texts never compare with
    each other; only groups that are still tied are sorted again.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = owner(bounds)
    left = bounds[text + 1] - np.arange(n)  # words from here to the end of the text
    key = text * (int(codes.max()) + 1) + codes
    sa = np.argsort(key, kind="stable")
    head = _heads(key[sa])
    levels, width = [], 1
    while True:
        rank = np.empty(n, np.int64)
        rank[sa] = head
        levels.append(rank.astype(np.int32))
        size = np.diff(np.append(np.flatnonzero(head == np.arange(n)), n))
        tied = np.flatnonzero(np.repeat(size, size) > 1)
        if not len(tied):
            break
        at = sa[tied]
        after = np.where(left[at] > width, rank[np.minimum(at + width, n - 1)] + 1, 0)
        order = np.argsort(head[tied] * (n + 1) + after, kind="stable")
        sa[tied] = at[order]
        key = (head[tied] * (n + 1) + after)[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        head = head.copy()
        head[tied] = tied[np.repeat(first, np.diff(np.append(first, len(key))))]
        width *= 2
    lcp = np.zeros(n, np.int64)
    pair = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    a, b, got = sa[pair - 1], sa[pair], np.zeros(len(pair), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (left[a] > got) & (left[b] > got)
        x, y = np.minimum(a + got, n - 1), np.minimum(b + got, n - 1)
        got += np.where(inside & (levels[k][x] == levels[k][y]), 1 << k, 0)
    lcp[pair] = got
    return sa, lcp


def _heads(keys: np.ndarray) -> np.ndarray:
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return np.repeat(first, np.diff(np.append(first, len(keys))))


def longest_repeats(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each word, the longest run of words from it that stands elsewhere in its text too."""
    sa, lcp = suffix_array(codes, bounds)
    longest = np.zeros(len(codes), np.int64)
    longest[sa] = np.maximum(lcp, np.append(lcp[1:], 0))
    return longest


def covered(longest: np.ndarray, bounds: np.ndarray, least: int, spans: int | None = None) -> np.ndarray:
    """Words of each text in the union of the repeats of at least `least` words (each cut to `spans` if given)."""
    at = np.flatnonzero(longest >= least)
    edge = np.zeros(len(longest) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + (longest[at] if spans is None else spans), -1)
    return per_text(np.cumsum(edge[:-1]) > 0, bounds)


def _byte_counts(texts: pa.Array, wanted: np.ndarray) -> np.ndarray:
    bounds, data = rebased(texts)
    return per_text(wanted[data], bounds, np.int64)


def _duplicate_lines(texts: pa.Array) -> np.ndarray:
    lines = pc.split_pattern(texts, "\n")
    offsets = lines.offsets.to_numpy() - lines.offsets[0].as_py()
    encoded = lines.flatten().dictionary_encode()
    worded = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(encoded.dictionary)), 0).to_numpy(zero_copy_only=False)
    codes = encoded.indices.to_numpy()
    if not len(codes):
        return np.zeros(len(texts), np.int64)
    key = owner(offsets) * len(worded) + codes
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return per_text(again & worded[codes], offsets)


def _rules(batches: Iterator[pa.RecordBatch], repeat_words: int, most_share: float, most_longest: int) -> Iterator[pa.RecordBatch]:
    symbol = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
    point = ~np.isin(np.arange(256), np.frombuffer(BLANKS, np.uint8)) & ((np.arange(256) & 0xC0) != 0x80)
    for whole in batches:
        for batch in slices(whole, "text", 2 << 20):
            texts = texts_of(batch)
            codes, bounds, _ = word_codes(texts)
            longest = longest_repeats(codes, bounds)
            n = np.diff(bounds)
            in_windows = covered(longest, bounds, 3, 3)
            in_repeats = covered(longest, bounds, repeat_words)
            top = np.zeros(len(n), np.int64)
            np.maximum.at(top, owner(bounds), longest)
            share = in_repeats / np.maximum(n, 1)
            failed = (n < 50) | (100 * in_windows > 50 * n)
            columns = {
                "doc_id": batch.column("doc_id"), "n_words": n, "word_chars": _byte_counts(texts, point), "n_symbols": _byte_counts(texts, symbol), "n_dup_lines": _duplicate_lines(texts), "n_repeat_words": in_windows, "base_failed": failed,
                "kept": ~failed & (share <= most_share) & (top <= most_longest), "covered_share": share, "longest_repeat": top,
            }
            yield pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def repetition_rules(docs: DataFrame, repeat_words: int = 8, most_share: float = 0.3, most_longest: int = 100) -> DataFrame:
    """Counts and verdict of every document, one row each.

    Words stand between ASCII blanks of the whole text (null: none). A suffix array over the words
    of each text and its longest-common-prefix intervals give the maximal repeated word runs;
    n_repeat_words is the union of all repeated 3-word windows, covered_share that of the runs of
    at least `repeat_words` words over all words, longest_repeat the longest run found twice.
    base_failed: under 50 words or over half of them in repeated windows. kept: not base_failed, and
    covered_share and longest_repeat within their limits. word_chars counts code points in words,
    n_symbols the characters #*$%&|<>, n_dup_lines lines with a word that equal an earlier line.

    Each row is judged alone: null or repeated doc_id and repeated rows stay as they are, other
    columns are ignored, an empty table gives no rows, a text without words is not kept. No shuffle;
    memory follows the longest text, or 6 MB of text where that is more.
    """
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, covered_share double, longest_repeat long"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(lambda it: _rules(it, repeat_words, most_share, most_longest), schema)


def op2_repetition(spark, sf_dir: str) -> DataFrame:
    return repetition_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
