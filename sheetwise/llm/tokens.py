"""Token ids of whole texts under a public tokenizer that never joins characters across blanks."""

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import gather, rebased, word_codes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
WORD_BPE = "word_bpe_49k.json"
#: Words made of these letters alone (ASCII and Latin-1) are one piece in any normal form and have one lower case.
PIECE = r"[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+"


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Merges:
    """Byte-pair merges of many words at once.

    Every round merges, in each word that still has a pair, the pair of least rank (the leftmost
    of equals), as the tokenizer does word by word.
    """

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        signs = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
        shown = {b: chr(b) for b in signs} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in signs)}
        self.inner = np.array([vocab[shown[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[shown[b] + suffix] for b in range(256)], np.int64)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        self.width = max(vocab.values()) + 1
        key = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.bits = 20
        self.slot_key, self.slot_rank = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, len(pairs), np.int64)
        left = np.arange(len(key))
        probe = self._slot(key)
        while len(left):  # open addressing, all keys a step at a time
            free = self.slot_key[probe[left]] < 0
            self.slot_key[probe[left[free]]] = key[left[free]]
            won = self.slot_key[probe[left]] == key[left]
            self.slot_rank[probe[left[won]]] = left[won]
            left = left[~won]
            probe[left] = (probe[left] + 1) & ((1 << self.bits) - 1)
        self.none = len(pairs)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, key: np.ndarray) -> np.ndarray:
        slot = self._slot(key)
        out, todo = np.full(len(key), self.none, np.int64), np.arange(len(key))
        while len(todo):
            held = self.slot_key[slot[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self.slot_rank[slot[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        return out

    def apply(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces and how many each has; no piece is empty."""
        bounds, data = rebased(pieces)
        size = np.diff(bounds)
        symbols = self.inner[data]
        symbols[bounds[1:] - 1] = self.final[data[bounds[1:] - 1]]
        done = np.zeros(len(size), bool)
        out = np.empty(len(symbols), np.int64)
        count = size.copy()
        word, place = np.repeat(np.arange(len(size)), size), bounds[:-1].copy()
        pair_rank = np.full(len(symbols), self.none)
        inside = np.flatnonzero(word[1:] == word[:-1])
        pair_rank[inside] = self.rank(symbols[inside] * self.width + symbols[inside + 1])
        while len(symbols):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            names = word[first]
            least = np.minimum.reduceat(pair_rank, first)
            length = np.diff(np.append(first, len(word)))
            over = least == self.none
            if over.any():  # words without a pair left go out
                done[names[over]] = True
                count[names[over]] = length[over]
                at = gather(first[over], length[over])
                out[gather(place[names[over]], length[over])] = symbols[at]
                keep = np.repeat(~over, length)
                symbols, word, pair_rank, least = symbols[keep], word[keep], pair_rank[keep], least[~over]
                if not len(symbols):
                    break
                first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                length = np.diff(np.append(first, len(word)))
            hits = np.flatnonzero(pair_rank == np.repeat(least, length))
            at = hits[np.append(True, word[hits[1:]] != word[hits[:-1]])]
            symbols[at] = self.result[least]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            new = at - np.arange(len(at))  # places after the removals
            symbols, word, pair_rank = symbols[keep], word[keep], pair_rank[keep]
            for side in (new - 1, new):
                side = side[(side >= 0) & (side < len(symbols))]
                pair = side[np.where(side + 1 < len(symbols), word[np.minimum(side + 1, len(symbols) - 1)] == word[side], False)]
                pair_rank[side] = self.none
                pair_rank[pair] = self.rank(symbols[pair] * self.width + symbols[pair + 1])
        return out[gather(place, count)], count


class WordTokenizer:
    """Encodes each distinct word of a batch once.

    Right only for tokenizers whose normaliser and pre-tokenizer split at every ASCII blank and
    look at nothing across it, as the word-end vocabulary does. Words of plain letters are merged
    here, many at a time; all others go through the tokenizer itself. The tests compare both with
    the tokenizer on whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.merges = Merges(json.load(f)["model"])

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each has."""
        body = pc.replace_substring_regex(words, r"[.,;:!?]+$", "")
        tail = pc.utf8_slice_codeunits(words, -1)
        cut = pc.subtract(pc.utf8_length(words), pc.utf8_length(body)).to_numpy(zero_copy_only=False)
        easy = pc.match_substring_regex(body, f"^{PIECE}$").to_numpy(zero_copy_only=False) & (cut <= 1)
        pieces = pc.dictionary_encode(pc.utf8_lower(body.filter(pa.array(easy))))
        size = np.zeros(len(words), np.int64)
        plain_ids, plain_size = self.merges.apply(pieces.dictionary) if len(pieces) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        plain_start = np.cumsum(plain_size) - plain_size
        rest = np.flatnonzero(~easy)
        hard = [e.ids for e in self.tokenizer.encode_batch_fast(words.take(pa.array(rest)).to_pylist(), add_special_tokens=False)]
        index = pieces.indices.to_numpy()
        signed = (cut > 0) & easy
        at_easy = np.flatnonzero(easy)
        size[at_easy] = plain_size[index] + signed[at_easy]
        size[rest] = [len(x) for x in hard]
        start = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()), np.uint32)
        flat[gather(start[at_easy], plain_size[index])] = plain_ids[gather(plain_start[index], plain_size[index])]
        if signed.any():
            marks = np.frombuffer("".join(tail.filter(pa.array(signed)).to_pylist()).encode("ascii"), np.uint8)
            flat[(start + size)[signed] - 1] = self.merges.final[marks]
        if len(rest):
            flat[gather(start[rest], size[rest])] = np.fromiter((i for x in hard for i in x), np.uint32)
        return flat, size

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """ids (uint32) of all texts, their bounds, then codes, bounds and dictionary of the words. `end` is put after each text."""
        codes, bounds, words = word_codes(texts)
        flat, sizes = self.words(words)
        with_end, ends = codes, bounds
        if end is not None:
            flat, sizes = np.append(flat, np.uint32(end)), np.append(sizes, 1)
            with_end, ends = np.insert(codes, bounds[1:], len(words)), bounds + np.arange(len(bounds))
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[with_end]
        token_bounds = np.concatenate([[0], np.cumsum(lengths)])[ends]
        return flat[gather(starts[with_end], lengths)], token_bounds, codes, bounds, words
