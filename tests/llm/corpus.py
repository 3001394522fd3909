"""A small corpus with every hard case, and brute-force versions to hold the operators against."""

import random
import re

#: Columns beside those of documents, named as the operators name their own.
CLASH = ["score", "row_hash", "key", "copies", "_hash", "_nth", "_id", "_to_id", "_to_hash", "removed", "_removed", "_row", "_copy", "_input_row_hash", "first_id", "taken", "_Taken", "nth", "sid", "n", "part", "words", "bigram", "chunk", "digest", "a.b"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` long" for c in CLASH)
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text: str | None, lower: bool = False) -> list[bytes]:
    data = (text or "").encode()
    return WORD.findall(data.lower() if lower else data)


def rows(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    stock = {"en": ["the", "of", "and", "thing", "other", "water", "stone", "light", "house", "river"], "fr": ["le", "la", "été", "eaux", "maison", "pierre", "lumière", "être", "rue", "déjà"]}
    pool = {k: v + ["".join(rng.choice(v) for _ in range(2)) for _ in range(300)] for k, v in stock.items()}
    make = lambda lang, n: " ".join(rng.choice(pool[lang]) for _ in range(n))
    passage, out = make("en", 70), []
    for i in range(40):
        lang = ["en", "fr"][i % 2]
        out.append([i, make(lang, rng.randint(60, 160)), lang, f"s{i % 3}"])
    out[4][1] = out[2][1]  # an exact copy
    out[6][1] = out[2][1].replace(" ", "\n", 3)  # the same words
    for i in range(10, 24, 2):  # near copies, one word changed each
        w = out[8][1].split(" ")
        w[i] = "changed"
        out[i][1] = " ".join(w)
    for i in (31, 33, 35):
        out[i][1] += " " + passage + " " + make("en", 5)
    out[37][1] = " ".join(["again and again"] * 60)
    out[38][1] = make("en", 20000)  # very long
    out[39][1] = "This work is licensed under the GNU General Public License, CC-BY. All rights reserved. all RIGHTS reserved"
    extra = [
        [100, None, "en", "s0"], [101, "", "fr", None], [102, " \t\n ", None, "s1"], [103, "word", "en", "s1"], [104, "1234 5678 | |", "en", "s2"], [105, "Ünïcode ẞtraße İstanbul ﬁ ½ don't <|endoftext|> naïve-cóoperate x", "en", "s2"],
        [None, make("en", 80), "en", "s1"], [None, make("fr", 80), "fr", None], [7, out[7][1], "fr", "s1"], [7, out[7][1], "fr", "s1"], [9, "another text under the same id", "en", "s0"], [106, "a b c", "en", "\U0001f600"],
    ]
    return [(*r, len(r[1] or ""), *range(len(CLASH))) for r in out + extra]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
