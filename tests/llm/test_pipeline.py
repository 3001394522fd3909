from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from sheetwise.llm.jaccard import near_duplicate_classes
from sheetwise.llm.language import identify_languages, learned

from .corpus import empty, frame, rows, words
from .test_operators import shingles, tokenizer_path
from tokenizers import Tokenizer


def test_stages(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == columns, name
        if k == 0:
            good = {r["doc_id"] for r in identify_languages(before, learned(before)).where("score >= 0.5").collect()}
            assert {r["doc_id"] for r in docs.collect()} == good
        if k == 1:
            classes = near_duplicate_classes(before, 5, 80)
            assert docs.count() == classes.select("first_id", "first_hash", F.when(F.col("n_shingles") == 0, F.monotonically_increasing_id()).alias("alone")).distinct().count()
    assert docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0


def test_run(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    empty(spark).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_near_duplicates_against_brute_force(spark):
    data = rows()
    sets = [shingles(r[1], 5) for r in data]
    label = list(range(len(data)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 10 * len(a & b) >= 8 * len(a | b) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    classes = defaultdict(list)
    for r, c in zip(data, label, strict=True):
        classes[c].append((r[0] is None, r[0], r[1]))
    want = sorted((x[1:] for x in map(min, classes.values())), key=repr)
    got = corpus_pipeline.drop_near_duplicates(spark, frame(spark), "").select("doc_id", "text")
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_passages_against_brute_force(spark):
    data = rows()
    windows, first, again = defaultdict(set), defaultdict(set), defaultdict(set)
    for r in data:
        w = words(r[1])
        for s in range(len(w) - 49):
            windows[tuple(w[s : s + 50])].add((r[0] is None, r[0], r[1], s))
    for places in windows.values():
        for p in places if len(places) > 1 else ():
            (first if p == min(places) else again)[p[1], p[2]].update(range(p[3], p[3] + 50))
    want = []
    for r in data:
        gone = again[r[0], r[1]] - first[r[0], r[1]]
        left = [x for k, x in enumerate(words(r[1])) if k not in gone]
        if left or not gone:
            want.append((r[0], left))
    got = corpus_pipeline.drop_repeated_passages(spark, frame(spark), "").select("doc_id", "text")
    assert sorted(((r["doc_id"], words(r["text"])) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_mixing_against_targets(spark):
    """Each source's words come within a document of the target that shares by hand give, copies differ by one at most between documents of a source, and all columns stay."""
    data = rows()
    size, words_of = defaultdict(int), {}
    for r in data:
        words_of[r[0], r[1], r[3]] = len(words(r[1]))
        size[r[3]] += len(words(r[1]))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    target, free = {}, set(size)
    while free:  # one source a round is set to its cap, the one that is furthest above it
        left = sum(size.values()) - sum(target.values())
        want = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if want[s] > 3 * size[s]]
        if not over:
            target |= want
            break
        s = max(over, key=lambda s: want[s] / max(size[s], 1e-9))
        target[s] = 3 * size[s]
        free.remove(s)
    got = corpus_pipeline.mix_sources(spark, frame(spark), "")
    assert got.columns == frame(spark).columns
    taken, rows_in = Counter(), Counter(tuple(r) for r in data)
    for r in map(tuple, got.collect()):
        taken[r] += 1
    assert set(taken) <= set(rows_in)
    by = defaultdict(int)
    for r, n in taken.items():
        assert n <= 3 * rows_in[r]
        by[r[3]] += n * words_of[r[0], r[1], r[3]]
    for s, t in target.items():
        assert abs(by[s] - t) <= max(w for (_, _, x), w in words_of.items() if x == s), s
        rate = t / size[s] if size[s] else 0
        for r, n in rows_in.items():
            if r[3] == s and words_of[r[0], r[1], s]:
                assert int(rate * n) <= taken[r] <= int(rate * n) + 1


def test_packed_ids_are_the_texts(spark):
    tok = Tokenizer.from_file(tokenizer_path())
    data = rows()
    pieces = corpus_pipeline.pack_sequences(spark, frame(spark), "").collect()
    by, total = defaultdict(list), 0
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] and p["offset"] + p["length"] <= 4096
        by[p["sequence_id"]].append((p["offset"], p["length"]))
        total += p["length"]
    for k, run in by.items():
        run.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(run, run[1:])) and run[0][0] == 0
        assert sum(n for _, n in run) == 4096 or k == max(by)
    want = Counter((r[0], tuple([*tok.encode(r[1] or "", add_special_tokens=False).ids, 2])) for r in data)
    whole = Counter()
    named = defaultdict(list)
    for p in pieces:
        named[p["doc_id"], p["doc_tokens"]].append((p["start"], p["ids"]))
    for (i, n), parts in named.items():
        alike = [x for x in want if x[0] == i and len(x[1]) == n]
        for x in alike:  # every piece is a run of such a text
            whole[x] = sum(len(b) // 4 for s, b in parts if list(x[1][s : s + len(b) // 4]) == [int.from_bytes(b[j : j + 4], "little") for j in range(0, len(b), 4)]) // n
    assert whole == want and total == sum(n * len(x[1]) for x, n in want.items())
