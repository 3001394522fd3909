import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sheetwise.llm import jaccard, language, licenses, lm, mixing, ogg, packing, repetition, shared, substrings, warc
from sheetwise.llm.tokens import tokenizer_path

from .corpus import CLASH, empty, frame, rows, words


def key(r):
    return tuple((x is None, x) for x in r)


def collected(df):
    return sorted(map(tuple, df.collect()), key=key)


# licenses ----------------------------------------------------------------------------------------


def license_brute(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at, labels, base, score = [], set(), set(), 0.0
    for t in licenses.TEMPLATES:
        tw, must = t.words, t.must
        for start in range(-len(tw), len(w) + len(tw)):
            hit = [0 <= start + k < len(w) and w[start + k] == x for k, x in enumerate(tw)]
            if all(h for h, m in zip(hit, must) if m) and 10 * sum(hit) >= licenses.TENTHS * len(tw):
                labels.add(t.label)
                score = max(score, sum(hit) / len(tw))
                if t.base:
                    at.append(start)
                    base.add(t.label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def test_licenses(spark):
    whole = {x.label: " ".join(y.text for y in licenses.TEMPLATES if y.label == x.label) for x in licenses.TEMPLATES}
    rng, more = np.random.default_rng(4), []
    for i, text in enumerate(whole.values()):
        w = text.split(" ")
        for k in rng.integers(0, len(w), len(w) // 8):
            w[k] = "otherwise"
        more += [(500 + 2 * i, f"(C) 2020 Someone. {text}"), (501 + 2 * i, " ".join(w))]
    data = rows() + [(*m, None, None, 0, *range(len(CLASH))) for m in [*more, (900, "cc by cc by by cc, CC-BY all rights rights reserved " * 3)]]
    got = collected(licenses.scan_licenses(frame(spark, data)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))
    assert got == sorted(((r[0], *license_brute(r[1])) for r in data), key=key)
    named = {r[0]: r[6].split(",") for r in got if r[0] is not None}
    assert all(label in named[500 + 2 * i] for i, label in enumerate(whole))
    assert next(r for r in got if r[0] == 39)[2] == 4
    assert licenses.scan_licenses(empty(spark)).count() == 0


# repetition --------------------------------------------------------------------------------------


def repetition_brute(text):
    w = words(text)
    n = len(w)

    def cover(k, spans):
        seen, mark = Counter(tuple(w[i : i + k]) for i in range(n - k + 1)), set()
        for i in range(n - k + 1):
            if seen[tuple(w[i : i + k])] > 1:
                mark.update(range(i, i + k))
        return len(mark)

    longest, k = 0, 1
    while n - k + 1 > 0 and max(Counter(tuple(w[i : i + k]) for i in range(n - k + 1)).values()) > 1:
        longest, k = k, k + 1
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    in3, in8 = cover(3, None), cover(8, None)
    failed = n < 50 or 100 * in3 > 50 * n
    share = in8 / max(n, 1)
    return n, sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), dup, in3, failed, not failed and share <= 0.3 and longest <= 100, share, longest


def test_repetition(spark):
    data = [r for r in rows() if r[0] != 38] + [(200, "a\nb x\n\nb x\n b x\nb x", None, None, 0, *range(len(CLASH)))]
    got = collected(repetition.repetition_rules(frame(spark, data)))
    assert got == sorted(((r[0], *repetition_brute(r[1])) for r in data), key=key)
    assert repetition.repetition_rules(empty(spark)).count() == 0


# mixing ------------------------------------------------------------------------------------------


def test_targets():
    assert mixing.source_targets({"a": 100, "b": 100, None: 100}) == {"a": 50, "b": 100, None: 150}
    capped = mixing.source_targets({"a": 10, "b": 1000, "c": 10})
    assert capped["c"] == 30 and capped["a"] == 30 and capped["b"] == 960
    assert mixing.source_targets({"a": 0, "b": 7}) == {"a": 0, "b": 7} and mixing.source_targets({}) == {}


def test_pivotal_keeps_words_and_means():
    rng = np.random.default_rng(1)
    size, total = rng.integers(1, 50, 40), np.zeros(40)
    p = rng.random(40)
    for _ in range(3000):
        q = mixing.pivotal(p, size, rng.random(40))
        assert abs((q * size).sum() - (p * size).sum()) < 1e-6 and ((q > 0) & (q < 1)).sum() <= 1
        total += q
    assert np.abs(total / 3000 - p).max() < 0.06


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 4)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    docs = frame(spark)
    got = mixing.mixed_copies(docs).collect()
    assert len(got) == docs.count()
    assert sorted(r["size"] for r in got) == sorted(len(words(r[1])) for r in rows())
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
        assert 0 <= r["copies"] <= 3
    wanted = mixing.source_targets({s: sum(r["size"] for r in x) for s, x in by.items()})
    for s, x in by.items():
        assert {r["target"] for r in x} == {wanted[s]}
        assert abs(sum(r["size"] * r["copies"] for r in x) - wanted[s]) <= max(r["size"] for r in x)
    again = mixing.mixed_copies(docs.repartition(3)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, again), key=key)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)
    assert mixing.mix_documents(empty(spark)).count() == 0


# language models ---------------------------------------------------------------------------------


def test_cross_entropy_difference(spark):
    """Against models that are counted anew for each document, without it."""
    tok = Tokenizer.from_file(tokenizer_path())
    data = [r for r in rows() if r[0] != 38] + [(300, " ".join(f"w{k % 700}" for k in range(3000)), None, None, 0, *range(len(CLASH)))]
    texts = [tok.encode(r[1] or "", add_special_tokens=False).ids for r in data]
    good = {1, 2, 3, 5, 7, 300}
    pairs_of = lambda ids: Counter(zip([None, *ids[:-1]], ids))
    every, aimed = Counter(), Counter()
    for r, ids in zip(data, texts, strict=True):
        every.update(pairs_of(ids))
        if r[0] in good:
            aimed.update(pairs_of(ids))
    size, rate = len({b for _, b in every}), sum(aimed.values()) / sum(every.values())

    def loss(pairs, ids, rate):
        history, kinds, word = Counter(), Counter(), Counter()
        for (a, b), n in pairs.items():
            history[a] += rate * n
            kinds[a] += 1 - (1 - rate) ** n
            word[b] += n
        some = sum(1 - (1 - rate) ** n for n in word.values())
        total, s = rate * sum(word.values()), 0.0
        for a, b in zip([None, *ids[:-1]], ids):
            low = (rate * word[b] + some / size) / (total + some) if total else 1 / size
            s -= np.log((rate * pairs[a, b] + kinds[a] * low) / (history[a] + kinds[a]) if history[a] else low)
        return s / max(len(ids), 1)

    without = lambda counts, ids: Counter({k: n for k, n in (counts - pairs_of(ids)).items() if n})
    labels = spark.createDataFrame([(i,) for i in [*good, 1, None]], "doc_id long")
    got = collected(lm.cross_entropy_difference(frame(spark, data), labels))
    want = sorted(((r[0], len(i), loss(without(aimed, i) if r[0] in good else aimed, i, 1.0), loss(without(every, i), i, rate), r[0] in good) for r, i in zip(data, texts, strict=True)), key=key)
    assert [(g[0], g[1], g[4]) for g in got] == [(w[0], w[1], w[4]) for w in want]
    np.testing.assert_allclose(sorted(g[2] for g in got), sorted(w[2] for w in want), rtol=1e-9)
    np.testing.assert_allclose(sorted(g[3] for g in got), sorted(w[3] for w in want), rtol=1e-9)
    none = lm.cross_entropy_difference(frame(spark, data), labels.where("false")).where("n_tokens > 0").select(F.min("target_loss"), F.max("target_loss")).first()
    assert none[0] == pytest.approx(np.log(size)) and none[1] == pytest.approx(np.log(size))
    assert lm.cross_entropy_difference(empty(spark), labels).count() == 0


def test_scores_of_documents_outside_the_target(spark):
    """Good documents that are not in the target stand below bad ones, and not above those that are in it."""
    rng = np.random.default_rng(2)
    draw = lambda lo, hi: " ".join(f"w{min(int(x), hi - 1)}" for x in lo + rng.zipf(1.4, 150) % (hi - lo))
    data = [(i, draw(0, 600) if i % 2 else draw(300, 900)) for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in lm.cross_entropy_difference(docs, docs.where("doc_id % 4 = 1")).collect()}
    inside, outside, bad = ([s for i, s in got.items() if f(i)] for f in (lambda i: i % 4 == 1, lambda i: i % 4 == 3, lambda i: i % 2 == 0))
    below = lambda a, b: np.mean([x < y for x in a for y in b])
    assert below(outside, bad) > 0.95 and 0.35 < below(inside, outside) < 0.65


# packing -----------------------------------------------------------------------------------------


def test_hilbert_neighbours_differ_by_one_step():
    side = 8
    points = np.stack(np.meshgrid(*[np.arange(side)] * 3), axis=-1).reshape(-1, 3)
    keys = packing.hilbert_key(points, 3)
    assert sorted(keys) == list(range(side**3))
    walk = points[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_packing(spark):
    tok = Tokenizer.from_file(tokenizer_path())
    data = rows()
    want = Counter((r[0], zlib.crc32(np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4").tobytes())) for r in data)
    pieces = packing.pack_documents(frame(spark)).collect()
    by_sequence, streams = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append(p)
        assert len(p["ids"]) == 4 * p["length"] and zlib.crc32(p["ids"]) == p["ids_crc32"]
        streams[p["doc_id"]].append(p)
    last = max(by_sequence)
    for s, x in by_sequence.items():
        at = 0
        for p in sorted(x, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == 4096 or s == last
    order = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
    found, now = Counter(), b""
    for p in order:  # a document's pieces stand one after another
        assert p["start"] * 4 == len(now)
        now += p["ids"]
        if len(now) == 4 * p["doc_tokens"]:
            found[p["doc_id"], zlib.crc32(now)] += 1
            now = b""
    assert found == want and now == b""
    again = packing.pack_documents(frame(spark).repartition(5), with_ids=False).collect()
    assert sorted(map(tuple, again), key=key) == sorted((tuple(p)[:7] for p in pieces), key=key)
    assert packing.pack_documents(empty(spark)).count() == 0


# Jaccard -----------------------------------------------------------------------------------------


def shingles(text, n):
    w = words(text, lower=True)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def classes_brute(data, n, percent):
    sets = [shingles(r[1], n) for r in data]
    parent = list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, r in enumerate(data):
        least[root(i)].append(r[0])
    return [(r[0], len(sets[i]), min((x for x in least[root(i)] if x is not None), default=None) if sets[i] else r[0]) for i, r in enumerate(data)]


@pytest.mark.parametrize("n, percent, short, block", [(3, 90, 8, 256), (3, 90, 2, 2), (5, 80, 3, 3)])
def test_near_duplicates(spark, monkeypatch, n, percent, short, block):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    got = jaccard.near_duplicate_classes(frame(spark), n, percent)
    assert collected(got.select("doc_id", "n_shingles", "component_id")) == sorted(classes_brute(rows(), n, percent), key=key)
    kept = jaccard.keep_one_of_each(frame(spark), got)
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == frame(spark).columns and {0, 1, 2, 3, 100, 101, 102, 103, None} <= ids and not {4, 6} & ids
    assert len([r for r in kept.collect() if r["doc_id"] == 7]) == 1


def test_random_sets_lose_no_link(spark):
    rng = np.random.default_rng(3)
    data = []
    for g in range(30):
        base = [f"w{x}" for x in rng.integers(0, 400, rng.integers(12, 120))]
        for _ in range(rng.integers(1, 14)):
            w = list(base)
            for _ in range(rng.integers(0, 4)):
                w[rng.integers(0, len(w))] = f"v{rng.integers(0, 50)}"
            data.append((len(data), " ".join(w), None, None, 0, *range(len(CLASH))))
    got = jaccard.near_duplicate_classes(frame(spark, data), 3, 80).select("doc_id", "n_shingles", "component_id")
    assert collected(got) == sorted(classes_brute(data, 3, 80), key=key)


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_no_table_of_jaccard_goes_through_the_driver(spark, monkeypatch, n, percent):
    monkeypatch.setattr(jaccard, "SHORT", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    seen, put = [], shared.Scratch.put

    def noted(self, df, name, settings=None):
        out = put(self, df, name, settings)
        store = spark._jsparkSession.sharedState().statusStore()
        ran = store.executionsList()
        seen.append(max((ran.apply(i) for i in range(ran.size())), key=lambda e: e.executionId()).physicalPlanDescription())
        return out

    monkeypatch.setattr(shared.Scratch, "put", noted)
    got = jaccard.near_duplicate_classes(frame(spark), n, percent)
    assert len(seen) > 10 and any("SortMergeJoin" in p for p in seen)
    assert not [p for p in [*seen, got._jdf.queryExecution().executedPlan().toString()] if "Broadcast" in p]


def test_jaccard_of_nothing(spark):
    assert jaccard.near_duplicate_classes(empty(spark)).count() == 0


# media -------------------------------------------------------------------------------------------


def slow_checksum(page):
    crc = 0
    for b in page:
        crc ^= b << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


def test_ogg(spark):
    got = {(r["doc_id"], r["payload"]): r for r in ogg.read_ogg(ogg.store_ogg(frame(spark))).collect()}
    for r in rows():
        data = (r[1] or "").encode()
        payload = data + b" " * (max(192, -(-len(data) // 192) * 192) - len(data))
        x = got[r[0], payload]
        media = ogg.encode(payload)
        assert (x["n_bytes"], x["payload_bytes"], x["payload_sha256"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest())
        assert (x["tail_crc32"], x["media_bytes"], x["media_sha256"]) == (zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest())
    assert ogg.read_ogg(ogg.store_ogg(empty(spark))).count() == 0


def test_ogg_pages():
    payload = bytes(range(256)) * 300  # several pages
    media = ogg.encode(payload)
    at, n = 0, 0
    while at < len(media):
        size = 27 + media[at + 26] + sum(media[at + 27 : at + 27 + media[at + 26]])
        page = media[at : at + size]
        assert page[:4] == b"OggS" and slow_checksum(page[:22] + b"\0\0\0\0" + page[26:]) == struct.unpack_from("<I", page, 22)[0]
        at, n = at + size, n + 1
    assert n == 5 and ogg.decode(media)[0] == payload
    bad = bytearray(media)
    bad[len(bad) // 2] ^= 1
    streams, lost = ogg.read_streams(bytes(bad))
    assert lost > 0 and len(streams) == 2
    long = ogg.write_pages([(b"head", 0), (b"x" * 255 * 300, 5), (b"y" * 255, 9), (b"", 9)], 1)
    streams, lost = ogg.read_streams(b"".join(long))
    assert [len(p) for p in streams[1]["packets"]] == [4, 255 * 300, 255, 0] and lost == 0 and streams[1]["granules"] == [0, 9]


# WARC --------------------------------------------------------------------------------------------

PAGES = [(3, "u3", "same"), (1, "u1", "same"), (2, "u2", None), (5, None, ""), (4, "u\r\n4", "Ünï\n\n\r\n\r\nWARC/1.1\r\n"), (6, "u6", "same"), (6, "u6", "same"), (None, "n", "same"), (7, "u7", "x" * 100_000)]


def test_warc(spark):
    pages = spark.createDataFrame([(*p, "c") for p in PAGES], "page_id long, url string, html string, digest string")
    archives = warc.write_warc(pages).cache()
    got = collected(warc.read_warc(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        first = min(p for p, _, h in PAGES if p is not None and (h or "") == (html or ""))
        again = i is None or i != first
        want.append((i, len(data), warc.base32(hashlib.sha1(data).digest()), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=key)
    assert warc.quarantined(archives).count() == 0
    assert warc.read_warc(warc.write_warc(pages, least=5), False).where("record_type = 'revisit'").count() == 0
    assert warc.read_warc(warc.write_warc(pages.where("false"))).count() == 0


def test_salvage():
    records = [warc.record(i, "u", bytes([65 + i]) * 50, None, False) for i in range(4)]
    plain = records[0] + b"junk WARC/1.1\r\nbroken" + records[1] + records[2][:60] + records[3]
    found = warc.salvage(plain)
    assert [r[2][:1] for r in found.records] == [b"A", b"B", b"D"] and [plain[a:b] for a, b, _ in found.gaps] == [b"junk WARC/1.1\r\nbroken", records[2][:60]]
    members = [warc.member(r) for r in records]
    hurt = bytearray(b"".join(members))
    hurt[len(members[0]) + 30] ^= 255
    found = warc.salvage(bytes(hurt))
    assert [r[2][:1] for r in found.records] == [b"A", b"C", b"D"] and found.gaps[0][:2] == (len(members[0]), len(members[0]) + len(members[1]))
    cut = warc.salvage(b"".join(members)[:-5])
    assert len(cut.records) == 3 and cut.gaps[-1][1] == len(b"".join(members)) - 5
    assert warc.salvage(b"").records == [] and warc.salvage(b"abc").gaps == [(0, 3, "no record starts here")]
    altered = records[1].replace(b"B" * 50, b"B" * 49 + b"C")
    assert warc.salvage(altered).gaps[0][2] == "block digest differs"


def test_salvage_of_other_writers():
    import gzip

    one, two = (warc.record(k, f"http://x/{k}", b"body %d" % k, None, False) for k in (1, 2))
    lists = one.replace(b"WARC-Date:", b"WARC-Concurrent-To: <urn:a>\r\nWARC-Concurrent-To: <urn:b>\r\nX-Note: folded\r\n\tline\r\nWARC-Date:")
    for data in (lists + two, gzip.compress(lists + two), warc.member(lists) + warc.member(two)):
        found = warc.salvage(data)
        assert [r[2] for r in found.records] == [b"body 1", b"body 2"] and not found.gaps
        assert found.records[0][1]["warc-concurrent-to"] == "<urn:a>, <urn:b>" and found.records[0][1]["x-note"] == "folded line"
    part = gzip.compress(one + b"junk" + two)
    found = warc.salvage(part + warc.member(two))
    assert [r[0] for r in found.records] == [0, 0, len(part)] and found.gaps == [(0, len(part), "no record starts here")]
    assert warc.salvage(one.replace(b"WARC-Date:", b"WARC-Date: 1\r\nWARC-Date:")).gaps[0][2] == "headers run into others"


# links --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("short, block", [(8, 256), (1, 3), (3, 4)])
def test_jaccard_counts_all_links(spark, monkeypatch, short, block):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    data = rows()
    sets = []
    for r in data:
        w = words(r[1], lower=True)
        sets.append({tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set())
    want = [(r[0], sum(i != j and 10 * len(a & b) >= 8 * len(a | b) > 0 for j, b in enumerate(sets))) for i, (r, a) in enumerate(zip(data, sets, strict=True))]
    got = collected(jaccard.near_duplicate_classes(frame(spark), 5, 80).select("doc_id", "n_links"))
    assert got == sorted(want, key=key) and max(n for _, n in want) > 5


# passages ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("group", [4096, 2])
def test_repeated_passages(spark, monkeypatch, group):
    monkeypatch.setattr(substrings, "GROUP", group)
    data = rows()
    unique = {(r[0], r[1]) for r in data}
    windows = defaultdict(list)
    for i, t in unique:
        w = words(t)
        for s in range(len(w) - 49):
            windows[tuple(w[s : s + 50])].append(((i is None, i), t, s))
    cover, again, first = defaultdict(set), defaultdict(set), defaultdict(set)
    for places in windows.values():
        if len(places) > 1:
            for place in places:
                k = (place[0][1], place[1])
                span = range(place[2], place[2] + 50)
                cover[k].update(span)
                (first if place == min(places) else again)[k].update(span)
    got = substrings.repeated_passages(frame(spark))
    text = {r[0]: (r[1], r[2]) for r in frame(spark).select(shared.row_key(frame(spark)), "doc_id", "text").collect()}
    spans, removed = {}, {}
    for r in got.collect():
        k = text[r["row_hash"]]
        spans[k] = {w for s in r["spans"] for w in range(s["start"], s["start"] + s["words"])}
        removed[k] = {w for s in r["removed"] for w in range(s["start"], s["start"] + s["words"])}
    assert spans == dict(cover)
    assert removed == {k: again[k] - first[k] for k in cover}
    left = substrings.remove_passages(frame(spark), got)
    assert left.columns == frame(spark).columns
    texts = {(r["doc_id"], len(words(r["text"]))) for r in left.collect()}
    for r in data:
        n = len(words(r[1])) - len(removed.get((r[0], r[1]), ()))
        assert (r[0], n) in texts or n == 0
    assert substrings.repeated_passages(empty(spark)).count() == 0


@pytest.mark.parametrize("group", [4096, 2])
def test_passages_name_all_partners(spark, monkeypatch, tmp_path, group):
    monkeypatch.setattr(substrings, "GROUP", group)
    make = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    p1, p2, p3, p4 = (make(f"p{k}x", 60 + k) for k in range(4))
    data = [(2, f"{p1} {make('a', 20)}"), (5, f"{make('b', 10)} {p2}"), (9, f"{p1} {make('c', 30)} {p2}"), (11, f"{p1} {p2}"), (7, f"{make('h', 3)} {p1}"), (8, f"{p2} {make('i', 3)}"), (None, f"{p3} {make('d', 9)} {p3}"), (12, f"{p4} {make('e', 7)} {p1}"), (None, f"{make('f', 5)} {p4}"), (13, make("g", 80)), ((1 << 63) - 1, f"{p4} {make('j', 70)}")]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    windows, least, cover = defaultdict(list), {}, defaultdict(set)
    for i, t in data:
        w = words(t)
        for s in range(len(w) - 49):
            windows[tuple(w[s : s + 50])].append(((i is None, i), t, s))
    for places in windows.values():
        for (_, i), t, s in places if len(places) > 1 else ():
            least[i, t, s] = min(places)[0][1]
            cover[i, t].update(range(s, s + 50))
    want = []
    for (i, t), at in cover.items():
        for a in sorted(x for x in at if x - 1 not in at):
            b = next(x for x in range(a, 1000) if x not in at)
            want.append((i, a, b - a, tuple(sorted({least[i, t, s] for s in range(a, b - 49) if (i, t, s) in least}, key=lambda x: (x is None, x)))))
    got = substrings.op9_passages(spark, str(tmp_path)).collect()
    assert sorted(((r["doc_id"], r["start_word"], r["n_words"], tuple(r["match_doc_ids"])) for r in got), key=repr) == sorted(want, key=repr)
    by = {(r["doc_id"], r["start_word"]): r["match_doc_ids"] for r in got}
    assert by[9, 0] == [2] and by[9, 90] == [5] and by[11, 0] == [2, 5] and by[None, 0] == [None]


def test_windows_are_told_apart_by_sorted_suffixes():
    rng = np.random.default_rng(6)
    least, among, n = 6, 4, 60
    around = rng.integers(0, 2, (n, among - 1 + least)).astype(np.uint32)
    group = np.sort(rng.integers(0, 3, n))
    of, k = np.nonzero(rng.random((n, among)) < 0.8)
    number = substrings.window_classes(around, group, of, k, least, among)
    window = [(group[i], s, tuple(around[i, s : s + least])) for i, s in zip(of, k, strict=True)]
    assert all((number[i] == number[j]) == (window[i] == window[j]) for i in range(len(of)) for j in range(i))
    order, common = substrings.sorted_runs(around, group)
    for x, y, c in zip(order, order[1:], common[1:], strict=False):
        assert (group[x], *around[x]) <= (group[y], *around[y])
        assert c == (-1 if group[x] != group[y] else next((i for i in range(around.shape[1]) if around[x, i] != around[y, i]), around.shape[1]))


@pytest.mark.parametrize("group", [4096, 3])
def test_passages_longer_than_a_context(spark, monkeypatch, group):
    """Matches go on over many retained places, and inside one document that repeats them."""
    monkeypatch.setattr(substrings, "GROUP", group)
    make = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    long, short = make("p", 700), make("q", 51)
    data = [(1, f"{make('a', 30)} {long} {make('b', 20)}"), (2, f"{long}\n{make('c', 9)}"), (3, " ".join([short] * 12)), (4, f"{make('d', 70)} {short}"), (5, make("p", 49))]
    found = {r["doc_id"]: r for r in substrings.repeated_passages(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    span = lambda i, c="spans": [(x["start"], x["words"]) for x in found[i][c]]
    assert set(found) == {1, 2, 3, 4}
    assert span(1) == [(30, 700)] and span(2) == [(0, 700)] and span(3) == [(0, 612)] and span(4) == [(70, 51)]
    assert span(1, "removed") == [] and span(2, "removed") == [(0, 700)] and span(4, "removed") == [(70, 51)]
    # the first 50 windows of the first copy stand first, and windows over two copies too
    assert span(3, "removed") == [(100, 512)]


# language ----------------------------------------------------------------------------------------


def test_language(spark):
    docs = frame(spark)
    models = language.learned(docs)
    got = language.identify_languages(docs, models).collect()
    assert len(got) == len(rows())
    by = {(r["doc_id"], r["languages"]): r for r in got}
    for r in got:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (100, 101, 102, 104):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None and r["doc_id"] < 37:
            assert r["lang_pred"] == next(x[2] for x in rows() if x[0] == r["doc_id"]) or r["doc_id"] in (9, 31, 33, 35)
    assert by
    mixed = spark.createDataFrame([(1, "the water of the house and the river " * 10 + "la lumière de la maison était déjà en été " * 10)], "doc_id long, text string")
    one = language.identify_languages(mixed, models).first()
    assert "en:" in one["languages"] and "fr:" in one["languages"] and one["score"] < 0.8
    assert language.identify_languages(docs, language.learned(empty(spark))).where("lang_pred <> 'und'").count() == 0
    kept = language.accept_languages(docs, models)
    assert kept.columns == docs.columns and not {100, 101, 102, 104} & {r["doc_id"] for r in kept.collect()}
    held = {r[0]: r[1] for r in docs.select("doc_id", language.held_out(docs)).collect()}
    assert all(held[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in held if i is not None)


def language_brute(data):
    """Predictions by dictionaries of trigrams and expectation-maximisation in plain loops."""
    import math

    import regex

    def letters(text):
        out = [regex.sub(r"[^\p{L}\p{M}]+", "", w.decode().lower()) for w in words(text)]
        return [w for w in out if regex.search(r"\p{L}", w)]

    marked = lambda w: "\x02\x02" + w + "\x03"
    grams, langs = defaultdict(Counter), set()
    for i, text, lang in data:
        if lang is not None and i is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            for w in map(marked, letters(text)):
                langs.add(lang)
                grams[lang].update(w[k - 2 : k + 1] for k in range(2, len(w)))
    langs = sorted(langs)
    base = len({c for g in grams.values() for x in g for c in x}) + 1

    def model(counts):
        orders = [Counter(), Counter(), counts]
        for g, n in counts.items():
            orders[0][g[2]] += n
            orders[1][g[1:]] += n
        total, kinds = [Counter(), Counter(), Counter()], [Counter(), Counter(), Counter()]
        for k in range(3):
            for g, n in orders[k].items():
                total[k][g[:-1]] += n
                kinds[k][g[:-1]] += 1

        def p(gram):
            low = 1 / base
            for k in range(3):
                g = gram[2 - k :]
                seen = total[k][g[:-1]] + kinds[k][g[:-1]]
                low = (orders[k][g] + kinds[k][g[:-1]] * low) / seen if seen else low
            return low

        return p

    models = [model(grams[x]) for x in langs]

    def share_of(rel, share, steps):
        for _ in range(steps):
            sums = [0.0] * len(langs)
            for r in rel:
                joint = [a * b for a, b in zip(r, share, strict=True)]
                for k, x in enumerate(joint):
                    sums[k] += x / sum(joint)
            share = [x / sum(sums) for x in sums]
        return share

    out = []
    for i, text, _ in data:
        rel = []
        for w in map(marked, letters(text)):
            ll = [sum(math.log(p(w[k - 2 : k + 1])) for k in range(2, len(w))) for p in models]
            rel.append([max(math.exp(x - max(ll)), 1e-12) for x in ll])
        if not rel:
            out.append((i, "und", 0.0))
            continue
        full = share_of(rel, [1 / len(langs)] * len(langs), 8)
        ranked, best, best_score = sorted(range(len(langs)), key=lambda k: -full[k]), None, -math.inf
        for k in range(1, len(langs) + 1):
            start = [max(x, 1e-3) if j in ranked[:k] else 0.0 for j, x in enumerate(full)]
            share = share_of(rel, [x / sum(start) for x in start], 0 if k == 1 else 3)
            score = sum(math.log(sum(a * b for a, b in zip(r, share, strict=True))) for r in rel) - (k - 1) * math.log(len(rel) + 1)
            if score > best_score:
                best, best_score = share, score
        out.append((i, langs[best.index(max(best))], max(best)))
    return out


def test_language_against_brute_force(spark):
    stock = {"de": ["der", "und", "wasser", "haus", "stein", "licht", "größe", "über"], "es": ["el", "agua", "casa", "piedra", "luz", "año", "río", "calle"]}
    rng = np.random.default_rng(8)
    data = [(r[0], r[1], r[2]) for r in rows() if r[0] not in (38, 105)]
    data += [(1000 + k, " ".join(rng.choice(stock[x], 30)), x) for k, x in enumerate(["de", "es"] * 12)]
    data += [(1100 + k, " ".join([*rng.choice(stock["de"], 10 + 3 * k), *rng.choice(stock["es"], 25), *data[0][1].split(" ")[: 9 * (k % 3)]]), None) for k in range(9)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = collected(language.identify_languages(docs, language.learned(docs)).select("doc_id", "lang_pred", "score"))
    want = sorted(language_brute(data), key=key)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    np.testing.assert_allclose([g[2] for g in got], [w[2] for w in want], atol=2e-3)
    assert any(0.3 < w[2] < 0.7 for w in want)


def test_mixture_chooses_by_penalty():
    clear = np.array([[1, 1e-6]] * 30 + [[1e-6, 1]] * 10, np.float32)
    share = language.mixture(np.concatenate([clear, clear[:30]]), np.array([0, 40, 70]))
    np.testing.assert_allclose(share[0], [0.75, 0.25], atol=0.01)
    assert share[1].tolist() == [1, 0]


def test_mixture_judges_each_text_alone():
    # a close relative of the first language gains nothing, the third language much
    close = np.array([[1, 0.95, 1e-6]] * 24 + [[1e-6, 1e-6, 1]] * 6, np.float32)
    other = np.array([[1, 1e-6, 1e-6]] * 20 + [[1e-6, 1, 1e-6]] * 20, np.float32)
    alone = language.mixture(close, np.array([0, 30]))
    beside = language.mixture(np.concatenate([other, close]), np.array([0, 40, 70]))
    assert alone[0, 2] > 0.1
    np.testing.assert_allclose(alone[0], beside[1], atol=1e-6)


# shared tables -----------------------------------------------------------------------------------


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    context = SimpleNamespace(getConf=dict, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(SimpleNamespace(sparkContext=context))


def test_what_was_decided_meets_every_row(spark):
    """Rows that differ in nulls alone are told apart, equal rows are numbered."""
    data = [(1, "a"), (1, "a"), (1, None), (None, "a"), (None, None), (0, None), (2, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    keys = docs.select("doc_id", shared.row_key(docs).alias("row_hash"), "text")
    assert keys.select("row_hash").distinct().count() == 6
    joined, name = shared.beside_rows(docs, shared.row_key(docs), keys.dropDuplicates(["doc_id", "row_hash"]).select("doc_id", "row_hash", F.col("text").alias("other")), "left")
    got = sorted(((r["doc_id"], r["text"], r[name["other"]], r[name["nth"]]) for r in joined.collect()), key=repr)
    assert got == sorted(((i, t, t, 2 if k == 1 else 1) for k, (i, t) in enumerate(data)), key=repr)
