"""Suffix-array, doubling and SimHash deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash, substring_doubling, suffix_dedup
from tessera.llm.runlength_index import RunLengthIndex, suffix_array
from tessera.llm.segments import RangeHash, merge_spans, sliding_min

from odd_data import odd_rows


def ordered(spark, docs):
    """Distinct (id, text) in the order the operators define: NULL ids first, then a hash of the text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("x")).collect()
    return sorted({(r.doc_id, r.x, r.t) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def brute_bytes(rows, window):
    seen, out = set(), {}
    for doc, _, text in rows:
        raw = text.encode()
        hit = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - window + 1):
            g = raw[i:i + window]
            if g in seen:
                hit[i:i + window] = True
            seen.add(g)
        runs = int((np.diff(np.concatenate(([0], hit.astype(int)))) == 1).sum())
        out.setdefault(doc, set()).add((len(raw), int(hit.sum()), runs, hashlib.sha256(
            bytes(b for b, h in zip(raw, hit) if not h)).hexdigest()))
    return out


def brute_words(rows, window):
    first, out = {}, {}
    for n, (doc, _, text) in enumerate(rows):
        words = text.encode().split()
        hit = np.zeros(len(words), dtype=bool)
        for i in range(len(words) - window + 1):
            if first.setdefault(tuple(words[i:i + window]), n) < n:
                hit[i:i + window] = True
        out.setdefault(doc, set()).add((len(words), int(hit.sum()), hashlib.sha256(
            b" ".join(w for w, h in zip(words, hit) if not h)).hexdigest()))
    return out


@pytest.mark.parametrize("pieces", [1 << 14, 1])
def test_byte_dedup_matches_brute_force(spark, odd_docs, pieces):
    # piece_rows=1 sends every anchor with several contents through the cross-piece comparison.
    got = {}
    rows = suffix_dedup.digests(suffix_dedup.dedup_bytes(spark, odd_docs, piece_rows=pieces, chunk_bytes=2000)).collect()
    for r in rows:
        got.setdefault(r.doc_id, set()).add((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    assert got == brute_bytes(ordered(spark, odd_docs), 100)
    assert len(rows) == len(odd_rows())


def test_whole_characters_stay_valid_text(spark, odd_docs):
    for r in suffix_dedup.dedup_bytes(spark, odd_docs, whole_characters=True).collect():
        bytes(r.kept).decode()


def test_word_dedup_matches_brute_force(spark, odd_docs):
    got = {}
    rows = substring_doubling.digests(substring_doubling.dedup_words(spark, odd_docs)).collect()
    for r in rows:
        got.setdefault(r.doc_id, set()).add((r.n_words, r.n_removed, r.kept_sha256))
    assert got == brute_words(ordered(spark, odd_docs), 50)
    assert len(rows) == len(odd_rows())


def test_short_windows_on_repetitive_text(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("ab") * rng.randint(1, 2) for _ in range(60))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: {(r.n_words, r.n_removed, r.kept_sha256)}
           for r in substring_doubling.digests(substring_doubling.dedup_words(spark, docs, window=8)).collect()}
    assert got == brute_words(ordered(spark, docs), 8)
    got = {r.doc_id: {(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)}
           for r in suffix_dedup.digests(suffix_dedup.dedup_bytes(spark, docs, window=20, gram=6)).collect()}
    assert got == brute_bytes(ordered(spark, docs), 20)


def test_dedup_of_an_empty_table(spark, no_docs):
    assert suffix_dedup.dedup_bytes(spark, no_docs).count() == 0
    assert substring_doubling.dedup_words(spark, no_docs).count() == 0
    assert simhash.near_duplicates(spark, no_docs).count() == 0


def test_run_length_index_finds_all_windows():
    rng = np.random.default_rng(3)
    for trial in range(25):
        window, low = int(rng.integers(3, 30)), 0 if trial % 2 else 97
        source = bytes(rng.integers(low, low + 3, 300).astype(np.uint8))

        def piece() -> bytes:
            at = int(rng.integers(0, 200))
            out = bytearray(source[at:at + int(rng.integers(window, 90))])
            out[int(rng.integers(0, len(out)))] = int(rng.integers(0, 100))
            return bytes(out)

        strings, patterns = [piece() for _ in range(12)], [piece() for _ in range(12)] + [b"\xff" + source[:40]]
        wanted = np.array([int(rng.integers(1, 60)) for _ in patterns])
        found = {(p, i): c for p, i, c in zip(*(a.tolist() for a in RunLengthIndex(strings, window).matches(patterns, wanted)))}
        held = {s[i:i + window] for s in strings for i in range(len(s) - window + 1)}
        want = {(p, i): t[i:i + window] for p, t in enumerate(patterns)
                for i in range(min(wanted[p], len(t) - window + 1)) if t[i:i + window] in held}
        assert found.keys() == want.keys()
        assert len({(c, want[at]) for at, c in found.items()}) == len(set(want.values())) == len(set(found.values()))


def test_small_helpers():
    assert suffix_array(np.array([3, 4, 3, 4, 3, 1])).tolist() == [5, 4, 2, 0, 3, 1]
    assert sliding_min(np.array([5, 3, 4, 1, 6, 7]), 3).tolist() == [3, 1, 1, 1]
    assert [a.tolist() for a in merge_spans(np.array([5, 0, 2]), np.array([9, 3, 5]))] == [[0], [9]]
    raw = np.frombuffer(b"abcabcab", dtype=np.uint8)
    h = RangeHash(raw).of(np.array([0, 3, 1]), np.array([3, 6, 4]))
    assert h[0] == h[1] != h[2]


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and bin(a ^ b).count("1") <= bits:
                parent[find(b)] = find(a)
    return {p: find(p) for p in prints}


def test_simhash_matches_brute_force(spark, odd_docs):
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(spark, odd_docs).collect())
    prints = [(d, brute_fingerprint(t or "")) for d, t in odd_rows()]
    roots = brute_components({p for _, p in prints}, 4)
    least = {}
    for d, p in prints:
        if d is not None:
            least[roots[p]] = min(least.get(roots[p], d), d)
    assert got == sorted((str(d), format(p, "016x"), least.get(roots[p])) for d, p in prints)


@pytest.mark.parametrize("cell_rows", [1 << 20, 8])
def test_near_links_lose_nothing(spark, cell_rows):
    rng = random.Random(11)
    prints = set()
    for _ in range(40):  # chains and clusters around centres
        p = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            prints.add(p)
            for b in rng.sample(range(64), rng.randint(0, 4)):
                p ^= 1 << b
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    edges = simhash.near_links(spark, frame, 4, cell_rows=cell_rows)
    nodes = {r.node: r.root for r in simhash.connected_components(spark, edges).collect()}
    got, want = {}, {}
    for p, root in brute_components(prints, 4).items():
        want.setdefault(root, set()).add(p)
    for p in prints:
        s = p - (1 << 64) if p >> 63 else p
        got.setdefault(nodes.get(s, s), set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_null_texts_stay_null_when_strings_are_cut(spark):
    import corpus_pipeline

    from odd_data import syllables

    passage = syllables(77, 60)
    docs = spark.createDataFrame([(1, passage + "first", 0), (2, "second " + passage, 0), (3, None, None), (4, None, 7), (5, "", 0)],
                                 "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.cut_repeated_strings(spark, docs, "").collect()}
    assert got[3] == (None, None) and got[4] == (None, 7) and got[5] == ("", 0)
    assert got[1] == (passage + "first", len(passage) + 5) and len(got[2][0]) < 30
