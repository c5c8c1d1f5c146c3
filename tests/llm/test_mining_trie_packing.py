"""Hard negatives, the conversation trie and token packing against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from odd_data import odd_rows, syllables
from tessera.llm import cutting_stock, hard_negatives, prefix_trie
from tessera.llm.bpe import Encoder, Vocabulary
from tessera.llm.queries import tokenizer_path


# Hard negatives.

def brute_negatives(rows, stride=50, positives=5, per_positive=3):
    """``rows``: (id, integer vector, label) of all that take part."""
    width = max(len(v) for _, v, _ in rows)
    rows = [(i, list(v) + [0] * (width - len(v)), lab) for i, v, lab in rows]
    out = []
    for a, av, alab in {(i, tuple(v), lab) for i, v, lab in rows if i % stride == 0}:
        scored = sorted((-sum(x * y for x, y in zip(av, v)), i, lab) for i, v, lab in rows if i != a)
        for p_score, p, _ in [s for s in scored if s[2] == alab][:positives]:
            fit = [(s, i) for s, i, lab in scored if lab != alab and 50 * -p_score <= -100 * s <= 95 * -p_score]
            out += [(a, p, r + 1, i, -p_score, -s) for r, (s, i) in enumerate(fit[:per_positive])]
    return sorted(out)


@pytest.mark.parametrize("block", [8192, 40])
def test_hard_negatives_match_brute_force(spark, block):
    rng = np.random.default_rng(3)
    base = rng.normal(size=12)
    rows = [(i, (base * rng.choice([0, 0.7]) + rng.normal(size=12) * rng.choice([0.2, 1, 2])).tolist(), int(i * 7 % 3)) for i in range(300)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(150)]  # a third of one label is one vector: ties by id
    rows += [(100, rows[9][1], 2), (100, rows[9][1], 2), (150, rows[3][1], 0)]  # repeated rows, one id with two vectors
    rows += [(2000, [0.0] * 12, 0), (2050, [], 1), (2100, rows[5][1][:4], 1), (-50, rows[11][1], 2)]
    odd = [(50, None, 1), (None, rows[3][1], 1), (450, rows[3][1], None), (600, [float("nan")] * 12, 1), (700, [None] * 12, 1),
           (800, [float("inf")] * 12, 1)]
    frame = spark.createDataFrame([(i, v, lab, "?") for i, v, lab in rows + odd], "vec_id long, embedding array<double>, label int, v string")
    got = hard_negatives.hard_negatives(spark, frame, hard_negatives.shifted_label(), block_rows=block, anchor_rows=3)
    whole = [(i, [int(np.floor(256 * x)) for x in v], (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows]
    want = brute_negatives(whole)
    assert len(want) > 60 and sorted(tuple(r) for r in got.collect()) == want
    assert hard_negatives.hard_negatives(spark, frame.filter("false")).count() == 0


def test_hard_negatives_of_huge_components(spark):
    big = [[1e9, 3e9], [2e9, 1e9], [1.5e9, 1e9], [3e8, 2e9], [1e9, 1.0]]
    frame = spark.createDataFrame([(i * 25, v, i % 2) for i, v in enumerate(big)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large|OverflowError|int too big"):
        hard_negatives.hard_negatives(spark, frame).collect()
    whole = [(i * 25, [int(np.floor(256 * x)) for x in np.array(v) / 4096], i % 2) for i, v in enumerate(big)]
    small = spark.createDataFrame([(i * 25, (np.array(v) / 4096).tolist(), i % 2) for i, v in enumerate(big)],
                                  "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(r) for r in hard_negatives.hard_negatives(spark, small).collect()) == brute_negatives(whole)
    with pytest.raises(Exception, match="beyond 64 bits"):
        hard_negatives.hard_negatives(spark, spark.createDataFrame([(0, [1e18], 1), (1, [3e18], 1)],
                                                                   "vec_id long, embedding array<double>, label int")).collect()


def test_score_bounds_hold():
    rng = np.random.default_rng(5)
    v = rng.integers(-300, 300, size=(500, 8))
    v[:20] = v[20:40] * 3  # angles of zero
    refs = np.linalg.qr(rng.normal(size=(8, 4)))[0]
    length, angles = hard_negatives.angles_to(v, refs)
    cut = 0
    for i in range(0, 500, 25):
        least, most = hard_negatives.score_bounds(length[i], angles[i], length, angles)
        exact = v @ v[i]
        assert (least <= exact).all() and (exact <= most).all()
        cut += int((most < 0.8 * length[i] * length.max()).sum())
    assert cut > 5000


# The trie.

def brute_trie(rows):
    """``rows``: (conv_id, turn, role, text) without NULL ids and without ties of a turn's number."""
    own = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], set()).add(c)
    out = []
    for node, m in members.items():
        under = [n for n in members if n[:len(node)] == node]
        children = [n for n in under if len(n) == len(node) + 1]
        leaves = [n for n in under if not any(len(x) == len(n) + 1 and x[:len(n)] == n for x in under)]
        saved = sum((len(members[n]) - 1) * (len(n[-1][1]) if n else 0) for n in under)
        ends = ",".join(str(c) for c in sorted(c for c in m if len(paths[c]) == len(node)))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations():
    rng = random.Random(8)
    rows = []
    for c in list(range(0, 40)) + list(range(100, 130)) + list(range(205, 220)) + [-7, 300]:
        for t in range(rng.randint(1, 7)):
            rows.append((c, t if t or c % 3 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "ab", "é日本", "", None, "x" * 900])))
    rows += [(400 + i, t, "user", f"copy {t}") for i in range(60) for t in range(3)]  # one conversation holds many copies
    rows += [(500 + i, 0, "system", "the same") for i in range(40)] + [(500 + i, 1, "user", f"{i}") for i in range(40)]  # a common first turn
    rows += [(700, t, "user", f"turn {t % 5}") for t in range(3000)] + [(701, t, "user", f"turn {t % 5}") for t in range(2500)]
    return rows


@pytest.mark.parametrize("per_shard", [100_000, 25])
def test_trie_matches_brute_force(spark, per_shard, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 7)
    rows = [r for r in conversations() if r[0] not in (700, 701)]
    frame = spark.createDataFrame([r + ("?",) for r in rows + [(None, 1, "user", "lost")]],
                                  "conv_id long, turn long, role string, text string, ids string").repartition(4)
    got = prefix_trie.prefix_trie(spark, frame, turns_per_shard=per_shard).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_trie(rows)


def test_trie_of_long_and_empty_conversations(spark):
    rows = [r for r in conversations() if r[0] in (700, 701)] + [(102, 0, "user", "alone")]  # 102: turnless when its h is 1 or more
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.depth): r for r in prefix_trie.prefix_trie(spark, frame, turns_per_shard=1000).collect()}
    assert max(d for _, d in got) == 3000 and len(got) > 3000
    root = next(r for r in got.values() if r.depth == 0)
    assert root.n_convs == 3 and root.parent_conv_id is None
    assert prefix_trie.prefix_trie(spark, frame.filter("false")).count() == 0
    turnless = prefix_trie.prefix_trie(spark, spark.createDataFrame([(1, 0, "user", "x")], frame.schema)).collect()
    h = zlib.crc32(b"1") % 6
    assert len(turnless) == (1 if h else 2)


def test_ties_of_a_turn_and_repeated_rows_are_turns_of_their_own(spark):
    rows = [(0, 1, "user", "b"), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 0, "user", "c")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    first = prefix_trie.prefix_trie(spark, frame).collect()
    assert max(r.depth for r in first) == 4
    again = prefix_trie.prefix_trie(spark, frame.orderBy("text").coalesce(1)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


# Packing.

def held_to_law(pieces, ids_of, width):
    """Every id lies in one piece, sequences are gapless and hold at most ``width``; returns the padding."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for doc, want in ids_of.items():
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(want) // 4
            assert p["ids_crc32"] == zlib.crc32(want[4 * at:4 * (at + p["length"])]) and p["length"] > 0
            at += p["length"]
        assert at == len(want) // 4
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= width
        padding += 0 if at & (at - 1) == 0 else width - at
    return padding


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Vocabulary.load(tokenizer_path()))


def test_texts_encode_like_the_tokenizers_library(encoder):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    texts = ["", " ", "  ", "a  b", " a", "a ", "a\n b", "a \nb", "a\t b c", "　 x", "it's  we'll\r\n\r\n  x", "x <|endoftext|> y", "  a  b",
             "a" * 3000, "ab" * 2500, "x" * 5000, " " * 3000 + "x", "\n" * 5000, "日本語" * 900, "word " * 50_000]
    texts += ["".join(rng.choice("ab1. \n\t  é'日$aaabbb") for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randint(33, 126), rng.randint(160, 0x2FFF), rng.randint(0x1F300, 0x1F600)])) for _ in range(30)) for _ in range(500)]
    texts += [t for _, t in odd_rows() if t]
    library = Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    library.no_padding()
    fast = cutting_stock.TextEncoder(encoder.vocabulary)
    assert fast.fast is not None
    for text in texts:
        want = np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert fast.encode(text) == want, text[:80]
        assert encoder.encode(text) == want, text[:80]


def test_vocabulary_pieces_merge_to_themselves_or_are_not_ranked(encoder):
    fast = cutting_stock.TextEncoder(encoder.vocabulary)
    for merge in list(encoder.vocabulary.merges.values())[::37]:
        piece = encoder.vocabulary.pieces[merge & ((1 << 20) - 1)]
        rows = np.array([[encoder.vocabulary.byte_ids[b] for b in piece]])
        alone = encoder._table.merge(rows)[0][1] if len(piece) > 1 else rows
        assert (piece in fast.fast._mergeable_ranks) == (alone.shape[1] == 1)


@pytest.mark.parametrize("tasks", [512, 2])
def test_packing_keeps_every_id_without_padding(spark, encoder, monkeypatch, tasks):
    monkeypatch.setattr(cutting_stock, "TASKS_PER_BLOCK", tasks)
    rng = random.Random(6)
    rows = [(i, syllables(i, rng.randint(1, 90))) for i in range(400)] + [(5000 + i, "one copy of many " * 9) for i in range(250)]
    rows += [(9000 + i, t) for i, (_, t) in enumerate(odd_rows())]
    docs = spark.createDataFrame([r + ("?",) for r in rows], "doc_id long, text string, ids string").repartition(5)
    out = cutting_stock.digests(cutting_stock.pack_tokens(spark, docs, tokenizer_path(), width=128))
    pieces = [r.asDict() for r in out.collect()]
    ids_of = {i: encoder.encode(t or "") + np.uint32(1).tobytes() for i, t in rows}
    assert held_to_law(pieces, ids_of, 128) == 0
    # Most documents are cut only where they are longer than a sequence.
    cut = sum(1 for i, ids in ids_of.items() if sum(p["doc_id"] == i for p in pieces) > -(-len(ids) // 4 // 128))
    assert cut < 0.3 * len(rows)
    assert cutting_stock.pack_tokens(spark, docs.filter("false"), tokenizer_path()).count() == 0


def test_packing_of_null_ids_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, None), (None, ""), (1, "a b"), (1, "a b")], "doc_id long, text string")
    pieces = cutting_stock.pack_tokens(spark, docs, tokenizer_path(), width=4).collect()
    assert sum(p.length for p in pieces) == sum(p.doc_tokens for p in pieces if p.start == 0) == 8
    assert len({(p.sequence_id, p.offset) for p in pieces}) == len(pieces)


def brute_cheapest(price, lengths, w):
    if w == 0:
        return 0.0
    return min([brute_cheapest(price, lengths, w - v) + p for v, p in zip(lengths, price) if v <= w], default=float("inf"))


def test_knapsack_prices_the_cheapest_exact_fill():
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = np.sort(rng.choice(np.arange(1, 12), size=4, replace=False))
        price = rng.random(4)
        cost, last = cutting_stock.cheapest_fills(price, lengths, 14)
        for w in range(15):
            assert cost[w] == pytest.approx(brute_cheapest(price, lengths.tolist(), w))
            if w and np.isfinite(cost[w]):
                parts = cutting_stock._fill(w, last)
                assert sum(parts) == w and sum(price[lengths.tolist().index(v)] for v in parts) == pytest.approx(cost[w])


def test_program_reaches_the_best_number_of_sequences():
    # 30 of 6, 30 of 3, 20 of 4, 10 of 2 into 10: 6+4, 4+3+3, 6+2+2, 3+3+2+2 and the like.
    for histogram, best in (({6: 30, 4: 30}, 30), ({5: 7}, 3), ({7: 10, 3: 4, 1: 18}, 10), ({9: 5, 8: 5}, 0), ({1: 25}, 2),
                            ({3: 20, 4: 10}, 10)):
        plan = cutting_stock.plan_fills(histogram, 10, gap=1e-6)
        assert sum(plan.counts) == best
        used = {}
        for uses, count in zip(plan.uses, plan.counts):
            assert sum(v * n for v, n in uses) == 10
            for v, n in uses:
                used[v] = used.get(v, 0) + n * count
        assert all(used[v] <= histogram[v] for v in used)
