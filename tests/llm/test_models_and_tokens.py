"""Classifiers by held-out accuracy, tokens against the tokenizers library, the pipeline's decisions."""

import hashlib
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, pu_quality, queries, toxicity
from tessera.llm.transducer import Transducer, compile_words
from tessera.sources.tables import read_table

from odd_data import odd_rows, syllables


def auc(labels, scores):
    ranks = pd.Series(scores).rank().to_numpy()
    n1 = int(labels.sum())
    return (ranks[labels == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(labels) - n1))


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_transducer_holds_exactly_its_words():
    words = {w.encode(): w[::-1].encode() for w in ["", "tap", "taps", "top", "tops", "stop", "stops", "é", "ab" * 30]}
    t = Transducer(compile_words(words))
    assert {w: t.get(w) for w in words} == words
    others = [b"ta", b"tapss", b"x", b"sto"]
    assert [t.get(w) for w in others] == [None] * 4
    assert t.get_all([*words, *others]) == [*words.values(), *[None] * 4]
    assert t.n_states < sum(map(len, words))  # suffixes are shared
    assert Transducer(compile_words({})).get(b"a") is None and Transducer(compile_words({})).get_all([b"a", b""]) == [None, None]


def test_encoding_matches_the_library(spark, odd_docs, no_docs, tokenizer):
    path = queries.tokenizer_path()
    got = sorted(str(tuple(r)) for r in bpe.digests(bpe.encode(spark, odd_docs, path, lexicon_words=50)).collect())
    want = []
    for d, t in odd_rows():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append(str((d, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                         hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())))
    assert got == sorted(want)
    assert bpe.encode(spark, no_docs, path).count() == 0


@pytest.mark.parametrize("text", ["a  b\n c\t\td <|endoftext|>x'll  we've  z \n\n q", "  ", "\x1c a\x85b   c", "日本語 ١٢٣ ½ x²",
                                  "é" * 300 + " " + "!?" * 90, "it's\r\n 'tis  ", "word. word, (word) \"x\""])
def test_awkward_texts_encode_alike(tokenizer, text):
    e = bpe.Encoder(bpe.Vocabulary.load(queries.tokenizer_path()))
    assert np.frombuffer(e.encode(text), dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert e.decode(e.encode(text)) == text


def test_decoder_restores_obfuscated_words():
    counts = np.zeros((toxicity.SYMBOLS,) * 3)
    for word in ["idiot", "loser", "moron", "stupid", "pathetic"] * 20 + syllables(1, 400).split(" "):
        c = toxicity._TABLE[np.frombuffer(f"  {word} ".encode(), dtype=np.uint8)]
        for a, b, d in zip(c, c[1:], c[2:]):
            counts[a, b, d] += 1
    decoder = toxicity.Decoder(toxicity.trigram_costs(counts))
    for text, word in [("an 1d10t!", "idiot"), ("l0$er", "loser"), ("m.o.r.o.n", "moron"), ("i d i o t here", "idiot"),
                       ("stuuuupid", "stupid"), ("p@thet1c", "pathetic"), ("IDIOT", "idiot")]:
        assert word in toxicity.words_of(decoder, text)
    plain = "The 3rd of 10,000 words *** $$$ stays, e.g. http://x.org/a"
    assert decoder.restore(plain).split()[0] == "the" and toxicity.words_of(decoder, None) == []


@pytest.fixture(scope="module")
def insults():
    counts = np.zeros((toxicity.SYMBOLS,) * 3)
    for word in ["idiot", "loser", "moron", "scumbag", "pathetic", "kill", "ass", "such", "you", "are", "a"] * 20 + syllables(1, 400).split(" "):
        c = toxicity._TABLE[np.frombuffer(f"  {word} ".encode(), dtype=np.uint8)]
        np.add.at(counts, (c[:-2], c[1:-1], c[2:]), 1)
    return toxicity.Decoder(toxicity.trigram_costs(counts))


@pytest.mark.parametrize("text, word", [
    ("such a i d i o t", "idiot"), ("y o u i d i o t", "idiot"), ("y o u  i d i o t", "you"), ("i d 1 0 t", "idiot"), ("m o r 0 n", "moron"),
    ("l o $ e r", "loser"), ("s c u m b @ g", "scumbag"), ("an a s s", "ass"), ("i/d/i/o/t", "idiot"), ("i, d, i. o t!", "idiot")])
def test_letters_set_apart_are_read_with_boundaries(insults, text, word):
    assert word in toxicity.words_of(insults, text)


@pytest.mark.parametrize("text, word", [
    ("p@th" + "e" * 60 + "tic", "pathetic"), ("you+are+a+p@thetic+1d10t+and+such+a+m0ron", "idiot"), ("you+are+a+p@thetic+1d10t+and+such+a+m0ron", "you"),
    ("m0ron" + "3" * 50, "moron"), ("a55", "ass"), ("an idi07", "idiot"), ("you a$$", "ass"), ("idiot5", "idiot"), ("k€ll", "kell"),
    ("£oser", "loser"), ("k!ll", "kill"), ("idiot!!!", "idiot"), ("1d1ot|m0ron", "moron")])
def test_no_obfuscated_token_is_left_out(insults, text, word):
    assert word in toxicity.words_of(insults, text)


def labelled_corpus(spark):
    bad = ["moron", "scumbag", "loser"]
    rows, labels = [], []
    for i in range(900):
        text = syllables(i, 60)
        toxic = i % 6 == 0
        if toxic:
            words = text.split(" ")
            words.insert(i % 50, bad[i % 3])
            text = " ".join(words)
        junk = i % 5 == 0
        if junk:
            text = " ".join(w + "***" for w in text.split(" "))
        rows.append((i, text))
        labels.append((i, int(not junk), int(toxic)))
    labels += [(None, 1, 1), (3, None, None), (90_000, 1, 1), (1, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifiers_hold_out_and_separate(spark, odd_docs, no_docs):
    docs, labels = labelled_corpus(spark)
    docs = docs.withColumn("toxicity", F.lit("?"))
    for module, label, modulus, remainder in ((toxicity, "toxic", 5, 0), (pu_quality, "quality", 3, 1)):
        out = module.score_documents(spark, docs, labels).toPandas()
        assert len(out) == 900 and out.score.between(0, 1).all()
        assert (out.held_out == [zlib.crc32(str(i).encode()) % modulus == remainder for i in out.doc_id]).all()
        assert (out.predicted == (out.score >= 0.5)).all()
        truth = np.array([i % 6 == 0 if label == "toxic" else i % 5 != 0 for i in out.doc_id]).astype(int)
        held = out.held_out.to_numpy()
        assert auc(truth[held], out.score.to_numpy()[held]) > 0.95
        odd = module.score_documents(spark, odd_docs, labels)
        assert odd.count() == len(odd_rows()) and odd.filter("score IS NULL").count() == 0
        assert module.score_documents(spark, no_docs, labels).count() == 0
        assert module.score_documents(spark, docs.limit(20), labels.filter("false")).count() == 20


def trained(spark, rows):
    """The toxicity model of (text, toxic) rows, all of them for training."""
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    return toxicity.train(spark, docs, labels, lambda c: F.lit(True))


def test_stock_phrases_teach_and_near_copies_do_not(spark):
    base = syllables(1000, 200).split(" ")
    base[20] = "wozzle"
    copies = []
    for i in range(60):  # near copies of one toxic document: their rare word is no evidence
        copies.append(" ".join([*base[:60 + i], f"changed{chr(97 + i % 26)}", *base[61 + i:]]))
    rows = [(syllables(i, 30) + (" you are an idiot" if i % 6 == 0 else ""), int(i % 6 == 0)) for i in range(600)]
    model = trained(spark, rows + [(t, 1) for t in copies])
    assert "idiot" in model.weights and "wozzle" not in model.weights
    assert model.score(syllables(5000, 30) + " you are an idiot") > 0.5 > model.score(syllables(5001, 30) + " wozzle")


def test_rare_terms_of_a_minority_are_learned(spark):
    rare = ["zarpo", "quimf", "blixt", "vundo", "krewp"]
    rows = []
    for i in range(3000):
        toxic = i % 5 == 0
        word = (rare[i // 75 % 5] if i % 75 == 0 else "moron") if toxic else "ti"
        rows.append((f"{syllables(i, 6)} {word} {syllables(10_000 + i, 6)}", int(toxic)))
    assert all(sum(w in t for t, _ in rows) == 8 for w in rare)  # of 600 toxic documents: 1.3 %
    model = trained(spark, rows)
    assert {"moron", *rare} <= model.weights.keys()


def test_class_prior_of_a_known_mixture():
    cells = np.arange(pu_quality.SCORE_CELLS)
    good, bad = np.exp(-((cells - 400) / 50) ** 2), np.exp(-((cells - 100) / 50) ** 2)
    mixed = 0.7 * good / good.sum() + 0.3 * bad / bad.sum()
    assert abs(pu_quality.class_prior(good, mixed) - 0.7) < 0.01


def test_pipeline_stages(spark, odd_docs, no_docs, sf_dir):
    import corpus_pipeline as C
    from tessera.llm.common import staged

    assert [n for n, _ in C.STAGES][1] == "simhash_near_dedup" and len(C.STAGES) == 5
    docs = odd_docs.withColumn("n_chars", F.length("text").cast("long"))
    for name, stage in C.STAGES:
        before = docs.columns
        docs = staged(spark, stage(spark, docs, sf_dir), "test-stage")
        assert name == "bpe_encoding" or docs.columns == before
        assert stage(spark, odd_docs.filter("false"), sf_dir).count() == 0
    ids = [r.doc_id for r in docs.collect()]
    assert {10, 16} <= set(ids) and not {11, 17, 18, None} & set(ids) and ids.count(22) <= 1


def test_pipeline_keeps_clean_documents(spark, sf_dir):
    import corpus_pipeline as C

    docs = read_table(spark, sf_dir, "documents")
    kept = C.drop_toxic(spark, docs, sf_dir)
    clean = read_table(spark, sf_dir, "labels").filter("toxic = 0").join(docs, "doc_id")
    assert kept.join(clean.select("doc_id"), "doc_id").count() >= 0.97 * clean.count()
    assert C.run(spark, sf_dir).columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_long_runs_cost_their_length():
    import time

    decoder = toxicity.Decoder(toxicity.trigram_costs(np.ones((toxicity.SYMBOLS,) * 3)))
    for text in ("1d10t " + "abcde" * 200_000, "stuuupid " + "abcde" * 200_000, "abcde" * 200_000 + "é 1d10t stuuupid", "xy" * 500_000 + " aaab"):
        start = time.process_time()
        decoder.restore(text)
        assert time.process_time() - start < 3
