"""Operators on single texts: SentencePiece ids, license scan, language, toxicity."""

import hashlib
import math
import random
import re
import struct
import sys
import tracemalloc
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from fareline.llm import language, licenses, pieces, toxicity, words  # noqa: E402
from fareline.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "  ", " a", "a  b", "trail  ", "▁", "a▁b", " ▁", "\n\n", "ha.\nTo", "日本語 テキスト", "emoji 😀😀 x", "<s> </s> <unk>",
    "<0x41>", "é́", "\x00x", "tab\there", "1234567 89", "a" * 500, "…—“quoted”", "ŉ ﬀ", "Ünïcödé", "x². y_z",
]
MIX = "abcdeéñß  \n\t.,▁漢😀1²_-'S\x1c\x85"


def mixed(seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice(MIX) for _ in range(rng.randint(1, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def docs(spark):
    """Null, empty, long and repeated texts; a column whose name clashes."""
    data = [(1, "All rights reserved.", "x"), (2, None, "x"), (3, "", "x"), (4, "word " * 60_000, "x"), (5, "a b", "x"), (5, "a b", "x"), (None, "c", "x")]
    return spark.createDataFrame(data, "doc_id long, text string, n_words string")


def test_piece_ids_and_texts_equal_the_library(documents):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoder = pieces.load_encoder(PIECES)
    texts = [r.text for r in documents.collect()] + ODD + mixed(1)
    rng = random.Random(2)
    vocabulary = list(encoder.table.ids)
    texts += ["".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 6))).replace("▁", " ") for _ in range(400)]
    for text in texts:
        packed = encoder.encode(text)
        ids = list(struct.unpack(f"<{len(packed) // 4}I", packed))
        assert ids == library.encode(text), text
        framed = struct.pack(f"<{len(ids) + 2}I", library.bos_id(), *ids, library.eos_id())
        assert encoder.table.decode(framed).decode() == library.decode([library.bos_id(), *ids, library.eos_id()]), text


def test_decoding_of_broken_bytes_equals_the_library():
    library, table = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.load_encoder(PIECES).table
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32_000), 0]) for _ in range(rng.randint(0, 8))]
        assert table.decode(struct.pack(f"<{len(ids)}I", *ids)).decode() == library.decode(ids), ids


def test_pair_table_agrees_with_merging(documents):
    """Compatible pairs are those that the library leaves as they are."""
    table = pieces.load_encoder(PIECES).table
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng, checked = random.Random(4), 0
    inner = [i for i, text in table.text.items() if text.isalpha() and i in table._edges]
    while checked < 500:
        a, b = rng.choice(inner), rng.choice(inner)
        ids = library.encode("\n" + table.text[a] + table.text[b])[2:]
        if ids and table.text[ids[0]] and "".join(table.text[i] for i in ids) == table.text[a] + table.text[b]:
            assert table.compatible(a, b) == (ids == [a, b])
            checked += 1


def test_piece_query(spark, docs):
    found = {r.doc_id: r for r in pieces.encode_digest(docs, PIECES).collect()}
    assert len(found) == 6 and pieces.encode_digest(docs, PIECES).count() == 7
    assert (found[2].n_tokens, found[3].n_tokens) == (2, 2)
    assert found[3].ids_sha256 == hashlib.sha256(struct.pack("<2I", 1, 2)).hexdigest()
    assert found[4].decoded_sha256 == hashlib.sha256(("word " * 60_000).encode()).hexdigest()
    full = pieces.encode_decode(docs.where("doc_id = 1"), PIECES).first()
    assert full.decoded == "All rights reserved." and full.n_tokens == len(full.ids) // 4
    assert pieces.encode_digest(docs.limit(0), PIECES).count() == 0


def test_word_ids_equal_the_library(documents):
    library, fast = Tokenizer.from_file(WORDS), words.WordIds(WORDS)
    assert fast._by_words
    odd = ["<|endoftext|>", "a<|endoftext|>b", "İstanbul", "ΟΔΟΣ", "it's we'll 'S", "a" * 200]
    for text in [r.text for r in documents.collect()] + ODD + odd + mixed(5):
        ids = library.encode(text, add_special_tokens=False).ids
        assert fast.packed(text) == struct.pack(f"<{len(ids)}I", *ids), text


def test_word_caches_of_bounded_size_change_nothing(documents, monkeypatch):
    monkeypatch.setattr(words, "CACHED_CHUNKS", 50)
    monkeypatch.setattr(words, "CACHED_WORDS", 40)
    monkeypatch.setattr(words, "LONGEST_CACHED", 6)
    small, library = words.WordIds(WORDS), Tokenizer.from_file(WORDS)
    for row in documents.limit(60).collect():
        ids = library.encode(row.text, add_special_tokens=False).ids
        assert small.packed(row.text) == struct.pack(f"<{len(ids)}I", *ids)


def test_word_caches_stay_small_after_texts_of_many_or_endless_words(monkeypatch):
    monkeypatch.setattr(words, "CACHED_CHUNKS", 50)
    monkeypatch.setattr(words, "CACHED_WORDS", 40)
    small, library = words.WordIds(WORDS), Tokenizer.from_file(WORDS)
    names = ["".join(chr(97 + n // 26**k % 26) for k in range(3)) for n in range(3000)]
    texts = ["x" * 50_000 + " 0 7", " ".join(names), *(" ".join(names[n : n + 20]) + " 0, it's 0" for n in range(0, 400, 20))]
    for number, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids
        assert small.packed(text) == struct.pack(f"<{len(ids)}I", *ids), text
        caches = [small._chunks, small._old_chunks, small._words, small._old_words]
        assert max((len(word) for cache in caches for word in cache), default=0) <= words.LONGEST_CACHED
        # What the text of many words has filled is given up by the next.
        assert number == 1 or max(map(len, caches)) <= 150


def test_texts_packed_together_ask_the_library_once_for_each_word(documents, monkeypatch):
    library, fast = Tokenizer.from_file(WORDS), words.WordIds(WORDS)
    asked, encoded = [], fast._encoded
    monkeypatch.setattr(fast, "_encoded", lambda some: asked.append(sorted(some)) or encoded(some))
    texts = [r.text for r in documents.limit(60).collect()] + ["", " \xa0", "naïve naïve, (naïve)", "_a1 a_ 'sun''s !'t"] + mixed(6)
    texts += ["".join(map(chr, range(0x20, 0x180))), "x" * 100, " ".join(["y" * 100, "z"] * 3), *ODD]
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert fast.packed_all(texts) == [struct.pack(f"<{len(ids)}I", *ids) for ids in want]
    assert len(asked) == 1 and len(asked[0]) == len(set(asked[0])) > 100
    monkeypatch.setattr(words, "BATCH", 2000)
    assert fast.packed_all(texts[::-1]) == [struct.pack(f"<{len(ids)}I", *ids) for ids in want[::-1]]
    again = [word for some in asked[1:] for word in some]
    assert again and all(len(word) > words.LONGEST_CACHED for word in again)
    assert fast.packed_all([]) == []


def brute_scan(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        hits = [i for i in range(len(found)) if found[i : i + len(parts)] == parts]
        places += hits
        labels |= {label} if hits else set()
    return len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_base_equals_brute_force(documents, docs):
    extra = ["cc by cc by cc", "CC-BY, all rights reserved; All Rights Reserved!", "é cc by ünder", "ccby general  public\nlicense"]
    finder = licenses.NoticeFinder(licenses.NOTICES)
    for text in [r.text for r in documents.collect()] + extra + ODD + mixed(6):
        assert licenses.scan_text(text, licenses.PHRASES, finder)[:5] == brute_scan(text), text
    found = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert (found[1].n_base, found[1].labels, found[1].score, found[1].first_word) == (1, "reserved", 1.0, 0)
    assert (found[2].n_words, found[2].labels, found[2].score, found[2].first_word) == (0, "", 0.0, None)
    assert found[4].n_words == 60_000
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_notices_are_found_with_edits_and_their_spans():
    finder = licenses.NoticeFinder(licenses.NOTICES)
    text = "some words Realesed under the M1T licence and more"
    *_, labels, score, notices = licenses.scan_text(text, licenses.PHRASES, finder)
    assert labels == "" or "mit" in labels
    *_, labels, score, notices = licenses.scan_text("x relased under the mit license y", licenses.PHRASES, finder)
    assert labels == "mit" and 0.9 < score < 1 and notices == [{"label": "mit", "first_word": 1, "last_word": 5, "edits": 1}]


def test_pigeonhole_search_finds_what_a_full_search_finds():
    """Random edits up to the bound, against matching the whole text."""
    import regex

    rng = random.Random(7)
    finder = licenses.NoticeFinder(licenses.NOTICES)
    for _ in range(150):
        notice, label = rng.choice(licenses.NOTICES)
        edits, chars = len(notice) // licenses.CHARS_AN_EDIT, list(notice)
        for _ in range(rng.randint(0, edits + 1)):
            at = rng.randrange(len(chars))
            chars[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "z"])
        text = f" lorem ipsum {''.join(chars)} dolor sit "
        full = regex.search(f"(?:{regex.escape(notice)}){{e<={edits}}}", text)
        assert (label in {f[2] for f in finder.find(text)}) or not full, text


def test_languages_are_learned_and_odd_texts_rejected(spark, documents):
    model = language.fit_languages(documents)
    found = language.identify(documents, model)
    assert found.columns[: len(documents.columns)] == documents.columns
    held = found.where(language.held_out("doc_id"))
    right, accepted = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("lang_accepted").cast("int"))).first()
    assert right > 0.9 and accepted > 0.95
    assert held.where("lang_score < 0 or lang_score > 1").count() == 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!² ½"), (4, "Это совсем другой язык, его не было."), (5, "x " * 200_000)], "doc_id long, text string")
    rows = {r.doc_id: r for r in language.identify(odd, model).collect()}
    assert [rows[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and not rows[1].lang_accepted
    assert not rows[4].lang_accepted and rows[5].lang_pred in model.languages
    assert language.identify(odd.limit(0), model).count() == 0
    none = language.fit_languages(documents.limit(0))
    assert language.identify(odd, none).where("lang_pred <> 'und'").count() == 0


#: Text in seven languages that no document is in, and program code.
UNLEARNED = {
    "it": "La mattina seguente il vecchio pescatore scese verso il porto con la sua rete sulle spalle e guardò il mare che si stendeva calmo davanti alle case del paese senza dire una parola",
    "pt": "Na manhã seguinte o velho pescador desceu até ao porto com a rede aos ombros e olhou o mar que se estendia calmo diante das casas da aldeia sem dizer uma palavra",
    "nl": "De volgende ochtend liep de oude visser naar de haven met zijn net over de schouder en keek naar de zee die rustig voor de huizen van het dorp lag zonder een woord te zeggen",
    "pl": "Następnego ranka stary rybak zszedł do portu z siecią na ramieniu i patrzył na morze które spokojnie leżało przed domami wsi nie mówiąc ani słowa do nikogo",
    "tr": "Ertesi sabah yaşlı balıkçı omzunda ağıyla limana indi ve köyün evlerinin önünde sakin sakin uzanan denize tek bir söz söylemeden uzun uzun baktı durdu sonra eve döndü",
    "fi": "Seuraavana aamuna vanha kalastaja käveli satamaan verkko olkapäällään ja katseli merta joka lepäsi tyynenä kylän talojen edessä sanomatta sanaakaan kenellekään joka kulki silloin ohi hänen luotaan illalla",
    "sw": "Asubuhi iliyofuata mvuvi mzee alishuka hadi bandarini akiwa na wavu begani na akaitazama bahari iliyotulia mbele ya nyumba za kijiji bila kusema neno lolote kwa mtu yeyote",
    "code": "def parse ( self , xs ) : for i in range ( len ( xs ) ) : if xs [ i ] is None : continue yield xs [ i ] . strip ( ) . lower ( ) return dict ( zip ( keys , vals ) ) import os , sys",
}


def test_unlearned_languages_are_rejected_and_clean_documents_kept(spark, documents):
    model = language.fit_languages(documents)
    rng = random.Random(5)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(40)]
    texts = {**{name: text.split() for name, text in UNLEARNED.items()}, "noise": noise}
    for name, words in texts.items():
        pieces = [" ".join(words[at : at + n]) for n in range(21, len(words) + 1) for at in range(len(words) - n + 1)]
        rejected = sum(not model.predict(piece)[2] for piece in pieces)
        assert rejected * 2 >= len(pieces) > 0, name
    held = language.identify(documents.where(language.held_out("doc_id")), model)
    assert held.where("not lang_accepted").count() <= held.count() // 100


def test_scores_by_plain_arithmetic(documents):
    """Average of rows and softmax, subword by subword."""
    model = language.fit_languages(documents)
    for text in ["Der Mann und the", "é", "a b", *[r.text for r in documents.where("doc_id < 12").collect()]]:
        data, rows = language.folded(text), []
        for n, order in enumerate((2, 3, 4)):
            for at in range(len(data) - order + 1):
                part = data[at : at + order]
                if b" " in part[1:-1] or part[:1] == part[-1:] == b" ":
                    continue
                h = 2166136261 + n
                for byte in part:
                    h = ((h ^ byte) * 16777619) % 2**32
                rows.append((h ^ (h >> 15)) % language.BUCKETS + n * language.BUCKETS)
        means = [sum(float(model.logits[r][k]) for r in rows) / len(rows) for k in range(len(model.languages))]
        powers = [math.exp(x / model.temperature) for x in means]
        best = max(range(len(powers)), key=powers.__getitem__)
        found, score, _ = model.predict(text)
        assert found == model.languages[best] and abs(score - powers[best] / sum(powers)) < 1e-6


def test_least_shares_by_length():
    own, foreign = [0.99] * 40 + [0.7] * 40 + [0.99] * 5, [0.3] * 40 + [0.9] * 40 + [0.3] * 5
    counts = [300] * 40 + [2000] * 40 + [70] * 5
    assert language.least_shares(own, foreign, counts) == pytest.approx((0.5, 0.6, 0.645, 0.645, 0.7, 0.7))


def test_language_learning_leaves_held_out_documents_alone(documents):
    """Labels of held-out documents don't matter."""
    broken = documents.withColumn("lang", F.when(language.held_out("doc_id"), "zz").otherwise(F.col("lang")))
    assert "zz" not in language.fit_languages(broken).languages


def test_long_text_scores_equal_those_of_its_pieces(documents):
    model = language.fit_languages(documents)
    text = " ".join(r.text for r in documents.where("lang = 'en'").limit(150).collect()) * 4
    assert len(text) > 1 << 20
    import numpy as np

    rows, _ = language.subwords(np.frombuffer(language.folded(text), np.uint8))
    assert np.allclose(model.raw(text)[0], model.logits[rows].mean(axis=0, dtype=np.float64), atol=1e-5)


@pytest.fixture(scope="module")
def toxic_model(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    return docs, labels, toxicity.fit_toxicity(docs, labels)


def test_toxicity_by_a_chain(spark, toxic_model):
    docs, labels, model = toxic_model
    names = [name for name, _, _ in model.links]
    assert names[-1] == "toxic" and len(names) >= 2
    # Each link has a weight for each one before it.
    assert [len(w) - len(model.features) for _, w, _ in model.links] == list(range(len(names)))
    found = toxicity.score_toxicity(docs, model).join(labels, "doc_id")
    hit, missed, wrong = found.agg(
        F.count_if(F.expr("is_toxic and toxic = 1")), F.count_if(F.expr("not is_toxic and toxic = 1")), F.count_if(F.expr("is_toxic and toxic = 0"))
    ).first()
    assert hit / (hit + missed) > 0.6 and wrong <= 8
    odd = spark.createDataFrame(
        [(1, None, "k"), (2, "", "k"), (3, "you pathetic idiot, worthless scum", "k"), (4, "fine " * 100_000, "k")],
        "doc_id long, text string, is_toxic string",
    )
    rows = {r.doc_id: r for r in toxicity.score_toxicity(odd, model).collect()}
    assert [rows[i].is_toxic for i in (1, 2, 3, 4)] == [False, False, True, False]
    assert toxicity.score_toxicity(odd.limit(0), model).count() == 0


def test_toxicity_generalises_to_unseen_documents(spark, toxic_model):
    _, _, model = toxic_model
    base = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{base}/documents.parquet").where("doc_id >= 1000")
    labels = spark.read.parquet(f"{base}/labels.parquet").where("toxic in (0, 1)")
    found = toxicity.score_toxicity(docs, model).where("lang = 'en'").join(labels, "doc_id")
    hit, flagged = found.agg(F.count_if(F.expr("is_toxic and toxic = 1")), F.count_if(F.expr("is_toxic"))).first()
    assert hit / max(1, flagged) > 0.9


def test_toxicity_by_plain_arithmetic(spark, toxic_model):
    """Each link's probability, added up term by term from the chain's weights."""
    docs, _, model = toxic_model
    by_number = {n: f for f, n in model.features.items()}
    found = toxicity.score_toxicity(docs.limit(300), model).collect()
    assert len(found) == 300
    for row in found:
        every = {f for w in re.findall(r"[^\W\d_]+", (row.text or "").lower()) for f in toxicity.word_features(w)}
        earlier = []
        for name, weights, bias in model.links:
            score = bias + sum(float(w) for n, w in enumerate(weights[: len(by_number)]) if by_number[n] in every)
            score += sum(float(w) * p for w, p in zip(weights[len(by_number) :], earlier, strict=True))
            earlier.append(1 / (1 + math.exp(-score)))
            assert row[f"p_{name}"] == pytest.approx(earlier[-1], abs=1e-4)
        assert row.is_toxic == (bool(row.text) and row.p_toxic >= model.threshold)


def test_links_learn_from_probabilities_of_fits_without_the_row(spark):
    rng = np.random.default_rng(4)
    present = [sorted(rng.choice(6, 3, replace=False).tolist()) for _ in range(83)]
    target = np.array([float(0 in at) for at in present], np.float32)
    earlier = rng.random((83, 1)).astype(np.float32)
    here = toxicity._fits_in_turn(present, 6, earlier, target)
    tasks = toxicity.fits_as_tasks(spark)(present, 6, earlier, target)
    assert len(here) == len(tasks) == toxicity.FOLDS + 1 and not len(here[-1][2])
    for (weights, bias, out), (other, other_bias, other_out) in zip(here, tasks, strict=True):
        assert weights == pytest.approx(other, abs=1e-4) and bias == pytest.approx(other_bias, abs=1e-4)
        assert out == pytest.approx(other_out, abs=1e-4)
    for fold in range(toxicity.FOLDS):
        # Labels of the rows left out have no say in their own probabilities.
        turned = target.copy()
        turned[fold :: toxicity.FOLDS] = 1 - turned[fold :: toxicity.FOLDS]
        assert (toxicity.fit_without(present, 6, earlier, turned, fold)[2] == here[fold][2]).all()
        assert len(here[fold][2]) == len(range(fold, 83, toxicity.FOLDS))


def test_a_fit_holds_one_matrix():
    rng = np.random.default_rng(5)
    present = [rng.choice(800, 20, replace=False).astype(np.uint16) for _ in range(2000)]
    target = (rng.random(2000) < 0.5).astype(np.float32)
    tracemalloc.start()
    try:
        toxicity.fit_without(present, 800, np.zeros((2000, 0), np.float32), target, 0)
        assert tracemalloc.get_traced_memory()[1] < 1.3 * 4 * 800 * 1600
    finally:
        tracemalloc.stop()


def test_fit_ends_where_no_weight_lessens_the_loss():
    """The gradient of the penalised loss, summed row by row, is near zero."""
    rng = np.random.default_rng(6)
    x = (rng.random((200, 8)) < 0.4).astype(np.float32)
    y = (x[:, 0] + rng.random(200) > 1.2).astype(np.float32)
    weights, bias = toxicity._fit(x, y)
    slope = [toxicity.PENALTY * float(w) for w in weights]
    for row, label in zip(x.tolist(), y.tolist(), strict=True):
        p = 1 / (1 + math.exp(-bias - sum(a * float(b) for a, b in zip(row, weights, strict=True))))
        slope = [s + (p - label) * a for s, a in zip(slope, row, strict=True)]
    assert max(map(abs, slope)) / 200 < 0.01


def test_toxicity_without_labels_flags_nothing(spark):
    docs = spark.createDataFrame([(1, "idiot")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert toxicity.score_toxicity(docs, model).where("is_toxic").count() == 0


@pytest.mark.parametrize("name", ["op4_sentencepiece", "op5_language", "op6_toxicity", "op10_licenses"])
def test_queries_return_every_document(spark, documents, name):
    found = QUERIES[name](spark, SF)
    assert found.count() == documents.count() and "doc_id" in found.columns
