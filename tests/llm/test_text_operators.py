"""Packing, sentencepiece, language ID, toxicity and license scans on small tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from beatmetrics.llm import langid, licenses, toxicity
from beatmetrics.llm.packing import WordIds, pack
from beatmetrics.llm.queries import tokenizer_path
from beatmetrics.llm.sentencepiece_bpe import Codec, round_trip

WORD_BPE = tokenizer_path("word_bpe_49k.json")
PIECES = tokenizer_path("piece_bpe_32k.model")
ODD = ["", None, " ", "a  b", "a\nb\n\nc", "a▁b", "don't stop!?", "日本語 😀 é\t x", "x" * 30_000, "\x00a"]


def frame(spark, texts, more=""):
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, offset string{more}")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(WORD_BPE)
    own.encode_special_tokens = True
    return own


def test_pack_is_a_gapless_round_trip(spark, library):
    texts = ODD + ["some words, again. " * 700, "The Cat's 12 hats…..", "same", "same"]
    rows = pack(frame(spark, texts).repartition(3), WORD_BPE, length=64, with_ids=True).collect()
    expected = {
        i: np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for i, t in enumerate(texts)
    }
    at = 0
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        piece = expected[r.doc_id][r.start : r.start + r.length].tobytes()
        assert (bytes(r.ids), r.ids_crc32) == (piece, zlib.crc32(piece))
        assert r.doc_tokens == len(expected[r.doc_id])
        assert r.sequence_id * 64 + r.offset == at and r.offset + r.length <= 64
        at += r.length
    assert at == sum(map(len, expected.values()))


def test_pack_of_nothing_and_of_null_ids(spark):
    empty = frame(spark, []).limit(0)
    assert pack(empty, WORD_BPE).collect() == []
    rows = spark.createDataFrame([(None, "a"), (None, "a"), (7, None)], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in pack(rows, WORD_BPE).collect()) == ["7", "None", "None"]


def test_pack_takes_special_tokens_as_the_library_does(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(WORD_BPE)
    texts = [
        "end of page <|endoftext|> next", "a<|startoftext|>b<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> A.",
        "x <|endoftext |> <| endoftext|>\n<|endoftext|", "plain", None, "word, " * 900 + "<|endoftext|>",
    ]
    rows = pack(frame(spark, texts), WORD_BPE, length=50_000, with_ids=True).collect()
    found = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in rows}
    assert found[0] == [806, 539, 2504, 49407, 1131, 1]
    assert found == {
        i: own.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)
    }


def test_word_ids_keep_repeated_words_and_equal_the_library(library):
    store = WordIds(WORD_BPE, limit=100)
    rng = np.random.default_rng(5)
    common = ["".join(rng.choice(list("abcé1'"), 6)) for _ in range(15)]
    for turn in range(6):
        texts = [" ".join([*common, f"it's-x{turn}y{i}(z) Q{turn}q{i}"]) for i in range(20)]
        for text, ids in zip(texts, store.encode(texts), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert {w.encode() for w in common} <= store.places.keys()
        assert len(store.places) <= store.limit


def test_agenda_equals_the_library():
    codec = Codec(PIECES)
    chance = random.Random(1)
    signs = "ab e\n▁thin ering  é😀.,0%#"
    texts = ODD + ["".join(chance.choices(signs, k=chance.randint(0, 30))) for _ in range(3000)]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids == codec.library.encode(text or ""), text


def test_sentencepiece_rows(spark):
    codec = Codec(PIECES)
    for r in round_trip(frame(spark, ODD), PIECES, with_ids=True).collect():
        ids = codec.library.encode(ODD[r.doc_id] or "")
        joined = ",".join(map(str, ids)).encode()
        assert (list(r.ids), r.n_tokens) == (ids, len(ids))
        assert r.ids_sha256 == hashlib.sha256(joined).hexdigest()
        decoded = codec.library.decode(ids) if ids else ""
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert round_trip(frame(spark, []).limit(0), PIECES).collect() == []


def languages(n):
    chance = random.Random(2)
    sounds = {"aa": ["ba", "na", "ta"], "bb": ["pö", "zü", "kö"]}
    return [
        (k, " ".join("".join(chance.choices(sounds[lang], k=4)) for _ in range(20)), lang)
        for k in range(n)
        for lang in [("aa", "bb")[k % 2]]
    ]


def test_language_id_learns_and_rejects(spark):
    rows = languages(80)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    odd = [(900, None), (901, ""), (902, "123 !?"), (None, "bana"), (None, "bana")]
    asked = spark.createDataFrame([(k, t) for k, t, _ in rows] + odd, "doc_id long, text string")
    found = langid.predict(asked, model).collect()
    assert len(found) == len(rows) + 5
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[k].lang_pred == lang for k, _, lang in rows)
    assert {by_id[k].lang_pred for k in (900, 901, 902)} == {"und"}
    assert all(0 <= r.score <= 1 for r in found)
    assert langid.keep_identified(asked, model).count() == len(rows) + 2


def test_language_id_without_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert langid.predict(df, model).collect() == []
    one = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert langid.predict(one, model).first().lang_pred == "und"


def test_toxicity_finds_planted_words(spark):
    chance = random.Random(4)
    plain = ["".join(chance.choices("abcdefgh", k=5)) for _ in range(500)]
    rows, labels = [], []
    for k in range(400):
        words = chance.choices(plain, k=60)
        if k % 4 == 0:
            words[k % 60] = chance.choice(["rotten", "vileness"])
        rows.append((k, " ".join(words), "xx"))
        labels.append((k, int(k % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = spark.createDataFrame(labels + labels[:5] + [(None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(df, known.where("doc_id < 300"))
    scores = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    wrong = [k for k, y in labels if k >= 300 and (scores[k] >= 0.3) != (y == 1)]
    assert len(wrong) <= 2
    odd = [(None, None), (None, ""), (1, "x " * 40_000)]
    odd = spark.createDataFrame(odd, "doc_id long, text string")
    assert all(0 <= r.score <= 1 for r in toxicity.score(odd, model).collect())
    kept = {r.doc_id for r in toxicity.keep_clean(df, model).collect()}
    assert len(kept & {k for k, y in labels if y}) <= 2 and len(kept) >= 295


def test_toxicity_answers_to_the_share_of_all_rows(spark):
    chance = random.Random(12)
    plain = ["".join(chance.choices("abcdefgh", k=5)) for _ in range(300)]
    rows, labels = [], []
    for k in range(3000):
        words = chance.choices(plain, k=20)
        toxic = k % 10 == 0
        if toxic or k % 10 == 1:  # half of the rows with the word are toxic
            words[k % 20] = "rotten"
        rows.append((k, " ".join(words), "xx"))
        labels.append((k, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    for per_class in (100, 3000):
        model = toxicity.fit(df, known, per_class=per_class)
        scores = np.array([r.score for r in toxicity.score(df, model).collect()])
        assert abs(scores.mean() - 0.1) < 0.03, per_class
        assert set(model.thresholds) == {"xx"}


def test_thresholds_from_counts_equal_those_of_rows():
    random_ = np.random.default_rng(1)
    scores = np.round(random_.random(400), 2)
    y = (random_.random(400) < scores).astype(np.int64)
    cuts = np.unique(scores)
    f1 = [2 * y[scores >= c].sum() / ((scores >= c).sum() + y.sum()) for c in cuts]
    cut = toxicity.best_threshold(scores, y, np.ones(400))
    assert np.isclose(2 * y[scores >= cut].sum() / ((scores >= cut).sum() + y.sum()), max(f1))
    pairs, n = np.unique(np.stack([scores, y]), axis=1, return_counts=True)
    assert toxicity.best_threshold(pairs[0], pairs[1], n) == cut


def test_toxicity_without_labels(spark):
    df = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert 0 <= toxicity.score(df, toxicity.fit(df, none)).first().score <= 1


def test_patience_alignment():
    a, b = "x the quick brown fox y jumps the end".split(), "the quick red fox jumps end".split()
    pairs = licenses.align(a, b)
    assert [a[i] for i, _ in pairs] == ["the", "quick", "fox", "jumps", "end"]
    assert licenses.increasing([(0, 3), (1, 1), (2, 2), (3, 0), (4, 5)]) == [(1, 1), (2, 2), (4, 5)]


def test_license_scan(spark):
    texts = [
        "foo\nReleased under the MIT License.\nbar Released under the MIT License.",
        "Licensed under the APACHE license -- version 2.0!",
        "the license of the work",
        None,
        "",
        "word " * 50_000 + "This work is licensed under the GNU General Public License, version 3.",
    ]
    found = {r.doc_id: r for r in licenses.scan(frame(spark, texts)).collect()}
    assert found[0].matches == "MIT:1:6,MIT:7:12" and found[0].n_matches == 2
    assert (found[1].license, found[1].coverage) == ("Apache-2.0", 1.0)
    assert [found[k].license for k in (2, 3, 4)] == [None] * 3
    assert found[5].license == "GPL-3.0" and found[5].matches.startswith("GPL-3.0:50000:")


def test_license_names_and_whole_texts(spark):
    t = licenses.TEMPLATES
    gpl = t["GPL-3.0-header"]
    broken = t["MIT-text"].replace("THE SOFTWARE IS", "Copyright 2020 somebody of that name. THE SOFTWARE IS")
    expected = [
        ("Released under the BSD License.", "BSD"),
        ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
        ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
        ("Licensed under CC BY-NC 2.5.", None),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
        ("This work is licensed under the GNU Library General Public License, version 3.", None),
        ("Released under the XYZ License.", None),
        ("Licensed under the Apache License, Version 1.1.", None),
        (gpl, "GPL-3.0-header"),
        (gpl.replace("version 3", "version 2"), "GPL-2.0-header"),
        (t["LGPL-2.1-header"], "LGPL-2.1-header"),
        ("the of this and in a work " * 9 + broken, "MIT-text"),
        (t["BSD-2-Clause-text"], "BSD-2-Clause-text"),
        (t["BSD-3-Clause-text"], "BSD-3-Clause-text"),
        (t["ISC-text"], "ISC-text"),
        (t["MPL-2.0-header"], "MPL-2.0-header"),
    ]
    found = {r.doc_id: r for r in licenses.scan(frame(spark, [x for x, _ in expected])).collect()}
    for k, (text, name) in enumerate(expected):
        assert found[k].license == name, (text, found[k])
    assert all(found[k].coverage == 1.0 for k in (9, 10, 11, 12, 13, 14, 15, 16))
    names = list(t)
    whole = {r.doc_id: r.license for r in licenses.scan(frame(spark, [t[n] for n in names])).collect()}
    assert {names[k]: name for k, name in whole.items()} == {n: n for n in names}
