"""Grams are numbered and looked up in numpy, with the results of plain loops."""

import collections
import cProfile
import pstats
import random

import numpy as np

from sensorflow.llm import chargrams, language_id
from sensorflow.llm.chargrams import LETTERS, LONGEST_KEY, count_grams, grams, numbered_grams, portions

WORDS = ["the", "of", "Straße", "naïve", "x²", "123", "^", "$^", "a^b$c", "𐐀𐐁", "don't", "e-mail", "語", "İstanbul"]


def texts(n, seed):
    draw = random.Random(seed)
    return [" ".join(draw.choice(WORDS) + draw.choice(["", ",", "x"]) for _ in range(draw.randrange(1, 300))) for _ in range(n)]


def test_numbered_grams_are_the_grams():
    words = LETTERS.findall(" ".join(texts(40, 5)).lower()) + ["a", "a", "b" * (LONGEST_KEY + 9)]
    for order in (1, 2, 4, 5):
        names, numbers = numbered_grams(words, order)
        want = [g for w in words for g in grams(w, order)]
        assert [names[i] for i in numbers.tolist()] == want
        assert len(set(names)) == len(names)
        assert set(names) == {g[k:] for g in want for k in range(len(g) + 1)}
    assert numbered_grams([], 4)[0] == [""]


def test_portions_are_all_words_and_bounded(monkeypatch):
    monkeypatch.setattr(chargrams, "LETTERS_AT_ONCE", 20)
    words = ["a" * n for n in (1, 2, 3, 60, 18, 19, 1, 18, 5, 5)]
    found = [words[part] for part in portions(words)]
    assert sum(found, []) == words and all(p and (len(p) == 1 or sum(len(w) + 2 for w in p) <= 20) for p in found)
    assert len(found) == 7 and list(portions([])) == []


def test_counts_are_plain_counts(spark):
    rows = [(i % 2, t) for i, t in enumerate(texts(30, 11))] + [(None, "a"), (1, None), (0, "")]
    got = count_grams(spark.createDataFrame(rows, "label int, text string"), "text", "label", 4).collect()
    want = collections.Counter((label, g) for label, t in rows if label is not None and t is not None
                               for w in LETTERS.findall(t.lower()) for g in grams(w, 4))
    assert {(r["label"], r["gram"]): r["n"] for r in got} == want and len(got) == len(want)


def plain_words(rows, values, languages, order, chunks):
    out = np.full((len(chunks), languages), np.nan, np.float32)
    for k, chunk in enumerate(chunks):
        runs = LETTERS.findall(chunk)
        if runs:
            total = np.zeros(languages, np.float32)
            for gram in (g for run in runs for g in grams(run, order)):
                while gram and gram not in rows:
                    gram = gram[1:]
                if gram:
                    total = total + values[rows[gram]]
            out[k] = (total - total.max()) * np.float32(min(1.0, language_id.LONG_WORD / sum(map(len, runs))))
    return out


def model_of(words, order, languages=3):
    draw = np.random.default_rng(1)
    names = numbered_grams(words, order)[0][1:]
    values = draw.normal(-3, 1, (len(names), languages)).astype(np.float32)
    return names, values, language_id.LanguageModel([f"l{i}" for i in range(languages)], names, values, order, 2.0)


def test_words_back_off_to_the_longest_ending_known():
    known = LETTERS.findall(" ".join(texts(3, 6)).lower())
    chunks = sorted({*" ".join(texts(30, 7)).lower().split(), "thex", "zzz", "語", "語the", "the,of", "!!", "q" * 40, "жук"})
    for order in (1, 2, 4):
        names, values, model = model_of(known, order)
        got = model.words(chunks)
        want = plain_words({g: i for i, g in enumerate(names)}, values, 3, order, chunks)
        assert np.array_equal(np.isnan(got), np.isnan(want)) and np.isnan(got).any()
        assert np.allclose(got, want, atol=1e-5, equal_nan=True)
    assert language_id.LanguageModel(["l0"], [], np.zeros((0, 1), np.float32), 4, 2.0).words(["the", "1"])[0, 0] == 0


def test_words_make_no_python_call_for_a_letter():
    draw = random.Random(8)
    chunks = list({"".join(draw.choices("abcdefgh", k=draw.randrange(6, 16))) for _ in range(3000)})
    model = model_of(chunks[:1500], 4)[2]
    profile = cProfile.Profile()
    profile.runcall(model.words, chunks)
    assert pstats.Stats(profile).total_calls < 6 * len(chunks)  # 30 and more with a look-up a gram


def test_text_of_many_groups_is_solved_like_one(monkeypatch):
    """Words are numbered over all groups of documents; NULL, empty and letterless texts between them."""
    found = {}
    monkeypatch.setattr(language_id, "score_blocks", lambda df, table, text, out, kind, keys, scorer: found.update(keys=keys, scorer=scorer))
    language_id.predict(None, language_id.FittedLanguages(["l0", "l1", "l2"], None, 4, 2.0))
    documents = [*texts(60, 9), None, "", "123 ^ $", *texts(20, 10), "!"]
    names, values, _ = model_of(LETTERS.findall(" ".join(t or "" for t in documents[:40]).lower()), 4)
    assert found["keys"](set(LETTERS.findall(" ".join(documents[:40]).lower()))) == set(names)
    whole = found["scorer"](list(names), values)(documents)
    monkeypatch.setattr(language_id, "BLOCK_WORDS", 500)
    monkeypatch.setattr(chargrams, "LETTERS_AT_ONCE", 50)
    assert found["scorer"](list(names), values)(documents) == whole
    assert [p["lang_pred"] for p in whole[60:63]] == ["und"] * 3 and whole[0]["lang_pred"] != "und" and whole[-1]["score"] == 0
