"""Alignment against plain merges of each text, and its steps on their own."""

import collections
import hashlib
import random

import numpy as np
import pytest
from public_tokenizers import PATTERN

from sensorflow.llm import queries
from sensorflow.llm.alignment import Tokens, align, lockstep

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_a string, groups int, block string"


@pytest.fixture(scope="module")
def paths():
    from public_tokenizers import path
    return path("byte_bpe_50k.json"), path("piece_bpe_32k.model")


def plain(texts, paths):
    """Columns for each text by nested loops over whole encodings."""
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in shown]
    letter = {chr(x): x for x in shown} | {chr(256 + n): x for n, x in enumerate(rest)}
    found = []
    for text in texts:
        whole = (" " + text).encode() if text else b""
        ids = ([], []) if not text else (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text))
        parts = ([bytes(letter[c] for c in a.id_to_token(i)) for i in ids[0]],
                 [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                  for i in ids[1]])
        if b"".join(parts[0]) != whole or b"".join(parts[1]) != whole:
            ids, parts = ([], []), ([], [])
        ends = [np.cumsum([0, *map(len, p)]).tolist() for p in parts]
        links, groups = [], []
        for i, x in enumerate(ids[0]):
            for j in range(np.searchsorted(ends[1], ends[0][i], "right") - 1, len(ids[1])):
                if ends[1][j] >= ends[0][i + 1]:
                    break
                links.append((x, ids[1][j]))
        cuts = sorted(set(ends[0]) & set(ends[1]))
        for lo, hi in zip(cuts, cuts[1:]):
            groups.append("|".join(",".join(str(t) for t, e in zip(side, end) if lo <= e < hi)
                                   for side, end in zip(ids, ends)))
        found.append((len(ids[0]), len(ids[1]), len(groups), links, ";".join(groups)))
    count = collections.Counter(x for f in found for x in f[3])
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    return [(n_a, n_b, n_g, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(groups.encode()).hexdigest() if groups else "", groups)
            for n_a, n_b, n_g, links, groups in found]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_equals_plain_merges(spark, paths):
    docs = queries.documents(spark, SF).orderBy("doc_id").collect()
    want = plain([d["text"] for d in docs], paths)
    got = {r["doc_id"]: r for r in queries.op13_alignment(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, w in zip(docs, want):
        assert tuple(got[d["doc_id"]][c] for c in COLUMNS) == w[:-1]


ODD = [None, "", " ", "a", "  two  spaces ", "▁", "mark ▁ inside", "<|endoftext|> <s> </s> <0x41>", "tab\tline\nfeed\r\n",
       "日本語のテキスト", "é combining", "😀 emoji 👩‍👩‍👧", "x" * 3000, "don't we'll", "ﬁ ligature", "\x00 nul", "  ",
       "same text", "same text", "12345 67.89", "ÀÉÎ été", "a" + " " * 50 + "b"]


def test_odd_texts_repeated_rows_and_clashing_names(spark, paths):
    rng = random.Random(5)
    odd = ODD + ["".join(rng.choice("ab é\n.1▁<>") for _ in range(rng.randrange(40))) for _ in range(60)]
    rows = [(i if i % 7 else None, t, "a", 1, "b") for i, t in enumerate(odd)] + [(3, "a", "a", 1, "b")] * 2
    got = align(spark.createDataFrame(rows, DOCS).repartition(3), *paths, pattern=PATTERN, keep=True).collect()
    want = plain([r[1] for r in rows], paths)
    key = [(r[0], *w) for r, w in zip(rows, want)]
    assert sorted(map(repr, key)) == sorted(repr((r["doc_id"], *(r[c] for c in COLUMNS), r["groups"])) for r in got)


def test_empty_table(spark, paths):
    assert align(spark.createDataFrame([], DOCS), *paths).count() == 0
    assert align(spark.createDataFrame([(1, None, "", 0, "")], DOCS), *paths).first()["count_sum"] == 0


def test_long_texts_in_parts(paths):
    tokens = Tokens(*paths, PATTERN)
    assert tokens.ranked
    rng = random.Random(8)
    text = "".join(rng.choice(["word", " ", "  ", "é", ".\n", " the", "\t", "x"]) for _ in range(200_000))
    assert len(text) > 1 << 18
    a, b = tokens.ids(text)
    assert a == tokens.a.encode(" " + text, add_special_tokens=False).ids
    assert b == tokens.b.encode(text)


def test_both_libraries_give_the_same_ids_of_plain_texts(paths):
    tokens, rng = Tokens(*paths, PATTERN), random.Random(12)
    marks = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xa1, 0xad), *range(0xae, 0x180), *range(0x2010, 0x2028)]]
    words = ["don't", "we'll", "THE", " the", "1234", "ß", "naïve", "<|endoftext|>", "   ", "\n\n", "…", "!!", "x" * 40]
    for _ in range(3000):
        text = "".join(rng.choice(words) if rng.random() < 0.5 else rng.choice(marks) for _ in range(rng.randrange(40)))
        assert tokens.ids_a(text) == tokens.a.encode(text, add_special_tokens=False).ids


def test_lockstep_emits_each_overlap_once():
    rng = np.random.default_rng(3)
    ends, firsts, stops, base = ([], []), ([], []), ([], []), 0
    want = set()
    for _ in range(40):
        size = int(rng.integers(0, 30))
        sides = [np.unique(np.r_[rng.integers(1, size + 1, size // 2), size]) if size else np.zeros(0, int) for _ in "ab"]
        at = [len(e) for e in ends]
        for k in (0, 1):
            firsts[k].append(at[k])
            ends[k].extend(base + sides[k])
            stops[k].append(len(ends[k]))
        spans = [list(zip(np.r_[0, s][:-1], s)) for s in sides]
        want |= {(at[0] + i, at[1] + j) for i, (x, y) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1])
                 if max(x, u) < min(y, v)}
        base += size
    arrays = [np.array(x) for x in (*ends, *firsts, stops[0])]
    link_a, link_b, cut_a, cut_b = lockstep(*arrays)
    assert sorted(zip(link_a, link_b)) == sorted(want) and len(link_a) == len(want)
    assert sorted(arrays[0][cut_a]) == sorted(set(ends[0]) & set(ends[1])) == sorted(arrays[1][cut_b])
