"""Operators against plain versions on the smallest tables."""

import collections
import hashlib
import re
import zlib

import pytest

from sensorflow.llm import queries

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return queries.documents(spark, SF).collect()


def near_components(docs, k, percent=80):
    """Component of each document: all pairs that share a shingle, exactly."""
    sets, by = {}, collections.defaultdict(list)
    for doc, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
        sets[doc] = {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())
        for x in sets[doc]:
            by[x].append(doc)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for doc, own in sets.items():
        for other, common in collections.Counter(y for x in own for y in by[x] if y < doc).items():
            if 100 * common >= percent * (len(own) + len(sets[other]) - common):
                a, b = sorted((find(doc), find(other)))
                parent[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def check_packing(rows, docs, limit=4096):
    from public_tokenizers import path
    from tokenizers import Tokenizer
    tokenizer, want = Tokenizer.from_file(path("word_bpe_49k.json")), {}
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), limit):
            cut = ids[at: at + limit]
            want[doc, at // limit] = (at, len(cut), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in cut)))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= limit
    total = sum(r["length"] for r in rows)
    assert len(bins) <= -(-total // limit) * 1.02 + 1


def test_op3_equals_the_library(spark, docs):
    import sentencepiece
    from public_tokenizers import path
    lib = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in queries.op3_piece_codec(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = lib.encode(d["text"] or "", add_bos=True, add_eos=True)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_op4_equals_grouping(spark, docs):
    by = collections.defaultdict(list)
    for d in docs:
        by[(d["text"] or "").translate(LOW)].append(d["doc_id"])
    want = {(i, max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest())
            for t, ids in by.items() for i in ids}
    assert {tuple(r) for r in queries.op4_exact_dedup(spark, SF).collect()} == want


def test_op5_recovers_all_differences(spark, docs):
    def paragraphs(t):
        return {p for p in re.split(r"\n|(?<=[.!?])\s+", t) if p}

    def like(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    got = {r["doc_id"]: r for r in queries.op5_fingerprints(spark, SF).collect()}
    rows = sorted((d["doc_id"], d["text"] or "") for d in docs)
    prints = {}
    for i, (doc, text) in enumerate(rows):
        n, after = len(text), rows[(i + 1) % len(rows)][1]
        edited = text[: n - n // 4] + after[: n // 4]
        r = got[doc]
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(like(paragraphs(text), paragraphs(edited)))
        assert r["near_next"] == pytest.approx(like(paragraphs(text), paragraphs(after)))
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]


def test_op6_equals_full_recount(spark, docs):
    from public_tokenizers import PATTERN, path
    from sensorflow.llm.token_counts import Counter
    count = lambda t, c=Counter(path("byte_bpe_50k.tiktoken"), PATTERN): len(c.encoding.encode_ordinary(t))
    got = {r["doc_id"]: r for r in queries.op6_token_counts(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        text, r = d["text"] or "", got[d["doc_id"]]
        n = len(text)
        edited = text[: n // 5] + text[n // 5 + 12:]
        edited = edited[: n // 2] + f" (see: {text[:20]})" + edited[n // 2:] + "\nRevised."
        assert (r["n_tokens"], r["edited_n_tokens"]) == (count(text), count(edited))
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_op7_pieces_and_sequences(spark, docs):
    check_packing(queries.op7_packing(spark, SF).collect(), [(d["doc_id"], d["text"]) for d in docs])


def test_packing_merges_up_the_tree(spark, monkeypatch):
    from sensorflow.llm import packing
    monkeypatch.setattr(packing, "GROUP", 8)
    lengths = [(i, 1 + (i * 7919) % 60) for i in range(400)]
    rows = packing.pack(spark.createDataFrame(lengths, "item long, length long"), 100).collect()
    assert sorted(r["item"] for r in rows) == list(range(400))
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], dict(lengths)[r["item"]]))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 100
    first = -(-400 // 8)  # groups of 8 items fill badly on their own; merging must mend some of it
    alone = sum(len(packing.best_fit(sorted((n for i, n in lengths if i % first == g), reverse=True), 100)[2])
                for g in range(first))
    assert sum(n for _, n in lengths) / 100 <= len(bins) < 0.95 * alone


def test_op8_finds_every_notice(spark, docs):
    from sensorflow.llm.license_texts import TEMPLATES
    notices = {k: v for k, v in TEMPLATES.items() if k.endswith("notice")}
    got = {(r["doc_id"], r["template"], r["start"], r["end"]) for r in queries.op8_license_scan(spark, SF).collect()}
    want = {(d["doc_id"], k, m.start(), m.end() - 1) for d in docs for k, v in notices.items()
            for m in re.finditer(re.escape(v), d["text"] or "")}
    assert want <= got and {x[1] for x in got - want} <= {"Apache-2.0 header"}


def test_license_alignment_allows_changed_words():
    from sensorflow.llm.license_scan import LicenseIndex
    from sensorflow.llm.license_texts import TEMPLATES
    index = LicenseIndex(TEMPLATES)
    words = TEMPLATES["MIT text"].split()
    words[10] = "WHOEVER"
    del words[30:33]
    text = "Preface, unrelated. " + " ".join(words) + " More of the same text"
    (name, coverage, matched, total, start, end), = index.scan(text)
    assert name == "MIT text" and 0.9 < coverage < 1
    assert text[start:end].startswith("Permission is hereby") and text[start:end].endswith("of the Software")
    assert index.scan(" ".join(TEMPLATES["MIT text"].split()[:40])) == []


def test_op9_equals_all_pairs(spark, docs):
    want = near_components([(d["doc_id"], d["text"]) for d in docs], 4)
    got = queries.op9_near_dedup(spark, SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_dedup_finds_links_that_no_pivot_shows(spark, tmp_path):
    """Chains: each text is like its neighbours only, and one bucket holds many."""
    from sensorflow.llm import near_dedup as nd
    base = [f"w{i}" for i in range(200)]
    rows = []
    for c in range(60):
        words = list(base)
        for j in range(c * 2):
            words[(j * 13) % 200] = f"x{(j * 13) % 200}"
        rows.append((c, " ".join(words)))
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    got = nd.near_dedup(spark.read.parquet(path), shingle=4).collect()
    want = near_components(rows, 4)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_op10_cuts_follow_the_mixture(spark, docs):
    rows = queries.op10_sharding(spark, SF).collect()
    by_source = collections.defaultdict(list)
    for d in docs:
        key = hashlib.md5(f"17:{d['doc_id']}".encode()).hexdigest()
        by_source[d["source"]].append((key, d["doc_id"]))
    order = []
    for source, members in by_source.items():
        for rank, (key, doc) in enumerate(sorted(members), 1):
            order.append(((2 * rank - 1) / (2 * len(members)), key, doc))
    order = [doc for _, _, doc in sorted(order)]
    place = {doc: i for i, doc in enumerate(order)}
    n = len(order)
    for r in rows:
        shard = place[r["doc_id"]] * 16 // n
        assert (r["shard"], r["slot"]) == (shard, place[r["doc_id"]] - -(-shard * n // 16))
    text = {d["doc_id"]: (d["text"] or "").encode() for d in docs}
    assert all((r["size"], r["text_crc32"]) == (len(text[r["doc_id"]]) + 1, zlib.crc32(text[r["doc_id"]])) for r in rows)


def test_op1_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    langs = {d["doc_id"]: d["lang"] for d in queries.documents(spark, sf).collect()}
    rows = queries.op1_language_id(spark, sf).collect()
    held = [r for r in rows if r["held_out"] and langs[r["doc_id"]]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) / len(held) > 0.97


def test_language_mixture_proportions(spark):
    from sensorflow.llm import language_id
    sf = "/root/testdata/sf0.01"
    docs = queries.documents(spark, sf)
    model = language_id.fit(docs)
    text = {lang: docs.filter(f"lang = '{lang}' AND n_chars > 3000").orderBy("doc_id").first()["text"].split()
            for lang in ("en", "de")}
    mixed = " ".join(text["en"][:150] + text["de"][:50])
    (row,) = language_id.predict(spark.createDataFrame([(mixed,)], "text string"), model).collect()
    assert row["lang_mix"]["lang_pred"] == "en" and set(row["lang_mix"]["mixture"]) == {"en", "de"}
    assert row["lang_mix"]["mixture"]["de"] == pytest.approx(0.25, abs=0.08)


def test_op2_held_out(spark):
    sf = "/root/testdata/sf0.01"
    toxic = {r["doc_id"]: r["toxic"] for r in queries.labels(spark, sf).collect()}
    rows = queries.op2_toxicity(spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in toxic]
    pairs = [(a["score"] > b["score"]) + (a["score"] == b["score"]) / 2 for a in held for b in held
             if toxic[a["doc_id"]] == 1 and toxic[b["doc_id"]] == 0]
    assert sum(pairs) / len(pairs) > 0.9
    assert sum(r["predicted"] for r in held if toxic[r["doc_id"]] == 0) <= 1


def test_kneser_ney_log_ratios(spark):
    """The Spark model against the formulas written out for one n-gram."""
    import math
    from sensorflow.llm import toxicity
    rows = spark.createDataFrame([("ab ab ac", 1), ("ac ad", 0)], "text string, label int")
    ratios, histories = toxicity._ratios(rows, 2, 0.75, 1000)
    # history a: toxic b b c (3, 2 kinds), ordinary c d (2, 2 kinds)
    # shared: of the 9 kinds of bigrams, b, c, d end one each, a one, $ three
    kinds = {"^a": 1, "ab": 1, "ac": 1, "ad": 1, "b$": 1, "c$": 1, "d$": 1}
    ends = collections.Counter(g[1] for g in kinds)
    total, n = sum(ends.values()), len(ends)
    p = {x: (ends[x] - 0.75 + 0.75 * n * (1 / n)) / total for x in ends}
    toxic = (2 - 0.75) / 3 + 0.75 * 2 / 3 * p["b"]
    ordinary = 0 + 0.75 * 2 / 2 * p["b"]
    assert ratios["ab"] == pytest.approx(math.log(toxic / ordinary), rel=1e-5)
    assert histories["a"] == pytest.approx(math.log((0.75 * 2 / 3) / (0.75 * 2 / 2)), rel=1e-5)


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components(spark, kind):
    import random

    from sensorflow.llm.components import components
    random.seed(5)
    nodes = random.sample(range(10_000), 300)
    links = {"chain": list(zip(nodes, nodes[1:])), "star": [(max(nodes), n) for n in nodes if n != max(nodes)],
             "random": [tuple(random.sample(nodes, 2)) for _ in range(220)] + [(nodes[0], nodes[0])]}[kind]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == {x: find(x) for x in list(parent)}
