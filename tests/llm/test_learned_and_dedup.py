"""Near duplicates, line templates, embeddings, language ID and the pipeline against brute force."""

import math
import random
import time
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from concord.llm import components, embedding_dedup, language_id, line_dedup, minhash


def closure(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(0, 120)] + [(500, k) for k in range(501, 620)] + [(rnd.randrange(1000, 1200), rnd.randrange(1000, 1200)) for _ in range(120)] + [(7, 7), (-5, 3)]
    rnd.shuffle(links)
    df = spark.createDataFrame([*links, (None, 4)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(df, "a", "b").collect()}
    want = closure({n for x in links for n in x}, links)
    joined = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: want[n] for n in joined}
    assert components.connected_components(df.limit(0), "a", "b").count() == 0


def words(rnd, n):
    return [rnd.choice(WORDS) for _ in range(n)]


WORDS = ["".join(random.Random(i).choice("etaoinshrdlu") for _ in range(2 + i % 7)) for i in range(4000)]


def near_copies():
    rnd = random.Random(9)
    texts = [None, "", "  \n", "one", "one", "two words", "one two three four", "one two three four"]
    for _ in range(60):
        base = words(rnd, rnd.randrange(30, 200))
        texts.append(" ".join(base))
        for _ in range(rnd.randrange(0, 4)):
            copy = list(base)
            for _ in range(rnd.randrange(0, 8)):
                copy[rnd.randrange(len(copy))] = rnd.choice(WORDS)
            texts.append(rnd.choice([" ", "\n", "  "]).join(copy))
    base = words(rnd, 300)
    for k in range(150):  # a large group: some hundred different texts that are near copies
        copy = list(base)
        copy[k] = "changed"
        texts.append(" ".join(copy))
    return texts


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_near_duplicates_equal_brute_force(spark):
    texts = near_copies()
    sets = [shingles(t or "") for t in texts]
    links = [(i, j) for i, j in combinations(range(len(texts)), 2) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = closure(range(len(texts)), links)
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words int, rep string").repartition(5)
    # small blocks, so that groups span several
    for block in (256, 16):
        got = {r["doc_id"]: r for r in minhash.near_duplicate_classes(docs, block=block).collect()}
        assert {i: r["class_id"] for i, r in got.items()} == want
        assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got.values())
    kept = minhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(want.values())
    assert minhash.near_duplicate_classes(docs.limit(0)).count() == 0


def test_near_duplicates_with_repeated_passages(spark):
    rnd, texts = random.Random(41), []
    for times in (20, 100, 1000):
        for _ in range(12):
            w = [f"v{rnd.randrange(10**7)}" for _ in range(204)]
            texts += [" ".join(w), " ".join(w[:100] + w[60:100] * times + w[100:])]
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i, j in combinations(range(len(texts)), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert len(links) == len(texts) // 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicate_classes(docs).collect()}
    assert got == closure(range(len(texts)), links)


def test_near_duplicates_that_do_not_link_with_the_least(spark):
    rnd, texts = random.Random(43), []
    for _ in range(6):  # chains: each text is a near copy of the one before, and soon none of the first
        w = [f"c{rnd.randrange(10**7)}" for _ in range(200)]
        for _ in range(25):
            texts.append(" ".join(w))
            for _ in range(3):
                w[rnd.randrange(200)] = f"c{rnd.randrange(10**7)}"
    for _ in range(4):  # the least one is far from all the others, which are near each other
        w = [f"d{rnd.randrange(10**7)}" for _ in range(160)]
        texts.append(" ".join(w[:125] + [f"d{rnd.randrange(10**7)}" for _ in range(35)]))
        for _ in range(40):
            copy = list(w)
            copy[rnd.randrange(160)] = "changed"
            texts.append(" ".join(copy))
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i, j in combinations(range(len(texts)), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    # every row twice, one id with two texts, a null id
    rows = [*enumerate(texts), *enumerate(texts), (900, texts[0] + " x"), (900, "quite another text of its own that is no copy"), (None, texts[3])]
    docs = spark.createDataFrame([(*r, 5, "clash") for r in rows], "doc_id long, text string, rep int, band string").repartition(7)
    want = closure([*range(len(texts)), 900], [*links, (0, 900)])
    for block in (128, 8):
        got = minhash.near_duplicate_classes(docs, block=block).collect()
        assert len(got) == len(rows) - 1
        assert {r["doc_id"]: r["class_id"] for r in got} == want


def test_near_dedup_keeps_other_texts_of_an_id(spark):
    rnd = random.Random(31)
    a, b, c, d = (" ".join(f"{x}{rnd.randrange(10**6)}" for _ in range(80)) for x in "abcd")
    rows = [(3, a), (5, a), (5, b), (6, c), (6, f"{b} more"), (None, a), (7, d), (7, d), (8, None), (8, f"{d} end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(map(tuple, minhash.near_dedup(docs).collect()))
    assert got == Counter(r for r in rows if r not in [(5, a), (6, f"{b} more"), (8, f"{d} end")])


def test_probminhash_estimates_weighted_similarity():
    rnd = np.random.default_rng(3)
    ids = rnd.integers(0, 1 << 62, 60).astype(np.uint64)
    w = rnd.uniform(0.2, 5, (2, 60)) * (rnd.random((2, 60)) < 0.8)
    doc, at = np.nonzero(w)
    sig = minhash.signatures(doc, ids[at], w[doc, at], 2, 8192)
    want = sum(1 / np.maximum(w[0] / w[0, d], w[1] / w[1, d]).sum() for d in np.flatnonzero((w[0] > 0) & (w[1] > 0)))
    assert (sig[0] == sig[1]).mean() == pytest.approx(want, abs=0.03)


def test_word_hashes_follow_white_space():
    texts = ["a  b\tc\n", "", " ", "é x" * 50, "a b c"]
    h, n = minhash.word_hashes([t.encode() for t in texts])
    assert n.tolist() == [len(t.split()) for t in texts]
    assert h[:3].tolist() == h[-3:].tolist()


def test_a_language_of_few_repeated_texts_is_learned(spark):
    kept = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rnd = random.Random(2)
    many = [(kept[k], "aa", " ".join(rnd.choice(["the", "and", "house", "of"]) for _ in range(12))) for k in range(400)]
    few = [(kept[500 + k], "bb", text) for k, text in enumerate(["quelle heure est il donc", "nous ne savons pas ou aller", "une maison verte et bleue"]) for _ in range(4000)]
    docs = spark.createDataFrame(many + few, "doc_id long, lang string, text string").repartition(4)
    net = language_id.fit_language_model(docs, steps=2)
    assert list(net.labels) == ["aa", "bb"]
    with pytest.raises(ValueError, match="languages"):
        language_id.fit_language_model(docs.withColumn("lang", F.uuid()), steps=2)


def plain_lines(texts, min_docs, share=0.001, long_words=50, copied=0.25):
    """Templates as tuples: which lines go, by document.

    A template is a line with some tokens open: all that hold a digit, and at most one of four segments
    behind the first three tokens.  Three of its tokens, and half of them, must be words (letters, no digit).
    """
    digit, word = lambda t: any(c.isdigit() for c in t), lambda t: any(c.isalpha() for c in t) and not any(c.isdigit() for c in t)

    def paths(line):
        raw = line.split()
        n = len(raw)
        out = {}
        fits = lambda tokens: sum(t is not None and word(t) for t in tokens) >= max(3, n / 2)
        sure = lambda tokens: sum(t is not None and word(t) for t in tokens) >= 12
        if fits(raw) or n >= long_words:
            out["as it stands", *raw] = sure(raw) or n >= long_words
        open_ = [None if digit(t) else t for t in raw]
        if not fits(open_):
            return out
        if None in open_:
            out["open", *open_] = sure(open_)
        if n >= 5:
            step = math.ceil((n - 3) / 4)
            for start in range(3, n, step):
                tokens = [*open_[:start], None, *open_[start + step :]]
                if fits(tokens):
                    out["segment", n, start, *tokens] = sure(tokens)
        return out

    lines = {i: [paths(x) for x in (t or "").split("\n")] for i, t in texts.items()}
    where, certain = {}, {}
    for i, found in lines.items():
        for p in found:
            for path, sure in p.items():
                where.setdefault(path, set()).add(i)
                certain[path] = certain.get(path, False) or sure
    many = max(min_docs, math.ceil(share * len(texts)))
    recurs = {p for p, docs in where.items() if len(docs) >= (min_docs if certain[p] else many)}
    out = {}
    for i, found in lines.items():
        elsewhere = [{p for p in ps if min(where[p]) != i} for ps in found]
        size = [next((len(p) - 1 for p in ps if p[0] == "as it stands"), 0) for ps in found]
        shared = {k for k, ps in enumerate(elsewhere) for p in ps if p[0] == "as it stands" and p not in recurs and 2 <= len(where[p]) < min_docs}
        few = {k for k in shared if size[k] >= long_words} if sum(size[k] for k in shared) < copied * sum(size) else set()
        out[i] = {k for k, ps in enumerate(elsewhere) if ps & recurs} | few
    return out


def test_lines_equal_a_plain_restatement(spark):
    rnd = random.Random(11)
    boiler = ["all rights reserved by the owner in 2021 and later", "all rights reserved by the owner in 1999 and later", "please read the terms of use before you go on to read"]
    passage = " ".join(words(rnd, 55))
    texts = {0: None, 1: "", 2: "short line"}
    for i in range(3, 80):
        lines = [" ".join(words(rnd, rnd.randrange(1, 20))) for _ in range(rnd.randrange(1, 6))]
        if i % 3:
            lines.insert(rnd.randrange(len(lines) + 1), rnd.choice(boiler))
        if i % 4 == 0:
            lines.append(f"hello dear reader your name is {rnd.choice(WORDS)} and here is what we wrote")
        if i % 5 == 0:
            lines += ["see below", "All rights reserved.", " ".join(words(rnd, 260))]
        if i in (7, 19, 31, 45, 60, 61):  # a passage in few documents: it goes where it is a small part, as in 45 and 60
            lines += [passage, *([" ".join(words(rnd, 300))] if i > 40 else [])]
        texts[i] = "\n".join(lines)
    texts |= {100: texts[45], 101: texts[60] + "\nand one more line", 102: None, 103: "see below", 104: "\n\n \n"}
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in texts.items()], "doc_id long, text string, lines string, n_lines int")
    drop = plain_lines(texts, 6)
    assert sum(map(len, drop.values())) > 40
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs, rules=line_dedup.Rules(min_docs=6)).collect()}
    assert len(got) == len(texts)
    for i, t in texts.items():
        kept = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop[i])
        assert (got[i]["text"], got[i]["n_dropped"]) == (kept, len(drop[i])), i
        assert got[i]["n_lines"] == (0 if t is None else t.count("\n") + 1)
    # a line stays in the first document that has it; two words are no template
    assert sum(boiler[2] in (r["text"] or "") for r in got.values()) == 1
    assert sum("All rights reserved." in (r["text"] or "").split("\n") for r in got.values()) == 1
    assert sum("see below" in (r["text"] or "").split("\n") for r in got.values()) == sum("see below" in (t or "").split("\n") for t in texts.values())
    assert passage not in got[45]["text"] and passage not in got[60]["text"] and passage in got[7]["text"]
    # copies of documents are left to the comparison of documents
    assert got[101]["text"].count("\n") == texts[101].count("\n") - got[101]["n_dropped"] and len(got[101]["text"]) > 0.8 * len(texts[101])
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


LICENSE = ["Licensed under the terms of the common license, version 2.0", "All rights reserved.", "You may not use this file except in compliance with the license, a copy of which is at example.org"]
CLEAN = ["if (a) {", "x = 3", "}", "return 0;", "21 40 9", "1.5 2.25 3 4 5 6", "And.", "To be.", "| 12 | 7 | ok |", "", "---", "total 5", "for (;;)"]


@pytest.mark.parametrize(("n", "licensed"), [(10, 10), (10_000, 40)])
def test_clean_lines_stay(spark, n, licensed):
    """Code, tables of numbers and one-word lines stay in every document; license lines go from all but the first."""
    def text(i):
        row = " ".join(str(i * 60 + k) for k in range(60))  # a long row of numbers, unlike in every document
        return "\n".join([*(LICENSE if i < licensed else []), *CLEAN, f"{chr(97 + i % 26) * 3} {i} {i * 17 % 1009} {i * 31 % 2003}", row, " ".join(words(random.Random(i), 30))])

    docs = spark.createDataFrame([(i, text(i)) for i in range(n)], "doc_id long, text string").repartition(4)
    for r in line_dedup.dedup_lines(docs).collect():
        want = text(r["doc_id"]) if r["doc_id"] == 0 else text(r["doc_id"]).removeprefix("\n".join(LICENSE) + "\n")
        assert r["text"] == want, r["doc_id"]


def test_lines_of_few_words_need_a_share_of_all_documents(spark):
    phrase, sentence = "Thank you very much", "Please send all your questions to the office in the main building of the school"
    texts = [f"{phrase}\n{sentence}" if i < 20 else " ".join(words(random.Random(i), 9)) for i in range(2500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for share, kept in ((0.01, 20), (0.005, 1)):
        out = line_dedup.dedup_lines(docs, rules=line_dedup.Rules(share=share)).filter("doc_id < 20")
        assert out.filter(F.col("text").contains(phrase)).count() == kept and out.filter(F.col("text").contains(sentence)).count() == 1


def test_lines_of_null_and_repeated_ids(spark):
    rows = [(None, "a b c\nx"), (None, "a b c\ny"), (3, "a b c\nz"), (3, "a b c\nq"), (4, "a b c\nr"), (5, "t\na b c")]
    docs = spark.createDataFrame([(*r, 0, [1]) for r in rows], "doc_id long, text string, n_dropped int, __x array<int>").repartition(3)
    got = Counter((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs, rules=line_dedup.Rules(min_docs=3)).collect())
    assert got == Counter([*rows[:4], (4, "r"), (5, "t")])


def test_texts_of_many_lines_take_time_in_proportion(spark):
    def seconds(n):
        each = lambda k: "\n".join(f"{chr(97 + i % 23)} {chr(97 + i % 19)} {chr(97 + i % 17)}" if i % 2 else f"own {'o' * k} line {chr(97 + i % 26) * (i % 50)} {chr(97 + i % 25) * (i // 50 % 60)}" for i in range(n))
        docs = spark.createDataFrame([(k, each(k)) for k in range(11)], "doc_id long, text string").repartition(4)
        began = time.perf_counter()
        out = line_dedup.dedup_lines(docs).agg(F.sum("n_dropped"), F.sum(F.length("text"))).first()
        assert out[0] == 10 * (n // 2) and out[1] > 11 * n
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(100_000) < 20


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(250, 32))
    near = base[:120] + rng.normal(size=(120, 32)) * 0.18
    tight = base[0] + rng.normal(size=(300, 32)) * 0.05  # one dense group
    x = np.concatenate([base, near, tight, base[:20], 3 * base[20:25]])
    rows = [(i, v.tolist(), int(i % 2) if i < 370 else 0, 1) for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 32, [math.nan] * 32, [None] + [1.0] * 31, [math.inf] + [0.0] * 31]
    rows += [(10_000 + i, v, 0, 1) for i, v in enumerate(odd)] + [(20_000, x[0].tolist(), None, 1), (20_001, x[0].tolist(), None, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, rep int").repartition(3)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows[: len(x)]])
    link = (u @ u.T >= 0.93) & (label[:, None] == label) & ~np.eye(len(x), dtype=bool)
    want = closure(range(len(x)), zip(*np.nonzero(link), strict=True))
    for block in (256, 20):
        got = {r["vec_id"]: r for r in embedding_dedup.embedding_classes(df, block=block).collect()}
        assert len(got) == len(rows)
        found = sum(got[i]["n_links"] for i in range(len(x)))
        assert all(got[i]["n_links"] <= link[i].sum() for i in range(len(x)))  # none below the threshold
        assert found >= 0.97 * link.sum()
        assert sum(got[i]["component_id"] == want[i] for i in range(len(x))) >= 0.99 * len(x)
        assert all(r["n_links"] == 0 and r["component_id"] == i and r["kept"] for i, r in got.items() if i >= 10_000)
    assert embedding_dedup.embedding_classes(df.limit(0)).count() == 0


@pytest.mark.parametrize("dense", [4096, 0])
def test_lists_own_the_pairs_of_their_pivots(monkeypatch, dense):
    monkeypatch.setattr(embedding_dedup, "DENSE", dense)
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, pivots = int(rng.integers(2, 30)), int(rng.integers(8, 30))
        near = np.array([rng.choice(pivots, 6, replace=False) for _ in range(n)]).astype(float)
        p, q = sorted(rng.choice(pivots, 2, replace=False))
        for row in near:  # all vectors of a list have its pivots
            row[:2] = [p, q]
        own = rng.integers(0, 2, n)
        want = [[i != j and own[i] != own[j] and not (set(near[i]) & set(near[j]) & set(range(q))) - {p} for j in range(n)] for i in range(n)]
        mine = embedding_dedup.owned(near, own, False, p, q)
        assert mine.tolist() == want
        m = rng.normal(size=(n, 3))
        u = m / np.linalg.norm(m, axis=1, keepdims=True)
        for some in (mine, mine & (np.arange(n) < 3)[:, None] & (np.arange(n) < 3)):
            assert embedding_dedup.linked(m, some, 0.5).tolist() == (some & (u @ u.T >= 0.5)).tolist()


def test_embeddings_of_repeated_and_missing_ids(spark):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(40, 16))
    rows = [(i, x.tolist(), 1) for i, x in enumerate(v)] + [(3, v[3].tolist(), 1), (None, v[5].tolist(), 1), (50, (v[7] * 2).tolist(), 1), (51, v[7].tolist(), 2), (52, None, 1), (52, v[9].tolist(), 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, list string").repartition(3)
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.embedding_classes(df).collect())
    assert len(rows) == got.total()
    assert got[3, 1, 3] == 2 and got[5, 1, 5] == 1 and got[7, 1, 7] == 1 and got[50, 1, 7] == 1 and got[51, 0, 51] == 1 and got[52, 0, 52] == 1 and got[52, 1, 9] == 1 and got[9, 1, 9] == 1
    assert sum(n for (i, _, _), n in got.items() if i is None) == 1


LANGUAGES = {"xx": "ka to ri mo sun tel", "yy": "éa üo ßi çu ñe", "zz": "sch ung keit ver ein"}


def language_rows(n):
    rnd = random.Random(13)
    rows = []
    for i in range(n):
        lang = rnd.choice([*LANGUAGES])
        rows.append((i, " ".join("".join(rnd.choice(LANGUAGES[lang].split()) for _ in range(rnd.randrange(1, 4))) for _ in range(rnd.randrange(3, 80))), lang))
    return rows


def test_language_id(spark):
    rows = language_rows(400)
    extra = [(1000, None, "xx"), (1001, "", "yy"), (1002, "12 34 !!", "zz"), (1003, "é" * 200_000, None), (None, "kato rimo", "xx")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows + extra], "doc_id long, text string, lang string, score double")
    net = language_id.fit_language_model(docs, per_language=60, steps=120)
    told = language_id.identify_languages(docs, net)
    assert told.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r["doc_id"]: r for r in told.withColumn("held", language_id.held_out(told["doc_id"])).collect()}
    held = [r for r in got.values() if r["held"] and r["doc_id"] is not None and r["doc_id"] < 1000]
    assert len(held) > 60
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert got[1003]["lang_pred"] in LANGUAGES
    assert all(0 <= r["score"] <= 1 for r in got.values())
    # without labels there is nothing to learn
    none = language_id.fit_language_model(docs.filter("lang is null"))
    assert none is None
    assert {r["lang_pred"] for r in language_id.identify_languages(docs.limit(3), none).collect()} == {"und"}


def test_gradients_are_those_of_the_loss():
    net = language_id.new_network(["a", "b", "c"], 3, 1)
    for p in net.parameters():
        p *= 0.5
    rng = np.random.default_rng(0)
    windows, target = rng.integers(0, 256, (6, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, grads = language_id.gradients(net, windows, target)
    for p, g in zip(net.parameters(), grads, strict=True):
        flat, k = p.reshape(-1), int(np.abs(g).argmax())
        old = flat[k]
        flat[k] = old + 1e-2
        up = language_id.gradients(net, windows, target)[0]
        flat[k] = old - 1e-2
        down = language_id.gradients(net, windows, target)[0]
        flat[k] = old
        assert (up - down) / 2e-2 == pytest.approx(float(g.reshape(-1)[k]), rel=0.05, abs=1e-4)


def test_windows_cover_every_position():
    net = language_id.new_network(["a", "b"], 4, 2)
    text = bytes(random.Random(1).randrange(97, 123) for _ in range(1000))
    whole = language_id.probabilities(language_id.forward(net, np.frombuffer(text, np.uint8)[:, None])[0]).mean(axis=(0, 1))
    assert language_id.label_texts(net, [text, b"", b"xy"], window=100, halo=30)[0] == pytest.approx(whole, abs=5e-3)


def test_production_windows_say_what_whole_texts_say():
    """A trained network, windows of 240 bytes that see 8 more on either side, against the same network over whole texts."""
    import pyarrow.parquet as pq

    rows = [r for r in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text", "lang"]).to_pylist() if r["lang"] and r["text"] and len(r["text"]) > 300]
    labels = sorted({r["lang"] for r in rows})
    train, held = rows[::2], rows[1::2][:60]
    windows = np.stack([np.frombuffer(r["text"].encode()[:64], np.uint8) for r in train])
    net = language_id.train(windows, np.array([labels.index(r["lang"]) for r in train]), labels, steps=150)
    texts = [r["text"].encode()[:6000] for r in held]
    whole = np.stack([language_id.probabilities(language_id.forward(net, np.frombuffer(t, np.uint8)[:, None])[0]).mean(axis=(0, 1)) for t in texts])
    cut = language_id.label_texts(net, texts)
    assert (whole.argmax(axis=1) == cut.argmax(axis=1)).mean() >= 0.98 and np.abs(whole - cut).mean() < 0.01


def test_predictions_do_not_depend_on_neighbours():
    net = language_id.new_network(["a", "b"], 4, 3)
    rnd = random.Random(2)
    texts = [bytes(rnd.randrange(97, 123) for _ in range(n)) for n in (3, 700, 41, 240, 250, 1)]
    together = language_id.label_texts(net, texts)
    assert all(language_id.label_texts(net, [t])[0] == pytest.approx(p, abs=1e-6) for t, p in zip(texts, together, strict=True))


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(21)
    langs = language_rows(120)
    rows = [(i, f"{t}\n{' '.join(words(rnd, 12))}", lang, f"s{i % 3}", len(t)) for i, t, lang in langs]
    rows = [(i, f"{t}\n{rnd.choice(['the terms of use apply', 'all rights reserved by us in 2020'])}" if i % 5 == 0 else t, *rest) for i, t, *rest in rows]
    rows += [(500 + k, rows[1][1], "xx", "s0", 3) for k in range(5)]
    rows += [(700 + k, "\n".join([rows[k][1].split("\n")[0] + " and one", rows[k][1].split("\n")[1]]), rows[k][2], "s1", 7) for k in range(6, 19, 3)] + [(600, "12345 678", "yy", "s1", 9), (601, None, "yy", "s1", None), (602, "", None, None, 0), (None, rows[3][1] + " and some more of it here", "xx", None, 5)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    docs, sizes, tables = spark.read.parquet(f"{folder}/documents.parquet"), [], []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        tables.append(docs.collect())
        out = stage(spark, docs, folder)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        sizes.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    _, told, lined, kept, mixed = tables
    # line dedup, restated
    drop = plain_lines({r["doc_id"]: r["text"] for r in told if r["doc_id"] is not None}, 10)
    want = Counter()
    for r in told:
        left = "\n".join(x for k, x in enumerate(r["text"].split("\n")) if k not in drop.get(r["doc_id"], ()))
        if left.strip() or not drop.get(r["doc_id"]):
            want[r["doc_id"], left, r["source"], len(left)] += 1
    assert sum(map(len, drop.values())) >= 12
    assert Counter((r["doc_id"], r["text"], r["source"], r["n_chars"]) for r in lined) == want
    # near duplicates, by all pairs
    sets = {r["doc_id"]: shingles(r["text"]) for r in lined if r["doc_id"] is not None}
    links = [(i, j) for i, j in combinations(sets, 2) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    classes = closure(sets, links)
    assert len(links) >= 10
    assert Counter(map(tuple, kept)) == Counter(tuple(r) for r in lined if r["doc_id"] is None or classes[r["doc_id"]] == r["doc_id"])
    # the mix: whole documents of the input, each source's words near its target, none more than three times
    words_of = Counter()
    for r in kept:
        words_of[r["source"]] += len(r["text"].split())
    order = sorted(words_of, key=lambda s: (s is None, s or ""))
    share, left = {s: 1 + i % 3 for i, s in enumerate(order)}, set(words_of)
    target, rest = {}, sum(words_of.values())
    while left:
        over = [s for s in left if rest * share[s] / sum(share[x] for x in left) > 3 * words_of[s]]
        if not over:
            target |= {s: rest * share[s] / sum(share[x] for x in left) for s in left}
            break
        target |= {s: 3 * words_of[s] for s in over}
        left, rest = left - set(over), rest - sum(3 * words_of[s] for s in over)
    taken, times = Counter(), Counter(map(tuple, mixed))
    for r in mixed:
        taken[r["source"]] += len(r["text"].split())
    assert set(times) <= set(map(tuple, kept)) and max(times.values()) <= 3
    longest = max(len(r["text"].split()) for r in kept)
    assert all(abs(taken[s] - target[s]) <= longest for s in words_of)
    # tokens, by the library
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert Counter((r["doc_id"], r["source"], r["n_tokens"], tuple(r["token_ids"])) for r in docs.collect()) == Counter((r["doc_id"], r["source"], len(ids), tuple(ids)) for r in mixed for ids in [library.encode(r["text"] or "", add_special_tokens=False).ids])
    assert sizes[0] == {r[0] for r in rows} - {600, 601, 602}
    assert None in sizes[3]
    assert sizes[2] <= sizes[1] - {500, 501, 502, 503, 504}
    assert sizes[4] == sizes[3] <= sizes[2]
    again = Counter((r["doc_id"], tuple(r["token_ids"])) for r in corpus_pipeline.run(spark, folder).collect())
    assert again == Counter((r["doc_id"], tuple(r["token_ids"])) for r in docs.collect())
    spark.createDataFrame([], spark.read.parquet(f"{folder}/documents.parquet").schema).write.parquet(f"{folder}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/empty").count() == 0
