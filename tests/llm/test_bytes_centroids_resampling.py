"""Byte-level BPE from ranks, clusters around centroids, importance resampling: against the library, and against plain restatements."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.errors import PySparkException

from concord.llm import byte_bpe, centroids, queries, resampling

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
NAN, INF = float("nan"), float("inf")
TEXTS = [
    None, "", " ", "\n\n  \t", "a", "é" * 40, "naïve café — 東京タワー 🙂🙃 👩‍👩‍👧", "it's we'LL I'm 'tis", "<|endoftext|> is text", "x" * 5000, "   leading and trailing   ", "1234567890 12 3", "ㅋㅋㅋㅋㅋㅋㅋ .......... ------ ====",
    "\u0085   odd spaces​", "same", "same", "a\x00b \x7f", "Ünïcödé wörds " * 300, "tab\tand  two  spaces \r\n ends", "ﬁ ½ ² ٣ x₁",
]


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.load(RANKS, public_tokenizers.PATTERN)


def test_ids_are_those_of_the_library_of_ranks(spark, library, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, n_tokens int, token_ids string").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter()
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), sha(",".join(map(str, ids))), sha(library.decode_bytes(ids))] += 1
    got = queries.op11_byte_bpe(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    assert sum(r["n_split"] for r in got) > 0
    assert byte_bpe.ranked_digests(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_known_words_are_looked_up(library, monkeypatch):
    """The library merged every word of every text; now each new one once, also when a task has forgotten some."""
    own = byte_bpe.RankedBPE(RANKS, public_tokenizers.PATTERN)
    texts, met = [t or "" for t in TEXTS], []
    learn = own.learn
    monkeypatch.setattr(own, "learn", lambda words: met.extend(words) or learn(words))
    for limit in (byte_bpe.KEPT_WORDS, 3):
        monkeypatch.setattr(byte_bpe, "KEPT_WORDS", limit)
        for _ in range(2):
            ids, ends = own.encode_all(texts)
            assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [library.encode_ordinary(t) for t in texts]
        if limit > 3:
            assert len(met) == len(set(met))


def test_overlapping_merges_come_from_the_left(library, bpe):
    """Every token of which two overlapping copies can be merged at different cuts, in all surroundings that could show it; runs; random strings of tokens."""
    ranks, rnd = byte_bpe.read_ranks(RANKS), random.Random(4)
    texts = set()
    for token in ranks:
        cuts = byte_bpe.halves(token, ranks)
        for i in cuts:
            j = len(token) - i
            if i != j and j in cuts and token[:j] == token[i:]:
                for raw in (token[:i] + token, token * 2, token + token[i:], token * 3 + token[:i]):
                    for before in ("", " ", "a", ".", "\n"):
                        texts.add(before + raw.decode("utf-8", "ignore"))
    texts |= {b + c * n for c in "=-. ao!?ㅋ・\n" for n in range(1, 70) for b in ("", "x", " ")}
    known = [t.decode("utf-8", "ignore") for t in ranks]
    texts |= {"".join(rnd.choices(known, k=rnd.randrange(1, 7))) for _ in range(3000)}
    texts = sorted(texts)
    ids, ends = bpe.encode_all(texts)
    for t, a, z in zip(texts, ends, ends[1:], strict=False):
        assert ids[a:z].tolist() == library.encode_ordinary(t), t


def test_parts_of_long_texts_meet_where_words_do(library, bpe, monkeypatch):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(["word", "Wörter", "'s", "don't", "12", " ", "  ", "\n", "\t ", "!", "...", "東京", "é", "_"]) for _ in range(400)) for _ in range(40)]
    monkeypatch.setattr(byte_bpe, "PART_CHARS", 7)
    assert all("".join(byte_bpe.parted(t)) == t for t in texts) and sum(len(list(byte_bpe.parted(t))) for t in texts) > 1000
    ids, ends = bpe.encode_all(texts)
    assert [ids[a:z].tolist() for a, z in zip(ends, ends[1:], strict=False)] == [library.encode_ordinary(t) for t in texts]


def test_offsets_and_split_characters(spark, bpe):
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS)], "doc_id long, text string, token_ids_stop string").repartition(2)
    out = byte_bpe.ranked_encode(docs, RANKS, public_tokenizers.PATTERN, offsets=True)
    assert out.columns == ["doc_id", "text", "token_ids", "token_ids_start", "token_ids_stop"]
    for r in out.collect():
        encoded = bpe.library.encode(r["text"] or "", add_special_tokens=False)
        assert r["token_ids"] == encoded.ids and [*zip(r["token_ids_start"], r["token_ids_stop"], strict=True)] == encoded.offsets, r["text"]
    back = byte_bpe.ranked_decode(out, RANKS, public_tokenizers.PATTERN)
    back = byte_bpe.ranked_pieces(byte_bpe.ranked_decode(back, RANKS, public_tokenizers.PATTERN, into="raw", raw=True), RANKS, public_tokenizers.PATTERN)
    for r in back.collect():
        assert r["decoded"] == (r["text"] or "") and bytes(r["raw"]) == (r["text"] or "").encode()
        assert "".join(r["pieces"]) == (r["text"] or "") and len(r["pieces"]) == len(r["token_ids"])
    # part of a character is no character, and no error
    ids = bpe.encode_all(["🙃"])[0].tolist()
    assert len(ids) > 1 and bpe.pieces(ids) == [*[""] * (len(ids) - 1), "🙃"]
    cut = spark.createDataFrame([(ids[:-1],), (None,), ([],)], "token_ids array<int>")
    assert [r["decoded"] for r in byte_bpe.ranked_decode(cut, RANKS, public_tokenizers.PATTERN).collect()] == ["�", None, ""]
    assert bpe.pieces(ids[:-1])[-1] == "�"


# ---- centroids ---------------------------------------------------------------
def plain_clusters(rows, k, rounds, dim):
    """vec_id, cluster, distance, centroids by whole-number arithmetic, one vector after another."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, sha(f"2:{r[0]}"), r[1]))
    c = [v for _, v in order[:k]]
    far = lambda v, m: sum((x - y) ** 2 for x, y in zip(v, c[m], strict=True))
    nearest = lambda v: min(range(len(c)), key=lambda m: (far(v, m), m))
    for _ in range(rounds):
        at = [nearest(v) for _, v in kept]
        for m in range(len(c)):
            mine = [v for (_, v), n in zip(kept, at, strict=True) if n == m]
            if mine:
                c = [*c[:m], [sum(x) // len(mine) for x in zip(*mine, strict=True)], *c[m + 1 :]]
    found = [(i, nearest(v)) for i, v in kept]
    return [(i, m, far(v, m)) for (i, m), (_, v) in zip(found, kept, strict=True)], c


def test_bisectors_choose_the_nearest_and_the_smaller_of_equals():
    rng = np.random.default_rng(3)
    c = rng.integers(-3, 4, (17, 4))
    c[9], c[12] = c[2], -c[2]
    x = rng.integers(-4, 5, (5000, 4))
    planes = centroids.Bisectors(c)
    all_ = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    at = planes.nearest(x)
    assert at.tolist() == all_.argmin(axis=1).tolist() and planes.distance(x, at).tolist() == all_.min(axis=1).tolist()
    assert (np.sort(all_, axis=1)[:, 0] == np.sort(all_, axis=1)[:, 1]).sum() > 500  # many ties
    edge = np.array([[centroids.LARGEST] * 64, [-centroids.LARGEST] * 64])
    assert centroids.Bisectors(edge).distance(edge, np.array([1, 0])).tolist() == [64 * (2 * centroids.LARGEST) ** 2] * 2


@pytest.mark.parametrize(("k", "rounds"), [(5, 3), (1, 2), (90, 1)])
def test_clusters_equal_a_plain_restatement(spark, k, rounds):
    rnd = random.Random(7)
    rows = [(i, [rnd.choice([-1.5, -0.001, 0.0, 0.25, 1.0, rnd.uniform(-1, 1)]) for _ in range(6)]) for i in range(60)]
    rows += [(i, rows[3][1]) for i in range(100, 110)] + [(3, rows[3][1]), (None, rows[5][1])]
    odd = [(200, None), (201, []), (202, [1.0] * 5), (203, [1.0] * 7), (204, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (205, [NAN] * 6), (206, [INF, 0.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd], "vec_id long, embedding array<float>, cluster string, distance int").repartition(4)
    got = centroids.centroid_clusters(df, k=k, rounds=rounds, dim=6).collect()
    want, c = plain_clusters(rows, k, rounds, 6)
    assert Counter((r["vec_id"], r["cluster"], r["distance"]) for r in got) == Counter(want)
    sums = Counter()
    for _, m, d in want:
        sums[m] += d
    for r in got:
        assert (r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) == (sums[r["cluster"]], sum(sums.values()), sha(",".join(map(str, c[r["cluster"]]))))


def test_clusters_of_nothing_and_of_too_large_numbers(spark):
    empty = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")
    out = centroids.centroid_clusters(empty)
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(PySparkException, match="too large"):
        centroids.centroid_clusters(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>"), dim=2)


# ---- resampling --------------------------------------------------------------
def plain_features(text, runs=2):
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


def plain_resample(docs, target, share=25, least=20, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(bucket(f) for _, x in docs for f in plain_features(x)[1]), Counter(bucket(f) for x in target for f in plain_features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    rows = []
    for i, x in docs:
        words, features = plain_features(x)
        weight = math.floor(sum(gain(bucket(f)) for f in features) / len(features)) if features else 0
        h = int(sha(f"7:{'' if i is None else i}")[:8], 16)
        rows.append([i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    fit = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    rank = {id(r): n for n, r in enumerate(fit[: share * len(fit) // 100], 1)}
    return Counter((*r[:4], rank.get(id(r))) for r in rows)


def test_resampling_equals_a_plain_restatement(spark, tmp_path):
    rnd = random.Random(13)
    vocabulary = ["alpha", "Beta", "gamma9", "d-e", "naïve", "東京", "x_y", "the", "OF", "zeta"]
    docs = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([0, 1, 2, 5, 19, 20, 25, 60])))) for i in range(150)]
    docs += [(500, None), (501, ""), (502, "..., --"), (None, "the of " * 15), (None, None), (7, docs[7][1]), (7, docs[7][1]), (503, "İ Σ ß ﬀ K " * 9), (504, "a\x00b " * 30)]
    target = ["the of zeta the of", None, "", "naïve zeta 東京", "solo"]
    frame = spark.createDataFrame([(*r, 5, "x") for r in docs], "doc_id long, text string, weight int, rank string").repartition(5)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = plain_resample(docs, target)
    got = queries.op13_resampling(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == want
    # the drawn documents come whole
    drawn = resampling.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"))
    ranked = Counter(r[0] for r in want.elements() if r[4] is not None)
    assert Counter(r["doc_id"] for r in drawn.collect()) == ranked and {(r["doc_id"], r["text"]) for r in drawn.collect()} <= set(docs)
    nothing = resampling.resampled(frame.limit(0), spark.createDataFrame([(t,) for t in target], "text string"))
    assert nothing.count() == 0
    assert resampling.resampled(frame, spark.createDataFrame([], "text string")).count() == len(docs)


@pytest.mark.parametrize("step", [1, 2, 5, 1 << 16])
@pytest.mark.parametrize("runs", [1, 2, 3])
def test_runs_do_not_cross_documents_or_steps(monkeypatch, step, runs):
    monkeypatch.setattr(resampling, "STEP_WORDS", step)
    texts = ["One two three", "", "four", "...", "Five six. SEVEN eight nine ten", "é 東 x"]
    bucket, owner, words = resampling.hashed_runs(texts, runs, 1 << 32)
    want = Counter((zlib.crc32(f.encode()), i) for i, t in enumerate(texts) for f in plain_features(t, runs)[1])
    assert Counter(zip(bucket.tolist(), owner.tolist(), strict=True)) == want and words.tolist() == [3, 0, 1, 0, 6, 3]
    assert [len(x) for x in resampling.hashed_runs([], runs, 10)] == [0, 0, 0]
