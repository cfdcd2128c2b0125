"""Tokenizers, spans, fingerprints and mixing against the libraries and plain restatements."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from concord.llm import bpe, fingerprint, mixing, pii, secret_scan, token_count

SCHEMA = "doc_id long, text string, lang string, source string, score string, n_lines int"


def frame(spark, texts, sources=None):
    rows = [(i, t, None, (sources or ["a", "b", None])[i % (len(sources) if sources else 3)], "clash", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def strange_texts(n=60):
    rnd = random.Random(3)
    kinds = [lambda: chr(rnd.randrange(32, 127)), lambda: chr(rnd.randrange(160, 0x2FF)), lambda: rnd.choice(" \n\t.,!'0123456789aeiou"), lambda: chr(rnd.randrange(0x4E00, 0x4F00)), lambda: chr(rnd.randrange(0x1F300, 0x1F600))]
    return [None, "", " ", "\n\n", "a", "aaaa" * 50, "x<|endoftext|>y <|endoftext|>", "▁▁ a▁b", "ab " * 3000, "word" * 2000] + ["".join(rnd.choice(kinds)() for _ in range(rnd.randrange(1, 300))) for _ in range(n)]


def test_bpe_equals_the_library(spark):
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    t, texts = Tokenizer.from_file(path), strange_texts()
    got = {r["doc_id"]: r for r in bpe.bpe_digests(frame(spark, texts), path).collect()}
    assert len(got) == len(texts)
    for i, x in enumerate(texts):
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_tables_round_trip(spark):
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    texts = strange_texts(10)
    docs = frame(spark, texts).withColumnRenamed("score", "token_ids")
    rows = bpe.bpe_decode(bpe.bpe_encode(docs, path), path).collect()
    assert [r["decoded"] for r in rows] == [x or "" for x in texts]
    assert bpe.bpe_encode(docs.limit(0), path).count() == 0


def test_token_counts_equal_the_library(spark):
    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    sp, _ = token_count.load_model(path)
    texts = strange_texts(30)
    # small chunks, so that most texts are spliced
    for chunk, overlap in ((16384, 128), (64, 8), (33, 1)):
        got = {r["doc_id"]: r for r in token_count.token_counts(frame(spark, texts), path, limit=100, chunk=chunk, overlap=overlap).collect()}
        for i, x in enumerate(texts):
            n = len(sp.encode(x or ""))
            assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((x or "").encode()), n, n > 100), (i, chunk)


BASE_SECRETS = {
    "assign": re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def plain_secrets(text):
    out = [(m.start(), m.end(), 0) for m in BASE_SECRETS["assign"].finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), m.end(), 1) for m in BASE_SECRETS["access"].finditer(text) if len(m[0]) >= 18]
    return sorted(out + [(m.start(), m.end(), 2) for m in BASE_SECRETS["hex"].finditer(text) if len(m[0]) >= 16], key=lambda s: (s[0], s[2]))


def test_secrets_keep_the_base_rules_and_add():
    rnd = random.Random(5)
    bits = ["password", "PassWD", "api_key", "apikey", "Token", "secret", " ", "=", ": ", '"', "'", "AKIA", "ABCDEFGH12345678", "deadbeef01", "a1b2c3d4e5f6", "é", "\n", "x.y-z/9"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(30))) for _ in range(2000)]
    for text, found in zip(texts, secret_scan.scan(texts), strict=True):
        assert [s for s in found if s[2] < 3] == plain_secrets(text)
    key = "é ghp_" + "a1B2" * 9 + " and -----BEGIN RSA PRIVATE KEY-----"
    kinds = {secret_scan.RULES[s[2]].kind for s in secret_scan.scan([key])[0]}
    assert {"code_host", "private_key"} <= kinds


def test_trigram_queries_hold_for_every_match():
    assert secret_scan.derive("[0-9a-f]{16,}") is None
    assert secret_scan.leaves(secret_scan.derive("AKIA[A-Z0-9]+")) == {"aki", "kia"}
    assert secret_scan.derive("(abc|xyz)+q") == ("or", ("abc", "xyz"))
    assert secret_scan.derive("ab?c") is None
    assert secret_scan.leaves(secret_scan.derive("a[bB]cd")) == {"abc", "bcd"}


def plain_personal(text):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_personal_data_keeps_the_base_rules():
    rnd = random.Random(7)
    for alphabet in ("0123456789..--++  @@ab()4111", "ab.@-%é \n", "4111111111111111 -"):
        for _ in range(4000):
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60)))
            assert pii.base_spans(text) == plain_personal(text), text


def test_personal_data_adds_what_the_trees_select():
    judge = pii.fit()
    hits = {k: [0, 0] for k in pii.KINDS}
    wrong = 0
    for text, spans in pii.examples(1600, 12345):
        found = [s[:3] for s in pii.judged([text], judge)[0]]
        base = pii.base_spans(text)
        assert set(base) <= set(found)
        wrong += sum(s not in base and s not in spans for s in found)
        for s in spans:
            hits[pii.KINDS[s[2]]][0] += s in found
            hits[pii.KINDS[s[2]]][1] += 1
    assert all(h >= 0.7 * n for h, n in hits.values()), hits
    assert wrong <= 10
    assert pii.judged(["The cat sat at home. It was 3.14 on page 12."], judge) == [[]]


@pytest.mark.parametrize(("text", "wanted"), [
    ("555-123-4567 555-765-4321", ["555-123-4567", "555-765-4321"]), ("555-123-4567  555-765-4321  555-999-1234", ["555-123-4567", "555-765-4321", "555-999-1234"]),
    ("tel (415) 555-1234 (415) 555-9876", ["(415) 555-1234", "(415) 555-9876"]), ("4111 1111 1111 1111 4000 0000 0000 0002", ["4111 1111 1111 1111", "4000 0000 0000 0002"]),
])
def test_numbers_side_by_side_are_proposed(text, wanted):
    assert set(wanted) <= {text[a:z] for a, z, _ in pii.candidates(text)}


def test_added_spans_among_real_texts():
    """Numbers planted between the words of the given documents: which are found, and what else is marked."""
    import pyarrow.parquet as pq

    rnd, judge = random.Random(9), pii.fit()
    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist() if t and not pii.candidates(t) and len(t) > 80][:250]
    number = lambda k: "".join(rnd.choice("23456789") for _ in range(k))
    makers = [(3, lambda: f"({number(3)}) {number(3)}-{number(4)}"), (3, lambda: f"{number(3)}-{number(3)}-{number(4)}"), (0, lambda: "jo.doe [at] mail [dot] org"), (None, lambda: f"20{number(2)}-0{rnd.randrange(1, 10)}-1{rnd.randrange(10)}"), (None, lambda: number(9))]
    right = planted = added = 0
    for i, t in enumerate(texts):
        kind, make = makers[i % len(makers)]
        at = t.index(" ", len(t) // 2) if " " in t[len(t) // 2 :] else len(t)
        s = make()
        found = {x[:3] for x in pii.judged([f"{t[:at]} {s}{t[at:]}"], judge)[0] if not x[3]}
        added += len(found)
        if kind is not None:
            planted += 1
            want = len(s) if kind else len("jo.doe [at] mail [dot] org")
            right += (at + 1, at + 1 + want, kind) in found
    assert right >= 0.8 * planted and added - right <= 0.05 * added, (right, planted, added)


def test_redaction(spark):
    got = pii.redact(frame(spark, ["mail bob@example.org now", None, ""])).collect()
    assert [r["redacted"] for r in got] == ["mail [email] now", None, ""]


def test_long_texts_stay_linear():
    import time

    began = time.time()
    for text in ("a" * 300_000, "1." * 150_000, "+1 ((" * 60_000, "@" * 300_000, "1" * 300_000):
        pii.base_spans(text)
        secret_scan.scan([text])
    assert time.time() - began < 20


def in_order(row):
    """Null ids come first, by Spark's hash of their text; then by id, and text."""
    i, t = row
    h = xxhash.xxh64_intdigest((t or "").encode(), seed=42)
    return (i is not None, i if i is not None else h - (1 << 64) * (h >> 63), t or "")


def test_fingerprints(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abcdefgh é") for _ in range(rnd.randrange(0, 400))) for _ in range(40)] + [None, "", "x", "same text again and again", "same text again and again"]
    ids = rnd.sample(range(-50, 1000), len(texts))
    docs = spark.createDataFrame([(i, t, "clash") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, part string")
    order = sorted(zip(ids, texts, strict=True))
    expected = {}
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) - len(t) // 4
        expected[i] = (len(t), hashlib.sha256((t[:cut] + nxt[: len(t) // 4]).encode()).hexdigest())
    for parts in (1, 3, 16):
        got = {r["doc_id"]: r for r in fingerprint.fingerprints(docs, partitions=parts).collect()}
        assert {i: (r["n_chars"], r["edited_sha256"]) for i, r in got.items()} == expected
    a, b = (i for i, t in zip(ids, texts, strict=True) if t == "same text again and again")
    assert got[a]["fingerprint"] == got[b]["fingerprint"]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got.values())
    assert fingerprint.fingerprints(docs.limit(0)).count() == 0
    one = fingerprint.fingerprints(docs.limit(1)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_fingerprints_of_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n"), (None, "m"), (2, "a")], "doc_id long, text string")
    assert fingerprint.fingerprints(docs, partitions=3).count() == 5


@pytest.mark.parametrize("missing", [0, 3])
def test_fingerprints_of_large_ids(spark, missing):
    rnd, base = random.Random(11), 1 << 60
    ids = rnd.sample(range(base, base + 5000), 300) + [(1 << 63) - 1, -(1 << 63), 0]
    texts = {i: f"{i} " + " ".join(str(rnd.randrange(1000)) for _ in range(20)) for i in ids}
    rows = [*texts.items(), *[(None, f"none {k} " * 9) for k in range(missing)]]
    rnd.shuffle(rows)
    got = fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), partitions=8).collect()
    order = sorted(rows, key=in_order)
    follows = {r: order[(k + 1) % len(order)][1] for k, r in enumerate(order)}
    edited = lambda t, f: t[: len(t) - len(t) // 4] + f[: len(t) // 4]
    want = sorted((str(i), hashlib.sha256(edited(t, follows[i, t]).encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["edited_sha256"]) for r in got) == want


def test_fingerprint_likeness_orders_edits():
    rnd = random.Random(4)
    words = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(2, 9))) for _ in range(3000)]
    a, b = (" ".join(rnd.choice(words) for _ in range(600)) for _ in range(2))
    d = fingerprint.digests([x.encode() for x in (a, a[: len(a) * 3 // 4] + b[: len(a) // 4], b)])
    assert fingerprint.likeness(d[:1], d[:1])[0] == 1.0
    assert fingerprint.likeness(d[:1], d[1:2])[0] > fingerprint.likeness(d[:1], d[2:3])[0] + 0.1


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        free = {s: weight[s] for s in order if s not in capped}
        share = {s: rest * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return share | capped
        capped |= {s: 3.0 * sizes[s] for s in over}


def test_mixing_targets_and_words(spark):
    rnd = random.Random(2)
    texts, sources = [], []
    for s, n in (("big", 300), ("é", 20), ("a", 3), (None, 40), ("none", 2), ("z", 15)):
        for _ in range(n):
            texts.append(None if s == "none" else " ".join("w" for _ in range(rnd.randrange(0, 60))))
            sources.append(s)
    rows = [(i, t, s, 5) for i, (t, s) in enumerate(zip(texts, sources, strict=True))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix(docs).collect()
    sizes = {}
    for t, s in zip(texts, sources, strict=True):
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = plain_targets(sizes)
    taken = {}
    for r in got:
        s = sources[r["doc_id"]]
        assert r["size"] == len((texts[r["doc_id"]] or "").split()) and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s], abs=1e-4)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    places = [r["position"] for r in got if r["position"] is not None]
    assert places == sorted(places) and 0 <= min(places) and max(places) <= 1
    assert sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=str) == sorted(map(tuple, got), key=str)
    repeats = {r["doc_id"]: r["repeats"] for r in got}
    mixed = mixing.mixed_documents(docs).collect()
    assert {i: n for i, n in repeats.items() if n} == {i: sum(r["doc_id"] == i for r in mixed) for i in {r["doc_id"] for r in mixed}}
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixed_rows_of_one_id_keep_their_turns(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, 5, 6, k]), " ".join(f"w{rnd.randrange(50)}" for _ in range(rnd.randrange(1, 60))), rnd.choice(["a", "b", "c", None])) for k in range(120)]
    rows += [(7, "the same text", "a")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    key = lambda r: (str(r["doc_id"]), str(r["source"]), len(r["text"].split()))
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[str(r["doc_id"])] += r["repeats"]
    planned = Counter()
    for r in mixing.plan_mix(docs).collect():
        planned[str(r["doc_id"]), str(r["source"]), r["size"]] += r["repeats"]
    got = mixing.mixed_documents(docs).collect()
    assert Counter(map(key, got)) == +planned
    assert Counter(str(r["doc_id"]) for r in got) == +want
