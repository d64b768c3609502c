"""Operators against brute force on small tables, with nulls, empty texts, copies and ties."""

from __future__ import annotations

import collections
import gzip
import hashlib
import io
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from milepost.llm import (
    byte_bpe,
    icws_dedup,
    lpf_dedup,
    quality_cnn,
    quality_rules,
    secret_scan,
    sharding,
    simhash_decontam,
    toxicity,
    warc,
)
from tests.conftest import FOLDER

COLUMNS = "doc_id long, text string, size string, digest string, key string"


def words(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n))


def docs_of(spark, texts, ids=None):
    ids = ids if ids is not None else list(range(len(texts)))
    rows = [(i, t, "x", "y", "z") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def odd_texts():
    """Nulls, empty and blank texts, copies, and one very long text."""
    rng = np.random.default_rng(1)
    long = words(rng, 40_000)
    return [None, "", "   \n\n", None, words(rng, 50), long, long, "ein Satz.\nein Satz.", "\U0001f600 é 中", "a" * 3000]


def empty(spark):
    return docs_of(spark, [])


# 1


def rules_by_hand(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def test_rules_count_as_by_hand(spark, odd_texts):
    texts = [*odd_texts, "a b c d e f a b c d e x", "to to to to to to to to", "x\nx\n\nx", "one | two | three |"]
    rows = quality_rules.clean(docs_of(spark, texts)).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        got = row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words
        assert got == rules_by_hand(text)
        assert row.base_failed == (row.n_words < 10 or 100 * row.n_repeat_words > 20 * row.n_words)
        assert not (row.kept and row.base_failed)


def test_rules_remove_lines_then_documents(spark):
    good = "This is a line of plain prose, which has its stops and stays here."
    bar = "Home | News | Sport | Weather | Travel"
    rows = quality_rules.clean(docs_of(spark, [f"{good}\n{bar}\nAll rights reserved.", f"{good}\n" + f"{bar} | more\n" * 9]))
    first, second = rows.orderBy("doc_id").collect()
    assert first.kept and first.clean_text == good and first.n_removed_lines == 2
    assert not second.kept
    assert quality_rules.clean(empty(spark)).count() == 0


# 2


def test_network_learns_and_covers_whole_texts(spark):
    rng = np.random.default_rng(3)
    texts = [words(rng, 60) if i % 2 else "$$$ ".join(words(rng, 60).split()) for i in range(80)]
    docs = docs_of(spark, [*texts, None, "", words(rng, 50_000) + " $$$" * 4000])
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(7, None)], "doc_id long, quality int")
    net = quality_cnn.train(docs, labels)
    rows = {r.doc_id: r for r in quality_cnn.score(docs, net).collect()}
    held = [i for i in range(80) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(rows[i].score >= 0.5) == bool(i % 2) for i in held]) > 0.9
    assert rows[80].score == rows[81].score and 0 <= rows[82].score <= 1
    assert rows[0].size == "x" and rows[0].digest == "y"
    assert {r.score for r in quality_cnn.score(docs, quality_cnn.train(docs, labels.limit(0))).collect()} == {0.5}
    assert quality_cnn.score(empty(spark), net).count() == 0


def test_a_text_beyond_the_sample_does_not_end_it(spark, monkeypatch):
    monkeypatch.setattr(quality_cnn, "TRAIN_BYTES", 20_000)
    rng = np.random.default_rng(6)
    texts = [words(rng, 30) if i % 2 else "$$$ ".join(words(rng, 30).split()) for i in range(60)]
    for i in range(0, 60, 7):
        texts[i] = "x" * 30_000
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    sample, marks = quality_cnn.training_rows(docs_of(spark, texts), labels, "doc_id", "text", "quality")
    held = {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert len(sample) == len([i for i in range(60) if i not in held and i % 7]) and set(marks) == {0, 1}
    long = [t if i % 2 else "x" * 30_000 for i, t in enumerate(texts)]
    with pytest.raises(ValueError):
        quality_cnn.training_rows(docs_of(spark, long), labels, "doc_id", "text", "quality")


def test_blocks_do_not_change_scores(monkeypatch):
    net, rng = quality_cnn.start_weights(), np.random.default_rng(0)
    sizes = [0, 3, 511, 512, 513, 9_000, 70_000]
    flat = rng.integers(0, 256, sum(sizes), dtype=np.uint8)
    at = np.concatenate([[0], np.cumsum(sizes)])
    whole = quality_cnn.scores(net, flat, at)
    monkeypatch.setattr(quality_cnn, "BLOCK_CHUNKS", 5)
    monkeypatch.setattr(quality_cnn, "PART_BYTES", 4_000)
    np.testing.assert_allclose(quality_cnn.scores(net, flat, at), whole, atol=1e-6)


def test_gradients_agree_with_differences():
    rng, net = np.random.default_rng(0), quality_cnn.start_weights(4)
    net = {k: v.astype(np.float64) for k, v in net.items()}
    net["bias"] = rng.normal(size=quality_cnn.FILTERS)  # away from the corner of the rectifier
    parts = [quality_cnn._chunks(rng.integers(0, 256, n, dtype=np.uint8).tobytes()) for n in (700, 30, 0)]
    codes, windows = np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])
    owner, labels = np.repeat(np.arange(3), [len(a) for a, _ in parts]), np.array([1.0, 0.0, 1.0])
    grads = quality_cnn._gradients(net, codes, windows, owner, 3, labels)

    def loss():
        texts = np.split(codes, np.flatnonzero(np.diff(owner)) + 1)
        raw = [b"".join([x[: quality_cnn.STEP].tobytes() for x in t[:-1]] + [t[-1].tobytes()]) for t in texts]
        flats = [np.frombuffer(x, np.int16) for x in raw]
        flats = [x[x != quality_cnn.PAD].astype(np.uint8) for x in flats]
        at = np.concatenate([[0], np.cumsum([len(x) for x in flats])])
        p = quality_cnn.scores(net, np.concatenate(flats), at)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for name, place in (("out", 3), ("filters", (5, 2)), ("bias", 7), ("shift", 0)):
        before, step = net[name][place], 1e-3
        net[name][place] = before + step
        up = loss()
        net[name][place] = before - step
        down = loss()
        net[name][place] = before
        assert abs((up - down) / (2 * step) - grads[name][place]) < 2e-3


# 3


def test_tree_takes_the_tightest_bin():
    rng, tree, plain = np.random.default_rng(2), sharding.FreeSpace(), []
    for i, size in enumerate(rng.integers(0, 50, 600).tolist()):
        if i % 3:
            tree.put(size, i)
            plain.append((size, i))
        else:
            fit = min((x for x in plain if x[0] >= size), default=None)
            assert tree.take(size) == fit
            if fit:
                plain.remove(fit)


def test_best_fit_equals_plain_search():
    sizes = sorted(np.random.default_rng(5).integers(1, 90, 300).tolist(), reverse=True)
    free, want = [], []
    for size in sizes:
        fit = min(((f, b) for b, f in enumerate(free) if f >= size), default=None)
        if fit is None:
            free.append(100 - size)
            want.append(len(free) - 1)
        else:
            free[fit[1]] -= size
            want.append(fit[1])
    assert sharding.best_fit(sizes, 100) == want
    assert len(set(want)) <= -(-sum(sizes) * 11 // 900) + 1


def test_shards_keep_groups_and_number_rows(spark, odd_texts):
    rng = np.random.default_rng(4)
    texts = [*odd_texts, *[words(rng, int(n)) for n in rng.integers(1, 200, 200)], *["copy"] * 60]
    docs = docs_of(spark, texts, [*range(len(texts) - 2), None, None])
    rows = sharding.pack(docs, shards=6).collect()
    assert len(rows) == len(texts)
    groups = collections.defaultdict(set)
    for row in rows:
        groups[(row.text_crc32, row.size)].add(row.shard)
        assert 0 <= row.shard < 6
    assert all(len(x) == 1 for x in groups.values())
    for shard in range(6):
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].size == 16 and by_id[8].size == 16 + len(texts[8].encode())
    assert by_id[8].text_crc32 == zlib.crc32(texts[8].encode())
    assert sharding.pack(empty(spark), shards=3).count() == 0


def test_capacity_is_kept_and_shards_are_few(spark):
    rng = np.random.default_rng(6)
    texts = [words(rng, int(n)) for n in rng.integers(1, 60, 400)]
    rows = sharding.pack(docs_of(spark, texts), capacity=2_000).collect()
    load = collections.Counter()
    for row in rows:
        load[row.shard] += row.size
    assert max(load.values()) <= 2_000 and sorted(load) == list(range(len(load)))
    assert len(load) <= 1.25 * sum(load.values()) / 2_000 + 2


def test_even_shards_are_near_equal():
    sizes = sorted(np.random.default_rng(8).integers(10, 900, 2_000).tolist(), reverse=True)
    load = collections.Counter()
    for size, b in zip(sizes, sharding.even_fit(sizes, 40), strict=True):
        load[b] += size
    assert len(load) == 40 and max(load.values()) <= 1.01 * min(load.values())


# 4


def test_secrets_are_told_from_other_strings(spark):
    rng = np.random.default_rng(9)
    token = lambda: hashlib.sha1(rng.bytes(8)).hexdigest()
    texts, secret = [], set()
    for i in range(60):
        value = token()
        secret.add(value)
        form = (f'then token = "{value}" follows', f"so password={value} here", f"an api_key: {value} is set")[i % 3]
        texts += [form, f"card {rng.integers(10**15, 10**16)} was used"]
        texts.append("the " + words(rng, 5).replace(" ", "") + " again")
    key = "AKIA" + "Q7ZP2M4XK9LT3WVB"
    docs = docs_of(spark, [*texts, f"see {key} and {key}", None, "", texts[0]])
    found = secret_scan.scan(docs).collect()
    assert {r.value for r in found if r.is_secret} == secret | {key}
    clean = {r.doc_id: r for r in secret_scan.redact(docs).collect()}
    assert clean[180].text == f"see {secret_scan.MARK} and {secret_scan.MARK}"
    assert clean[181].text is None and clean[182].text == "" and clean[1].text == texts[1]
    assert clean[0].digest == "y" and clean[183].text == clean[0].text != texts[0]
    assert secret_scan.scan(empty(spark)).count() == 0 and secret_scan.redact(empty(spark)).count() == 0


def test_forest_holds_on_unseen_findings(spark):
    rng = np.random.default_rng(10)
    alphabet = list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789")
    texts = []
    for i in range(200):
        value = "".join(rng.choice(alphabet, 24))
        texts.append(f'secret = "{value}" ok' if i % 2 else f"order number {rng.integers(10**17, 10**18)} sent")
    found = secret_scan.findings(docs_of(spark, texts).select("text", F.col("doc_id").alias("digest")))
    found = secret_scan.seed_labels(secret_scan.described(found))
    model = secret_scan.train(found.filter("digest < 120"))
    rest = secret_scan.judge(found.filter("digest >= 120"), model).collect()
    assert np.mean([r.is_secret == bool(r.digest % 2) for r in rest]) > 0.95


# 5


def test_chain_finds_toxic_texts(spark):
    rng = np.random.default_rng(12)
    bad = ["idiot", "moron", "stupid", "worthless", "scum"]
    texts = []
    for i in range(240):
        own = words(rng, 30).split()
        if i % 3 == 0:
            own[3:3] = rng.choice(bad, 2).tolist()
        texts.append(" ".join(own))
    docs = docs_of(spark, [*texts, None, ""])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)], "doc_id long, toxic int")
    chain = toxicity.train(docs, labels)
    rows = {r.doc_id: r for r in toxicity.score(docs, chain).collect()}
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(rows[i].p_toxic >= 0.5) == (i % 3 == 0) for i in held]) > 0.95
    assert rows[240].p_toxic == rows[241].p_toxic < 0.5 and rows[5].key == "z"
    assert toxicity.score(docs, toxicity.train(docs, labels.limit(0))).agg(F.max("p_toxic")).first()[0] == 0
    assert toxicity.score(empty(spark), chain).count() == 0


def test_later_models_take_earlier_probabilities():
    texts = [b"idiot here" if i % 2 else b"plain here" for i in range(60)]
    chain = toxicity.fit(texts, [i % 2 for i in range(60)])
    assert [len(m["chain"]) for m in chain["models"]] == [0, 1, 2, 3]
    assert chain["models"][-1]["chain"][0] > 0


# 6


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    pattern = public_tokenizers.PATTERN
    return path, pattern, tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_ids_offsets_and_round_trip(spark, odd_texts, tiktoken_encoding):
    path, pattern, plain = tiktoken_encoding
    rng = np.random.default_rng(13)
    parts = ["aa", "é", "中", "​", "\u0085", "  ", "\n", "'s", "12", "\U0001f600", "<|endoftext|>", "़"]
    texts = [*odd_texts, *["".join(rng.choice(parts, 30)) for _ in range(200)]]
    docs = docs_of(spark, texts)
    rows = byte_bpe.decode(byte_bpe.encode(docs, path, pattern), path).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        want = plain.encode_ordinary(text or "")
        assert np.frombuffer(row.ids, "<u4").tolist() == want and row.n_tokens == len(want)
        assert bytes(row.decoded) == (text or "").encode() and row.decoded_text == (text or "")
        assert np.frombuffer(row.starts, "<u4").tolist() == plain.decode_with_offsets(want)[1]
    once = byte_bpe.round_trip(docs, path, pattern).orderBy("doc_id").collect()
    for a, b in zip(rows, once, strict=True):
        assert (a.doc_id, a.ids, a.starts, a.n_tokens) == (b.doc_id, b.ids, b.starts, b.n_tokens)
        assert b.ids_sha256 == hashlib.sha256(a.ids).hexdigest()
        assert b.decoded_sha256 == hashlib.sha256(a.decoded).hexdigest()
    assert byte_bpe.round_trip(empty(spark), path, pattern).count() == 0
    assert byte_bpe.encode(empty(spark), path, pattern).count() == 0


def test_split_characters_come_whole(tiktoken_encoding):
    path, _, plain = tiktoken_encoding
    ids = np.array(plain.encode_ordinary("x\U0001f9ffy"), "<u4")
    assert len(ids) > 3  # the character spans tokens
    chunks = [i.tobytes() for i in np.split(ids, len(ids))]
    assert "".join(byte_bpe.decode_stream(chunks, byte_bpe.read_ranks(path))) == "x\U0001f9ffy"


def test_forgetting_pieces_changes_nothing(monkeypatch, tiktoken_encoding):
    path, pattern, plain = tiktoken_encoding
    monkeypatch.setattr(byte_bpe, "KEPT_PIECES", 5)
    encoder = byte_bpe.Encoder(byte_bpe.build_tokenizer(byte_bpe.read_ranks(path)), pattern)
    for text in ("one two three four five six seven", "eight nine ten one two", ""):
        assert np.frombuffer(encoder.encode([text], True)[0][0], "<u4").tolist() == plain.encode_ordinary(text)


# 7


def test_archives_resolve_revisits(spark, tmp_path):
    big, other = "<p>é</p>" * 400, "<b>\r\n\r\nWARC/1.1\r\n</b>" * 100
    rows = [(1, "http://a/1", big), (2, None, big), (3, "http://a/ 3\n", big), (4, "u", "small"), (5, "u", "small")]
    rows += [(6, "u", None), (7, "u", ""), (8, "u", other), (None, "u", other), (None, "u", "<i>" * 500)]
    rows += [(9, "u", "z" * 1000), (9, "u", "z" * 1000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    warc.write_archives(pages, str(tmp_path / "a"))
    found = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert len(found) == len(rows)
    for page, _, html in rows:
        raw = (html or "").encode()
        sha = hashlib.sha1(raw).hexdigest()
        own = [r for r in found if r.page_id == page and r.payload_digest == sha]
        assert own and all(r.payload_bytes == len(raw) for r in own)
        for r in own:
            assert r.record_type == "revisit" or bytes(r.payload) == raw
    kind = {r.page_id: (r.record_type, r.refers_to) for r in found if r.page_id}
    assert kind[3] == ("response", None) and kind[1] == kind[2] == ("revisit", 3)
    assert kind[4] == kind[5] == kind[8] == kind[9] == ("response", None)
    lone = {(r.record_type, r.refers_to) for r in found if r.page_id is None}
    assert lone == {("revisit", 8), ("response", None)}
    by_id = {r.record_id: r for r in found}
    assert all(by_id[r.refers_to_id].page_id == r.refers_to for r in found if r.record_type == "revisit")
    assert {r.url for r in found if r.page_id == 3} == {"http://a/%203%0A"}


def test_archives_are_plain_warc(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "x" * 50)], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "a"), date="2026-01-02T03:04:05Z")
    raw = b"".join(gzip.open(p).read() for p in (tmp_path / "a").glob("*.gz"))
    head, _, rest = raw.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", head)[1])
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and rest[length:] == b"\r\n\r\n"
    assert list(warc.parse(io.BytesIO(raw)))[0]["payload"] == b"x" * 50
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


# 8


def jaccard(a, b):
    one, two = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(one & two) / len(one | two)


def classes_by_hand(texts, least):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(texts):
        for j in range(i):
            b = texts[j]
            if (a or "") == (b or "") or (len((a or "").split()) > 5 < len((b or "").split()) and jaccard(a, b) >= least):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def test_near_duplicates_as_by_hand(spark):
    rng = np.random.default_rng(14)
    texts = [None, "", "one", "one", "two words"]
    passage = words(rng, 60)
    for _ in range(12):  # groups of near copies, a chain, and texts that share one passage
        own = words(rng, 150).split()
        texts.append(" ".join(own))
        for _ in range(3):
            copy = list(own)
            copy[int(rng.integers(0, 150))] = "changed"
            texts.append(" ".join(copy))
        texts.append(words(rng, 60) + " " + passage + " " + words(rng, 40))
        texts.append(" ".join(own[:70]))
    chain = words(rng, 200).split()
    for k in range(0, 120, 15):
        texts.append(" ".join(chain[k : k + 160]))
    rows = icws_dedup.near_duplicates(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r.class_id for r in rows] == classes_by_hand(texts, 0.8)
    size = collections.Counter(r.class_id for r in rows)
    assert all(r.class_size == size[r.class_id] for r in rows)


def test_near_duplicates_edges(spark, odd_texts):
    rows = icws_dedup.near_duplicates(docs_of(spark, odd_texts)).orderBy("doc_id").collect()
    assert [r.class_id for r in rows] == [0, 0, 2, 0, 4, 5, 5, 7, 8, 9]
    lone = icws_dedup.near_duplicates(docs_of(spark, ["a b", "a b"], [None, None])).collect()
    assert [(r.class_id, r.class_size) for r in lone] == [(None, 2)] * 2
    assert icws_dedup.near_duplicates(empty(spark)).count() == 0


def tailed_texts(rng):
    """Copies of a core with tail X or Y, no X-copy 0.8 alike to a Y-copy, and two with shortened tails that are."""
    core, x, y = words(rng, 300).split(), words(rng, 48).split(), words(rng, 48).split()
    texts = []
    for tail in (x, y):
        for k in range(12):
            own = core + tail
            own[-1 - k % 3] = "".join(rng.choice(list("klmnop"), 7))
            texts.append(" ".join(own))
    return [*texts, " ".join(core + x[:28]), " ".join(core + y[:28])]


def weighted_pairs(texts, of):
    """All pairs at or over the threshold among the texts at places ``of``, by exact weights."""
    found = collections.Counter(w for t in texts for w in set(t.split()))
    idf = {w: np.log((len(texts) + 1) / (n + 1)) + 1 for w, n in found.items()}
    sets = []
    for i in of:
        w = texts[i].split()
        grams = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        sets.append({g: n * sum(idf[x] for x in g) / 5 for g, n in grams.items()})
    total = [sum(s.values()) for s in sets]
    for p, a in enumerate(sets):
        for q in range(p):
            common = sum(min(v, sets[q].get(g, 0)) for g, v in a.items())
            if common >= 0.8 * (total[p] + total[q] - common):
                yield of[q], of[p]


def test_links_between_components_of_two_leads(spark):
    rng, texts, want = np.random.default_rng(21), [], []
    for _ in range(30):
        texts += tailed_texts(rng)
    for first in range(0, len(texts), 26):
        pairs = list(weighted_pairs(texts, range(first, first + 26)))
        x, y = {*range(first, first + 12), first + 24}, {*range(first + 12, first + 24), first + 25}
        assert [p for p in pairs if (p[0] in x) != (p[1] in x)] == [(first + 24, first + 25)]
        assert all({p for p in pairs if s >= set(p)} for s in (x, y))
        want += [first] * 26
    rows = icws_dedup.near_duplicates(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r.class_id for r in rows] == want


def test_near_duplicates_tests_few_pairs_of_a_large_key(spark, monkeypatch):
    # Texts that differ from a core in four places: most pairs are 0.7 to 0.78 alike, few reach 0.8.
    rng, tested, verified = np.random.default_rng(31), [], icws_dedup.verified
    core, texts = words(rng, 300).split(), []
    for _ in range(150):
        own = list(core)
        for at in rng.choice(300, 4, replace=False).tolist():
            own[at] = own[at][::-1] + "x"
        texts.append(" ".join(own))

    def counted(pairs, rows, idf):
        tested.append(pairs.count())
        return verified(pairs, rows, idf)

    monkeypatch.setattr(icws_dedup, "verified", counted)
    rows = icws_dedup.near_duplicates(docs_of(spark, texts)).orderBy("doc_id").collect()
    class_of = [r.class_id for r in rows]
    assert all(class_of[a] == class_of[b] for a, b in weighted_pairs(texts, range(150)))
    assert len(set(class_of)) > 10
    assert sum(tested) < 2_500


def test_open_texts_are_broadcast_to_their_keys(spark, monkeypatch):
    # As in the pipeline, where sides are joined by shuffle from a small size on: parts of both sides of a key
    # would meet in a task each.
    rng, plans, staged = np.random.default_rng(31), [], icws_dedup.staged
    core, texts = words(rng, 100).split(), []
    for _ in range(100):
        own = list(core)
        for at in rng.choice(100, 2, replace=False).tolist():
            own[at] = own[at][::-1] + "x"
        texts.append(" ".join(own))
    size = "spark.sql.adaptive.autoBroadcastJoinThreshold"

    def watched(df, **settings):
        if df.columns == ["a", "b"] and "sharp" in df._jdf.queryExecution().analyzed().toString():
            now = spark.conf.get(size)
            spark.conf.set(size, settings.get(size, now))
            df.collect()
            spark.conf.set(size, now)
            plans.append(df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        return staged(df, **settings)

    monkeypatch.setattr(icws_dedup, "staged", watched)
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "1k")
        icws_dedup.near_duplicates(docs_of(spark, texts)).count()
    finally:
        spark.conf.set(size, before)
    assert len(plans) == 1
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]


def test_samples_agree_as_often_as_texts():
    rng = np.random.default_rng(15)
    hashes = rng.integers(0, 2**63, 600, dtype=np.uint64)
    weights = rng.gamma(2, 1, 600) + 0.1
    one, two, other = slice(0, 500), slice(100, 600), weights.copy()
    other[100:300] *= 2
    least, most = np.minimum(weights, other)[100:500].sum(), np.maximum(weights, other)[100:500].sum()
    exact = least / (most + weights[:100].sum() + other[500:].sum())
    agree = []
    for turn in range(12):
        h = icws_dedup.mixed(hashes + np.uint64(turn))
        agree.append((icws_dedup.samples(h[one], weights[one]) == icws_dedup.samples(h[two], other[two])).mean())
    assert abs(np.mean(agree) - exact) < 0.05


@pytest.mark.parametrize("n", [20_000, 400_000])
def test_samples_of_long_texts_edited_with_rare_words(n):
    rng = np.random.default_rng(22)
    vocabulary = np.array(words(rng, 2_000).split())
    rank = np.minimum(rng.zipf(1.3, n), 2_000) - 1
    own = vocabulary[rank].tolist()
    # A serial number in every second word keeps shingles apart, as in prose.
    own[::2] = [f"{w}{i % 997}" for i, w in enumerate(own[::2])]
    other = list(own)
    for i in rng.choice(n, n // 90, replace=False).tolist():
        other[i] = f"rare{i}"
    of = icws_dedup.Words().of
    idf = np.full(1 << icws_dedup.BUCKET_BITS, 2.0)
    rare = np.frombuffer(" ".join(w for w in other if w.startswith("rare")).encode(), np.uint8)
    idf[(of(rare, np.array([0, len(rare)]))[0] >> np.uint64(64 - icws_dedup.BUCKET_BITS)).astype(np.int64)] = 9.0
    found = []
    for text in (own, other):
        flat = np.frombuffer(" ".join(text).encode(), np.uint8)
        found.append(next(icws_dedup.shingles(*of(flat, np.array([0, len(flat)])), idf)))
    (h, v), (g, w) = found
    _, p, q = np.intersect1d(h, g, assume_unique=True, return_indices=True)
    common = np.minimum(v[p], w[q]).sum()
    exact = common / (v.sum() + w.sum() - common)
    agree = (icws_dedup.samples(h, v, 512) == icws_dedup.samples(g, w, 512)).mean()
    assert exact > 0.8 and abs(agree - exact) < 0.07


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(16)
    nodes = [int(x).to_bytes(2, "big") for x in rng.permutation(300)]
    pairs = [(nodes[i], nodes[i + 1]) for i in range(99)] + [(nodes[150], nodes[i]) for i in range(151, 250)]
    found = icws_dedup.components(spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in pairs], "a binary, b binary"))
    got = {bytes(r.node): bytes(r.root) for r in found.collect()}
    for group in (nodes[:100], nodes[150:250]):
        assert {got.get(x, x) for x in group} == {min(group)}


# 9


def repeats_by_hand(texts, length, keep):
    places = collections.defaultdict(list)
    raw = [(t or "").encode() for t in texts]
    for k, b in enumerate(raw):
        for i in range(len(b) - length + 1):
            places[b[i : i + length]].append((k, i))
    gone = [np.zeros(len(b), bool) for b in raw]
    for found in places.values():
        for k, i in found[1:] if keep == "first" else found if len(found) > 1 else ():
            gone[k][i : i + length] = True
    return [bytes(np.frombuffer(b, np.uint8)[~g]) for b, g in zip(raw, gone, strict=True)]


@pytest.mark.parametrize("group_rows", [20_000, 1])
@pytest.mark.parametrize("keep", ["first", "none"])
def test_repeats_as_by_hand(spark, monkeypatch, keep, group_rows):
    monkeypatch.setattr(lpf_dedup, "GROUP_ROWS", group_rows)
    rng = np.random.default_rng(17)
    passage, other = words(rng, 30), words(rng, 12)
    texts = [None, "", "a" * 130, "é" * 90, words(rng, 40), passage, passage, passage]
    for _ in range(10):
        texts.append(words(rng, 8) + passage + words(rng, 6) + other + words(rng, 3) + passage[40:120])
    rows = lpf_dedup.remove_repeats(docs_of(spark, texts), length=40, keep=keep).orderBy("doc_id").collect()
    want = repeats_by_hand(texts, 40, keep)
    assert [bytes(r.kept) for r in rows] == want
    for row, text, left in zip(rows, texts, want, strict=True):
        assert row.n_removed == len((text or "").encode()) - len(left)
        assert row.kept_sha256 == hashlib.sha256(left).hexdigest()


def test_long_texts_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lpf_dedup, "PART_BYTES", 700)
    rng = np.random.default_rng(18)
    passage = words(rng, 40)
    texts = [words(rng, 900) + passage + words(rng, 500), words(rng, 300) + passage, passage[30:] + words(rng, 900)]
    rows = lpf_dedup.remove_repeats(docs_of(spark, texts), length=40, keep="none").orderBy("doc_id").collect()
    assert [bytes(r.kept) for r in rows] == repeats_by_hand(texts, 40, "none")
    assert lpf_dedup.remove_repeats(empty(spark), keep="none").count() == 0


# 10


def matches_by_hand(texts, items):
    out, split = set(), lambda t: re.findall(r"\w+", (t or "").lower())
    for d, text in enumerate(texts):
        w = split(text)
        for i, item in enumerate(items):
            v = split(item)
            if not v:
                continue
            size = min(5, len(v))
            have = collections.Counter(tuple(v[k : k + size]) for k in range(len(v) - size + 1))
            for s in range(len(w) - len(v) + 1):
                own = w[s : s + len(v)]
                seen = collections.Counter(tuple(own[k : k + size]) for k in range(len(own) - size + 1))
                both = sum((have & seen).values())
                if both >= 0.8 * sum((have | seen).values()):
                    out.add((d, i))
    return out


def test_leaks_as_by_hand(spark, monkeypatch):
    rng = np.random.default_rng(19)
    items = [words(rng, int(n)) for n in rng.integers(15, 70, 30)] + [None, "", "one two three", "again " * 20]
    texts = [None, "", words(rng, 200), "one two three", "so one two three four", "again " * 50]
    for k in range(30):
        own = items[k].split()
        change = list(own)
        change[int(rng.integers(0, len(own)))] = "changed"
        texts += [words(rng, 40) + " " + items[k].upper() + " " + words(rng, 9), words(rng, 5) + " " + " ".join(change)]
        texts.append(" ".join(own[: len(own) // 2]))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs, want = docs_of(spark, texts), matches_by_hand(texts, items)
    assert {(r.key, r.item) for r in simhash_decontam.find(docs, benchmark).collect()} == want
    monkeypatch.setattr(simhash_decontam, "SLICE_ITEMS", 7)
    assert {(r.key, r.item) for r in simhash_decontam.find(docs, benchmark).collect()} == want
    assert simhash_decontam.find(empty(spark), benchmark).count() == 0
    assert simhash_decontam.find(docs, benchmark.limit(0)).count() == 0


def shorter_by_hand(texts, items):
    """Matches of whole texts with items of more words."""
    out, split = set(), lambda t: re.findall(r"\w+", (t or "").lower())
    grams = lambda w, size: collections.Counter(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            w, v = split(text), split(item)
            if len(w) < len(v):
                have, seen = grams(v, min(5, len(v))), grams(w, min(5, len(v)))
                if sum((have & seen).values()) >= 0.8 * sum((have | seen).values()):
                    out.add((d, i))
    return out


def test_texts_shorter_than_items(spark):
    rng = np.random.default_rng(23)
    items = [words(rng, int(n)) for n in [5, 6, 7, 9, 10, *rng.integers(15, 90, 25)]] + ["one two three", "again " * 20, None]
    texts = [None, "", "one two", "again " * 19, "again " * 12]
    for item in items[:30]:
        own = item.split()
        texts += [" ".join(own[a : len(own) - b]) for a, b in ((0, 1), (1, 0), (1, 1), (2, 3), (0, len(own) // 6), (0, len(own) // 3))]
        texts.append(" ".join([*own[: len(own) // 2], "changed", *own[len(own) // 2 + 1 : -1]]))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    short = shorter_by_hand(texts, items)
    rows = simhash_decontam.find(docs_of(spark, texts), benchmark).collect()
    assert len(short) > 60 and {(r.key, r.item) for r in rows} == short | matches_by_hand(texts, items)
    assert all(r.end_word <= len(texts[r.key].split()) for r in rows)


def test_blocks_find_all_within_the_radius():
    rng = np.random.default_rng(20)
    index = simhash_decontam.Index([(i, words(rng, 30)) for i in range(40)])
    for _ in range(200):
        i = int(rng.integers(0, 40))
        bits = np.unpackbits(index.prints[i])
        bits[rng.choice(64, simhash_decontam.RADIUS, replace=False)] ^= 1
        near = np.zeros(40, bool)
        for b, value in enumerate(np.packbits(bits)):
            near |= index.near[b][value]
        assert near[i]


def test_given_documents_hold_their_items():
    docs = pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()
    items = pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()
    index, hashes = simhash_decontam.Index([(x["item_id"], x["text"]) for x in items]), simhash_decontam.WordHashes()
    found = {(d["doc_id"], m[0]) for d in docs for m in index.matches(hashes.of(d["text"]))}
    assert {(d["doc_id"], x["item_id"]) for d in docs for x in items if x["text"] in d["text"]} <= found
