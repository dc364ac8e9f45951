"""Quality rules, archives, token files, packing, mixing and personal data."""

import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pulsemart.llm import mixing, packing, personal, quality, token_files, tokens, warc
from pulsemart.llm.common import scratch_path, stage
from pulsemart.llm.queries import QUERIES, SQL, vocabulary

LABELS = "doc_id long, quality int, toxic int"


def ordered(rows):
    return sorted(rows, key=repr)


def by_hand(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(found[k:k + 3]) for k in range(len(found) - 2)]
    seen = Counter(windows)
    inside = {j for k, w in enumerate(windows) if seen[w] > 1 for j in (k, k + 1, k + 2)}
    return (
        len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), len(lines),
    )


@pytest.mark.parametrize("text", [
    None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a", "a a a a a", "x\n\nx\n \nx\ny", "é# <b>|&%*$ 日本\x0bz z", "w " * 500,
    "same line\nsame line\nsame  line",
])
def test_measures(text):
    assert quality.measure_text(text) == by_hand(text)


def test_measured_table(docs, sample, empty):
    got = quality.measure(docs, ["doc_id"]).collect()
    want = [(r[0], *by_hand(r[1])) for r in sample]
    assert ordered(tuple(r)[:-1] for r in got) == ordered(want)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)
    assert quality.measure(empty, ["doc_id"]).collect() == []


def test_bounds_are_exact():
    for n, k, p in [(10, 0, 0.1), (50, 3, 0.2), (7, 7, 0.3), (300, 20, 0.05)]:
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert math.isclose(quality.at_most(k, n, p), min(1.0, exact), rel_tol=1e-9)
    bound = quality.false_rejection_bound(4, 200, 0.01)
    assert math.isclose(quality.at_most(4, 200, bound), 0.01, rel_tol=1e-6)
    assert math.isclose(quality.false_rejection_bound(0, 100, 0.05), 1 - 0.05**0.01, rel_tol=1e-6)


def test_cutoffs_limit_false_rejections():
    rng, failures = np.random.default_rng(4), 0
    chance = np.r_[np.full(100, 0.0098), np.full(quality.STEPS - 99, 0.02 / (quality.STEPS - 99))]
    for _ in range(300):
        step = quality.strictest(rng.multinomial(2000, chance / chance.sum()), 0.02, 0.05)
        failures += chance[step + 1:].sum() / chance.sum() > 0.02
    assert failures / 300 < 0.08  # 5 % promised
    assert quality.strictest(np.zeros(quality.STEPS + 1, int), 0.02, 0.05) == quality.STEPS
    assert quality.strictest(np.array([10**6, 0, 0]), 0.02, 0.05) == 0


def test_no_good_document_is_spent_for_nothing(spark, docs):
    rng = random.Random(2)
    text = lambda k: " ".join(f"{rng.randrange(10 ** (2 + k % 7))}{'$$$' if k % 4 == 0 else ''}" for _ in range(60))
    table = spark.createDataFrame([(k, text(k), "en", "s", 1) for k in range(4000)], docs.schema)
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(4000)], LABELS)
    measured = quality.measure(table, ["doc_id", "lang"])
    rejected = quality.judge(measured, quality.choose_cutoffs(measured, labels)).where("not base_failed and not kept").collect()
    assert {r.doc_id % 4 for r in rejected} == {0}
    assert quality.mildest(np.array([0, 5, 0, 0, 2, 1]), 1) == 3 and quality.mildest(np.array([4, 0, 0]), 0) == 2


def test_rules_reject_junk_and_keep_the_rest(spark, clashing, docs, empty):
    rng = random.Random(1)
    text = lambda k, bad: " ".join(f"{rng.randrange(10**6)}{'$$$' if bad else ''}" for _ in range(60))
    rows = [(k, text(k, k % 4 == 0), "en", "s", 1) for k in range(2400)]
    table = spark.createDataFrame(rows, docs.schema).withColumn("n_words", F.lit("own"))
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(2400)] + [(1, 0, 0), (None, 1, 0)], LABELS)
    kept = quality.keep_good(table, labels)
    assert kept.columns == table.columns
    ids = {r.doc_id for r in kept.collect()}
    good = {k for k in range(2400) if k % 4}
    assert not ids - good and len(good - ids) <= 0.05 * len(good)
    none = spark.createDataFrame([], LABELS)
    assert quality.keep_good(clashing, none).count() == quality.measure(docs, ["doc_id"]).where("not base_failed").count()
    assert quality.keep_good(empty, labels).collect() == []


def pages():
    long = "é" * 60
    return [
        (5, "http://a/ü?x=%20 y", long), (3, "http://b", long), (9, None, long), (None, "http://n", long), (4, "u\r\nWARC-Type: x", "short"),
        (6, "u", "short"), (7, "u", None), (8, "u", ""), (3, "http://b", long), (10, "u", "\r\n\r\nx" * 50), (11, "u", "z" * 300_000), (12, "u", "a" * 100), (13, "u", "a" * 100), (14, "u", "b" * 99), (15, "u", "b" * 99),
    ]


def test_archive_round_trip(spark):
    table = spark.createDataFrame(pages(), "page_id long, url string, html string").withColumn("payload", F.lit("own")).repartition(3)
    folder = scratch_path(spark, "warc")
    warc.register(spark)
    warc.write_pages(table, folder)
    got = warc.read_archive(spark, folder).collect()
    want = []
    for i, _, html in pages():
        raw = (html or "").encode()
        same = [p for p, _, h in pages() if (h or "").encode() == raw and p is not None]
        revisit = len(raw) >= 100 and same and i != min(same)
        want.append((i, "revisit" if revisit else "response", hashlib.sha256(raw).hexdigest(), min(same) if revisit else None, len(raw), None if revisit else raw))
    assert ordered((r.page_id, r.record_type, r.payload_digest, r.refers_to, r.payload_bytes, r.payload and bytes(r.payload) if r.record_type == "revisit" else bytes(r.payload)) for r in got) == ordered(want)
    headers = warc.read_archive(spark, folder, "page_id long, record_type string")
    assert headers.where("record_type = 'revisit'").count() == sum(w[1] == "revisit" for w in want)
    assert headers.where("page_id in (3, 7) and record_type = 'response'").count() == 3
    assert headers.where("page_id is null").count() == 1 and headers.where("page_id > 10").count() == 5


def test_unwanted_payloads_are_not_inflated(monkeypatch):
    rows = [
        {"page_id": k, "url": "u", "record_type": "response", "payload_digest": "d", "refers_to": None, "payload_bytes": 200_000, "payload": random.Random(k).randbytes(200_000)}
        for k in range(3)
    ]
    data = memoryview(b"".join(map(warc._record, rows)))
    inflated, real = [], warc.zlib.decompressobj

    class Counting:
        def __init__(self, bits):
            self.inner = real(bits)

        def decompress(self, raw):
            inflated.append(len(raw))
            return self.inner.decompress(raw)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    monkeypatch.setattr(warc.zlib, "decompressobj", Counting)
    found = list(warc.records(data, lambda h: h["page_id"] == 1, True))
    assert [(h["page_id"], p) for h, p in found] == [(1, rows[1]["payload"])]
    assert sum(inflated) < 210_000
    inflated.clear()
    assert len(list(warc.records(data, lambda h: True, False))) == 3 and sum(inflated) < 20_000


def foreign(k, body, kind="response"):
    """A record as other writers make it: names in lower case, no space after the colon, no payload length."""
    block = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n" + body
    return b"WARC/1.0\r\nwarc-type:%s\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n" % (kind.encode(), k, len(block)) + block + b"\r\n\r\n"


def foreign_bodies():
    return [b"hello", b"", b"\r\n\r\nWARC/1.0\r\n\r\n", random.Random(1).randbytes(70_000), b"z" * 3_000_000, b"end"]


def foreign_forms():
    plain = [foreign(k, body, "request" if k == 1 else "response") for k, body in enumerate(foreign_bodies())]
    return {
        "plain.warc": b"".join(plain),
        "members.warc.gz": b"".join(map(gzip.compress, plain)),
        "padded.warc.gz": b"\0\0".join(map(gzip.compress, plain)) + b"\0" * 20_000,
        "one.warc.gz": gzip.compress(b"".join(plain)),
        "pairs.warc.gz": b"".join(gzip.compress(a + b) for a, b in zip(plain[::2], plain[1::2], strict=True)),
    }


@pytest.mark.parametrize("form", foreign_forms())
def test_archives_of_other_writers(form):
    data = foreign_forms()[form]
    found = list(warc.records(memoryview(data), lambda h: True, True))
    assert [(h["page_id"], h["payload_bytes"], p) for h, p in found] == [
        (k, None, None if k == 1 else body) for k, body in enumerate(foreign_bodies())
    ]
    some = list(warc.records(memoryview(data), lambda h: h["page_id"] == 3, True))
    assert [p for _, p in some] == [foreign_bodies()[3]]
    assert [p for _, p in warc.records(memoryview(data), lambda h: True, False)] == [None] * 6
    for blocks in (1, 7, 1000):  # headers and members cut anywhere
        small = gzip.compress(foreign(1, b"a")) + gzip.compress(foreign(2, b"b" * 500))
        cut = (small[i:i + blocks] for i in range(0, len(small), blocks))
        assert [p for _, p in warc.streamed(cut, lambda h: True, True)] == [b"a", b"b" * 500]


def test_a_foreign_member_after_our_own():
    own = warc._record({"page_id": 1, "url": "u", "record_type": "response", "payload_digest": "d", "refers_to": None, "payload_bytes": 3, "payload": b"own"})
    data = memoryview(own + gzip.compress(foreign(2, b"other")) + own)
    assert [p for _, p in warc.records(data, lambda h: True, True)] == [b"own", b"other", b"own"]


@pytest.mark.parametrize("data", [
    b"something else\r\n\r\n", b"WARC/1.0\r\nno end", gzip.compress(foreign(1, b"x" * 5000))[:-30], foreign(1, b"cut" * 50)[:-40],
])
def test_broken_archives_are_refused(data):
    with pytest.raises(ValueError, match="record|member"):
        list(warc.records(memoryview(data), lambda h: True, True))


def test_foreign_archives_take_linear_time():
    def inflated(n):
        data, fed, real = gzip.compress(foreign(1, random.Random(1).randbytes(2000))) * n, [], warc.zlib.decompressobj

        class Counting:
            def __init__(self, bits):
                self.inner = real(bits)

            def decompress(self, raw, *most):
                fed.append(len(raw))
                return self.inner.decompress(raw, *most)

            def __getattr__(self, name):
                return getattr(self.inner, name)

        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(warc.zlib, "decompressobj", Counting)
            assert len(list(warc.records(memoryview(data), lambda h: False, True))) == 0
        return sum(fed)

    assert inflated(400) < 4.4 * inflated(100)


def test_reading_a_folder_of_other_writers(spark, tmp_path):
    for name, data in foreign_forms().items():
        (tmp_path / name).write_bytes(data)
    warc.register(spark)
    rows = warc.read_archive(spark, str(tmp_path))
    got = ordered((r.page_id, r.record_type, r.payload and hashlib.sha256(r.payload).hexdigest()) for r in rows.collect())
    one = [(k, "request" if k == 1 else "response", body and k != 1 and hashlib.sha256(body).hexdigest()) for k, body in enumerate(foreign_bodies())]
    assert len(got) == 5 * len(one) and {g[:2] for g in got} == {o[:2] for o in one}
    assert {g[2] for g in got if g[0] > 1} == {o[2] for o in one if o[0] > 1}


@pytest.mark.parametrize(("condition", "n"), [
    ("page_id > 10", 5), ("page_id >= 11 and page_id < 14", 3), ("page_id <= 3", 2), ("url like 'http://b%'", 2), ("url > 'u'", 1),
])
def test_predicates_on_ranges_are_taken_over(spark, condition, n):
    folder = scratch_path(spark, "warc")
    warc.register(spark)
    warc.write_pages(spark.createDataFrame(pages(), "page_id long, url string, html string"), folder)
    rows = warc.read_archive(spark, folder, "page_id long, url string").where(condition)
    assert rows.count() == n
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert " Filter " not in plan


def test_empty_archive(spark):
    folder = scratch_path(spark, "warc")
    warc.register(spark)
    warc.write_pages(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.read_archive(spark, folder).collect() == []


@pytest.fixture(scope="module")
def tokenizer():
    return tokens.encoder(vocabulary("word_bpe_49k.json")).tokenizer


def ids_of(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_are_encoded_as_in_their_text(name):
    if name.startswith("byte"):
        pytest.skip("a byte-level tokenizer keeps the space in front of a word: its words are not independent")
    rng, coder = random.Random(3), tokens.Encoder(vocabulary(name))
    bits = ["it's", "IT'S", "<|endoftext|>", "<|ENDOFTEXT|>", "a<|startoftext|>b,", "É", "é", "é,", "ΣΑΣ.", "İx", "x y", "1,234.5%", "(foo)", "'s", "s'", "日本語", "ß!!", "ﬁ,", "\x0b", "\r\n", "“q”,", "x²,", "\x1f", "≠,"]
    texts = ["".join(rng.choice([" ", "\n", "", "  "]).join(rng.choice(bits) for _ in range(rng.randint(0, 9)))) for _ in range(1500)]
    ids, starts = coder.encode(pa.array(texts).slice(5))
    for text, a, b in zip(texts[5:], starts[:-1], starts[1:], strict=True):
        assert ids[a:b].tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 5)
    coder = tokens.Encoder(vocabulary("word_bpe_49k.json"))
    for k in range(5):
        text = f"one two{k} three four five six{k}"
        assert coder.encode(pa.array([text]))[0].tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_token_files(spark, docs, sample, empty, tokenizer):
    folder = scratch_path(spark, "tokens")
    token_files.write_tokens(docs, folder, vocabulary("word_bpe_49k.json"), 1)
    got = token_files.read_tokens(spark, folder, with_ids=True).collect()
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == crc(r.ids)
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted((r[0] for r in sample), key=lambda i: (i is not None, i or 0))
    assert ordered((r.doc_id, r.ids) for r in got) == ordered((r[0], ids_of(tokenizer, r[1], 1)) for r in sample)
    folder = scratch_path(spark, "tokens")
    token_files.write_tokens(empty, folder, vocabulary("word_bpe_49k.json"), 1)
    assert token_files.read_tokens(spark, folder).collect() == []


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, held = packing.best_fit(np.array([6, 5, 3, 4, 2]), 10)
    assert held == [10, 10] and bins[0] == bins[3] and bins[1] == bins[2] == bins[4]
    assert offsets.tolist() == [0, 0, 5, 6, 8]


def checked(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(spark, docs, sample, empty, tokenizer):
    items = stage(packing.pieces(docs, vocabulary("word_bpe_49k.json"), 0), "pieces")
    got = packing.pack(items).collect()
    want = []
    for r in sample:
        ids = ids_of(tokenizer, r[1], 0)
        want += [(r[0], k, s, len(ids[s:s + 2048]), crc(ids[s:s + 2048])) for k, s in enumerate(range(0, len(ids), 2048))]
    assert ordered((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == ordered(want)
    assert checked(got, 2048) <= 1.1 * sum(w[3] for w in want) / 2048 + 1
    assert packing.pack(packing.pieces(empty, vocabulary("word_bpe_49k.json"), 0)).collect() == []


def test_rounds_merge_what_partitions_leave(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    rng = random.Random(8)
    items = [(k, rng.choice([10, 300, 700, 1025, 1100, 2048])) for k in range(600)]
    table = spark.createDataFrame(items, "key long, length long").repartition(12)
    got = packing.pack(table).collect()
    assert sorted((r.key, r.length) for r in got) == items
    alone, _, held = packing.best_fit(np.array([n for _, n in items]), 2048)
    assert checked(got, 2048) <= len(held) * 1.03


def test_targets_are_dealt_until_none_is_above(spark):
    sizes = [("a", 100), ("b", 1000), ("c", 10), ("d", 500), ("e", 0), (None, 300)]
    table = spark.createDataFrame([(s is None, s or "", n) for s, n in sizes], "missing boolean, name string, size long")
    got = {(r.name, r.missing): r.target for r in mixing.source_targets(table).collect()}
    weights = dict(zip(["a", "b", "c", "d", "e", None], [3, 1, 2, 3, 1, 2], strict=True))
    total, open_, want = 1.5 * sum(n for _, n in sizes), dict(sizes), {}
    while open_:
        price = (total - sum(want.values())) / sum(weights[s] for s in open_)
        above = [s for s, n in open_.items() if price * weights[s] > 2 * n]
        if not above:
            want |= {s: price * weights[s] for s in open_}
            break
        want |= {s: 2.0 * open_.pop(s) for s in above}
    assert got == pytest.approx({(s or "", s is None): t for s, t in want.items()})


def test_mix(clashing, docs, sample, empty):
    got = mixing.mix(clashing).collect()
    assert ordered((r.doc_id, r.text, r.mix_size) for r in got) == ordered((r[0], r[1], by_hand(r[1])[0]) for r in sample)
    taken, targets = Counter(), {}
    for r in got:
        words = sum(c.words for c in r.mix_copies)
        assert words <= 2 * r.mix_size and all(0 <= c.position <= 1 for c in r.mix_copies)
        assert [c.position for c in r.mix_copies] == sorted(c.position for c in r.mix_copies)
        taken[r.source] += words
        targets[r.source] = r.mix_target
    assert all(abs(taken[s] - t) <= 1 for s, t in targets.items())
    key = lambda rows: ordered((r.doc_id, r.text, [tuple(c) for c in r.mix_copies]) for r in rows)
    assert key(mixing.mix(clashing.repartition(5)).collect()) == key(got)
    assert mixing.mix(empty).collect() == []
    whole = mixing.mix(docs, cut=False).collect()
    assert all(c.words == r.mix_size for r in whole for c in r.mix_copies)
    order = [r.mix_copy.position for r in mixing.in_training_order(mixing.mix(docs)).collect()]
    assert order == sorted(order) and len(order) == sum(len(r.mix_copies) for r in got)


@pytest.mark.parametrize("schedule", [*mixing.CURRICULUM, mixing.Schedule(1, ((0.0, 0.0), (0.3, 2.0), (0.6, 0.0), (1.0, 1.0)))])
def test_times_invert_the_integral(spark, schedule):
    shares = [k / 200 for k in range(201)]
    table = spark.createDataFrame([(s,) for s in shares], "s double")
    times = [r[0] for r in table.select(mixing._time_of(F.col("s"), schedule)).collect()]
    knots = schedule.knots

    def integral(t):
        total = 0.0
        for (a, u), (b, v) in zip(knots, knots[1:], strict=False):
            if t > a:
                x = min(t, b) - a
                total += u * x + (v - u) * x * x / (2 * (b - a))
        return total

    assert [integral(t) / integral(1.0) for t in times] == pytest.approx(shares, abs=1e-6)
    assert times == sorted(times)


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0
            if {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15,
            }[kind]:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], personal.KINDS.index(s[2])))


def test_guarded_patterns_match_as_the_plain_ones():
    rng = random.Random(9)
    bits = ["a@b.c", "@", ".", "-", "1", "12", "256", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 010-9999", "+", " ", "x", "%", "é", "a.b@c-d.ee.f", "0", "\n", "(", ")", "٣"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert personal.base_spans(text) == plain_spans(text), text


def test_long_runs_stay_linear():
    for text in ("a" * 200_000, "1" * 200_000, "a" * 100_000 + "@" + "b" * 100_000, "1." * 100_000, "1-" * 100_000, "+1" + "(" * 100_000, "0" * 9_000 + ".1.2.3"):
        personal.loose_spans(text, personal.base_spans(text))


def personal_rows():
    rng, rows = random.Random(2), []
    for k in range(200):
        rows.append((k, f"text {k} write to me{k}@mail{k % 7}.example.com or call +1 (555) 010-{rng.randrange(1000, 9999)} host {rng.randrange(1, 223)}.1.2.3 end"))
    rows += [(300 + k, f"phone (415) 555-{1000 + k} or jane.roe{k} (at) mail.example.com now") for k in range(40)]
    rows += [(400 + k, f"number {4000000000000000 + k * 7} in order 999.1.2.3") for k in range(40)]
    return [*rows, (500, None), (501, ""), (None, "a@b.co"), (500, "nothing")]


def test_personal_data(spark):
    table = spark.createDataFrame(personal_rows(), "doc_id long, text string").withColumn("proposals", F.lit("own"))
    got = {(r.doc_id, r.base_sha256): r for r in personal.find(table).collect()}
    for i, text in personal_rows():
        base = plain_spans(text or "")
        listed = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        row = got[i, hashlib.sha256(listed.encode()).hexdigest()]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for *_, k in base) for kind in personal.KINDS]
        spans = row.spans.split(",") if row.spans else []
        assert set(f"{k}:{a}:{b}" for a, b, k in base) <= set(spans) or not base
        if i is not None and 300 <= i < 340:
            assert [s.split(":")[0] for s in spans] == ["phone", "email"]  # added by the classifier
        if i is not None and 400 <= i < 440:
            assert len(spans) == len(base)  # failing numbers are left alone
    none = spark.createDataFrame([], "doc_id long, text string")
    assert personal.find(none).collect() == [] and not personal.fit(personal.propose(none, ["doc_id"])).any()


def test_reliabilities_are_found_without_labels():
    rng = np.random.default_rng(6)
    true = rng.random(6000) < 0.4
    right = [0.95, 0.9, 0.8, 0.7, 0.55]
    ballots = np.stack([np.where(rng.random(6000) < p, true, ~true) * 2 - 1 for p in right], 1)
    patterns, which, counts = np.unique(ballots, axis=0, return_inverse=True, return_counts=True)
    guess = personal.estimate(patterns, counts)[which.ravel()] > 0.5
    majority = ballots.sum(1) > 0
    assert (guess == true).mean() > max(0.94, (majority == true).mean())


def test_redaction(clashing, docs, sample, empty):
    got = personal.redact(clashing)
    assert got.columns == clashing.columns and got.count() == len(sample)
    assert {r["proposals"] for r in got.collect()} == {"own proposals"}
    assert personal.replaced("a x@y.zz b", [{"kind": 0, "start": 2, "end": 8}, {"kind": 3, "start": 5, "end": 9}]) == "a <email>b"
    assert personal.redact(empty).collect() == []


def test_pipeline(spark, sample, docs, tmp_path, empty):
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(r[0], 1, 0) for r in sample], LABELS).write.parquet(f"{folder}/labels.parquet")
    now, columns = spark.read.parquet(f"{folder}/documents.parquet"), docs.columns
    for name, apply in corpus_pipeline.STAGES[:-1]:
        before, now = now, stage(apply(spark, now, folder), name)
        assert now.columns == columns
        if name != "source_mixing":
            assert now.count() <= before.count()
    kept = {r.doc_id for r in now.collect()}
    assert kept and not kept & {151, 152, 153} and len(kept & set(range(100, 118))) <= 1
    last = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in last} == kept and checked(last, 2048)
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, empty, folder).collect() == []


def test_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14)) and set(SQL) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "personal_data", "source_mixing", "best_fit_packing"]
