"""Language-model scores, n-gram join, suffix dedup and fingerprints against brute force."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from pulsemart.llm import fingerprints, ngram_join, ngram_model, suffix_dedup
from pulsemart.llm.common import stage
from pulsemart.llm.elias_fano import EliasFano, Trie
from pulsemart.llm.words import coded_words, parts


def words(text):
    return (text or "").encode().lower().split()


def ordered(rows):
    return sorted(rows, key=repr)


def test_words_of_slices(sample):
    batch = pa.RecordBatch.from_pydict({"text": pa.array([r[1] for r in sample])}).slice(3)
    seen = []
    for part in parts(batch, "text", 500):
        found, numbers, starts = coded_words(part.column(0))
        seen += [[found[k] for k in numbers[a:b]] for a, b in zip(starts[:-1], starts[1:], strict=True)]
    assert seen == [words(r[1]) for r in sample[3:]]


@pytest.mark.parametrize("values", [[], [0], [5, 5, 5], [0, 1, 2**40, 2**40 + 7, 2**60], list(range(0, 5000, 7))])
def test_successor_search(values):
    sequence = EliasFano(*EliasFano.pack(np.array(values, np.uint64)))
    asked = sorted({v + d for v in values for d in (-1, 0, 1) if v + d >= 0} | {0, 3, 2**41, 2**61})
    index, hit = sequence.successor(np.array(asked, np.uint64))
    assert index.tolist() == [next((k for k, v in enumerate(values) if v >= x), len(values)) for x in asked]
    assert hit.tolist() == [x in values for x in asked]


def test_trie_finds_words_inside_their_context(tmp_path):
    rng = random.Random(1)
    table = {c: sorted(rng.sample(range(1 << 20), rng.randint(1, 30))) for c in sorted(rng.sample(range(1 << 50), 40))}
    firsts = np.cumsum([0, *map(len, table.values())])
    flat = np.array([w for ws in table.values() for w in ws], np.uint64)
    trie = Trie(str(tmp_path / "t"), np.array(list(table), np.uint64), firsts, flat, 20, np.arange(1, len(flat) + 1, dtype=np.uint16), np.full(len(table), 9, np.uint16))
    contexts = np.repeat(np.array(list(table), np.uint64), np.diff(firsts))
    codes, own = trie.look_up(contexts, flat)
    assert codes.tolist() == list(range(1, len(flat) + 1)) and set(own.tolist()) == {9}
    codes, _ = trie.look_up(contexts[::-1].copy(), flat)
    assert [c > 0 for c in codes.tolist()] == [int(w) in table[int(c)] for c, w in zip(contexts[::-1], flat, strict=True)]
    assert trie.look_up(np.array([1], np.uint64), np.array([1], np.uint64))[1].tolist() == [0]


@pytest.mark.parametrize(("shards", "chunk"), [(1, 4_000_000), (5, 2_000), (64, 20_000)])
def test_scores(docs, sample, empty, monkeypatch, shards, chunk):
    monkeypatch.setattr(ngram_model, "HOT", 1.28 / shards)  # some contexts are hot
    monkeypatch.setattr(ngram_model, "MIN_SHARDS", shards)
    monkeypatch.setattr(ngram_model, "CHUNK_BYTES", chunk)
    texts = [(r[0], zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 7 == 2, [*words(r[1]), None]) for r in sample]
    c = Counter(w for _, held, t in texts if not held for w in t)
    pairs = Counter(p for _, held, t in texts if not held for p in zip(t, t[1:], strict=False))
    after, total = Counter(u for u, _ in pairs), Counter()
    for (u, _), n in pairs.items():
        total[u] += n
    size, distinct = sum(c.values()), len(c)

    def one(w):
        return (c[w] + 1) / (size + distinct + 1)

    def two(u, w):
        if not total[u]:
            return one(w)
        return max(pairs[u, w] - 0.75, 0) / total[u] + 0.75 * after[u] / total[u] * one(w)

    want = ordered(
        (i, held, len(t), sum(c[w] > 0 for w in t), size, round(sum(math.log10(one(w)) for w in t), 6)) for i, held, t in texts
    )
    got = ngram_model.score(docs).collect()
    assert ordered((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    scores = {(i, len(t), round(math.log10(one(t[0])) + sum(math.log10(two(u, w)) for u, w in zip(t, t[1:], strict=False)), 1)) for i, _, t in texts}
    for r in got:
        assert any(i == r.doc_id and n == r.n_tokens and abs(s - r.score) < 0.1 + n * 0.6 / ngram_model.STEPS for i, n, s in scores)
    assert ngram_model.score(empty).collect() == []


def test_hot_contexts_are_spread_by_their_share():
    hot = ngram_model._Hot({7: 1000, 3: 150, 9: 101}, bound=100.0, shards=8)
    assert hot.words.tolist() == [3, 7, 9] and hot.spread.tolist() == [2, 8, 2] and hot.totals.tolist() == [150, 1000, 101]
    place, found = hot.find(np.array([9, 8, 3, 2**63], np.uint64))
    assert found.tolist() == [True, False, True, False] and hot.words[place[found]].tolist() == [9, 3]
    assert not ngram_model._Hot({}, 1.0, 4).find(np.array([1], np.uint64))[1].any()


def test_batches_are_gathered(monkeypatch):
    monkeypatch.setattr(ngram_model, "CHUNK_BYTES", 100)
    batches = [pa.RecordBatch.from_pydict({"a": pa.array(range(n), pa.int64())}) for n in (5, 5, 5, 0, 40, 1)]
    assert [b.num_rows for b in ngram_model._gathered(iter(batches))] == [10, 5, 40, 1]
    assert list(ngram_model._gathered(iter([]))) == []


def test_probabilities_sum_to_one():
    # shares of the words after a context and its backoff, as a shard computes them
    n = np.array([5, 3, 1, 1])
    assert math.isclose(((n - ngram_model.DISCOUNT) / n.sum()).sum() + ngram_model.DISCOUNT * len(n) / n.sum(), 1)
    p = np.array([1.0, 0.5, 1e-7])
    assert np.allclose(ngram_model.restored(ngram_model.quantised(p), 0), p, rtol=2e-4)


def brute_classes(pairs):
    """Rows that links reach from each (id, shingles), as a number; rows without shingles are classes of their own."""
    sets = [s for _, s in pairs]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    columns = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            columns[x].append(k)
    for k, s in enumerate(sets):
        for j in {j for x in s for j in columns[x] if j < k}:
            both = len(s & sets[j])
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                parent[root(k)] = root(j)
    return [root(k) for k in range(len(sets))]


def brute_components(pairs):
    """Component of each (id, shingles); equal to the smallest id reachable."""
    classes, ids = brute_classes(pairs), defaultdict(list)
    for c, (i, _) in zip(classes, pairs, strict=True):
        ids[c].append(i)
    return [min((i for i in ids[c] if i is not None), default=None) if s else i for c, (i, s) in zip(classes, pairs, strict=True)]


def shingled(text):
    own = words(text)
    return frozenset(tuple(own[k:k + 5]) for k in range(max(1, len(own) - 4))) if own else frozenset()


def chained():
    """Texts that link in a chain, each only with the next, and a crowd that shares a passage without linking."""
    own = [f"w{k}" for k in range(100)]
    chain = [(200 + k, " ".join(own[3 * k:] + [f"v{j}" for j in range(3 * k)])) for k in range(8)]
    crowd = [(300 + k, " ".join([f"c{j}" for j in range(40)] + [f"d{k}x{j}" for j in range(9 + k)])) for k in range(30)]
    return chain + crowd


def test_join(spark, docs, sample, empty):
    found = ngram_join.near_duplicates(docs).collect()
    sets = [(r[0], shingled(r[1])) for r in sample]
    assert ordered(map(tuple, found)) == ordered((i, len(s), c) for (i, s), c in zip(sets, brute_components(sets), strict=True))
    assert ngram_join.near_duplicates(empty).collect() == []


def crowds():
    """Near copies of two patterns with one to four edits each, some of them shared, and columns common to both patterns."""
    rng, out = random.Random(12), []
    for g in range(2):
        pattern = [f"c{j}" for j in range(30)] + [f"p{g}x{j}" for j in range(90)]
        for k in range(40):
            text = list(pattern)
            for _ in range(rng.randrange(5)):
                at = rng.randrange(len(text))
                text[at] = rng.choice([f"e{at}", f"e{g}y{k}z{at}"])
            out.append((1000 * g + k, " ".join(text[rng.randrange(4):])))
    return out


@pytest.mark.parametrize("make", [chained, crowds])
def test_join_of_chains_and_crowds(spark, make):
    table = spark.createDataFrame(make(), "doc_id long, text string")
    sets = [(i, shingled(t)) for i, t in make()]
    assert ordered(map(tuple, ngram_join.near_duplicates(table).collect())) == ordered((i, len(s), c) for (i, s), c in zip(sets, brute_components(sets), strict=True))


@pytest.mark.parametrize("entries", [50, 4000])
def test_join_in_many_shards_and_blocks(spark, docs, sample, monkeypatch, entries):
    monkeypatch.setattr(ngram_join, "SHARD_ENTRIES", entries)
    monkeypatch.setattr(ngram_join, "BLOCK_ENTRIES", entries // 2)
    sets = [(r[0], shingled(r[1])) for r in sample]
    assert ordered(map(tuple, ngram_join.near_duplicates(docs).collect())) == ordered((i, len(s), c) for (i, s), c in zip(sets, brute_components(sets), strict=True))


def test_a_shard_of_many_rows_sends_to_many_blocks():
    entries = SimpleNamespace(groupBy=lambda _: SimpleNamespace(applyInArrow=lambda run, _: run))
    run, rows = ngram_join._shared(entries, 20_000), 200_000
    keys = np.random.default_rng(1).integers(-1 << 62, 1 << 62, rows)
    lone = np.arange(1, 101, dtype=np.int64)  # rows of one column, which no other row has

    def message(keys, columns, counts, size):
        raw = columns.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
        return 3, keys.tobytes(), np.full(len(keys), size, "<u4").tobytes(), counts.astype("<u4").tobytes(), raw

    pairs = np.repeat(np.arange(rows // 2), 2)  # each column has two rows, each row two columns
    columns = np.stack([pairs, (np.arange(rows) + 1) % rows // 2 + (1 << 30)], 1).ravel()
    columns.reshape(-1, 2).sort()
    sent = [message(keys, columns, np.full(rows, 2), 7), message(keys[:4], columns[:8], np.full(4, 2), 7), message(lone, lone + (1 << 35), np.ones(100), 1)]
    kinds = [pa.int32(), *[pa.binary()] * 4]
    table = pa.table([pa.array(c, k) for c, k in zip(zip(*sent, strict=True), kinds, strict=True)], names=["shard", "keys", "sizes", "counts", "columns"])
    start = time.process_time()
    got = run(table).to_pydict()
    took = time.process_time() - start
    flat = {k: np.concatenate([np.frombuffer(x, t) for x in got[k]]) for k, t in (("keys", "<i8"), ("sizes", "<u4"), ("counts", "<u4"), ("columns", "<u8"), ("often", "<u4"))}
    assert sorted(got["block"]) == sorted(set((keys.view(np.uint64) % np.uint64(20_000)).tolist()))
    assert all((np.frombuffer(k, "<u8") % np.uint64(20_000) == b).all() for k, b in zip(got["keys"], got["block"], strict=True))
    assert (flat["sizes"] == 7).all() and (flat["counts"] == 2).all() and (flat["often"] == 2).all()
    order, own = np.argsort(keys), np.argsort(flat["keys"])
    assert np.array_equal(flat["keys"][own], keys[order])
    assert np.array_equal(flat["columns"].reshape(-1, 2)[own], columns.reshape(-1, 2)[order] | 3 << 40)
    assert took < 3  # under 1 s; 12 s when all rows' sizes were gathered anew for each block


def test_keep_one(clashing, sample, empty):
    kept = ngram_join.keep_one(clashing)
    assert kept.columns == clashing.columns
    got = kept.collect()
    assert all(r["label"] == "own label" and r["set_key"] == "own set_key" for r in got)
    sets = [(r[0], shingled(r[1])) for r in sample]
    classes = defaultdict(set)
    for (i, s), c in zip(sets, brute_classes(sets), strict=True):
        if s:
            classes[c].add(i)
    kept_ids = Counter(r["doc_id"] for r in got if words(r["text"]))
    assert len(got) == len(classes) + sum(not s for _, s in sets)
    assert kept_ids == Counter(min((i for i in ids if i is not None), default=None) for ids in classes.values())
    assert ngram_join.keep_one(empty).collect() == []


def test_keep_one_of_real_components(spark):
    own = [" ".join(f"u{k}x{j}" for j in range(20)) for k in range(5)]
    near = " ".join(f"u4x{j}" for j in range(19))  # links with the last text, 15 of 16 shingles
    table = [(None, own[0]), (None, own[1]), (3, own[2]), (3, own[3]), (None, own[4]), (9, near), (9, near), (None, "")]
    kept = ngram_join.keep_one(spark.createDataFrame(table, "doc_id long, text string").repartition(3)).collect()
    assert ordered(map(tuple, kept)) == ordered([*table[:4], (9, near), (None, "")])


def brute_repeats(texts):
    length, seen = suffix_dedup.LENGTH, Counter()
    for t in texts:
        seen.update(t[i:i + length] for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_removal(docs, sample, empty):
    want = [(r[0], *x) for r, x in zip(sample, brute_repeats([(r[1] or "").encode() for r in sample]), strict=True)]
    assert ordered(map(tuple, suffix_dedup.remove_repeats(docs).collect())) == ordered(want)
    assert suffix_dedup.remove_repeats(empty).collect() == []


def test_removal_of_passages_that_differ_at_either_end(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RUN_BYTES", 3_000)  # many runs
    monkeypatch.setattr(suffix_dedup, "SHARD_RECORDS", 2)
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdef ghij") for _ in range(1500))
    texts = []
    for k in range(40):
        a, b = rng.randrange(0, 700), rng.randrange(800, 1500)
        texts.append("".join(rng.choice("klmnop") for _ in range(rng.randrange(300))) + passage[a:b] + "".join(rng.choice("qrstu") for _ in range(rng.randrange(300))))
    texts += ["z" * 399, "z" * 400, "y" * 900, "ab" * 401, passage]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = [(k, *x) for k, x in enumerate(brute_repeats([t.encode() for t in texts]))]
    assert sorted(map(tuple, suffix_dedup.remove_repeats(table).collect())) == want


def test_no_task_merges_a_frequent_passage(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_RECORDS", 4, raising=False)
    merged, runs = [], suffix_dedup._runs
    monkeypatch.setattr(suffix_dedup, "_runs", lambda texts, splitters: merged.append(texts) or runs(texts, splitters))
    rng = random.Random(9)
    rand = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    passage, other = rand("abcdef ghij", 900), rand("abcdef ghij", 500)
    texts = [rand("klmnop", rng.randrange(300)) + passage[rng.randrange(200):rng.randrange(560, 900)] + rand("qrstu", rng.randrange(300)) for _ in range(60)]
    texts += [rand("klmnop", 90) + passage[a:b] + rand("qrstu", 90) for a, b in ((0, 300), (300, 560), (100, 499), (100, 500), (101, 501))]
    texts += [passage, passage + rand("klm", 20), rand("klm", 20) + passage, other + "k", "l" + other, "z" * 1500, "ab" * 450]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = sorted(map(tuple, suffix_dedup.remove_repeats(table).collect()))
    assert got == [(k, *x) for k, x in enumerate(brute_repeats([t.encode() for t in texts]))]
    (listed,) = [r.hashes for texts in merged for r in texts.selectExpr("explode(hashes) as h").groupBy("h").count().selectExpr("max(count) as hashes").collect()]
    assert listed and listed <= 4


def test_loser_tree_carries_prefixes():
    rng = random.Random(2)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(rng.randrange(1, 30))) for _ in range(7)]

    def coded(run):
        before = b""
        for s in run:
            yield s, suffix_dedup.common_prefix(before, s), (s,)
            before = s

    out = list(suffix_dedup.LoserTree([coded(r) for r in runs]))
    assert [s for s, _, _ in out] == sorted(s for r in runs for s in r)
    assert [p for _, p, _ in out[1:]] == [suffix_dedup.common_prefix(a[0], b[0]) for a, b in zip(out, out[1:], strict=False)]
    assert list(suffix_dedup.LoserTree([iter([])])) == []


def test_fingerprints(docs, sample, empty):
    got = fingerprints.compare_neighbours(docs).collect()
    order = sorted(sample, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars) for r in got) == sorted((r[0] is not None, r[0] or 0, len(r[1] or "")) for r in sample)
    texts = defaultdict(list)
    for r in sample:
        texts[r[0]].append(r[1] or "")
    unique = [r[0] for r in order if len(texts[r[0]]) == 1]
    by_id = {r.doc_id: r for r in got}
    prints = defaultdict(set)
    for a, b in zip(unique, unique[1:], strict=False):
        following = order[[r[0] for r in order].index(a) + 1][0]
        if following != b:
            continue  # an id of several texts lies between
        edited = fingerprints.edit(texts[a][0], texts[b][0])
        assert by_id[a].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        one, two, three = fingerprints.signatures([texts[a][0], edited, texts[b][0]])
        assert by_id[a].fingerprint == fingerprints.written(one) and by_id[a].edited_fingerprint == fingerprints.written(two)
        assert by_id[a].near_edited == (one == two).mean() and by_id[a].near_next == (one == three).mean()
        prints[texts[a][0]].add(by_id[a].fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert fingerprints.compare_neighbours(empty).collect() == []


def test_a_single_document_follows_itself(spark):
    (row,) = fingerprints.compare_neighbours(spark.createDataFrame([(7, "one two three four five six")], "doc_id long, text string")).collect()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"one two three four fiveone tw").hexdigest() or row.n_chars == 27


def test_collisions_follow_generalised_jaccard():
    rng = random.Random(3)
    estimates, truths = [], []
    for k in range(200):
        own = [f"w{rng.randrange(12)}" for _ in range(300)]  # few words: shingle counts above one
        other = own[:rng.randrange(300)] + [f"w{rng.randrange(12)}" for _ in range(60)]
        bags = [Counter(zip(*(t[i:] for i in range(5)), strict=False)) for t in (own, other)]
        keys = set(bags[0]) | set(bags[1])
        truths.append(sum(min(b[x] for b in bags) for x in keys) / sum(max(b[x] for b in bags) for x in keys))
        one, two = fingerprints.signatures([" ".join(own), " ".join(other)])
        estimates.append((one == two).mean())
    errors = np.array(estimates) - truths
    assert abs(errors.mean()) < 0.015 and errors.std() < 1.3 * math.sqrt(0.25 / fingerprints.SAMPLES)


def test_heavier_terms_win_in_proportion():
    terms = np.arange(1, 20001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    heavy = 0
    for k in range(0, 20000, 4):
        own = terms[k:k + 4]
        least = fingerprints._least([(own, np.array([1, 1, 1, 5]))])[0]
        only = fingerprints._least([(own[3:], np.array([5]))])[0]
        heavy += (least == only).sum()
        if k > 4000:
            break
    assert abs(heavy / (fingerprints.SAMPLES * (k / 4 + 1)) - 5 / 8) < 0.02


def test_stage_results_are_read_back(docs):
    assert stage(docs, "t").count() == docs.count()
