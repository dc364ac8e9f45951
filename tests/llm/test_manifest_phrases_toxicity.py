import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsemart.llm import gated, merkle_log, phrases, queries, toxicity


def ordered(rows):
    return sorted(map(repr, rows))


def brute_tree(nodes):
    """Root and, for each leaf, its siblings with their side."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, k in enumerate(at):
            paths[leaf].append((k & 1, nodes[k ^ 1]) if k ^ 1 < len(nodes) else None)
        nodes = [hashlib.sha256("".join(nodes[k:k + 2]).encode()).hexdigest() for k in range(0, len(nodes), 2)]
        at = [k // 2 for k in at]
    return nodes[0], paths


def brute_manifest(rows):
    def leaf(doc_id, text, lang, source, n_chars):
        fields = [doc_id, source, lang, n_chars, text]
        return hashlib.sha256("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields).encode()).hexdigest()

    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        raised = n_chars
        if n_chars is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
            raised += 1
        groups[lang].append((doc_id, leaf(doc_id, text, lang, source, n_chars), leaf(doc_id, text, lang, source, raised)))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {g: brute_tree([r[1] for r in own]) for g, own in groups.items()}
    root, above = brute_tree([trees[g][0] for g in langs]) if langs else (None, [])
    out = []
    for lang, rest in zip(langs, above, strict=True):
        subroot, paths = trees[lang]
        for (doc_id, own, checked), path in zip(groups[lang], paths, strict=True):
            node = checked
            for step in path + rest:
                pair = [node] if step is None else [step[1], node] if step[0] else [node, step[1]]
                node = hashlib.sha256("".join(pair).encode()).hexdigest()
            proof = hashlib.sha256("".join(s[1] for s in path + rest if s).encode()).hexdigest()
            out.append((doc_id, own, subroot, root, proof, node, node == root))
    return out


@pytest.mark.parametrize("height", [2, 12])
def test_manifest(monkeypatch, clashing, docs, sample, empty, height):
    """At height 2, builders are stacked several rounds high; results are the same."""
    monkeypatch.setattr(merkle_log, "HEIGHT", height)
    want = ordered(brute_manifest(sample))
    assert ordered(map(tuple, merkle_log.manifest(clashing).collect())) == want
    assert {r[6] for r in brute_manifest(sample)} == {True, False}
    if height == 12:
        assert merkle_log.manifest(empty).collect() == []
        assert ordered(map(tuple, merkle_log.manifest(docs.limit(1)).collect())) == ordered(brute_manifest([tuple(r) for r in docs.limit(1).collect()]))


@pytest.mark.parametrize("leaves", [1, 2, 3, 5, 8, 13, 16, 31])
def test_places(leaves):
    """Closed-form places address exactly the nodes that the log holds, in the order of their completion."""
    digests = [hashlib.sha256(bytes([k])).digest() for k in range(leaves)]
    for height in (merkle_log.height_of(leaves), 6):
        log = merkle_log.build(digests, height)
        levels = [digests]
        for _ in range(height):
            levels.append([merkle_log.node_hash(*levels[-1][k:k + 2]) for k in range(0, len(levels[-1]), 2)])
        places = [merkle_log.place(lev, k, leaves) for lev, nodes in enumerate(levels) for k in range(len(nodes))]
        assert sorted(places) == list(range(len(log) // 32))
        for lev, nodes in enumerate(levels):
            for k, node in enumerate(nodes):
                at = merkle_log.place(lev, k, leaves) * 32
                assert log[at:at + 32] == node
                if lev:
                    assert merkle_log.place(lev, k, leaves) > merkle_log.place(lev - 1, min(2 * k + 1, len(levels[lev - 1]) - 1), leaves)


def brute_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        small = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", small):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                f.update((lang, tuple(words[i:i + size])) for i in range(len(words) - size + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = set()
    for (lang, words), a in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                if 100 * a >= 100 * f[lang, words[i:i + size]]:
                    gone.add((lang, words[i:i + size]))
    out = defaultdict(list)
    for (lang, words), a in found.items():
        if (lang, words) not in gone:
            cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out[lang].append((" ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], n[lang], score))
    return [
        (lang, rank, *row) for lang, rows in out.items()
        for rank, row in enumerate(sorted(rows, key=lambda r: (-r[5], -r[1], r[0].encode()))[:top], 1)
    ]


def wordy():
    """Few words, so that phrases repeat, with copies, marks, long and odd texts."""
    rng, out = random.Random(4), []
    for i in range(120):
        text = "".join(rng.choice("the The a an é ab of x-y ü the the".split()) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " \r"]) for _ in range(rng.randrange(90)))
        out += [(text, rng.choice(["en", "en", "fr", None, "und", ""]))] * rng.choice([1, 1, 3])
    return out + [("ab " * 3000, "en"), (None, None), ("", "en"), (" .,; ", "fr"), ("one", "de"), ("\0 \0 \0 " * 40, "de")]


@pytest.mark.parametrize(("period", "bits"), [(32, 1 << 24), (2, 1 << 24), (3, 1 << 15)])
def test_phrases(spark, empty, period, bits):
    """Equal to brute force however texts are cut, and with a table so small that it lets most pass."""
    rows = wordy()
    table = spark.createDataFrame([(i, *r, "own") for i, r in enumerate(rows)], "doc_id long, text string, lang string, phrase string").repartition(3)
    assert ordered(map(tuple, phrases.mine(table, 20, 30, period, bits).collect())) == ordered(brute_phrases(rows, 20, 30))
    if period == 2:
        assert phrases.mine(empty).collect() == []


def test_chunks_are_chosen_by_content():
    """A passage has the same chunks inside, wherever it stands; together they own each word once."""
    rng = random.Random(9)
    passage = " ".join(rng.choice("ba de fi go lu mer".split()) + str(rng.randrange(50)) for _ in range(400))
    one = phrases.chunks(pa.array([f"Here. {passage}"]), 8).to_pylist()
    two = phrases.chunks(pa.array([f"Quite another start, then {passage} and more"]), 8).to_pylist()
    assert len(set(one) & set(two)) > 0.9 * len(one) > 30
    owned = [len(re.findall(rb"[^ \n]+", c[1:])) - int(c[:1]) for c in one]
    assert sum(owned) == 401


def test_exact_scores(spark):
    """Products beyond 64 bits."""
    big = 4_000_000_000
    row = spark.createDataFrame([(big, big * 7, 3, 5)], "a long, n long, l long, r long")
    got = row.select(F.call_function("div", F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)"),
                                     F.lit("1" + 20 * "0").cast("decimal(38,0)")).alias("s")).first().s
    assert got == 1000 * big * big * 7 // 10**20


def insulting(count, seed):
    """Prose, half of it with a marked word somewhere."""
    rng, out = random.Random(seed), []
    for i in range(count):
        words = ["".join(rng.choice("ba de fi go lu mer nat or".split()) for _ in range(rng.randint(1, 3))) for _ in range(rng.randrange(20, 160))]
        toxic = i % 2
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["Quzzik", "wexxle", "ziqqat"]))
        out.append((i, " ".join(words), toxic))
    return out


@pytest.fixture(scope="module")
def model(spark):
    rows = insulting(300, 1)
    toxicity_docs = spark.createDataFrame([r[:2] for r in rows] + [(7, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    return toxicity.fit(toxicity_docs, labels, steps=80)


def test_toxicity_held_out(spark, model, clashing, sample, empty):
    rows = insulting(200, 2)
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, own int").repartition(3), model).collect()}
    right = [got[i].predicted == t for i, _, t in rows]
    assert np.mean(right) >= 0.95
    everything = toxicity.score(clashing, model).collect()
    assert len(everything) == len(sample) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in everything)
    assert toxicity.score(empty, model).collect() == []


def test_toxicity_reads_whole_texts(spark, model):
    clean = insulting(300, 1)[0][1]
    texts = [clean * 40, clean * 40 + " quzzik wexxle ziqqat quzzik", "", None, "x" * 5000]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert got[0] < 0.5 < got[1] and got[2] == got[3] < 0.5


def test_windows_cover_all_words():
    tokens = toxicity.Tokens(pa.array(["a b", "", "w " * 33, "v " * 100, None, "z" * 60, "d1e-f"]))
    text, first, sizes = tokens.windows()
    assert np.diff(tokens.starts).tolist() == [2, 0, 33, 100, 0, 3, 3]
    for t, (a, b) in enumerate(zip(tokens.starts[:-1], tokens.starts[1:], strict=True)):
        covered = {k for f, s in zip(first[text == t], sizes[text == t], strict=True) for k in range(f, f + s)}
        assert covered == set(range(a, b))


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.5}


def test_gradients():
    rng = np.random.default_rng(1)
    params = {k: v.astype(np.float64) for k, v in gated.new_params(rng.normal(0, 0.3, (6, gated.WORD_DIM)), 3).items()}
    net = gated.Network(params)
    words = rng.integers(0, 256, (5, 4)), np.array([1, 4, 2, 3, 4]), np.array([0, 1, 2, 5, 3])
    codes, sizes, labels = rng.integers(0, 5, (3, 6)), np.array([6, 2, 4]), np.array([1, 0, 1])

    def loss():
        found = net.windows(net.word_gates(*words), codes, sizes).astype(float)
        return -(labels * np.log(found) + (1 - labels) * np.log(1 - found)).mean()

    grads = net.learn(*words, codes, sizes, labels)
    for name, values in params.items():
        at = np.unravel_index(np.argmax(np.abs(grads[name])), values.shape)
        old = values[at]
        values[at] = old + 1e-2
        up = loss()
        values[at] = old - 1e-2
        down = loss()
        values[at] = old
        assert (up - down) / 2e-2 == pytest.approx(grads[name][at], rel=0.02, abs=1e-4)


def write_tables(spark, folder, docs, labels):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")


def test_registered_queries(spark, tmp_path, docs, sample):
    """The registered functions themselves, over written tables."""
    texts = [(i, t, None, None, 0) for i, t, _ in insulting(120, 5)]
    write_tables(
        spark, str(tmp_path), docs.unionByName(spark.createDataFrame(texts, docs.schema)),
        spark.createDataFrame([(i, t) for i, _, t in insulting(120, 5)], "doc_id long, toxic int"),
    )
    rows = [*sample, *texts]
    assert ordered(map(tuple, queries.op11_merkle_manifest(spark, str(tmp_path)).collect())) == ordered(brute_manifest(rows))
    want = [(lang, rank, p, a, left, r, n, s) for lang, rank, p, a, left, r, n, s in brute_phrases([(r[1], r[2]) for r in rows], 100, 2000)]
    assert ordered(map(tuple, queries.op12_collocations(spark, str(tmp_path)).collect())) == ordered(want)
    found = queries.op13_toxicity(spark, str(tmp_path)).collect()
    assert ordered(r.doc_id for r in found) == ordered(r[0] for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert found[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
