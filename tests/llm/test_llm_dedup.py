"""Substring, suffix-array, SimHash and embedding deduplication against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash

from lakeload.llm import embeddings, graphs, phrase_dedup, repeats, simhash, suffix_dedup
from lakeload.llm.anchors import all_owned, byte_grams, owned

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    """Small texts with copies, shared passages, edits, periodic and odd texts."""
    r = random.Random(5)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(400)]
    make = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    shared = [make(60), make(45), make(25)]
    texts = [make(r.randint(0, 200)) for _ in range(25)]
    for k in range(20):
        texts.append(make(r.randint(0, 50)) + " " + shared[k % 3] + "\n" + make(r.randint(0, 50)))
    base = make(150).split(" ")
    for k in range(8):
        w = list(base)
        w[r.randrange(len(w))] = "edit" + str(k)
        texts.append("  ".join(w) if k == 3 else " ".join(w))
    texts += ["a" * 700, "ab " * 300, "x y z " * 90, texts[0], texts[0], shared[0] + " " + shared[0], "", None, " \t\n", "One", "one two"]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    rows += [(None, texts[1]), (None, shared[1]), rows[2], rows[2], (7, shared[2])]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", 0) for i, t in corpus()], SCHEMA)


def rows_of(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)


def test_owner_of_a_window_depends_on_its_content_alone():
    r = random.Random(1)
    text = bytes(r.choice(b"abc") for _ in range(3000))
    data = text[100:900] + text + text[200:1500]
    width, window = 41, 80
    seen = {}
    for first, count, owner in all_owned(byte_grams(data), len(data) - window + 1, width):
        assert first[0] == 0 and (np.diff(first) == count[:-1]).all()
        for f, c, o in zip(first.tolist(), count.tolist(), owner.tolist()):
            for p in range(f, f + c):
                assert 0 <= o - p < width
                assert seen.setdefault(data[p:p + window], o - p) == o - p
    assert [len(x) for x in owned(np.zeros(0, np.uint64), -5, 9)] == [0, 0, 0]


def brute_bytes(rows, window):
    count = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        for p in range(len(b) - window + 1):
            count[b[p:p + window]] = count.get(b[p:p + window], 0) + 1
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if count[b[p:p + window]] > 1:
                gone[p:p + window] = b"\1" * window
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_dedup(docs):
    got = suffix_dedup.deduplicate(docs, digest=True)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(corpus(), 200)


def test_suffix_dedup_in_segments(docs, monkeypatch):
    import lakeload.llm.anchors as anchors
    monkeypatch.setattr(anchors, "SEGMENT", 37)
    got = suffix_dedup.deduplicate(docs.coalesce(1), threshold=100, core=30, digest=True)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(corpus(), 100)


def brute_words(rows, window):
    docs = [(i if i is not None else 1 << 70, WORDS.findall(t or ""), i) for i, t in rows]
    first = {}
    for i, w, _ in docs:
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            first[k] = min(first.get(k, (i, p)), (i, p))
    out = []
    for i, w, own in docs:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < (i, p):
                gone[p:p + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((own, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_phrase_dedup(docs):
    got = phrase_dedup.deduplicate(docs, digest=True)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_words(corpus(), 20)


def test_phrase_dedup_small_windows_and_shards(docs, monkeypatch):
    monkeypatch.setattr(phrase_dedup, "SHARD_ROWS", 3)
    got = phrase_dedup.deduplicate(docs, window=8, core=4, digest=True)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_words(corpus(), 8)


def test_equal_rows_list_their_passages_once(spark):
    r = random.Random(9)
    make = lambda n: " ".join(f"w{r.randrange(10 ** 6)}" for _ in range(n))
    text, other = make(90), make(40)
    mixed = make(30) + " " + " ".join(text.split()[5:70]) + " " + make(30)
    rows = [(5, text)] * 3000 + [(None, text)] * 3000 + [(6, mixed), (9, other), (8, other)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    _, found = phrase_dedup.passages(df.select("doc_id", "text"))
    assert max(r.n for r in found.selectExpr("size(s) AS n").collect()) <= 71
    k, spans, _ = suffix_dedup.repeated_spans(df.select("doc_id", "text"))
    lists = {r.rkey: len(r.x) for r in suffix_dedup.span_lists(spans).collect()}
    assert len(lists) >= 4 and max(lists.values()) <= len(text)
    units = repeats.Units(words=True, window=20, core=6)
    again, contexts, _ = repeats.repeated_rows(k, units)
    ranges = repeats.compared(k, contexts, units, earlier=True).groupBy("core", "ctx", "rkey", "s").count()
    assert 1 <= ranges.agg({"count": "max"}).first()[0] <= 2
    got = phrase_dedup.deduplicate(df).select("doc_id", "n_words", "n_removed").distinct().collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(5, 90, 0), (None, 90, 90), (6, 125, 65), (8, 40, 0), (9, 40, 40)], key=repr)
    got = suffix_dedup.deduplicate(df).select("doc_id", "n_bytes", "n_removed").distinct().collect()
    assert {r.doc_id: r.n_bytes - r.n_removed for r in got if r.doc_id != 6} == {5: 0, None: 0, 8: 0, 9: 0}


def brute_print(t):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    h = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(n, linked):
    root = list(range(n))
    for _ in range(n):
        before = list(root)
        for i, j in linked:
            root[i] = root[j] = min(root[i], root[j])
        if root == before:
            break
    return root


def test_simhash(docs):
    rows = corpus()
    prints = [brute_print(t) for _, t in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = brute_groups(len(rows), linked)
    least = {}
    for (i, _), k in zip(rows, root):
        if i is not None:
            least[k] = min(least.get(k, i), i)
    want = sorted([(i, f"{p:016x}", least.get(k)) for (i, _), p, k in zip(rows, prints, root)], key=repr)
    assert rows_of(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    texts = {(i, t) for i, t in rows}
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(root)) and set(got) <= texts
    by_row = {}
    for (i, t), k in zip(rows, root):
        by_row.setdefault((i, t), k)
    assert len({by_row[x] for x in got}) == len(got)


def test_an_id_of_different_texts_keeps_its_own_component(spark):
    r = random.Random(4)
    alone, common = (" ".join(f"w{r.randrange(10 ** 6)}" for _ in range(80)) for _ in range(2))
    for texts in ((alone, common), (common, alone)):
        df = spark.createDataFrame([(5, t, "en", "s", 0) for t in texts] + [(3, common, "en", "s", 0)], SCHEMA).coalesce(1)
        assert rows_of(simhash.keep_one(df), "doc_id", "text") == sorted([(3, common), (5, alone)], key=repr)


def test_gray_index_finds_all_pairs():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 700, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 700, dtype=np.uint64))
                                    for c in centre]))
    q, found = simhash.GrayIndex(fps, leaf=8, fan=4).search(fps, 3)
    want = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    got = np.zeros_like(want)
    got[q, found] = True
    assert (got == want).all()
    ranks = np.sort(simhash.gray_rank(np.arange(256, dtype=np.uint64)))
    assert (ranks == np.arange(256)).all()


def test_masks_meet_every_near_pair():
    r = random.Random(2)
    masks = simhash.masks(3)
    for _ in range(2000):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), 3):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_components_of_chains_and_stars(spark):
    r = random.Random(9)
    pairs = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(500, 500)]
    pairs += [(r.randrange(1000, 1100), r.randrange(1000, 1100)) for _ in range(90)]
    r.shuffle(pairs)
    got = {x.node: x.root for x in graphs.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = sorted({x for p in pairs if p[0] != p[1] for x in p})
    at = {n: i for i, n in enumerate(nodes)}
    root = brute_groups(len(nodes), [(at[a], at[b]) for a, b in pairs if a != b])
    assert got == {n: nodes[root[i]] for n, i in at.items()}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_cells_bring_every_pair_together(spark):
    rows = spark.createDataFrame([(1, i) for i in range(1500)] + [(2, i) for i in range(3)] + [(3, 0)], "k int, m long")
    got = graphs.cells(rows, ["k"], "m").collect()
    met, size = set(), {}
    by_cell = {}
    for r in got:
        by_cell.setdefault((r.k, r.lo, r.hi), []).append(r)
    for (k, lo, hi), members in by_cell.items():
        assert len(members) < 1000
        for a in members:
            for b in members:
                if a.m < b.m and {a.block, b.block} == {lo, hi}:
                    met.add((k, a.m, b.m))
    assert len(met) == 1500 * 1499 // 2 + 3 and not any(k == 3 for k, _, _ in met)


def vectors():
    rng = np.random.default_rng(4)
    base = rng.standard_normal((12, 32))
    rows = []
    for k in range(12):
        for _ in range(15):
            rows.append((len(rows) + 5, (base[k] + 0.25 * rng.standard_normal(32)).tolist(), k % 4))
    rows += [(900, rows[0][1], rows[0][2]), (901, rows[0][1], rows[0][2]), (902, rows[0][1], 3 - rows[0][2]), (903, rows[0][1], None)]
    rows += [(904, None, 1), (905, [0.0] * 32, 1), (906, [float("nan")] * 32, 1), (907, [float("inf")] + [1.0] * 31, 1)]
    rows += [(908, [None] + [1.0] * 31, 1), (909, [], 1), (910, [1e300] * 32, 1), (911, [1e-300] * 32, 1), (912, [1.0, 2.0], 1)]
    rows += [(None, rows[3][1], rows[3][2]), rows[4], rows[4]]
    return rows


def test_embeddings(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    good = [e is not None and len(e) > 0 and all(x is not None and math.isfinite(x) for x in e) and any(e) and lab is not None
            for _, e, lab in rows]
    unit = [embeddings.unit(np.array([e]))[0] if g else None for (_, e, _), g in zip(rows, good)]
    near = lambda i, j: (good[i] and good[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j])
                         and float(unit[i] @ unit[j]) >= 0.93)
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if near(i, j)]
    root = brute_groups(len(rows), linked)
    n = [sum(near(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    least = {}
    for (i, _, _), k in zip(rows, root):
        if i is not None:
            least[k] = min(least.get(k, i), i)
    got = embeddings.near_duplicates(df).collect()
    have = {}
    for r in got:
        have.setdefault(r.vec_id, r)
    assert len(got) == len(rows)
    found = sum(r.n_links for r in got)
    assert 0.95 * sum(n) <= found <= sum(n)
    for (i, _, _), k, c in zip(rows, root, n):
        assert have[i].n_links <= c
        if have[i].n_links == c:
            assert have[i].kept == (i == have[i].component_id)
    assert have[900].n_links >= 2 and have[902].component_id != have[900].component_id and have[903].n_links == 0
    assert [have[i].n_links for i in (904, 905, 906, 907, 908, 909, 912)] == [0] * 7
    assert have[910].component_id == have[911].component_id == 910
    assert have[None].component_id is not None and not have[None].kept


def test_tables_meet_pairs_at_the_threshold():
    rng = np.random.default_rng(6)
    a = embeddings.unit(rng.standard_normal((400, 64)))
    b = embeddings.unit(rng.standard_normal((400, 64)))
    b = embeddings.unit(b - (a * b).sum(1, keepdims=True) * a)
    near = 0.935 * a + math.sqrt(1 - 0.935 ** 2) * b
    model = embeddings.learn(np.concatenate([a, embeddings.unit(rng.standard_normal((3000, 64)))]))
    for largest in (100, 6000, 10 ** 6):
        masks = embeddings.table_masks(64, largest)
        differ = embeddings.codes(a, model) ^ embeddings.codes(near, model)
        met = np.zeros(400, bool)
        for m in masks:
            assert m.bit_count() == masks[0].bit_count()
            met |= (differ & np.uint64(m)) == 0
        assert met.mean() >= 0.9


def pairs_at(cosine, n, dim, seed):
    rng = np.random.default_rng(seed)
    a, b = (embeddings.unit(rng.standard_normal((n, dim))) for _ in range(2))
    b = embeddings.unit(b - (a * b).sum(1, keepdims=True) * a)
    return a, cosine * a + math.sqrt(1 - cosine ** 2) * b


@pytest.mark.parametrize("dim", [64, 32, 16, 8, 3, 2])
def test_tables_meet_pairs_at_the_very_threshold_at_any_size(dim):
    a, near = pairs_at(0.93, 4000, dim, 3)
    x = np.concatenate([a, pairs_at(0.5, 3000, dim, 4)[0]])
    model = embeddings.learn(x)
    pairs = embeddings.threshold_pairs(x, model)
    differ = embeddings.codes(a, model) ^ embeddings.codes(near, model)
    for largest in (1000, 10 ** 5, 10 ** 7, 10 ** 8):
        masks = embeddings.table_masks(min(dim, 64), largest, differ=pairs)
        assert len(set(masks)) == len(masks)
        met = np.zeros(len(a), bool)
        for m in masks:
            met |= (differ & np.uint64(m)) == 0
        assert met.mean() >= 0.98


def test_a_short_vector_leaves_the_links_of_long_ones(spark):
    rng = np.random.default_rng(8)
    parts = [pairs_at(c, 100, 64, k) for k, c in enumerate(np.linspace(0.9301, 0.95, 8))]
    a, b = (np.concatenate(x) for x in zip(*parts))
    x = np.concatenate([a, b])[rng.permutation(1600)]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(5000 + k, [1.0] * k + [0.5], 1) for k in (0, 1, 5)]
    want = ((x @ x.T) >= 0.93).sum(1) - 1
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    found = sum(got[i] for i in range(1600))
    assert all(got[i] <= want[i] for i in range(1600)) and 0.97 * want.sum() <= found and want.sum() >= 1600
    assert [got[5000 + k] for k in (0, 1, 5)] == [0, 0, 0]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.deduplicate(empty).count() == 0
    assert phrase_dedup.deduplicate(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_clashing_columns(spark, docs):
    from pyspark.sql import functions as F
    names = ["rkey", "oid", "fp", "row", "core", "ctx", "component_id", "k0", "s_text", "copy"]
    more = docs.withColumns({n: F.lit(1) for n in names})
    assert rows_of(suffix_dedup.deduplicate(more), "doc_id", "n_removed") == rows_of(suffix_dedup.deduplicate(docs), "doc_id", "n_removed")
    assert rows_of(simhash.near_duplicates(more), "doc_id", "component_id") == rows_of(simhash.near_duplicates(docs), "doc_id", "component_id")
    kept = simhash.keep_one(more)
    assert kept.columns == more.columns and kept.count() == simhash.keep_one(docs).count()
