"""Quality rules, whitening and centroid clustering against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidyrent.llm import centroids, quality_rules, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VECTORS = "vec_id bigint, embedding array<float>, label int, cluster string, n string"


def brute_counts(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def texts():
    rng = np.random.default_rng(5)
    out = [None, "", " \n\t", "a b c d e", "a b c d e f a b c d e", "x " * 40, "é b 😀 ü\x0bz\x1cq # *|\n\n# *|", "one two\r\none two\r\n…\n- three..."]
    for vocabulary in (2, 3, 40, 4000):
        for n in (9, 60, 700):
            sep = rng.choice([" ", "\n", "  ", " \t"], n)
            out.append("".join(f"w{a}{b}" for a, b in zip(rng.integers(0, vocabulary, n), sep, strict=True)))
    return [*out, out[-1], "the cat sat on the mat and it was by the door of a house " * 2_000]


def test_quality_counts(spark, make_docs):
    rows = [(k if k % 5 else None, t, "en", "s") for k, t in enumerate(texts())]
    docs = make_docs(rows).withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit("clash"))
    got = quality_rules.judge(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(brute_counts(t) for _, t, *_ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.failed) and not (r.kept and r.base_failed)
    assert quality_rules.judge(make_docs([])).count() == 0


def test_colliding_window_hashes_are_resolved(spark, make_docs):
    rows = [(k, t, "en", "s") for k, t in enumerate(texts()) if t and len(t) < 9_000]
    words = F.array_remove(F.split("text", f"[{quality_rules.SPACE}]+"), "")
    got = make_docs(rows).select("doc_id", quality_rules.repeat_words(words, mark=lambda *w: F.pmod(F.xxhash64(*w), F.lit(7))).alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {k: brute_counts(t)[4] for k, t, *_ in rows}


def test_rule_table(spark, make_docs):
    assert "PythonUDF" not in quality_rules.judge(make_docs([]))._jdf.queryExecution().toString()
    table = (quality_rules.Rule("short", "n_words", None, "3", None, True), quality_rules.Rule("symbols", "n_symbols", "n_words", None, "0.5"))
    got = quality_rules.judge(make_docs([(1, "a # b #", "en", "s"), (2, "a # b # #", "en", "s"), (3, "a #", "en", "s"), (4, "", "en", "s")]), table)
    assert {r.doc_id: r.failed for r in got.collect()} == {1: [], 2: ["symbols"], 3: ["short"], 4: ["short"]}
    with pytest.raises(ValueError):
        quality_rules.judge(make_docs([]), (quality_rules.Rule("none", "n_words", None, None, None),))
    with pytest.raises(ValueError):
        quality_rules.judge(make_docs([]), (quality_rules.Rule("unknown", "n_things", None, "1", None),))


def vectors_of(seed, n, dims, centres=5, noise=(0.02, 0.2)):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims)) * 0.4
    v = middle[rng.integers(0, centres, n)] + rng.normal(size=(n, dims)) * rng.choice(noise, (n, 1))
    v[: n // 3] = v[0]
    rows = [(k, [float(np.float32(x)) for x in u], int(k % 3), "x", "y") for k, u in enumerate(v)]
    odd = [(9000, None, 1, "x", "y"), (9001, [0.0] * (dims - 1), 1, "x", "y"), (9002, [None] + [1.0] * (dims - 1), 1, "x", "y"),
           (9003, [float("nan")] * dims, 1, "x", "y"), (9004, [float("-inf")] * dims, 1, "x", "y"), (9005, [], 1, "x", "y"),
           (None, rows[-1][1], 1, "x", "y"), rows[1], (9006, [0.0] * dims, None, None, None), ((1 << 60) + 1, rows[-2][1], 0, "x", "y")]
    return rows + odd


def fit_list(rows, dims):
    return [(i, v) for i, v, *_ in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]


@pytest.mark.parametrize("dims,components,guard", [(24, 6, 3), (6, 32, 4), (40, 32, 24)])
def test_whitening(spark, dims, components, guard):
    rows = vectors_of(dims, 400, dims)
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS), components, 64.0, 1_000_000, guard=guard).collect()
    kept = fit_list(rows, dims)
    x = np.array([[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for _, v in kept], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [int(((n * r - sums) ** 2).sum()) for r in x]
    c = ((n * x - sums) / n).astype(float)
    v = c.T @ c / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(dims, components)
    white = c @ vectors[:, :k] / np.sqrt(values[:k])
    assert len(got) == n * k and {r.n for r in got} == {n} and {r.identity_error for r in got}.pop() < 1e-9
    expected = Counter((i, d) for (i, _), d in zip(kept, deviation, strict=True))
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == expected
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {}).setdefault(r.component, set()).add((r.whitened, r.explained))
    for j in range(k):
        pairs = [(next(iter(by_row[i][j + 1]))[0], w) for (i, _), w in zip(kept, white[:, j], strict=True)]
        sign = np.sign(sum(a * b for a, b in pairs))
        assert max(abs(a - sign * b) for a, b in pairs) < 1e-8
        assert abs(next(iter(by_row[kept[0][0]][j + 1]))[1] / (values[j] / values.sum()) - 1) < 1e-9


def test_whitening_edges(spark):
    make = lambda rows: spark.createDataFrame([(k, v, 0, "x", "y") for k, v in rows], VECTORS)
    assert whitening.whiten(make([]), 3, 64.0, 0).count() == 0
    assert whitening.whiten(make([(1, [1.0, 2.0])] * 4), 3, 64.0, 0).count() == 0  # no variance
    flat = whitening.whiten(make([(k, [float(k), 1.0, 2.0]) for k in range(5)]), 3, 64.0, 0).collect()
    assert {r.component for r in flat} == {1} and {round(r.explained, 9) for r in flat} == {1.0}
    mixed = whitening.whiten(make([(k, [float(k % 3), float(k % 2)] if k % 4 else [float(k)]) for k in range(20)]), 2, 64.0, 0).collect()
    assert {r.n for r in mixed} == {15}  # the most frequent length


def test_subspace_with_close_and_equal_values():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(90, 90)))[0]
    spectrum = np.sort(np.concatenate([[50, 50, 50, 1e-3], 1 + 0.02 * rng.random(60), 2 + rng.random(26)]))[::-1]
    operator = (q * spectrum) @ q.T
    values, vectors = whitening.subspace(lambda b: operator @ b, 90, 20, 8)
    assert np.allclose(values, spectrum[:20], rtol=1e-12) and np.allclose(vectors.T @ vectors, np.eye(20), atol=1e-12)
    assert np.linalg.norm(operator @ vectors - vectors * values, axis=0).max() < 1e-10


def lloyd(kept, k, rounds, scale, seed):
    x = np.array([[int(np.floor(scale * np.float64(c))) for c in v] for _, v in kept], dtype=np.int64)
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), x[r].tolist()) for r, (i, _) in enumerate(kept) if i is not None)
    c = np.array([v for _, v in order[:k]], dtype=np.int64)
    for r in range(rounds + 1):
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        own = d.argmin(axis=1)
        if r < rounds:
            for j in range(len(c)):
                if (own == j).any():
                    c[j] = x[own == j].sum(axis=0) // (own == j).sum()
    return own, d.min(axis=1), c


@pytest.mark.parametrize("dims,k,block_rows", [(8, 7, 16), (64, 40, 512), (3, 500, 5)])
def test_centroids(spark, dims, k, block_rows):
    rows = vectors_of(dims + 1, 450, dims)
    routed, last = centroids.cluster(spark.createDataFrame(rows, VECTORS), k, 5, 256.0, dims, 2, block_rows=block_rows, curve_dims=6)
    kept = fit_list(rows, dims)
    own, distance, expected = lloyd(kept, k, 5, 256.0, 2)
    assert last.tolist() == expected.tolist()
    got = centroids.with_totals(routed, last).collect()
    assert Counter((r.vec_id, r.cluster, r.distance) for r in got) == Counter((i, int(a), int(d)) for (i, _), a, d in zip(kept, own, distance, strict=True))
    assert all(r.inertia == distance.sum() and r.cluster_inertia == distance[own == r.cluster].sum() for r in got)
    assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, expected[r.cluster])).encode()).hexdigest() for r in got)


def test_boxes_prune_and_empty_tables_pass(spark):
    rows = spark.createDataFrame(vectors_of(4, 3000, 8, centres=30, noise=(0.005, 0.01)), VECTORS)
    whole = centroids.quantised(rows, 256.0, 8, "vec_id", "embedding")
    first = centroids.first_centroids(whole, 40, 2)
    assert centroids.candidate_share(centroids.blocks(whole, 8, block_rows=32), 8, first) < 0.5
    routed, last = centroids.cluster(spark.createDataFrame([], VECTORS), 40, 5, 256.0, 64, 2)
    assert routed.count() == 0 and centroids.with_totals(routed, last).count() == 0


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (5, 2)])
def test_hilbert_neighbours(dims, bits):
    side = np.arange(1 << bits)
    cells = np.stack(np.meshgrid(*[side] * dims), axis=-1).reshape(-1, dims)
    keys = [k.tobytes() for k in centroids.hilbert_keys(cells, bits)]
    path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert len(set(keys)) == len(cells) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
