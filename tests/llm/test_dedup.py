"""SimHash and suffix arrays against brute force."""

import re

import numpy as np
import pytest
import xxhash

from tidyrent.llm import simhash, suffix_dedup


def fingerprint(text, shingle):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    parts = [" ".join(words[k : k + shingle]) for k in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(keys, linked):
    out = {}
    for k in keys:
        seen, todo = {k}, [k]
        while todo:
            x = todo.pop()
            new = {y for y in keys if y not in seen and linked(x, y)}
            seen |= new
            todo += new
        out[k] = seen
    return out


@pytest.mark.parametrize("max_bits,bucket", [(2, 64), (2, 1), (1, 64), (1, 1)])
def test_links_connect_what_is_near(spark, max_bits, bucket):
    rng = np.random.default_rng(max_bits)
    base = [int(x) for x in rng.integers(0, 1 << 63, 8)]
    words = {b ^ sum({1 << int(k) for k in rng.integers(0, 64, int(rng.integers(0, 4)))}) for b in base * 12}
    words = sorted(w - (1 << 64) if w >= 1 << 63 else w for w in words)
    edges = simhash.links(spark.createDataFrame([(w,) for w in words], "fp bigint"), max_bits, bucket).collect()
    near = lambda x, y: ((x ^ y) & ((1 << 64) - 1)).bit_count() <= max_bits
    pairs = {(r.a, r.b) for r in edges}
    if bucket == 64:
        assert pairs == {(x, y) for x in words for y in words if x < y and near(x, y)}
    assert reach(words, lambda x, y: (x, y) in pairs or (y, x) in pairs) == reach(words, near)


def test_simhash_of_odd_rows(spark, odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs, 3, 2).collect()
    rows = odd_docs.collect()
    assert sorted(((r.doc_id, r.fingerprint) for r in got), key=str) == sorted(((r.doc_id, f"{fingerprint(r.text, 3):016x}") for r in rows), key=str)
    prints = {fingerprint(r.text, 3) for r in rows}
    groups = reach(prints, lambda x, y: (x ^ y).bit_count() <= 2)
    for r in got:
        ids = [x.doc_id for x in rows if fingerprint(x.text, 3) in groups[int(r.fingerprint, 16)] and x.doc_id is not None]
        assert r.component_id == min(ids)
    kept = simhash.keep_first(odd_docs, 3, 2).select(*odd_docs.columns).collect()
    assert sorted(r.doc_id for r in kept) == sorted({r.component_id for r in got})
    assert simhash.near_duplicates(no_docs, 3, 2).count() == 0 and simhash.keep_first(no_docs, 3, 2).count() == 0


def corpus(seed):
    rng = np.random.default_rng(seed)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 100_000, n)]
    passage, short, docs = word(60), word(30), []
    for k in range(40):
        text = word(int(rng.integers(0, 150)))
        if k % 3 == 0:
            text += passage + word(20)
        if k % 4 == 0:
            text += short + word(5)
        docs.append((k, ("\n" if k % 2 else " ").join(text), "en", "a"))
    docs += [(100, docs[5][1], "en", "a"), (101, docs[9][1] + " tail", "en", "a"), (102, None, None, None), (103, "", "en", "a"),
             (None, docs[9][1], "en", "a"), (104, " ".join(passage), "en", "a"), (104, " ".join(passage), "en", "a"), (105, "a " * 5000, "en", "a")]
    return docs


@pytest.mark.parametrize("partitions", ["1", "40"])
def test_repeated_spans(spark, make_docs, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    rows = corpus(7)
    got = suffix_dedup.repeated_spans(make_docs(rows)).collect()
    spark.conf.set("spark.sql.shuffle.partitions", old)
    text = {d: t for d, t, *_ in rows if d is not None and t is not None}
    words = {d: t.split() for d, t in text.items()}
    covered = {d: np.zeros(len(w), dtype=bool) for d, w in words.items()}
    for r in got:  # every span is verbatim in an earlier document
        n = r.end_word - r.start_word
        own = words[r.doc_id][r.start_word : r.end_word]
        assert r.match_doc_id < r.doc_id and n >= 50 and own == words[r.match_doc_id][r.match_start_word : r.match_start_word + n]
        assert text[r.doc_id][r.start_char : r.end_char].split() == own
        covered[r.doc_id][r.start_word : r.end_word] = True
    first = {}
    for d in sorted(words):  # every 50 words that an earlier document has are in spans
        for k in range(len(words[d]) - 49):
            if first.setdefault(tuple(words[d][k : k + 50]), d) != d:
                assert covered[d][k : k + 50].all(), (d, k)
    assert suffix_dedup.repeated_spans(make_docs([])).count() == 0


def test_remove_repeats(spark, make_docs):
    rows = corpus(8)
    docs = make_docs(rows)
    got = suffix_dedup.remove_repeats(docs)
    assert got.columns == docs.columns
    out = {r.doc_id: r.text for r in got.collect() if r.doc_id is not None}
    passage = rows[0][1].split()
    assert out[0] == rows[0][1] and out[1] == rows[1][1] and out[103] == "" and out[102] is None  # first and clean ones stay
    whole = {tuple(rows[3][1].split()[k : k + 50]) for k in range(len(rows[3][1].split()) - 49)} & {tuple(passage[k : k + 50]) for k in range(len(passage) - 49)}
    kept = out[3].split()
    assert whole and not whole & {tuple(kept[k : k + 50]) for k in range(len(kept) - 49)}
    assert 104 not in out and (None, rows[9][1]) in [(r.doc_id, r.text) for r in got.collect()]


def longer_repeats(groups=30, shared=45, whole=51):
    """Groups of four: P, P + Q, P, P + Q, each between words of its own."""
    rng, rows, expected = np.random.default_rng(3), [], {}
    word = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    for g in range(groups):
        passage = word(whole)
        for k, n in enumerate((shared, whole, shared, whole)):
            before = word(int(rng.integers(0, 40)))
            rows.append((4 * g + k, " ".join(before + passage[:n] + word(20)), "en", "a"))
            if k == 3:
                expected[4 * g + k] = (len(before), len(before) + whole)
    return rows, expected


@pytest.mark.parametrize("partitions", ["1", "40"])
def test_repeats_longer_than_what_many_share(spark, make_docs, partitions):
    rows, expected = longer_repeats()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    got = suffix_dedup.repeated_spans(make_docs(rows)).collect()
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert {r.doc_id: (r.start_word, r.end_word) for r in got} == expected
    assert all(r.match_doc_id == r.doc_id - 2 for r in got)


def test_runs_over_batches():
    import pandas as pd

    rng = np.random.default_rng(5)
    key = np.sort(rng.choice([1, 1, 1, 2, 3, 4, 5, 6, 7], 60).tolist() + [9, 9, 10])
    rows = pd.DataFrame({"key": key, "doc": np.arange(len(key)), "pos": 1})
    for size in (1, 2, 3, 7, 100):
        out = pd.concat(list(suffix_dedup._runs(iter([rows[a : a + size] for a in range(0, len(rows), size)]))))
        n, head = rows.groupby("key")["doc"].count(), rows.groupby("key")["doc"].min()
        assert sorted(out["doc"]) == [d for d, k in zip(rows["doc"], key, strict=True) if n[k] > 1 or k in (key[0], key[-1])]
        assert (out["crowded"] == (out["key"].map(n) > 2)).all() and (out["head_doc"] == out["key"].map(head)).all()
        assert out[out["key"] == key[0]]["edge"].all() and out["edge"].iloc[-1]


def test_keep_first_keeps_one_row_of_repeated_heads_and_of_rows_without_ids(spark, make_docs):
    rng = np.random.default_rng(11)
    text = lambda: " ".join(f"w{x}" for x in rng.integers(0, 1000, 400))
    head, bare, near, lone = text(), text(), None, text()
    for k in range(400):  # a text that differs in a few bits at most
        words = bare.split()
        words[k] = "other"
        near = " ".join(words)
        if 0 < (fingerprint(near, 3) ^ fingerprint(bare, 3)).bit_count() <= 2:
            break
    else:
        raise AssertionError("no near text")
    rows = [(1, head, "en", "a")] * 3 + [(1, head, "en", "b"), (2, head, "en", "a"), (5, lone, "en", "a")]
    rows += [(None, bare, "en", "a")] * 4 + [(None, near, "en", "a")] * 2 + [(None, head, "en", "a")]
    docs = make_docs(rows)
    got = simhash.keep_first(docs, 3, 2)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    kept = got.collect()
    assert sorted((r.doc_id for r in kept), key=str) == [1, 5, None]
    assert {r.text for r in kept if r.doc_id is None} <= {bare, near}


def test_hot_keys_dealt_to_many_places_change_nothing(spark, make_docs, monkeypatch):
    from tidyrent.llm import common

    rng = np.random.default_rng(13)
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 1 << 40, n))
    shared, copy = word(60), word(80)
    docs = make_docs([(k, f"{word(10)} {shared} {word(10)}", "en", "a") for k in range(12)] + [(100 + k, copy, "en", "a") for k in range(9)]
                     + [(200, word(70), "en", "a"), (None, copy, "en", "a")])
    runs = lambda: (sorted(map(str, suffix_dedup.repeated_spans(docs).collect())), sorted(map(str, simhash.near_duplicates(docs, 3, 2).collect())))
    plain = runs()
    assert len(plain[0]) == 11 + 8
    for module in (suffix_dedup, simhash):
        monkeypatch.setattr(module, "HOT_ROWS", 2)
    monkeypatch.setattr(common, "SALTS", 3)
    assert runs() == plain
