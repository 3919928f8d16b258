"""Token file and packing: exact round trips against whole-text encoding."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidyrent.llm import packing, rans, token_output
from tidyrent.llm.common import scratch
from tidyrent.llm.tokens import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def whole(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "  ", "a  b", "a \n b", "\n\n a", "x\t y", "it's 's  12 ab", " lead", "trail ", "a\u3000b \u3000 c", "<|endoftext|> a",
                                  "\u00e9  \u00e8\r\n  z", "\x1c a", "ß, ö. \u03a9 \u6f22\u5b57. x' ok ,. . , \u2167, \u00b2", "cats, dogs. Cats", "re.\nErtion a\nb,\nc", "\u0120abc x\u010a \u0120 \u010a", "a### b###\nc!! d\n\ne f.\n g\n",
                                  "don't. ö.\nä¹ a-b x² a.\n's ` ~a it_s (b) c)\nd"])
def test_pieces_encode_like_whole_texts(text):
    assert list(PieceEncoder(PATH).encode([text])[0]) == whole(text)


def test_many_texts_at_once():
    rng = np.random.default_rng(0)
    chars = list("abeö.,\n' #!1²Ġ") + ["the", " the", " of", "\n"]
    texts = ["".join(rng.choice(chars, rng.integers(0, 60))) for _ in range(400)]
    own = PieceEncoder(PATH, 100)
    one = Tokenizer.from_file(PATH)
    for a in range(0, 400, 50):
        for text, ids in zip(texts[a : a + 50], own.encode(texts[a : a + 50]), strict=True):
            assert list(ids) == one.encode(text, add_special_tokens=False).ids, text


def test_ids_do_not_depend_on_the_memo():
    small = PieceEncoder(PATH, 3)
    for text in ["one two three four five", "one two", "six, seven one", "", "five four"]:
        assert list(small.encode([text])[0]) == whole(text)


@pytest.mark.parametrize("n,distinct", [(1, 1), (5, 1), (5000, 7), (300_000, 3000), (2000, 2000)])
def test_rans_round_trip_and_spans(n, distinct):
    ids = (np.random.default_rng(n).zipf(1.3, n) % distinct).astype(np.uint32)
    table = rans.Table(*rans.frequency_table(ids))
    assert int(table.freq.sum()) == 1 << rans.SCALE_BITS
    block = rans.encode_block(ids, table, rans.lanes_for(n, 64), 16)
    assert (rans.decode_block(block, table) == ids).all()
    size = block["span"] * block["lanes"]
    for k in range(len(block["at"])):  # every checkpoint decodes on its own
        assert (rans.decode_span(block, k, table) == ids[k * size : (k + 1) * size]).all()
    block["crc"][0] ^= 1
    with pytest.raises(rans.Corrupt):
        rans.decode_block(block, table)


def read_back(spark, docs, **options):
    path = scratch(spark, "test-tokens")
    token_output.write_tokens(docs, path, PATH, 2, **options)
    return token_output.with_crc(token_output.read_tokens(spark, path)).toPandas()


def test_token_file_of_odd_rows(spark, odd_docs, no_docs):
    got = read_back(spark, odd_docs, segment_tokens=40_000, block_tokens=500, lanes=8, span=4).sort_values("start")
    rows = sorted(((r.doc_id, r.text) for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [None if np.isnan(d) else int(d) for d in got["doc_id"]] == [d for d, _ in rows]
    start = 0
    for r in got.itertuples():
        assert r.start == start and len(r.ids) == 4 * r.n_tokens and zlib.crc32(r.ids) == r.ids_crc32
        start += r.n_tokens
    expected = sorted(np.array([*whole(t), 2], "<u4").tobytes() for _, t in rows)
    assert sorted(map(bytes, got["ids"])) == expected
    assert len(read_back(spark, no_docs)) == 0


def test_token_file_keeps_large_ids_beside_nulls(spark, make_docs):
    rows = [(None, "a"), (2**60 + 1, "b c"), (2**60 + 3, "d"), (-(2**61) - 1, "e")]
    path = scratch(spark, "test-tokens")
    token_output.write_tokens(make_docs([(i, t, "en", "a") for i, t in rows]).coalesce(1), path, PATH, 2)
    assert {r.doc_id for r in token_output.read_tokens(spark, path).collect()} == {i for i, _ in rows}


def check_packed(docs, capacity, got):
    expected = []
    for d, t in docs:
        ids = np.array([*whole(t), 0], "<u4")
        for k, (s, n) in enumerate(packing.cut(len(ids), capacity)):
            expected.append((d, k, s, n, zlib.crc32(ids[s : s + n].tobytes())))
    rows = [(None if np.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()]
    assert sorted(rows, key=str) == sorted(expected, key=str)
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert (own["offset"] == own["length"].cumsum() - own["length"]).all() and own["length"].sum() <= capacity


@pytest.mark.parametrize("capacity", [8, 64, 2048])
def test_pack_documents(odd_docs, no_docs, capacity):
    got = packing.pack_documents(odd_docs, PATH, 0, capacity).toPandas()
    check_packed([(r.doc_id, r.text) for r in odd_docs.collect()], capacity, got)
    assert packing.pack_documents(no_docs, PATH, 0, capacity).count() == 0


def test_cut_leaves_only_the_first_piece_short():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)] and packing.cut(3, 4) == [(0, 3)]


@pytest.mark.parametrize("seed", range(5))
def test_plan_places_all_and_fills_exactly(seed):
    rng = np.random.default_rng(seed)
    counts = {int(x): int(n) for x, n in zip(rng.integers(1, 101, 60), rng.integers(1, 50, 60), strict=True)}
    plan = packing.plan(counts, 100)
    placed: dict[int, int] = {}
    for pattern, n in plan:
        assert sum(x * m for x, m in pattern) <= 100
        for x, m in pattern:
            placed[x] = placed.get(x, 0) + n * m
    assert placed == counts
    left = np.zeros(101, dtype=np.int64)
    for x, n in counts.items():
        left[x] = n
    best_fit = sum(n for _, n in packing._best_fit(left, 100))
    assert -(-sum(x * n for x, n in counts.items()) // 100) <= sum(n for _, n in plan) <= best_fit + 1


def test_exact_complements_are_used():
    assert sum(n for _, n in packing.plan({60: 2, 40: 1, 25: 1, 15: 1}, 100)) == 2
    assert sum(n for _, n in packing.plan({50: 3, 30: 2, 10: 5, 20: 2}, 100)) == 3


@pytest.mark.parametrize("span_rows", [None, 2])
def test_spans_without_bound_and_ids_of_any_size(spark, make_docs, span_rows):
    rows = [(2**60 + k, "word " * (k * 7 % 50), "en", "a") for k in range(260)] + [(None, "a b", "en", "a"), (None, "x " * 300, "en", "a")]
    docs = make_docs(rows).coalesce(1)
    got = packing.pack_documents(docs, PATH, 0, 64, span_rows=span_rows).collect()
    assert {r.doc_id for r in got} == {i for i, *_ in rows}
    if span_rows:
        at = {i: k for k, (i, *_) in enumerate(rows)}
        spans = {(r.sequence_id >> 32, at[r.doc_id] // 2) for r in got if r.doc_id is not None}
        assert {a for a, _ in spans} == set(range(130)) and all(a == b for a, b in spans)
        assert {r.sequence_id >> 32 for r in got if r.doc_id is None} == {130}
    for s in {r.sequence_id for r in got}:
        own = sorted((r.offset, r.length) for r in got if r.sequence_id == s)
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 64


def test_parts_of_a_span_meet_its_plan(spark, make_docs, monkeypatch):
    monkeypatch.setattr(packing, "PART", 8)
    rows = [(k, "word " * (k * 13 % 70), "en", "a") for k in range(300)]
    got = packing.pack_documents(make_docs(rows), PATH, 0, 64, span_rows=300).toPandas()
    check_packed([(i, t) for i, t, *_ in rows], 64, got)
