"""Token counts and SentencePiece against the libraries; TIFF and archives against their own round trips."""

import os
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexloom.llm import arc, arc_tables, sentencepiece_codec, tiff, token_count

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY, PIECE_LIBRARY = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
MERGER, MODEL = token_count.RankMerger(BPE), sentencepiece_codec.Model.read(PIECES)
ODD = ["", " ", "a" * 3000, "<|endoftext|>", "x<|endoftext|> <|endoftext|>y", "\n\n \t\r", "don't we'll", "éàü 你好 ▁▁ x", " " * 300, "ab" * 700, "\u2028\x85\xa0 .", "1234567 !?!?"]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_counts_equal_the_library(text):
    assert MERGER.count([text]) == [len(LIBRARY.encode(text, add_special_tokens=False).ids)]


def test_counts_of_odd_texts():
    assert MERGER.count(ODD) == [len(e.ids) for e in LIBRARY.encode_batch(ODD, add_special_tokens=False)]


def test_token_counts_table(spark):
    rows = spark.createDataFrame([(1, None, 9), (2, "hello  world", 9), (2, "hello  world", 9), (3, "", 9)], "doc_id long, text string, n_tokens int")
    got = token_count.token_counts(rows, BPE)
    assert got.columns == ["doc_id", "text", "n_tokens"]
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got.collect()) == [(1, 0), (2, 3), (2, 3), (3, 0)]
    assert token_count.token_counts(rows.limit(0), BPE).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("  abcdeth▁\n"), st.characters(exclude_categories=["Cs"], exclude_characters="\x00")), max_size=40))
def test_pieces_equal_the_library(text):
    assert MODEL.encode(text) == PIECE_LIBRARY.encode(text)


def test_pieces_of_odd_texts():
    texts = [x for x in ODD] + [" " * n + "the" for n in range(20)] + ["z" * n for n in range(60, 75)]
    assert MODEL.encode_all(texts) == PIECE_LIBRARY.encode(texts)
    assert [MODEL.decode(MODEL.encode(x)) for x in texts] == [x.replace("▁", " ") for x in texts]
    broken = [[200, 5], [260, 131, 300], [], [0, 1, 2, 300]]
    assert [MODEL.decode(x) for x in broken] == [PIECE_LIBRARY.decode(x) for x in broken]


def viterbi(model, text):
    best = [(0.0, [])] + [(-np.inf, [])] * len(text)
    for e in range(1, len(text) + 1):
        for s in range(e):
            i = model.ids.get(text[s:e])
            score = model.scores[i] if i is not None else model.unknown_score if e - s == 1 else None
            if score is not None and best[s][0] + score > best[e][0]:
                best[e] = (best[s][0] + score, best[s][1] + [(s, -1 if i is None else i)])
    return best[-1][1]


def test_unigram_takes_the_best_sum():
    pieces = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("a", -3.1, 1), ("b", -3.3, 1), ("ab", -4.05, 1), ("▁a", -4.2, 1), ("ba", -5.0, 1), ("bab", -7.0, 1), ("▁ba", -6.1, 1)]
    model = sentencepiece_codec.Model(pieces, sentencepiece_codec.UNIGRAM)
    r = random.Random(4)
    for _ in range(300):
        text = "".join(r.choice("aab b?") for _ in range(r.randint(0, 12)))
        norm = model.normalised(text)
        assert model.encode(text) == model.resolve(norm, viterbi(model, norm))


def test_pieces_table(spark):
    rows = spark.createDataFrame([(1, None), (2, "hello"), (3, "")], "doc_id long, text string")
    both = sentencepiece_codec.decode(sentencepiece_codec.encode(rows, PIECES), PIECES).orderBy("doc_id").collect()
    assert [(r["ids"], r["decoded"]) for r in both] == [([], ""), (PIECE_LIBRARY.encode("hello"), "hello"), ([], "")]
    one = sentencepiece_codec.encode_and_decode(rows, PIECES).orderBy("doc_id").select("coded.*").collect()
    assert [tuple(r) for r in one] == [(r["ids"], r["decoded"]) for r in both]


# --- TIFF -----------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=600), st.sampled_from(["random", "runs"]))
def test_codecs_round_trip(data, kind):
    data = data if kind == "random" else bytes(b for b in data for _ in range(b % 7))
    assert tiff.packbits_decode(tiff.packbits_encode(data), len(data)) == data
    assert tiff.lzw_decode(tiff.lzw_encode(data), len(data) + 1) == data


def test_lzw_passes_table_clear():
    data = np.random.default_rng(0).integers(0, 256, 60_000, dtype=np.uint8).tobytes()
    assert tiff.lzw_decode(tiff.lzw_encode(data), len(data) + 1) == data


@pytest.mark.parametrize("dtype", ["u1", "u2", "u4"])
@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("compression", [tiff.RAW, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS])
def test_pages_round_trip(dtype, order, compression):
    for predictor in (1, 2):
        for tile in (None, (16, 32)):
            images = [np.frombuffer(os.urandom(37 * 21 * s * int(dtype[1])), dtype).reshape(37, 21, s) for s in (1, 3)]
            pages = list(tiff.read_tiff(tiff.write_tiff(images, compression, predictor, tile, 5, order)))
            assert [p.pixels for p in pages] == [i.astype(i.dtype.newbyteorder(order)).tobytes() for i in images]
            assert [(p.page, p.width, p.height, p.samples, p.tiled) for p in pages] == [(0, 21, 37, 1, tile is not None), (1, 21, 37, 3, tile is not None)]


def test_floating_point_predictor():
    want = np.random.default_rng(1).standard_normal((3, 5, 2)).astype(">f4")
    planes = np.frombuffer(want.tobytes(), np.uint8).reshape(3, 10, 4).transpose(0, 2, 1).reshape(3, -1, 2).copy()
    planes[:, 1:] -= planes[:, :-1].copy()
    got = tiff.undo_predictor(np.frombuffer(planes.tobytes(), ">f4").reshape(3, 5, 2), 3, ">")
    assert np.array_equal(got, want)


def test_damaged_files(spark):
    good = tiff.write_tiff([np.zeros((4, 4, 1), np.uint8)])
    loop = bytearray(good)
    loop[-4:] = loop[4:8]
    rows = spark.createDataFrame([(1, bytearray(good)), (2, None), (3, bytearray(b"II*")), (4, bytearray(good[:-30])), (5, bytearray(loop)), (1, bytearray(good))], "page long, content binary")
    got = tiff.tiff_pages(rows).collect()
    assert sum(r["in_page"] == 1 and r["error"] is None and r["pixels"] == bytes(16) for r in got) == 2
    assert all(any(r["error"] for r in got if r["in_page"] == k) for k in (2, 3, 4, 5))
    assert tiff.tiff_pages(rows.limit(0)).count() == 0


# --- archives -------------------------------------------------------------------------------------


def test_arc_versions_and_lengths():
    body = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nhello\n\nworld"
    for version in (1, 2):
        data = arc.arc_filedesc("f", version) + arc.arc_record(arc.ArcRecord(version, "http://a b/c", "1.2.3.4", "20010203040506", "text/html", body))
        first, record = arc.read_arc(data)
        assert (first.version, record.block, record.ip, record.url) == (version, body, "1.2.3.4", "http://a%20b/c")
        w = arc.convert("f", 1, record)
        assert (w.headers["WARC-Type"], w.headers["WARC-Date"], w.headers["WARC-Payload-Digest"]) == ("response", "2001-02-03T04:05:06Z", f"sha1:{arc.sha1_base32(b'hello' + bytes((10, 10)) + b'world')}")
        assert arc.convert("f", 0, first).headers["WARC-Type"] == "warcinfo"
        (back,) = arc.read_warc(arc.warc_bytes(w))
        assert (back.headers, back.block) == (w.headers, body)
    spaced = b"http://x/a b 1.1.1.1 19990101000000 text/plain 3\nabc\n"
    (r,) = arc.read_arc(spaced, 1)
    assert (r.url, r.block) == ("http://x/a b", b"abc") and arc.convert("f", 0, r).headers["WARC-Type"] == "resource"
    for bad in (b"http://x 1 2 3\n", b"http://x 1.1.1.1 1 t 99\nabc", b"no end"):
        with pytest.raises(arc.ArcError):
            list(arc.read_arc(bad, 1))
    with pytest.raises(arc.ArcError):
        list(arc.read_arc(spaced))


def test_pages_through_archives(spark):
    rows = [(1, "http://a", "same"), (2, "http://b", "same"), (3, None, None), (4, "x y\nz", ""), (5, "http://é", "é" * 3000), (5, "http://é", "é" * 3000), (None, "http://n", "alone")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, type string")
    got = sorted(((r["record_key"] or -1, r["type"], r["refers_to_key"], r["payload_bytes"], r["error"]) for r in arc_tables.pages_through_archives(pages).collect()), key=str)
    want = [(-1, "response", None, 5, None), (1, "revisit", 2, 4, None), (2, "response", None, 4, None), (3, "revisit", 4, 0, None), (4, "response", None, 0, None), (5, "response", None, 6000, None), (5, "revisit", 5, 6000, None)]
    assert got == sorted(want, key=str)
    few = arc_tables.pages_through_archives(pages, min_bytes=5)
    assert sum(r["type"] == "revisit" for r in few.collect()) == 1
    assert arc_tables.pages_through_archives(pages.limit(0)).count() == 0


def test_damaged_archive(spark):
    bad = spark.createDataFrame([("a", bytearray(b"\x1f\x8bno")), ("b", None), ("c", bytearray(b"http://x 1.1.1.1 1 t 9\nabc"))], "archive string, content binary")
    assert {r["archive"] for r in arc_tables.arc_digests(bad).where(F.col("error").isNotNull()).collect()} == {"a", "c"}
    assert {r["archive"] for r in arc_tables.read_warc(bad).where(F.col("error").isNotNull()).collect()} == {"a", "c"}
