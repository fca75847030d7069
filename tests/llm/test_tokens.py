"""Tokenizing operators against the library: ops 4, 5 and 10."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siltstone.llm import bpe_transducer, config_packing, rans_output
from siltstone.llm.tokens import WordEncoder
from tests.llm.helpers import no_documents, odd_documents, sample_documents, texts_of

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}
ENCODERS = {p: WordEncoder(p) for p in (BYTE, WORD)}
MERGES = bpe_transducer.MergeList(BYTE)

MIXED = st.text(
    st.one_of(
        st.sampled_from("the cat's re'll I'VE 12ab.,;|#$%&<>\n\t  \x1c\x85 ​éßÀªµº日本🎉́"),
        st.characters(exclude_categories=["Cs"]),
    ),
    max_size=120,
)


def library_ids(path: str, text: str | None) -> list[int]:
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
@given(text=MIXED)
@settings(max_examples=400, deadline=None)
def test_word_encoder_equals_library(path, text):
    for t in (text, text + "<|endoftext|> x", text.upper()):
        assert np.frombuffer(ENCODERS[path].encode(t), "<u4").tolist() == library_ids(path, t)


def transduced(text: str) -> list[int]:
    return [i for part in bpe_transducer.Encoder(MERGES).stream(text) for i in part]


@given(text=MIXED)
@settings(max_examples=400, deadline=None)
def test_transducer_equals_library(text):
    for t in (text, f"x<|endoftext|>{text}"):
        assert transduced(t) == library_ids(BYTE, t)


@pytest.mark.parametrize("text", [
    "a" * 200_000, "thing" * 30_000, " " * 140_000 + "x", "\n \n" * 50_000, "'" + "l" * 140_000,
    "日本語" * 50_000, "é" * 140_000, "1234567890" * 14_000, "<|endoftext|>" * 12_000,
    "ab c'sltv \n.1" * 12_000,
])
def test_unbroken_texts_are_encoded_in_constant_memory(text):
    encoder, most, ids = bpe_transducer.Encoder(MERGES), 0, []
    for at in range(0, len(text), bpe_transducer.PIECE):
        ids += encoder.feed(text[at: at + bpe_transducer.PIECE])
        most = max(most, len(encoder.pending))
    ids += encoder.finish()
    assert ids == library_ids(BYTE, text)
    assert most <= bpe_transducer.LONG_WORD + 2 * MERGES.lookahead


def test_decoder_keeps_broken_characters_apart():
    ids = [MERGES.id_of_byte[b] for b in "né🎉".encode()[:-1]] + [MERGES.id_of_byte[65]]
    decoder = bpe_transducer.Decoder(MERGES)
    assert "".join(decoder.push([i]) for i in ids) + decoder.close() == LIBRARY[BYTE].decode(ids)


def test_sufficient_lookahead_follows_chains():
    # c+d then b+(cd) then a+(bcd): news of d reaches back over a, b and c.
    merges = [(3, 4, 5, 1, 1), (2, 5, 6, 1, 2), (1, 6, 7, 1, 3)]
    assert bpe_transducer.sufficient_lookahead(merges) == 4


def test_op5_rows(spark):
    for docs in (odd_documents(spark), sample_documents(spark)):
        found = sorted(map(tuple, bpe_transducer.encode_documents(docs, BYTE).collect()), key=repr)
        expected = []
        for doc_id, text in texts_of(docs):
            ids = library_ids(BYTE, text)
            decoded = LIBRARY[BYTE].decode(ids, skip_special_tokens=False)
            expected.append((
                doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest(),
            ))
        assert found == sorted(expected, key=repr)
    assert bpe_transducer.encode_documents(no_documents(spark), BYTE).count() == 0


def expected_pieces(docs, capacity=1024):
    out = []
    for doc_id, text in texts_of(docs):
        ids = [*library_ids(BYTE, text), 2]
        stop = (len(ids) - 1) % capacity + 1
        start = piece = 0
        while start < len(ids):
            crc = zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())
            out.append((doc_id, piece, start, stop - start, crc))
            start, stop, piece = stop, stop + capacity, piece + 1
    return sorted(out, key=repr)


def test_op4_rows(spark, monkeypatch):
    monkeypatch.setattr(config_packing, "STEPS", 60)
    for docs in (odd_documents(spark), sample_documents(spark)):
        rows = config_packing.pack_documents(docs, BYTE).collect()
        assert sorted((tuple(r[:5]) for r in rows), key=repr) == expected_pieces(docs)
        sequences = {}
        for r in rows:
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for places in sequences.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 1024
        total = sum(r.length for r in rows)
        # Pieces above half a sequence cannot share one: also a bound.
        least = max(-(-total // 1024), sum(r.length > 512 for r in rows))
        assert len(sequences) <= least * 1.03 + 1
    assert config_packing.pack_documents(no_documents(spark), BYTE).count() == 0


@given(st.lists(st.integers(1, 40), min_size=1, max_size=60))
@settings(max_examples=60, deadline=None)
def test_configurations_hold_every_piece_once(lengths):
    counts = np.bincount(lengths, minlength=41)
    held = np.zeros(41, dtype=int)
    for config, times in config_packing.configurations(counts, 40):
        assert sum(config) <= 40 and times > 0
        np.add.at(held, config, times)
    assert (held == counts).all()


def test_packing_reaches_the_optimum_on_pairs():
    counts = np.zeros(101, dtype=int)
    counts[60], counts[40], counts[70], counts[30] = 500, 500, 300, 300
    assert sum(t for _, t in config_packing.configurations(counts, 100)) == 800


def test_best_fills_equal_brute_force():
    value = np.array([0, 0, 3.0, 0, 0, 8.5, 0, 0])
    best, last = config_packing.best_fills(value, 12)
    for room in range(13):
        expected = max(
            3.0 * a + 8.5 * b for a in range(7) for b in range(3) if 2 * a + 5 * b <= room
        )
        assert best[room] == pytest.approx(expected)
        assert sum(value[x] for x in config_packing.taken(last, room)) == pytest.approx(expected)


def test_op10_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(rans_output, "SHARD_DOCUMENTS", 60)
    monkeypatch.setattr(rans_output, "BLOCK_TOKENS", 3000)
    for name, docs in (("odd", odd_documents(spark)), ("sample", sample_documents(spark))):
        rans_output.write_tokens(docs, f"{folder}/{name}", WORD, 2)
        found = rans_output.read_documents(spark, f"{folder}/{name}").collect()
        rows = sorted(texts_of(docs), key=lambda r: (r[0] is not None, r[0] or 0))
        at, expected = 0, []
        for doc_id, text in rows:
            ids = [*library_ids(WORD, text), 2]
            expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
        assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    assert spark.read.parquet(f"{folder}/sample/blocks").select("shard").distinct().count() > 2
    rans_output.write_tokens(no_documents(spark), f"{folder}/none", WORD, 2)
    assert rans_output.read_documents(spark, f"{folder}/none").count() == 0


@given(st.lists(st.integers(0, 300), max_size=6000), st.integers(1, 4))
@settings(max_examples=40, deadline=None)
def test_blocks_round_trip_and_decode_by_parts(ids, docs):
    tokens, counts = np.unique([*ids, 7], return_counts=True)
    table = rans_output.Table(tokens, rans_output.scaled(counts))
    sizes = [len(part) for part in np.array_split(np.array(ids), docs)]
    listed = list(enumerate(sizes))
    data = rans_output.encode_block(table, np.array(ids, dtype="<u4"), listed)
    found, known = rans_output.decode_block(table, data)
    assert found.tolist() == ids and known == listed
    step = rans_output.LANES * rans_output.CHECKPOINT_STEPS
    for part in range(-(-len(ids) // step)):
        piece, _ = rans_output.decode_block(table, data, part)
        assert piece.tolist() == ids[part * step: (part + 1) * step]


def test_many_checkpoints_and_broken_blocks():
    ids = np.random.default_rng(1).integers(0, 5000, 300_000).astype("<u4")
    tokens, counts = np.unique(ids, return_counts=True)
    table = rans_output.Table(tokens, rans_output.scaled(counts))
    data = rans_output.encode_block(table, ids, [(None, len(ids))])
    found, docs = rans_output.decode_block(table, data)
    assert (found == ids).all() and docs == [(None, len(ids))]
    step = rans_output.LANES * rans_output.CHECKPOINT_STEPS
    assert (rans_output.decode_block(table, data, 3)[0] == ids[3 * step: 4 * step]).all()
    assert len(data) < 2.0 * len(ids)
    broken = bytearray(data)
    broken[len(data) // 2] ^= 1
    with pytest.raises(rans_output.BrokenBlock):
        rans_output.decode_block(table, bytes(broken))


@given(st.lists(st.integers(1, 10**9), min_size=1, max_size=400))
@settings(max_examples=100, deadline=None)
def test_scaled_frequencies_are_a_power_of_two(counts):
    out = rans_output.scaled(np.array(counts))
    assert out.min() >= 1 and int(out.sum()).bit_count() == 1
