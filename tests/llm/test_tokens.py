"""Encoding, packing and token counts against the tokenizer libraries."""

import public_tokenizers
import pytest
import tiktoken
import numpy as np
from tokenizers import Tokenizer

from tests.llm.corpus import frame, odd_rows, prose
from tidemark.llm import bpe, packing, token_counts
from tidemark.llm.vocabulary import MULTI_BPE, path, read_ranks


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=read_ranks(path(MULTI_BPE)),
        special_tokens={},
    )


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(path("byte_bpe_50k.json"))


def texts():
    return [
        "a" * 900 + " " * 700 + "b",
        " \n\n  it's\tI'll 123,456  " * 60,
        prose(1, 400) + "   \n" + "é" * 300 + "'re 're",
        "日本語テキスト、" * 80 + "　　" * 90,
        "'" * 333 + "s" * 10,
    ]


@pytest.mark.parametrize("chunk, overlap", [(32_768, 512), (100, 30), (17, 9), (400, 400)])
def test_chunks_encode_as_the_whole(spark, reference, chunk, overlap):
    rows = [*odd_rows(), *enumerate(texts(), 50)]
    if chunk < 100:
        rows = [(i, text) for i, text in rows if len(text or "") < 10_000]
    coded = bpe.encode(frame(spark, rows), chunk_chars=chunk, overlap_chars=overlap)
    found = bpe.decode(coded).collect()
    expected = sorted(
        (str(i), reference.encode_ordinary(text or ""), (text or "").encode()) for i, text in rows
    )
    assert expected == sorted(
        (str(row.doc_id), np.frombuffer(row.ids, "<u4").tolist(), bytes(row.decoded))
        for row in found
    )
    assert all(row.n_tokens * 4 == len(row.ids) for row in found)


def test_json_vocabulary_encodes_as_its_library(byte_bpe):
    from tidemark.llm.vocabulary import encoded_with_added

    for text in [*texts(), *[text or "" for _, text in odd_rows()]]:
        own = encoded_with_added(path("byte_bpe_50k.json"), text).tolist()
        assert own == byte_bpe.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("window, open_windows, max_gap", [(2048, 64, 8), (64, 3, 4), (64, 2, 0)])
def test_packed_pieces(spark, byte_bpe, window, open_windows, max_gap):
    rows = [(i, prose(i, 5 + i * i % 190)) for i in range(60)] + [(100, None), (101, prose(9, 3000))]
    docs = frame(spark, rows).repartition(3)
    pieces = packing.packed(
        docs, window=window, open_windows=open_windows, max_gap=max_gap
    ).collect()
    sequences, documents = {}, {}
    for piece in pieces:
        sequences.setdefault(piece.sequence_id, []).append(piece)
        documents.setdefault(piece.doc_id, []).append(piece)
    for number, text in rows:
        own = sorted(documents[number], key=lambda piece: piece.start)
        ids = [x for piece in own for x in np.frombuffer(piece.ids, "<u4").tolist()]
        assert ids == [*byte_bpe.encode(text or "", add_special_tokens=False).ids, 1]
        assert [piece.start for piece in own] == np.cumsum([0, *[p.length for p in own[:-1]]]).tolist()
        assert {piece.doc_tokens for piece in own} == {len(ids)}
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda piece: piece.offset)
        assert [p.offset for p in own] == np.cumsum([0, *[p.length for p in own[:-1]]]).tolist()
        total = sum(piece.length for piece in own)
        assert total <= window
        padding += 0 if total & (total - 1) == 0 else window - total
    assert padding <= max_gap * len(sequences)


def test_digests_are_checksums_of_the_ids(spark):
    import zlib

    pieces = packing.packed(frame(spark, odd_rows()))
    ids = {(p.sequence_id, p.offset): zlib.crc32(p.ids) for p in pieces.collect()}
    found = packing.digests(pieces)
    assert "ids" not in found.columns
    assert {(p.sequence_id, p.offset): p.ids_crc32 for p in found.collect()} == ids


def test_histogram_answers(spark, byte_bpe, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_LENGTHS", 16)
    rows = [*odd_rows(), *[(i, prose(i, i % 50)) for i in range(200, 300)]]
    lengths = np.array(
        [len(byte_bpe.encode(text or "", add_special_tokens=False).ids) for _, text in rows]
    )
    histogram = token_counts.length_histogram(frame(spark, rows))
    found = histogram.collect()
    assert sorted(row.n_tokens for row in found) == sorted(set(lengths.tolist()))
    for row in found:
        assert row.n_docs == (lengths == row.n_tokens).sum()
        assert row.docs_from == (lengths >= row.n_tokens).sum()
        assert row.tokens_from == lengths[lengths >= row.n_tokens].sum()
        assert row.docs_to == (lengths <= row.n_tokens).sum()
        assert row.tokens_total == lengths.sum()
        assert row.tokens_cut == np.minimum(lengths, row.n_tokens).sum()
    limits = [0, 7, 64, 10**6]
    expected = {limit: int(np.minimum(lengths, limit).sum()) for limit in limits}
    assert token_counts.cut_totals(histogram, limits) == expected
    shares = [0.1, 0.5, 0.99, 1.0]
    ordered = np.sort(lengths)
    assert token_counts.quantiles(histogram, shares) == {
        share: int(ordered[int(np.ceil(share * len(ordered))) - 1]) for share in shares
    }


def test_added_tokens_of_the_json_vocabulary_are_found_in_the_text(spark):
    """As the library encodes with the file as it is: with the added tokens matched in the text."""
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    rows = [
        (1, "a<|endoftext|>b"),
        (2, "<|endoftext|><|endoftext|> x \n<|endoftext|>  y"),
        (3, "  <|endoftext|>\n\n<|ENDOFTEXT|> <|endoftext|"),
        (4, prose(3, 50) + "<|endoftext|>" + prose(4, 900)),
        *[(10 + i, text) for i, text in enumerate(texts())],
    ]
    expected = {n: library.encode(text, add_special_tokens=False).ids for n, text in rows}
    assert expected[1] == [64, 50256, 65]
    from tidemark.llm.vocabulary import encoded_with_added

    for number, text in rows:
        assert encoded_with_added(path("byte_bpe_50k.json"), text).tolist() == expected[number]
    found = {number: [] for number, _ in rows}
    for piece in packing.packed(frame(spark, rows)).orderBy("doc_id", "start").collect():
        found[piece.doc_id] += np.frombuffer(piece.ids, "<u4").tolist()
    assert found == {number: [*ids, 1] for number, ids in expected.items()}
    histogram = token_counts.length_histogram(frame(spark, rows)).collect()
    assert sorted(row.n_tokens for row in histogram for _ in range(row.n_docs)) == sorted(
        map(len, expected.values())
    )
