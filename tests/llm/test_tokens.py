"""Encoder, sequence files and packing against the tokenizers library."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tarmac.llm import arrow_sequences, bm25_packing
from tarmac.llm.tables import table
from tarmac.llm.word_tokens import WholeTextEncoder, parted, slices


def encoded(vocabulary, texts, end):
    codec = Tokenizer.from_file(vocabulary)
    return [[*codec.encode(text or "", add_special_tokens=False).ids, end] for text in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("max_words, max_pieces", [(3, 1_000_000), (1_000_000, 3), (1_000_000, 1_000_000)])
def test_encoder_equals_the_library(vocabulary, max_words, max_pieces):
    draw = random.Random(0)
    letters = "aZ'sS.,!?1$%-_éÉŞ²½ \n\t\x1c\x85\xa0é́İΣς<|>日ͅªⅣ"
    texts = [None, "", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "it's DON'T 3.4 ß ŉ ǅ", "x''s we'll'd a$$$ b%%%, 's 'S 're ÀÉ. ẞ İI. ΟΔΟΣ οδος ΣΑΣ. ſK"]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) for _ in range(2000)]
    codec = WholeTextEncoder(vocabulary, max_words, max_pieces)
    array = pa.array(texts, pa.string())
    got = []
    for start, stop in slices(array, 500):
        ids, ends, _ = codec.encode(array.slice(start, stop - start))
        got += [part.tolist() for part in np.split(ids, ends[:-1])]
    assert got == [ids[:-1] for ids in encoded(vocabulary, texts, 0)]


def check_sequences(frame, vocabulary):
    rows = [tuple(row) for row in frame.select("doc_id", "text").collect()]
    got = arrow_sequences.read_documents(arrow_sequences.write_sequences(frame, vocabulary, end_id=1)).collect()
    lengths = {}
    for (doc_id, text), ids in zip(rows, encoded(vocabulary, [text for _, text in rows], 1)):
        lengths.setdefault(doc_id, []).append((len(ids), crc(ids)))
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == collections.Counter(
        (doc_id, *found) for doc_id, all_found in lengths.items() for found in all_found
    )
    start = 0
    for row in sorted(got, key=lambda r: r.start):
        assert row.start == start
        start += row.n_tokens
    ids = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids)


def test_sequences_of_the_given_documents(spark, small, vocabulary):
    check_sequences(table(spark, small, "documents"), vocabulary)


def test_sequences_of_edge_rows(edge_docs, vocabulary):
    check_sequences(edge_docs, vocabulary)


def test_no_documents_no_sequences(no_docs, vocabulary):
    manifest = arrow_sequences.write_sequences(no_docs, vocabulary, end_id=1)
    assert arrow_sequences.read_documents(manifest).count() == 0


def test_random_access_to_sequences_and_masks(tmp_path):
    writer = arrow_sequences.ShardWriter(f"file://{tmp_path}/shard", 16, np.dtype("<u2"))
    stream = np.arange(16 * 600 + 5, dtype=np.uint16)
    for part in np.array_split(stream, 7):
        writer.add(pa.array([1], pa.int64()), part, np.array([len(part)]))
    writer.close()
    shard = arrow_sequences.Shard(f"file://{tmp_path}/shard")
    assert len(shard) == 601
    for k in (0, 255, 256, 599):
        assert shard.ids(k).tolist() == stream[16 * k : 16 * k + 16].tolist()
        assert shard.mask(k).to_pylist() == [True] * 16
    assert shard.mask(600).to_pylist() == [True] * 5 + [False] * 11
    assert shard.tokens(4000, 5000).tolist() == stream[4000:5000].tolist()
    # a view of the memory map, not a copy
    assert not shard.ids(3).flags.owndata


def check_packing(frame, vocabulary, **options):
    rows = [tuple(row) for row in frame.select("doc_id", "text").collect()]
    pieces = bm25_packing.pack(frame, vocabulary, end_id=2, **options).collect()
    wanted = collections.Counter()
    for (doc_id, _), ids in zip(rows, encoded(vocabulary, [text for _, text in rows], 2)):
        wanted[(doc_id, len(ids), crc(ids))] += 1
    by_document = collections.defaultdict(list)
    for piece in pieces:
        by_document[(piece.doc_id, piece.doc_tokens)].append(piece)
    assert {key[:2] for key in wanted} == set(by_document)
    for (doc_id, size), found in by_document.items():
        times = sum(n for key, n in wanted.items() if key[:2] == (doc_id, size))
        assert sum(piece.length for piece in found) == times * size
    sequences = collections.defaultdict(list)
    for piece in pieces:
        sequences[piece.sequence_id].append(piece)
    for found in sequences.values():
        end = 0
        for piece in sorted(found, key=lambda p: p.offset):
            assert piece.offset == end and piece.length > 0
            end += piece.length
        assert end == 4096 or end & (end - 1) == 0
    return pieces, rows


def test_packing_of_the_given_documents(spark, small, vocabulary):
    pieces, rows = check_packing(table(spark, small, "documents"), vocabulary, shard_docs=50)
    texts = dict(rows)
    ids_of = dict(zip(texts, encoded(vocabulary, texts.values(), 2)))
    for piece in pieces:
        assert piece.ids_crc32 == crc(ids_of[piece.doc_id][piece.start : piece.start + piece.length])


def test_packing_of_edge_rows(edge_docs, no_docs, vocabulary):
    check_packing(edge_docs, vocabulary)
    assert bm25_packing.pack(no_docs, vocabulary, end_id=2).count() == 0


def test_scores_are_bm25():
    draw = np.random.default_rng(0)
    tokens = [draw.integers(0, 40, draw.integers(1, 60)).astype(np.uint16) for _ in range(30)]
    index = bm25_packing.ShardIndex(tokens, query_terms=1000)
    mean = np.mean([len(t) for t in tokens])
    for seed in range(30):
        expected = np.zeros(30)
        for term in set(tokens[seed].tolist()):
            holders = [k for k, t in enumerate(tokens) if term in t]
            if len(holders) < 2:
                continue
            idf = np.log(1 + (30 - len(holders) + 0.5) / (len(holders) + 0.5))
            for k in holders:
                tf = (tokens[k] == term).sum()
                norm = bm25_packing.K1 * (1 - bm25_packing.B + bm25_packing.B * len(tokens[k]) / mean)
                expected[k] += idf * tf * (bm25_packing.K1 + 1) / (tf + norm)
        assert np.allclose(index.scores(seed), expected)


def test_neighbours_share_a_window():
    topics = [np.arange(100 * k, 100 * k + 60, dtype=np.uint16) for k in range(6)]
    documents = [(k, topics[k % 6]) for k in range(36)]
    out, packer = [], bm25_packing.Packer(360)
    bm25_packing.pack_shard(documents, packer, 24, out)
    windows = collections.defaultdict(set)
    for piece in out:
        windows[piece[5]].add(piece[0] % 6)
    assert all(len(found) == 1 for found in windows.values())


def test_scores_weigh_terms_by_all_documents(spark):
    """A term that is common in the shard and rare in the corpus counts as rare; no term of a seed is left out."""
    rows = [np.array([1, 2, 3], np.uint16)] * 3 + [np.array([2, 4], np.uint16)] * 97
    frame = spark.createDataFrame([(bytes(ids.tobytes()),) for ids in rows], "ids binary").repartition(4)
    corpus = bm25_packing.corpus_of(frame, np.dtype(np.uint16))
    assert (corpus.n, corpus.mean) == (100, 2.03) and corpus.df.tolist() == [0, 3, 100, 3, 97]
    shard = bm25_packing.ShardIndex(rows[:3], None, corpus)
    assert np.allclose(shard.idf[[1, 2]], np.log1p([97.5 / 3.5, 0.5 / 100.5]))
    # 40 rare terms that lead nowhere good, one more common term that half of the seed consists of
    seed = np.append(np.arange(100, 140), [7] * 40).astype(np.uint16)
    near, far = np.array([7] * 40, np.uint16), [np.array([k, 9], np.uint16) for k in range(100, 140)]
    index = bm25_packing.ShardIndex([seed, near, np.array([7, 8], np.uint16), *far])
    assert index.scores(0)[1] > 0


def test_words_that_come_again_are_not_forgotten(vocabulary):
    small, large = WholeTextEncoder(vocabulary, 40, 40), WholeTextEncoder(vocabulary, 10_000, 10_000)
    for at in range(6):
        texts = pa.array([f"often Known, {' '.join(f'word{at}x{k}' for k in range(15))}", None, ""])
        for one, other in zip(small.encode(texts), large.encode(texts)):
            assert one.tolist() == other.tolist()
    # the memory was full several times over
    assert len(small.places) < 60 and {"often", "Known,"} <= small.places.keys()
    small.max_words = 1  # a batch of more words than fit is still encoded
    assert small.encode(texts)[0].tolist() == large.encode(texts)[0].tolist()


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_parted_texts_have_the_same_ids_in_fewer_words(vocabulary, kind):
    draw = random.Random(1)
    letters = "aZJ'sS.,!?;:1$-_éÉ \n\t\x1c\xa0\u030c\u0301\u0307İΣς<|>日,. ,. "
    texts = [None, "", "a", "Known, known. KNOWN: It's 3, 'S, x., a$, J\u030c, I\u0307. É, ΟΔΟΣ, end,", "b, c. d! e", ", .", "A"]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    special = ["<|ENDOFTEXT|>, A, <|endoftext|>. B"]
    codec = WholeTextEncoder(vocabulary)
    for given in (texts, special, texts + special):
        array = pa.array(["cut off", *given, "cut off"], kind).slice(1, len(given))
        got = []
        for start, stop in slices(array, 400):
            found = parted(array.slice(start, stop - start))
            assert found.type == kind and found.validate(full=True) is None
            ids, ends, _ = codec.encode(found)
            got += [part.tolist() for part in np.split(ids, ends[:-1])]
        assert got == [ids[:-1] for ids in encoded(vocabulary, given, 0)]
    codec = WholeTextEncoder(vocabulary)
    codec.encode(parted(pa.array(["Known, known. KNOWN: known; "], kind)))
    assert codec.places.keys() <= {"known", ",", ".", ":", ";", ""}


def test_lone_marks_deal_out_no_text(vocabulary):
    texts = [f"word{k} , . ! ? ; :" for k in range(50)]
    _, _, least = WholeTextEncoder(vocabulary).encode(pa.array(texts))
    assert len(set(least.tolist())) == 50


def test_terms_are_counted_past_the_marks_of_255_documents(spark):
    rows = [np.array([3, 3, k % 2], np.uint32) for k in range(700)] + [np.array([70_000, 3], np.uint32), np.array([], np.uint32)]
    frame = spark.createDataFrame([(bytes(ids.tobytes()),) for ids in rows], "ids binary").repartition(1)
    corpus = bm25_packing.corpus_of(frame, np.dtype(np.uint32))
    assert (corpus.n, len(corpus.df)) == (702, 70_001)
    assert corpus.df[[0, 1, 2, 3, 70_000]].tolist() == [350, 350, 0, 701, 1] and corpus.df.sum() == 1402


def test_scores_of_the_documents_still_searched_stay_the_same():
    draw = np.random.default_rng(1)
    tokens = [draw.integers(0, 60, draw.integers(1, 50)).astype(np.uint16) for _ in range(40)]
    whole, less = bm25_packing.ShardIndex(tokens), bm25_packing.ShardIndex(tokens)
    order = draw.permutation(40)
    for kept in (30, 12, 3, 0):
        wanted = np.zeros(40, bool)
        wanted[order[:kept]] = True
        less.search_only(wanted)
        assert less.searched == kept and len(less.posted) == wanted[whole.posted].sum()
        for seed in range(40):
            assert less.scores(seed)[wanted].tolist() == whole.scores(seed)[wanted].tolist()
