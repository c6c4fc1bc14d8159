"""Token counts, BPE codec and packing against the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import EDGE, documents, frame, odd_texts

from logwarden.llm import bpe_codec, packing, token_counts
from logwarden.llm.bpe import default_path, vocabulary
from logwarden.llm.word_ids import BatchMerger, HashTable

LONG = (["theand" * k for k in (10, 1000, 4000)] + ["a" * 9000, "=" * 5001, "'" * 3000, "a'r" * 3000,
        "<|endoftext|>x<|endoftext|> y<|startoftext|>"])


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(default_path())
    return t, lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_counts_match_the_library(library):
    texts = odd_texts(1500) + LONG
    got = token_counts.Transducer(vocabulary(default_path())).count(texts)
    assert got.tolist() == [len(library[1](t)) for t in texts]


def test_wrong_entry_states_are_found_and_mended(library, monkeypatch):
    """Tiny chunks with hardly any context: entries are often guessed wrong."""
    monkeypatch.setattr(token_counts, "CHUNK", 7)
    monkeypatch.setattr(token_counts, "CONTEXT", 1)
    texts = LONG[:2] + odd_texts(200, 5) + ["internationalisation's " * 40]
    got = token_counts.Transducer(vocabulary(default_path())).count(texts)
    assert got.tolist() == [len(library[1](t)) for t in texts]


@pytest.mark.parametrize("most", [3, 60, 700])
def test_states_stay_bounded_within_a_batch(library, monkeypatch, most):
    """Random letters make a state each; chunks are taken again in halves."""
    monkeypatch.setattr(token_counts, "CHUNK", 64)
    monkeypatch.setattr(token_counts, "CONTEXT", 8)
    monkeypatch.setattr(token_counts, "MAX_STATES", most)
    rng = random.Random(11)
    texts = ["".join(rng.choice("abcdefghijklmnop qrstuvwxyz'.") for _ in range(n)) for n in (3000, 0, 1, 500, 64, 63, 65)]
    texts += ["".join(rng.choice("abcdefghijklmnop") for _ in range(2000))] + odd_texts(100, 4)
    m = token_counts.Transducer(vocabulary(default_path()))
    seen, kept = [], m._id
    monkeypatch.setattr(m, "_id", lambda state: (kept(state), seen.append(len(m.states)))[0])
    assert m.count(texts).tolist() == [len(library[1](t)) for t in texts]
    assert max(seen) <= most + 64 + 8 + 1                       # one chunk beyond the bound at most
    assert m.count(texts[::-1]).tolist() == [len(library[1](t)) for t in texts[::-1]]


def test_rare_symbols_beyond_the_dense_table(library, monkeypatch):
    monkeypatch.setattr(token_counts, "DENSE", 4)
    texts = odd_texts(200, 7)
    assert token_counts.Transducer(vocabulary(default_path())).count(texts).tolist() == [
        len(library[1](t)) for t in texts]


def test_prefix_scan_joins_only_matching_maps():
    doc = np.array([0, 0, 0, 1, 1])
    entry, exits = np.array([0, 5, 6, 0, 9]), np.array([5, 6, 7, 8, 1])
    ok, total = token_counts.prefix_scan(doc, entry, exits, np.array([1, 2, 3, 4, 5]))
    assert ok.tolist() == [True, True, True, True, False]
    assert total.tolist()[:4] == [1, 3, 6, 4]


@pytest.mark.parametrize("leaf", [2, 5, 48])
def test_tree_concatenation_is_exact(library, leaf):
    vocab = vocabulary(default_path())
    pieces = ["a" * 700, "=" * 501, "theand" * 90, "abcdefghij" * 30, "x", "ing"]
    got = bpe_codec.TreeEncoder(vocab, leaf).encode_pieces(pieces)
    assert got == [vocab.merge(vocab.symbols(p)) for p in pieces]


@pytest.mark.parametrize("step, remembered", [(1, 1), (3, 5), (32, 20_000)])
def test_joins_that_never_agree_early(library, monkeypatch, step, remembered):
    """Runs whose tokens shift to the end of the right side, and random ones."""
    monkeypatch.setattr(bpe_codec, "STEP", step)
    monkeypatch.setattr(bpe_codec, "REMEMBERED", remembered)
    vocab, rng = vocabulary(default_path()), random.Random(2)
    pieces = ["a" * n for n in range(1, 300, 7)] + ["=" * 1001, "-" * 777]
    pieces += ["".join(rng.choice(letters) for _ in range(rng.randint(40, 700)))
               for letters in ("ab", "aab", "theand", "abcdefghijklmnopqrstuvwxyz") for _ in range(25)]
    assert bpe_codec.TreeEncoder(vocab, 5).encode_pieces(pieces) == [vocab.merge(vocab.symbols(p)) for p in pieces]


def test_a_long_run_of_one_letter_takes_one_pass_a_level(library):
    vocab, piece = vocabulary(default_path()), "a" * 200_000
    encoder = bpe_codec.TreeEncoder(vocab)
    assert [vocab.ids[t] for t in encoder.encode_pieces([piece])[0]] == library[1](piece)
    assert len(encoder._known) < 1000


def test_batch_merging_and_heap_merging_agree():
    vocab = vocabulary(default_path())
    pieces = ["a" * 300, "hello", "x", "internationalisation", "theand" * 60]
    ids, size = BatchMerger(vocab).encode(pieces)
    want = [[vocab.ids[t] for t in vocab.merge(vocab.symbols(p))] for p in pieces]
    assert ids.tolist() == [i for w in want for i in w] and size.tolist() == [len(w) for w in want]


def test_hash_table_grows_and_finds():
    table, keys = HashTable(4), np.arange(1, 5000, dtype=np.uint64) * np.uint64(7919)
    table.add(keys, np.arange(len(keys), dtype=np.int32))
    assert table.find(keys).tolist() == list(range(len(keys)))
    assert (table.find(keys + np.uint64(1)) == -1).all()


def test_queries_match_the_library(spark, library):
    rows = documents(spark) + EDGE + [(1000 + i, t) for i, t in enumerate(odd_texts(50, 9))]
    docs = frame(spark, rows)
    want = sorted(((i, len((t or "").encode()), len(library[1](t)), len(library[1](t)) > 2048)
                   for i, t in rows), key=str)
    assert sorted(map(tuple, token_counts.token_counts(docs).collect()), key=str) == want

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    want = sorted(((i, len(ids), sha(" ".join(map(str, ids))),
                    sha(library[0].decode(ids, skip_special_tokens=False)))
                   for i, t in rows for ids in [library[1](t)]), key=str)
    assert sorted(map(tuple, bpe_codec.codec_digests(docs).collect()), key=str) == want


def test_encode_decode_round_trip(spark, library):
    rows = documents(spark, 20) + EDGE
    encoded = bpe_codec.encode(frame(spark, rows))
    assert sorted((tuple(r.ids) for r in encoded.collect())) == sorted(
        tuple(library[1](t)) for _, t in rows)
    decoded = sorted(r.text for r in bpe_codec.decode(encoded).collect())
    assert decoded == sorted(library[0].decode(library[1](t), skip_special_tokens=False)
                             for _, t in rows)


@pytest.mark.parametrize("per_task,limit", [(32768, 256), (60, 4)])
def test_packing(spark, library, per_task, limit):
    rows = documents(spark) + [r for r in EDGE if r[0] != 900004] + [(900007, "word " * 9000)]
    cut = packing.pieces(frame(spark, rows), length=4096)
    got = packing.pack(cut, 4096, limit, per_task).collect()
    text = dict(rows)
    placed, seen = defaultdict(list), defaultdict(list)
    for r in got:
        ids = library[1](text[r.doc_id]) + [1]
        part = ids[r.start:r.start + r.length]
        assert r.start == r.piece * 4096 and len(part) == r.length
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        placed[r.sequence_id].append((r.offset, r.length))
        seen[r.doc_id].append(r.length)
    total = 0
    for i, t in rows:
        n = len(library[1](t)) + 1
        total += n
        assert sorted(seen[i]) == sorted([4096] * (n // 4096) + [n % 4096] * (n % 4096 > 0))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(placed) <= -(-total // 4096) * 1.15 + 2


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    b = packing.BestFit(10, 2)
    assert not list(b.add("a", 6)) and not list(b.add("b", 7))     # free 4 and 3
    assert [x for _, x in b.add("c", 3)] == [[("b", 0), ("c", 7)]]  # fits b exactly: closes
    assert not list(b.add("d", 8))                                  # free 4 and 2
    assert [x for _, x in b.add("e", 9)] == [[("d", 0)]]            # the fullest goes


def test_empty_tables(spark):
    docs = frame(spark, [(1, "x")]).limit(0)
    for op in (token_counts.token_counts, bpe_codec.codec_digests, packing.pack_documents):
        assert op(docs).collect() == []


def test_pieces_of_words_by_the_library(library):
    p = packing.word_ids(default_path())
    texts = odd_texts(800, 11) + [None, ""]
    assert [x.tolist() for x in p.column(pa.array(texts))] == [library[1](t) for t in texts]
