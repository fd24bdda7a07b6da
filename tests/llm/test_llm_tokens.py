from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from llm_data import documents, frame, sentence
from tokenizers import Tokenizer

from trackframe.llm.packing import pack, pieces
from trackframe.llm.staging import scratch_path
from trackframe.llm.textops import utf8
from trackframe.llm.tokenfile import decode_range, expand, read_token_file, repair, token_digests, write_token_file
from trackframe.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def test_encoder_equals_the_library(whole):
    rng = random.Random(2)
    letters = list("abst 's're'll 'm  \n\n\t.,!?0123'’éßÀ²½×_$€日\xa0\x85A") + ["'s", "'re", "'ve", "<|endoftext|>", "  ", "n't"]
    texts = [r[1] or "" for r in documents()] + ["".join(rng.choices(letters, k=rng.randint(0, 14))) for _ in range(3000)]
    texts += ["".join(rng.choices(letters[:30], k=rng.randint(0, 14))) for _ in range(3000)]
    encoder = Encoder(PATH)
    for part in (texts, [t for t in texts if all(ord(c) < 0x240 and c not in "\xa0\x85" for c in t) and "<|" not in t]):
        ids, bounds = encoder.encode(*utf8(pa.array(part, pa.large_string())))
        for i, t in enumerate(part):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


def test_grammar_round_trip():
    rng = np.random.default_rng(1)
    for ids in (rng.integers(0, 6, 5000), np.zeros(999), rng.integers(0, 60000, 300), np.zeros(0), np.array([7])):
        ids = ids.astype(np.uint32)
        symbols, rules, lengths = repair(ids, least=3)
        assert (expand(symbols, rules, lengths) == ids).all()
        if len(ids) >= 999:
            assert len(symbols) < len(ids) / 2


def test_token_file(spark, whole):
    rows = documents()
    path = scratch_path(spark, "test-token-file")
    write_token_file(frame(spark, extra=True), path, PATH)
    shards = read_token_file(spark, path)
    got = sorted((tuple(r) for r in token_digests(shards).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted([r[0] for r in rows], key=lambda i: -1 if i is None else i)
    at, left = 0, sorted(((r[0], zlib.crc32(np.array(whole.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4"))) for r in rows), key=str)
    for doc, start, n, crc in got:
        assert start == at
        at += n
    assert sorted(((d, c) for d, _, _, c in got), key=str) == left
    first = max(shards.collect(), key=lambda r: r["n_ids"]).asDict()
    every = decode_range(first, 0, first["n_ids"])
    for a, b in ((0, 1), (5, 5), (100, 2600), (first["n_ids"] - 3, first["n_ids"])):
        assert (decode_range(first, a, b) == every[a:b]).all()


def test_packing(spark, whole):
    rows = documents()
    got = [r.asDict() for r in pack(frame(spark, extra=True).coalesce(1), PATH, keep_ids=True).collect()]
    by_sequence, by_doc = {}, {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4")) and len(r["ids"]) == r["length"]
    lengths = []
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        lengths.append(at)
    assert max(lengths) <= 1024 and all(n & (n - 1) == 0 for n in lengths)
    expected = sorted(tuple(whole.encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in rows)
    unique = {(d, n) for d, n in by_doc if sum(1 for r in rows if r[0] == d) == 1}
    for key in unique:
        parts = sorted(by_doc[key], key=lambda r: r["start"])
        assert tuple(i for p in parts for i in p["ids"]) in expected
    assert sum(r["length"] for r in got) == sum(map(len, expected))


def test_pieces_cover_everything():
    doc, start, size, sequence, offset = pieces(np.array([5, 3000, 1, 70]))
    assert size.sum() == 3076 and (np.bincount(sequence, size) == [1024, 1024, 1024, 4]).all()
    assert doc.tolist()[0] == 0 and start[doc == 1].tolist() == [0, 1019, 2043]


def test_empty_tables(spark):
    path = scratch_path(spark, "test-empty-file")
    write_token_file(frame(spark, []), path, PATH)
    assert token_digests(read_token_file(spark, path)).count() == 0
    assert pack(frame(spark, []), PATH).count() == 0


def test_packing_brings_neighbours_together(spark):
    rng = random.Random(4)
    topics = [[sentence(rng, 1) for _ in range(12)] for _ in range(40)]
    filler = [sentence(rng, 1) for _ in range(30)]
    text = lambda t: " ".join(rng.choice(topics[t]) if i % 2 else rng.choice(filler) for i in range(150))
    # A topic's documents lie far apart: in many partitions of rows, each a shard of its own if shards follow the layout.
    rows = [(100 * k + t, text(t)) for k in range(6) for t in range(40)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 24), "doc_id bigint, text string")
    got = pack(docs, PATH).collect()
    together = {}
    for r in got:
        together.setdefault(r["sequence_id"], []).append(r["doc_id"] % 100)
    alike = [x[i] == x[i + 1] for x in together.values() for i in range(len(x) - 1)]
    assert sum(alike) > 0.5 * len(alike)  # by layout every partition holds ten topics once


def test_long_text_has_neighbours():
    from trackframe.llm.packing import _blocks, halves

    sizes = [10, 5000, 10, 10, 3000, 900, 10, 10]
    batches = [pa.RecordBatch.from_arrays([pa.array([halves(np.arange(n))[0]], pa.binary())], ["ids"]) for n in sizes]
    assert [b.num_rows for b in _blocks(iter(batches), 1000)] == [5, 3]


def test_neighbours_by_all_shared_terms():
    from trackframe.llm.packing import Index, order

    flat = lambda docs: (np.concatenate(docs), np.concatenate([[0], np.cumsum([len(d) for d in docs])]))
    # The seed shares 20 rare ids with one document each, and 200 others with the last one, which three more hold.
    seed = np.arange(220)
    docs = [seed, *[np.array([i, 1000 + i]) for i in range(20)], *[np.arange(200 * k + 2000, 200 * k + 2200) for k in range(3)]]
    docs = [np.concatenate([d, np.arange(20, 220)]) if len(d) == 200 else d for d in docs] + [np.arange(20, 220)]
    index = Index(*flat(docs))
    used = np.zeros(len(docs), bool)
    used[0] = True
    ranked = list(index.neighbours(0, used))
    assert ranked[0] == len(docs) - 1 and sorted(ranked) == list(range(1, len(docs)))
    # 60 short neighbours of the first document, each after an unrelated one: all of them fill its window.
    docs = [np.arange(60), *[np.array([500 + k, 500 + k]) if k % 2 else np.array([k // 2, 9000]) for k in range(120)]]
    docs = [d if d[-1] != 9000 else d[:1] for d in docs]
    ids, bounds = flat(docs)
    assert all(len(docs[d]) == 1 for d in order(ids, bounds, 1024)[1:61])


def test_repair_goes_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 5000, 400)
    ids = np.concatenate([np.concatenate([passage, rng.integers(5000, 60000, 3)]) for _ in range(40)])
    symbols, rules, lengths = repair(ids)
    assert (expand(symbols, rules, lengths) == ids).all() and lengths.max() > 100
    pairs, counts = np.unique(np.stack([symbols[:-1], symbols[1:]]), axis=1, return_counts=True)
    assert counts.max() < 12


def test_neighbours_in_parts_and_after_forgetting():
    from trackframe.llm.packing import B, K1, Index

    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 60, rng.integers(1, 30)) for _ in range(400)]
    docs += [docs[5]] * 100  # ties
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    index, used = Index(np.concatenate(docs).astype(np.uint32), bounds), np.zeros(len(docs), bool)
    df = np.array([sum(t in d for d in docs) for t in range(60)])
    mean = np.mean([len(d) for d in docs])

    def plain(seed):
        score = []
        for d in docs:
            s = 0.0
            for t in np.unique(docs[seed]).tolist():
                if (tf := int((d == t).sum())) and df[t] > 1:
                    s += np.log1p((len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(d) / mean))
            score.append(round(s, 9))
        return score
    for seed in (0, 5, 17):
        used[seed] = True
        got, score = list(index.neighbours(seed, used)), plain(seed)
        assert sorted(got) == [i for i in range(len(docs)) if not used[i] and score[i] > 0]
        assert all(score[a] >= score[b] - 1e-8 for a, b in zip(got, got[1:]))
        used[rng.integers(0, len(docs), 120)] = True
        before = list(index.neighbours(seed, used))
        index.forget(used)
        assert list(index.neighbours(seed, used)) == before


def test_ids_as_halves():
    from trackframe.llm.packing import from_halves, halves

    rows = [[], [1, 65535], [65536, 7, (1 << 32) - 1], [], [3], [1 << 20]]
    for part in (rows, rows[:2], rows[3:5], []):
        made = [halves(np.array(r, np.uint32)) for r in part]
        batch = pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], pa.binary()) for i in (0, 1)], ["ids", "high"])
        for first in range(len(part) + 1):
            ids, bounds = from_halves(batch.slice(first))
            assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == part[first:]


def test_later_rounds_count_only_what_can_be_frequent(monkeypatch):
    from trackframe.llm import tokenfile

    rng = np.random.default_rng(8)
    passage = rng.integers(0, 5000, 400)
    ids = np.concatenate([rng.integers(0, 60000, 100_000), *[passage] * 30]).astype(np.uint32)
    counted, sort = [], np.sort
    monkeypatch.setattr(tokenfile.np, "sort", lambda x, *a, **k: (counted.append(len(x)) or sort(x, *a, **k)))
    symbols, rules, lengths = repair(ids)
    monkeypatch.undo()
    assert (expand(symbols, rules, lengths) == ids).all() and lengths.max() > 30
    assert len(counted) > 5 and sum(counted[1:]) < len(ids)  # a hundred thousand single pairs are counted once


def test_pieces_of_equal_hash(whole, monkeypatch):
    from trackframe.llm import tokens

    # Every hash meets others: pieces are told apart by their bytes, also when they are looked up again.
    monkeypatch.setattr(tokens, "span_hash", lambda prefix, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(3))
    rng = random.Random(9)
    for keep in (40, 10_000):
        encoder = Encoder(PATH, keep)
        for part in [[sentence(rng, 30) for _ in range(3)] for _ in range(4)] * 2:
            ids, bounds = encoder.encode(*utf8(pa.array(part, pa.large_string())))
            for i, t in enumerate(part):
                assert ids[bounds[i]:bounds[i + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids


def test_simple_texts_go_together(whole, monkeypatch):
    calls, plain = [], Encoder._encode
    monkeypatch.setattr(Encoder, "_encode", lambda self, offsets, data: calls.append(len(offsets) - 1) or plain(self, offsets, data))
    texts = ["one two", "", "\u65e5\u672c two", "two  three's", "caf\u00e9", "a <|endoftext|> b", "one"]
    ids, bounds = Encoder(PATH).encode(*utf8(pa.array(texts, pa.large_string())))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert calls == [5]


def test_packing_encodes_simple_texts_together(whole, monkeypatch):
    from trackframe.llm import packing

    calls, plain, held = [], Encoder._encode, []
    monkeypatch.setattr(Encoder, "_encode", lambda self, offsets, data: calls.append(len(offsets) - 1) or plain(self, offsets, data))
    monkeypatch.setattr(packing, "map_batches", lambda df, run, schema: held.append(run))
    texts = ["one two", None, "\u65e5\u672c", "two three", "four"]

    class Docs:
        schema = {"doc_id": type("Field", (), {"dataType": type("Kind", (), {"simpleString": lambda self: "bigint"})()})()}
    packing.encoded(Docs(), PATH, pieces=777)
    batch = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    rows = next(held[0](iter([batch])))
    ids, bounds = packing.from_halves(rows)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [whole.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    assert calls == [4]
