from __future__ import annotations

import base64
import gzip
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from provgraph.llm import packing, warc
from provgraph.llm.common import LOWER_TABLE
from provgraph.llm.packing import encoder, pack, pack_lengths
from provgraph.llm.warc import from_record, ranges, read_warc, to_record, write_warc

from .helpers import clashing_frame, docs_frame, words
from .test_exact_mixing_url import _targets

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("text", [
    "", " ", "a", " a", "a  b", "a \n b", "it's 12 o'clock, isn't it?", "été über ñandú", "x\ty\r\nz", "a\u00a0b c", "tail ", "\n\nhead", "ab\ncd ef", "a\x1cb c", "日本 語 😀 ok",
    "<|endoftext|> a b", "don't we'll" * 50,
])
def test_encoder_equals_the_tokenizer(text):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    assert encoder(PATH)(text).tolist() == tok.encode(text, add_special_tokens=False).ids


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "x\n<|endoftext|>\n", "<|endoftext|", "é  <|endoftext|>  <|ENDOFTEXT|>"]


def test_added_tokens_in_text_have_their_ids(spark):
    tok = Tokenizer.from_file(PATH)
    want = [tok.encode(t, add_special_tokens=False).ids for t in ADDED]
    assert want[0] == [64, 220, 50256, 275]
    assert [encoder(PATH, added_tokens=True)(t).tolist() for t in ADDED] == want
    got: dict = {}
    for r in sorted(pack(docs_frame(spark, list(enumerate(ADDED))), PATH, with_ids=True).collect(), key=lambda r: r.start):
        got.setdefault(r.doc_id, []).extend(r.ids)
    assert [got[i] for i in range(len(ADDED))] == [w + [1] for w in want]


def test_other_vocabularies_are_encoded_by_their_own_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert encoder(path)("Hello, wörld").tolist() == Tokenizer.from_file(path).encode("Hello, wörld", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_pack_lengths_hold_every_token_once(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 5, 100, 256, 300, 1000, 2048, 2049, 9000]) + rng.randrange(3) for _ in range(rng.choice([1, 3, 200]))]
    out = pack_lengths(lengths, [256, 512, 1024, 2048], 4)
    seen = [np.zeros(n, int) for n in lengths]
    load = [0] * 4
    for size, group, pieces in out:
        assert size & (size - 1) == 0 and size <= 2048 and sum(n for _, _, n in pieces) == size
        load[group] += size
        for doc, start, n in pieces:
            seen[doc][start : start + n] += 1
    assert all((s == 1).all() for s in seen)
    assert max(load) - min(load) <= 2048


def test_pack_round_trip(spark, monkeypatch):
    rng = random.Random(3)
    data = [(i, " ".join(words(rng, rng.choice([3, 50, 400, 3000])))) for i in range(60)] + [(70, None), (71, ""), (None, "null id"), (5, "again")]
    monkeypatch.setattr(packing, "BATCH_TOKENS", 20_000)
    got = pack(clashing_frame(spark, data).repartition(2), PATH, with_ids=True).collect()
    tok = Tokenizer.from_file(PATH)
    by: dict = {}
    for r in got:
        by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    for i, t in data:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        pieces = sorted(by[i, len(ids)], key=lambda r: r.start)
        assert sum((r.ids for r in pieces), []) == ids and [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
    seqs: dict = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append(r)
    for rs in seqs.values():
        rs.sort(key=lambda r: r.offset)
        assert [r.offset for r in rs] == np.cumsum([0, *(r.length for r in rs)])[:-1].tolist()
        assert sum(r.length for r in rs) == rs[0].tier and rs[0].tier & (rs[0].tier - 1) == 0
    assert pack(docs_frame(spark, []), PATH).count() == 0


def test_ranges_coalesce_neighbours():
    assert ranges([(0, 10), (10, 5), (20, 5), (200_000, 7)]) == [(0, 25), (200_000, 7)]
    big = warc.SPAN
    assert ranges([(0, big), (big, 5)]) == [(0, big), (big, 5)]
    assert ranges([]) == []


def test_record_round_trip():
    fields, body = from_record(to_record(7, "http://x/%0A\r\ny", b"a\r\n\r\nb", None, False))
    assert body == b"a\r\n\r\nb" and warc.page_of(fields["WARC-Record-ID"]) == 7 and warc._unescaped(fields["WARC-Target-URI"]) == "http://x/%0A\r\ny"
    fields, body = from_record(to_record(-3, None, b"zz", 9, True))
    assert body == b"" and warc.page_of(fields["WARC-Refers-To"]) == 9 and warc.page_of(fields["WARC-Record-ID"]) == -3


def test_warc_archives_round_trip(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    data = [(i, f"http://h/{i}", f"<p>{i % 40} é</p>" * (1 + i % 5)) for i in range(300)]
    data += [(400, None, None), (401, "u", ""), (None, "n", "only null"), (402, "r", "same"), (402, "r", "same"), (500, "l", "long" * 100_000), (None, "n2", "<p>0 é</p>")]
    pages = spark.createDataFrame([(*r, "x") for r in data], "page_id long, url string, html string, _sha string").repartition(4)
    index = write_warc(pages, str(tmp_path / "arc"))
    want = []
    groups: dict = {}
    for i, _, h in data:
        groups.setdefault(h or "", []).append(i)
    for i, url, h in data:
        keeper = max((x for x in groups[h or ""] if x is not None), default=None)
        again = keeper is not None and i != keeper
        b = (h or "").encode()
        want.append((i, url, None if again else b, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", keeper if again else None))
    got = [(r[0], r[1], None if r[2] is None else bytes(r[2]), *r[3:]) for r in read_warc(index).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    # A selection is read by ranges alone; the archives are plain gzip members.
    some = read_warc(index.where("record_type = 'response' and url like '%7'")).collect()
    assert {r.url for r in some} == {w[1] for w in want if w[5] == "response" and w[1] and w[1].endswith("7")}
    files = sorted((tmp_path / "arc").iterdir())
    assert len(files) > 4 and all(gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\n") for f in files)
    assert read_warc(write_warc(pages.limit(0), str(tmp_path / "none"))).count() == 0


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(2)
    data, labels = [], []
    for i in range(400):
        w = words(rng, 60)
        if i % 8 == 0:
            w[5:40:6] = ["nasty", "vile", "rotten", "nasty", "vile", "rotten"]
        data.append((i, " ".join(w), f"s{i % 4}"))
        labels.append((i, 1, int(i % 8 == 0)))
    for k in range(20):  # copies and near copies of clean documents
        t = data[8 * k + 3][1]
        data.append((1000 + k, t.upper(), "s1"))
        data.append((2000 + k, t + " tail", "s2"))
    data += [(3000, None, None), (3001, "", "s1")]
    sf = str(tmp_path)
    docs_frame(spark, data).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = {None: {r.doc_id for r in docs.collect()}}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        path = f"{sf}/stage{n}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        ids[name] = [r.doc_id for r in docs.collect()]
    gone = ids[None] - set(ids["toxicity"])
    assert gone <= set(range(0, 400, 8)) and len(gone) >= 40
    assert set(ids["toxicity"]) - set(ids["exact_dedup"]) == {8 * k + 3 for k in range(20)} | {3000}
    assert set(ids["exact_dedup"]) - set(ids["near_dedup"]) == {2000 + k for k in range(20)}
    assert set(ids["mixing"]) <= set(ids["near_dedup"]) and len(ids["mixing"]) > 0.9 * len(ids["near_dedup"])
    assert set(ids["packing"]) == set(ids["mixing"])
    run = corpus_pipeline.run(spark, sf)
    assert run.count() > 0 and "ids" in run.columns


def _unique(kept):
    """Plain exact and near dedup of {id: (text, source)}."""
    low = {i: (t or "").encode().translate(LOWER_TABLE) for i, (t, _) in kept.items()}
    last = {low[i]: i for i in sorted(kept)}
    kept = {i: x for i, x in kept.items() if last[low[i]] == i}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if (w := low[i].split()) else set() for i in kept}
    first = {i: i for i in kept}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in kept:
        before = dict(first)
        for a, b in links:
            first[a] = first[b] = min(first[a], first[b])
        if first == before:
            break
    return {i: x for i, x in kept.items() if first[i] == i}


def _copies(kept):
    """Plain copies of each document of {id: (text, source)}."""
    size = {i: len((t or "").split()) for i, (t, _) in kept.items()}
    of: dict = {}
    for i, (_, source) in kept.items():
        of.setdefault(source, []).append(i)
    sizes = {s: sum(size[i] for i in ids) for s, ids in of.items()}
    targets = _targets(sizes)
    draw = lambda i, seed: int(hashlib.md5(f"{i}:{seed // 4}".encode()).hexdigest()[seed % 4 * 8 :][:8], 16) / 2**32
    out = {}
    for s, ids in of.items():
        rate = targets[s] / sizes[s] if sizes[s] else 0.0
        whole, part = int(rate), rate - int(rate)
        seed = min(range(32), key=lambda k: (abs(whole * sizes[s] + sum(size[i] for i in ids if draw(i, k) < part) - targets[s]), k))
        out |= {i: whole + (draw(i, seed) < part) for i in ids}
    return out


def test_pipeline_rows_match_plain_python(spark, tmp_path):
    rng = random.Random(12)
    data, labels = [], []
    for i in range(160):
        w = words(rng, rng.choice([20, 60, 700]))
        if i % 8 == 0:
            w[5:19:2] = ["nasty", "vile", "rotten", "nasty", "vile", "rotten", "vile"]
        data.append((i, " ".join(w), [None, "b", "é", "a", "Z"][i % 5]))
        labels.append((i, 1, int(i % 8 == 0)))
    for k in range(10):  # copies, near copies and texts that are not near enough
        t = data[8 * k + 3][1]
        data += [(1000 + k, t.upper(), "b"), (2000 + k, t + " tail", "a"), (2100 + k, t + " " + " ".join(words(rng, len(t.split()) // 3)), "a")]
    data += [(3000, None, None), (3001, "", "b"), (3002, "x <|endoftext|> y", "b")]
    sf = str(tmp_path)
    docs_frame(spark, data).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    clean = {r.doc_id for r in corpus_pipeline.toxicity(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).collect()}
    kept = _unique({i: (t, s) for i, t, s in data if i in clean})
    assert {2100 + k for k in range(10)} <= set(kept) and not {2000 + k for k in range(10)} & set(kept)
    copies = _copies(kept)
    assert set(copies.values()) >= {0, 1, 2}
    tok = Tokenizer.from_file(PATH)
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, (t, _) in kept.items()}
    got = corpus_pipeline.run(spark, sf).collect()
    # Copies may be cut at different places: every piece is checked, and every token occurs once a copy.
    seen = {i: np.zeros(len(ids[i]), int) for i in kept}
    for r in got:
        assert list(r.ids) == ids[r.doc_id][r.start : r.start + r.length] and r.doc_tokens == len(ids[r.doc_id])
        seen[r.doc_id][r.start : r.start + r.length] += 1
    assert all((seen[i] == copies[i]).all() for i in kept)
