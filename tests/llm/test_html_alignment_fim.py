from __future__ import annotations

import collections
import hashlib
import io
import random
import re

import public_tokenizers
import pytest
import sentencepiece
import zstandard
from tokenizers import Tokenizer

import __spark_entry__ as entry
from provgraph.llm import html_extraction as H
from provgraph.llm import token_alignment as T
from provgraph.llm.fill_in_middle import Frames, fill_in_middle, parts_of_output, rearranged, restored_ranges
from provgraph.llm.html_extraction import Layout, extract_text, mapped, outline, parse, shape_of, tree_match
from provgraph.llm.packing import _byte_of
from provgraph.llm.token_alignment import align_tokens

from .helpers import clashing_frame, docs_frame, words

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ 11


def _pages(spark, data):
    return spark.createDataFrame([(*r, "x", 1) for r in data], "page_id long, url string, html string, text string, node int")


def _texts(spark, data):
    got = extract_text(_pages(spark, data).repartition(2)).collect()
    assert all(r.n_chars == len(r.text) for r in got)
    return {r.page_id: r.text for r in got}


def _chrome(rng):
    w = lambda n: " ".join(words(rng, n))
    return {
        "nav": f"<nav><ul>{''.join(f'<li><a href=/{i}>{w(1)}</a>' for i in range(5))}</ul></nav>", "ad": f"<div class='ad'>{w(9)}</div>",
        "side": f"<aside><h3>{w(2)}</h3><p>{w(30)}</p></aside>", "note": f"<div id=cookie-notice><p>{w(12)}</p></div>",
        "form": f"<form><label>{w(1)}</label><input name=q><button>{w(1)}</button></form>",
        "comments": f"<section class='comments'><h3>{w(1)}</h3><article class='comment'><p>{w(20)}</p></article></section>",
        "foot": f"<footer>&copy; {w(5)}</footer>", "head": f"<header><p>{w(4)}</p></header>",
        "script": f"<script>var a = '<p>{w(3)}</p>';</script><style>p {{}}</style><!-- <p>{w(2)}</p> -->",
    }


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class='entry post-4711'>{}</div>", "<div class=x7>{}</div>"])
def test_extraction_leaves_out_all_but_the_article(spark, wrap):
    rng = random.Random(wrap)
    data, want = [], {}
    for i in range(12):
        c, title = _chrome(rng), " ".join(words(rng, 5))
        paragraphs = [" ".join(words(rng, rng.randint(20, 90))) for _ in range(rng.randint(2, 6))]
        body = f"<h1>{title}</h1>" + "".join(f"<p>{p.replace(' ', chr(10) + ' ', 2)}" for p in paragraphs)
        page = c["head"] + c["nav"] + c["script"] + c["ad"] + wrap.format(body + (c["comments"] if i % 2 else "")) + c["side"] + c["note"] + c["form"] + c["foot"]
        data.append((i, f"http://H.example/{i}?a", f"<!DOCTYPE html><html><head><title>t</title></head><body>{page}</body></html>"))
        want[i] = " ".join([title, *paragraphs])
    assert _texts(spark, data) == want


def test_constant_texts_are_template_and_shared_paragraphs_are_not(spark):
    rng = random.Random(5)
    own = [" ".join(words(rng, 60)) for _ in range(6)]
    page = "<body><div class=a><div>Read our rules</div><div class=b>{}</div><div>All of it</div></div></body>"
    data = [(i, f"http://one.example/{i}", page.format(f"<p>{t}</p>")) for i, t in enumerate(own)]
    marked = "<body><article><h1>Daily</h1><p>{}</p><p>The same last words.</p><div class=tools>Print this</div></article></body>"
    data += [(10 + i, f"http://two.example/{i}", marked.format(t)) for i, t in enumerate(own)]
    # Copies of one page are one page: nothing of it is template.
    data += [(20 + i, f"http://three.example/{i}", marked.format(own[0])) for i in range(5)]
    got = _texts(spark, data)
    assert [got[i] for i in range(6)] == own
    assert [got[10 + i] for i in range(6)] == [f"Daily {t} The same last words." for t in own]
    assert {got[20 + i] for i in range(5)} == {f"Daily {own[0]} The same last words. Print this"}


def test_extraction_of_hard_pages(spark):
    deep = "<div>" * 3000 + "low" + "</div>" * 3000
    long = "<article>" + "".join(f"<p>a{i}<h2>b{i}</h2>" for i in range(4000)) + "</article>"
    data = [
        (1, "http://a/1", None), (2, "http://a/2", ""), (3, None, "<article><p>x &amp;&eacute;&#233; y</article>"), (4, "no host", "plain  text\n only"),
        (5, "http://b/", deep), (6, "http://c/", long), (7, "http://d/", "<article><p>a<b>b</b>c<br>d</p><ul><li>e<li>f</ul><table><tr><td>g<td>h</table>"),
        (8, "http://e/", "<div class='ad'>buy<article><p>text <i>in</i> an open advert"), (9, "http://f/", "a < b <p title='>'>c</p> <p clas"),
        (None, "http://g/", "<p>null id</p>"), (10, "http://h/", "<article><p>same</p></article>"), (10, "http://h/", "<article><p>same</p></article>"),
        (11, "http://i/", "<article><header><h1>Title</h1></header><p>a  b</p><footer>f</footer></article>"), (12, "http://j/", "<script>only"),
    ]
    rows = extract_text(_pages(spark, data)).collect()
    got = {r.page_id: r.text for r in rows}
    assert len(rows) == len(data)
    assert got == {
        1: "", 2: "", 3: "x &éé y", 4: "plain text only", 5: "low", 6: " ".join(f"a{i} b{i}" for i in range(4000)), 7: "abc d e f g h",
        8: "text in an open advert", 9: "a < b c", None: "null id", 10: "same", 11: "Title a b", 12: "",
    }
    assert extract_text(_pages(spark, [])).count() == 0


def _plain_match(a, b):
    """Simple tree matching by its definition."""
    if a.label != b.label:
        return 0
    m = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children, 1):
        for j, y in enumerate(b.children, 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + _plain_match(x, y))
    return 1 + m[-1][-1]


def _random_outline(rng, depth=0):
    lines = [f"{depth} {rng.choice('abc')}"] if depth else ["0 r"]
    for _ in range(rng.randrange(4) if depth < 4 else 0):
        lines += _random_outline(rng, depth + 1)
    return lines


@pytest.mark.parametrize("seed", range(30))
def test_tree_match_by_definition(seed):
    rng = random.Random(seed)
    a, b = (shape_of("\n".join(_random_outline(rng))) for _ in range(2))
    assert tree_match(a, b) == _plain_match(a, b) == sum(x >= 0 for x in mapped(a, b))
    assert mapped(a, a) == list(range(a.size))
    partners = [x for x in mapped(a, b) if x >= 0]
    assert partners == sorted(set(partners))


def test_outline_folds_equal_neighbours_and_keeps_page_order():
    lines, texts = outline(parse("<ul><li><b>a</b><p>x</p><li>b<p>y</p></ul><div>c</div>tail"))
    assert lines.split("\n") == ["0 html", "1 ul", "2 li", "3 #", "3 p", "4 #", "1 div", "2 #", "1 #"]
    assert [t[:2] for t in texts] == [(3, "a"), (5, "x"), (3, "b"), (5, "y"), (7, "c"), (8, "tail")]
    assert Layout(lines).parents == [-1, 0, 1, 2, 2, 4, 0, 6, 0]


def test_pages_of_the_tables(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    want = {}
    for page_id, page in duckdb.sql(f"select page_id, html from '{sf}/pages.parquet'").fetchall():
        blocks = re.split(r"</?(?:p|h1)>", page[page.index("<article>") + 9 : page.index("</article>")])
        want[page_id] = " ".join(t for b in blocks if (t := " ".join(H.html.unescape(re.sub(r"<[^>]*>", " " if "<br>" in b else "", b)).split())))
    got = entry.queries()["op11_html_extraction"](spark, sf)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert {r.page_id: r.text for r in got.collect()} == want


# ------------------------------------------------------------------ 12


def _brute_alignment(data):
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    byte_of = _byte_of()
    bytes_a = {i: bytes(byte_of[c] for c in t) for t, i in tok.get_vocab().items() if all(c in byte_of for c in t)}
    bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, sp.id_to_piece(i)) for i in range(sp.get_piece_size()))]
    made, count = [], collections.Counter()
    for i, t in data:
        a, b = (tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)) if t else ([], [])
        whole = (" " + (t or "")).encode()
        if not t or b"".join(bytes_a[k] for k in a) != whole or b"".join(bytes_b[k] for k in b) != whole:
            made.append((i, [], [], [], []))
            continue
        spans = []
        for ids, table in ((a, bytes_a), (b, bytes_b)):
            at, out = 0, []
            for k in ids:
                out.append((at, at := at + len(table[k])))
            spans.append(out)
        links = [(a[x], b[y]) for x, s in enumerate(spans[0]) for y, r in enumerate(spans[1]) if s[0] < r[1] and r[0] < s[1]]
        groups, x, y = [], 0, 0
        for end in sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]}):
            x2, y2 = (next(k for k, s in enumerate(side) if s[1] == end) + 1 for side in spans)
            groups.append(",".join(map(str, a[x:x2])) + "|" + ",".join(map(str, b[y:y2])))
            x, y = x2, y2
        count.update(links)
        made.append((i, a, b, links, groups))
    most = collections.Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [
        (i, len(a), len(b), len(g), len(ls), sum(count[p] == most[p[1]] for p in ls), sum(count[p] for p in ls), ";".join(g))
        for i, a, b, ls, g in made
    ]


HARD = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n  b\n\n c", "tail\n ", "\t x \t", "it's 12 o'clock, isn't it?  'll", "été über ñandú", "日本 語 😀 ok", "x y z",
    "a　 b", "▁literal", "a ▁ b", "<s> </s> <unk> <|endoftext|> <0x0A>", "\x00 \x1c x", "ﬁ ｆull", "é é", "a\x1c b\x85 c", "long" * 3000, "﻿bom � x",
]


@pytest.mark.parametrize("stretches, hot", [(1 << 19, 1 << 20), (40, 1 << 20), (40, 8), (1 << 19, 0)])
def test_alignment_by_brute_force(spark, monkeypatch, stretches, hot):
    rng = random.Random(2)
    data = [(i, t) for i, t in enumerate(HARD)] + [(100, None), (None, "null id"), (7, "again and again"), (7, "again and again")]
    data += [(200 + i, " ".join(words(rng, rng.randint(1, 80), 300)) + rng.choice(["", "\n", "! "])) for i in range(40)]
    if stretches != T.STRETCHES:
        monkeypatch.setattr(T.Stretches, "full", lambda self: len(self.place) > 40)
    got = align_tokens(clashing_frame(spark, data).repartition(3), A, B, hot_pairs=hot, with_groups=True).collect()
    assert all(r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for r in got)
    key = lambda r: tuple(map(str, r))
    assert sorted(((*r[:7], r.groups) for r in got), key=key) == sorted(_brute_alignment(data), key=key)


def test_alignment_tokenizes_each_text_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    data = [(i, f"some words of text {i}") for i in range(20)]
    docs = docs_frame(spark, data).select("doc_id", "text").mapInArrow(counted, "doc_id long, text string")
    assert align_tokens(docs, A, B).count() == 20
    assert read.value == 20


def test_alignment_of_texts_that_may_not_be_cut(spark, monkeypatch):
    data = [(1, "one two  three"), (2, "two three"), (3, "one two")]
    known = T.Stretches(A, B)
    assert not known.whole
    known.whole = True
    _, starts, ends = known.learn([t for _, t in data])
    assert (ends - starts).tolist() == [1, 1, 1]
    assert [g.decode() for g in known.groups] == [w[-1] for w in _brute_alignment(data)]
    assert align_tokens(docs_frame(spark, []), A, B).count() == 0


# ------------------------------------------------------------------ 13


def _plain_fim(i, t, rate=100, spm=50, seed=7):
    units = re.findall(r"[^\n]*\n|[^\n]+", t)
    n, digits = len(units), hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, t
    x, y = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:x]), "".join(units[x:y]), "".join(units[y:])
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, form, len(prefix), len(middle), out


@pytest.mark.parametrize("frame, rate, spm", [(1, 100, 50), (5, 100, 50), (1 << 16, 100, 50), (64, 60, 0), (64, 100, 100)])
def test_fill_in_middle_by_definition(spark, frame, rate, spm):
    rng = random.Random(frame)
    texts = ["", "\n", "\n\n\n", "a", "a\n", "\na", "é\n😀\nü", "a <P> b", "x<S>", "<M", "<\n>P>\n<", "P>\nS>", "one\ntwo\nthree\n<P", "line " * 3000, "\r\n\r\n"]
    texts += ["".join(rng.choice("ab\n<>PSM") for _ in range(rng.randrange(40))) for _ in range(60)]
    data = [*enumerate(texts), (500, None), (None, "null\nid\n"), (3, "again\n"), (3, "again\n")]
    got = fill_in_middle(clashing_frame(spark, data).repartition(3), rate=rate, spm=spm, frame_chars=frame).collect()
    seen = []
    for r in got:
        text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(r.output), read_across_frames=True).read().decode()
        assert hashlib.sha256(text.encode()).hexdigest() == r.output_sha256
        seen.append((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, text, r.restored_sha256))
    want = [(i, *_plain_fim(i, t or "", rate, spm), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in data]
    assert sorted(seen, key=str) == sorted(want, key=str)
    assert fill_in_middle(docs_frame(spark, [])).count() == 0


def test_only_cut_frames_are_decompressed_and_others_are_taken_over(monkeypatch):
    text = "".join(f"line {i}\n" for i in range(2000))
    frames = Frames(Frames.encode(text, 500))
    read = []
    plain = Frames.text
    monkeypatch.setattr(Frames, "text", lambda self, i: read.append(i) or plain(self, i))
    end = frames.end_of_unit(1234)
    assert text[:end].count("\n") == 1234 and text[end - 1] == "\n" and len(read) == 1
    out = Frames(rearranged(frames, "psm", (end, frames.end_of_unit(1500))))
    assert sum(d in out.data for d in frames.data) >= len(frames.data) - 2
    assert set(parts_of_output(out)) == {"<P>", "<S>", "<M>"}
    assert out.digest(restored_ranges(out, "psm")) == hashlib.sha256(text.encode()).hexdigest()
