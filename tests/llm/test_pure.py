"""The parts that run inside tasks, against plain versions."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import bpe, html_extract, langid, merkle, ngram_join, secrets, suffix_dedup, warc


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference_codec():
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", " ", "a ", " a", "a\n b", "a \n b", "x\n \ny", "foo   bar", "a  b", "tail\n ", "a b c", "it's 'll x's", "a\x1cb  \x85 c",
         "12３４ ñ€😀 don't", " \x00\x01", "ab" * 4000, "<|endoftext|> x", "über-straße, naïve; co-op."]


def test_bpe_equals_tiktoken(codec, reference_codec):
    for text in TEXTS:
        packed = codec.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == reference_codec.encode_ordinary(text), text[:30]
        assert codec.decode(packed) == text.encode()
    assert codec.encode(None) == b""


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_bpe_property(codec, reference_codec, text):
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == reference_codec.encode_ordinary(text)


def test_perfect_hash_is_minimal():
    keys = [b"k%d" % i for i in range(2000)]
    index = bpe.PerfectHash(keys)
    assert [index.get(k) for k in keys] == list(range(2000)) and sorted(index.slots) == list(range(2000))
    assert index.get(b"other") == -1 and bpe.PerfectHash([]).get(b"x") == -1


def test_merge_keeps_shared_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(200):
        strings = [bytes(rng.integers(97, 99, rng.integers(0, 12)).astype(np.uint8)) for _ in range(rng.integers(0, 40))]
        k = int(rng.integers(1, 6))
        got = list(suffix_dedup.merge([suffix_dedup.front_coded([(s, b"p") for s in strings[i::k]]) for i in range(k)]))
        assert [s for _, s, _ in got] == sorted(strings)
        for (_, before, _), (same, s, _) in zip(got, got[1:]):
            assert same == suffix_dedup.shared(before, s)


def test_anchor_kinds_do_not_depend_on_batches():
    rng = np.random.default_rng(0)
    for _ in range(500):
        n = int(rng.integers(1, 30))
        g, a = rng.integers(0, 4, n), rng.integers(0, 3, n) * 10
        order = np.lexsort((a, g))
        g, a, rid, pos = g[order], a[order], np.arange(n) + 100, np.arange(n)
        held, out, i = [np.empty(0, np.int64)] * 4, [], 0
        while i < n:
            k = int(rng.integers(1, 5))
            held, chosen = suffix_dedup.met_kinds(*[np.concatenate((h, c[i:i + k])) for h, c in zip(held, (g, a, rid, pos))], False)
            out += zip(*map(list, chosen))
            i += k
        out += zip(*map(list, suffix_dedup.met_kinds(*held, True)[1]))
        runs = Counter(zip(g.tolist(), a.tolist()))
        groups, first, want = Counter(x for x, _ in runs), set(), []
        for x, y, r, p in zip(g.tolist(), a.tolist(), rid, pos):
            if runs[x, y] > 1:
                want.append((r, p, 2 if groups[x] > 1 and (x, y) not in first else 1))
            elif groups[x] > 1:
                want.append((r, p, 0))
            first.add((x, y))
        assert sorted(out) == sorted(want)


def test_arc_versions_and_revisits():
    body = b"HTTP/1.1 200 OK\r\nX-Archive-Key: 5\r\nContent-Length: 3\r\n\r\nabc"
    for version in (1, 2):
        data = warc.arc_head(version, "x.arc") + warc.arc_record(version, "http://a/b c", "text/html", body) + warc.arc_record(
            version, None, "text/html", b"\n\nraw\n")
        head, one, two = warc.parse_arc(data)
        assert head["URL"] == "filedesc://x.arc" and one["URL"] == "http://a/b%20c" and one["content"] == body and two["content"] == b"\n\nraw\n"
        kinds = [warc.header(h, "WARC-Type") for r in (head, one, two) for h, _ in warc.parse_warc(warc.warc_record(r))]
        assert kinds == ["warcinfo", "response", "resource"]
        (h, block), = warc.parse_warc(warc.warc_record(one, ("4", "<urn:x>")))
        assert warc.header(h, "WARC-Type") == "revisit" and warc.header(h, "WARC-Refers-To") == "<urn:x>" and block.endswith(b"\r\n\r\n")
        assert warc.header(h, "WARC-Payload-Digest") == "sha1:" + warc.digest(b"abc")
    assert warc.iso("2001") == "2001-01-01T00:00:00Z" and warc.iso("20240229123456") == "2024-02-29T12:34:56Z"
    with pytest.raises(ValueError):
        list(warc.parse_arc(warc.arc_head(1, "x")[:-9]))


def test_html_layouts_and_broken_markup():
    model = html_extract.train(html_extract.LABELLED)
    page = """<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Menu</a></nav><header>Site head</header>
    <div class="cookie-notice"><p>We use cookies on this page.</p></div><article><h1>A &amp; B</h1><p>One  two<br>three <b>four</b>.<p>Next one, with more words in it.
    <script>var x = "</p>";</script><ul><li>item a<li>item b</ul><section class="comments"><p>First comment by a reader.</p></section></article>
    <aside class="sidebar"><p>Other things to read.</p></aside><footer>&copy; us</footer></body></html>"""
    assert model.extract(page) == "A & B\n\nOne two three four.\n\nNext one, with more words in it.\n\nitem a\n\nitem b"
    assert model.extract(None) == model.extract("") == ""
    for odd in ("<", "<p", "<div><p>a<p>b</div>", "</p></div>", "<b>" * 3000, "<div>" * 3000 + "x", "<table><tr><td>a<td>b</table>"):
        model.extract(odd)


def test_sum_product_equals_enumeration():
    import itertools
    import math
    nodes, _ = html_extract.parse("<body><div><p>a</p><p>b</p></div><div>c</div></body>")
    rng = np.random.default_rng(1)
    scores, edges = rng.normal(size=len(nodes)).tolist(), rng.normal(size=(len(nodes), 4)).tolist()
    weight = {}
    for labels in itertools.product((0, 1), repeat=len(nodes)):
        weight[labels] = math.exp(sum(s * y for s, y in zip(scores, labels)) + sum(
            edges[i][2 * labels[nodes[i].parent] + labels[i]] for i in range(1, len(nodes))))
    total = sum(weight.values())
    want = [sum(w for y, w in weight.items() if y[i]) / total for i in range(len(nodes))]
    assert np.allclose(html_extract.marginals(nodes, scores, edges), want)


def test_profile_table_is_cosine_of_bundles():
    train = {"x": "the cat sat on the mat", "y": "der hund und die katze über"}
    counts = np.stack([np.bincount(langid.trigrams(t), minlength=langid.SYMBOLS**3) for t in train.values()]).astype(np.float32)
    table = langid.profile_table(counts, width=256)
    text = "the hund sat"
    doc, protos = langid.hypervector(text, 256), [langid.hypervector(t, 256) for t in train.values()]
    want = [doc @ p / np.linalg.norm(p) for p in protos]
    assert np.allclose(table[langid.trigrams(text)].sum(axis=0), want, rtol=1e-3, atol=1e-2)


def test_merkle_trees():
    text = "One. Two.\nThree. Four.\n\nFive."
    assert merkle.fingerprint(text) == merkle.fingerprint(text) != merkle.fingerprint(text + " ")
    assert merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(text)) == 1 and merkle.differing(text, text) == []
    changed = merkle.differing(text, text.replace("Four", "4"))
    assert len(changed) == 1
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint(text)) == 0 and merkle.fingerprint(None) == merkle.fingerprint("")


def test_secret_spans():
    random = "q7Zk2LwX9vB4nT6yR1mC8sD3fG5hJ0pA"
    text = f"password = hunter22 token=a AKIA{'A1' * 8} x {'0a' * 12} the credential is {random} ok, secret place: somewhere"
    kinds = [secrets.KINDS[k] for _, k, _ in secrets.scan(text)]
    assert kinds == ["assign", "access", "hex", "novel"]
    assert [text[s:e] for s, k, e in secrets.scan(text) if k == 3] == [random]
    plain = "the authorization of the organisation was a formality_and_nothing_more than that " * 3
    assert secrets.scan(plain) == [] == secrets.scan(None) == secrets.scan("")
    assert secrets.scan("ſecret=abcdefgh") == [] and [s[1] for s in secrets.scan("SECRET:abcdefgh")] == [0]


def test_block_links_are_exact():
    rng = np.random.default_rng(2)
    base = np.arange(60, dtype=np.uint64) * np.uint64(7919)
    sets = [np.unique(np.where(rng.random(60) < 0.06, rng.integers(0, 10**9, 60).astype(np.uint64), base)) for _ in range(25)]
    sets += [np.unique(rng.integers(0, 10**9, 30).astype(np.uint64)) for _ in range(5)]

    def joined(pairs):
        parent = list(range(len(sets)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for x, y in pairs:
            parent[root(x)] = root(y)
        return [min(i for i in range(len(sets)) if root(i) == root(j)) for j in range(len(sets))]

    every = [(i, j) for i in range(len(sets)) for j in range(i) if (c := len(np.intersect1d(sets[i], sets[j]))) * 100 >= 85 * (
        len(sets[i]) + len(sets[j]) - c)]
    got = [tuple(p) for p in ngram_join.block_links(sets, [], 85, True)]
    assert set(map(frozenset, got)) <= set(map(frozenset, every)) and joined(got) == joined(every)


def test_crc_fold_is_zlibs():
    assert zlib.crc32(b"17") % 3 == zlib.crc32(str(17).encode()) % 3


def test_merkle_leaves_are_bounded():
    rng = np.random.default_rng(5)
    marks = {"words": " ", "marks": "!! ", "none": ""}
    for kind, mark in marks.items():
        for n in (200, 1000, 9000):
            one, other = (mark.join("".join(map(chr, rng.integers(97, 123, 5))) for _ in range(n // 5))[:n] for _ in range(2))
            mark_one = merkle.fingerprint(one)
            edited = merkle.likeness(mark_one, merkle.fingerprint(merkle._edited(one, other)))
            assert edited > merkle.likeness(mark_one, merkle.fingerprint(other)) and (n < 1000 or edited > 0.3), (kind, n)
            leaves = [t for _, paragraphs in merkle.tree(one)[1] for _, ls in paragraphs for _, t in ls]
            assert "".join(leaves) == one and max(map(len, leaves)) <= merkle.MOST
            middle = one[:n // 2] + "X" + one[n // 2:]  # cuts meet again behind a change
            assert len(merkle.differing(one, middle)) < 12
    han = "".join(map(chr, rng.integers(0x4E00, 0x9FA5, 2000)))
    assert merkle.likeness(merkle.fingerprint(han), merkle.fingerprint(han[:1000] + han[:1000])) > 0.3
    first, rest = (t for _, p in merkle.tree("ab cd " * 25)[1] for _, ls in p for _, t in ls)
    assert merkle.tree(first + rest)[0] != merkle.tree(first + ". " + rest)[0]


def test_html_head_and_controls_without_end_tag():
    model = html_extract.train(html_extract.LABELLED)
    article = "<article><h1>High water</h1><p>The river had risen for three days.</p><p>Nobody could remember such a spring.</p></article>"
    want = "High water\n\nThe river had risen for three days.\n\nNobody could remember such a spring."
    for page in ("<html><head><title>T</title><meta charset=utf-8><body>{}</body></html>", "<head><title>T</title>{}", "<head><link href=a><style>p{{}}</style></body>{}",
                 "<html><head><title>T</title></head><body><head>{}</body></html>", "<html><head><title>T</title></head><body>{}</body></html>",
                 "<body><div><button>Go{}</div></body>", "<body><div><select><option>A<option>B{}</div></body>", "<body><div><object data=x><param name=y>{}</div></body>",
                 "<body><button>A<button>B</button>{}</body>", "<body><form><select><option>A<input></form>{}</body>"):
        assert model.extract(page.format(article)) == want, page
    for bare in ("<head><title>T</title>Some <b>words</b>", "<head><a>Some</a> words", "<select>A<textarea></textarea>Some words"):
        nodes, blocks = html_extract.parse(bare)
        assert [t for o, t in blocks if not nodes[o].never] == ["Some words"]
    hidden = f"<body>{article}<button><div>Press</div></button><select><option>A<div>x</div></select><object><p>Old</p></object></body>"
    assert model.extract(hidden) == want
    nodes, blocks = html_extract.parse("<body>" + "<object>" * 3000 + "<p>x</p>")
    assert [not nodes[o].never for o, _ in blocks] == [True]


SNOW = "Die Bahn faehrt heute nicht, weil der Schnee auf den Gleisen liegt und niemand ihn raeumt."


@pytest.mark.parametrize("page, want", [
    ("<p>Hi.</p>", ["Hi."]),
    ("Hello there.", ["Hello there."]),
    ("<p>One.<p>Two.", ["One.", "Two."]),
    ("<a href=it's>Bob's</a> text", ["Bob's text"]),
    ("<p title=\"x>never ends", []),
    ("<footer>\u00a9 x</footer>", []),
    ("<nav><ul><li><a href=/>Menu</a></ul></nav>", []),
    ("<div class='haut'>Le site</div><div class='milieu'><a href=/>x</a></div><article><p>Une phrase seule.</p></article>", ["Une phrase seule."]),
    (f"<body><nav><a href=/>Home</a></nav><article><h1>T</h1><p>{SNOW}</p><ul><li><a href=a>Link one here</a><li><a href=b>Link two</a></ul></article></body>",
     ["T", SNOW, "Link one here", "Link two"]),
    (f"<body><article><h1>T</h1><p>{SNOW}</p></article><div>All rights reserved</div></body>", ["T", SNOW]),
    (f"<body><main><h1>Bahn</h1><p>{SNOW}</p><section><h2>Warum</h2><p>{SNOW}</p></section><section><h2>12 Comments</h2><p>Ja.</p><p>{SNOW}</p></section></main>"
     "<div>\u00a9 2020 Blatt</div></body>", ["Bahn", SNOW, "Warum", SNOW]),
    (f"<body><article><h1>B</h1><p>{SNOW}</p><p>Kurz.</p><div><h3>Replies</h3><p>{SNOW}</p></div></article></body>", ["B", SNOW, "Kurz."]),
    (f"<body><div id=a><div id=b><p>{SNOW}</p><p>{SNOW}</p><div><p>{SNOW}</p></div></div></div></body>", [SNOW] * 3),
    (f"<body><table><tr><td>{SNOW}</td><td>{SNOW}</td></tr></table></body>", [SNOW, SNOW]),
])
def test_html_plain_sparse_and_unmarked_pages(html_model, page, want):
    assert html_model.extract(page) == "\n\n".join(want)


@pytest.fixture(scope="module")
def html_model():
    return html_extract.train(html_extract.LABELLED)


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "</x>" * 100_000, "<div>" * 50_000 + "<li></li>" * 50_000, "<ul><li>" + "<div>" * 50_000 + "<li>x</li>" * 50_000,
    "<noscript>" * 100_000, "<a '" * 100_001, "<a =\"" * 100_001, "<div>" * 100_000 + "x" + "</div>" * 100_000])
def test_html_deep_and_broken_pages_take_linear_time(page):
    import time
    began = time.process_time()
    html_extract.parse(page)
    assert time.process_time() - began < 5  # a second or less on an idle machine; a quadratic search takes minutes


def test_html_given_pages_equal_their_articles(html_model):
    """Every page of the small table: the text of its article element, nothing else."""
    import html as _html
    import re
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column(0).to_pylist()
    assert len(pages) > 100
    for page in pages:
        if page is None:
            assert html_model.extract(page) == ""
            continue
        inner = page[page.index("<article>") + len("<article>"):page.index("</article>")]
        cut = re.split(r"</?(?:p|h[1-6]|div|ul|ol|li|table|tr|td|blockquote|pre)(?:\s[^>]*)?>", re.sub(r"<!--.*?-->", "", inner, flags=re.S))
        blocks = [" ".join(_html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br\s*/?>", " ", b))).split()) for b in cut]
        assert html_model.extract(page) == "\n\n".join(b for b in blocks if b)
