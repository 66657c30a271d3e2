"""Operators whose results are checked against brute force or the libraries themselves."""

import hashlib
import io
import random
import time
import zlib

import numpy as np
import pytest

from claimlake.llm import bpe_recursive, bwt_columns, fm_index, html_cut, imatch, superminhash, token_planes, windows
from claimlake.llm.queries import vocabulary

AWKWARD = "ab'sStTmdreELlvVΣσİß12 .,!\n\t\x1c\x85　ééŁ漢字Ж<|>endoftext#$%😀"


def awkward_texts(n=300):
    rng = random.Random(5)
    texts = ["".join(rng.choice(AWKWARD) for _ in range(rng.randrange(60))) for _ in range(n)]
    return [*texts, "", " ", "  ", "   a", "a   ", "a \n b", "a\n  b", "<|endoftext|> a", "x" * 3000, "xyzq" * 100]


def test_planes_hold_the_library_ids(spark, prose, docs_of):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(6)
    texts = awkward_texts() + ["".join(chr(rng.choice([rng.randrange(32, 0xD800), rng.randrange(0x10000, 0x20000), rng.randrange(32, 127)])) for _ in range(8)) for _ in range(4000)]
    texts += ["a <|endoftext|> b", "x<|startoftext|><|endoftext|>y", "<|ENDOFTEXT|>", "\u2445\U00019154", "\U00018fd8!", "\U0001df46\u2445"]
    expected = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert token_planes.Encoder(path).encode(texts) == expected

    rows = [(i, t) for i, t in prose if i is not None][:-1]
    found = {r.doc_id: r for r in token_planes.encode_and_read(docs_of(*rows), path).collect()}
    start = 0
    for key, text in sorted(rows):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (found[key].start, found[key].n_tokens, found[key].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_planes.encode_and_read(docs_of().limit(0), path).count() == 0


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_plane_files_round_trip(kind):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(0, 2**32, n, np.uint32).tobytes()) for i, n in enumerate([0, 5, 1000, 1, 0, 333])] + [(None, b"")]
    stream = io.BytesIO()
    assert token_planes.write_file(stream, rows, block_ids=64, kind=kind) == {"n_docs": 7, "n_ids": 1339}
    size = stream.getbuffer().nbytes
    assert [(k, ids.tobytes()) for k, _, ids in token_planes.read_file(stream, size)] == rows
    with pytest.raises(ValueError):
        list(token_planes.read_file(io.BytesIO(stream.getvalue()[:-3]), size - 3))


def test_recursive_bpe_equals_the_library(docs_of):
    import public_tokenizers
    import tiktoken

    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    ranks = bpe_recursive.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*awkward_texts(), None]
    rows = bpe_recursive.round_trip(docs_of(*enumerate(texts)), path, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id] or ""
        assert bytes(row.ids) == np.array(library.encode_ordinary(text), "<u4").tobytes(), repr(text)
        assert bytes(row.decoded) == text.encode() and row.n_tokens == len(row.ids) // 4


@pytest.mark.parametrize("letters, length", [("abcdefghij", 60), ("\u4e00\u4e8c\u4e09\u56db\u4e94\u516d\u4e03\u516b", 20), ("ab", 190)])
def test_many_distinct_long_words(letters, length):
    import public_tokenizers
    import tiktoken

    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_recursive.read_ranks(path), special_tokens={})
    rng = random.Random(length)
    text = " ".join("".join(rng.choice(letters) for _ in range(length)) for _ in range(20_000 if length < 100 else 1_000))
    coder = bpe_recursive.Bpe(path, public_tokenizers.PATTERN)
    found = coder.encode([text])
    assert found == [np.array(library.encode_ordinary(text), "<u4").tobytes()] and coder.decode(found) == [text.encode()]


def test_a_batch_out_of_memory_is_cut(monkeypatch):
    import public_tokenizers

    coder = bpe_recursive.Bpe(vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    words = [f"{i:x}" * 12 for i in range(3000)]
    expected = coder.encode([" ".join(words)])
    coder = bpe_recursive.Bpe(vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe_recursive, "MOST_ROWS", 1 << 60)
    coder.database.execute("SET memory_limit = '30MB'")
    assert coder.encode([" ".join(words)]) == expected


def brute_words(rows, window):
    split = {i: (t or "").encode().split() for i, t in rows if i is not None}
    counts = {}
    for words in split.values():
        for k in range(len(words) - window + 1):
            counts[tuple(words[k : k + window])] = counts.get(tuple(words[k : k + window]), 0) + 1
    out = {}
    for i, words in split.items():
        gone = set()
        for k in range(len(words) - window + 1):
            if counts[tuple(words[k : k + window])] > 1:
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), kept)
    return out


def brute_bytes(rows, window):
    out, seen = {}, set()
    for i, text in sorted({(i, t or "") for i, t in rows if i is not None}):
        raw = text.encode()
        gone = set()
        for k in range(len(raw) - window + 1):
            if raw[k : k + window] in seen:
                gone.update(range(k, k + window))
            seen.add(raw[k : k + window])
        out[i] = (len(raw), len(gone), hashlib.sha256(bytes(c for k, c in enumerate(raw) if k not in gone)).hexdigest())
    return out


@pytest.mark.parametrize("crowded", [False, True])
def test_repeated_word_windows(docs_of, prose, crowded, monkeypatch):
    if crowded:
        monkeypatch.setattr(windows.crowded_anchors, "__defaults__", (1.0, 2, 100_000, 5))
    expected = brute_words(prose, 12)
    kind = windows.Kind(windows.word_units, 12, 4, False)
    spans = windows.repeated_spans(docs_of(*prose), kind, fm_index.repeated_windows(12), 5, crowd_share=1.0 if crowded else 0.01)
    rows = fm_index.cut(docs_of(*prose), spans).collect()
    assert len(rows) == len(prose)
    for r in rows:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept_text.encode()) == expected[r.doc_id], r.doc_id
    assert sum(r.n_removed for r in rows) > 300
    assert fm_index.cut(docs_of().limit(0), fm_index.spans_of(docs_of().limit(0), 12, 4)).count() == 0


@pytest.mark.parametrize("crowded", [False, True])
def test_repeated_byte_windows(docs_of, prose, crowded, monkeypatch):
    if crowded:
        monkeypatch.setattr(windows.crowded_anchors, "__defaults__", (1.0, 2, 100_000, 5))
    expected = brute_bytes(prose, 40)
    kind = windows.Kind(windows.byte_units, 40, 10, True)
    spans = windows.repeated_spans(docs_of(*prose), kind, bwt_columns.later_windows(40), 5, crowd_share=1.0 if crowded else 0.01)
    rows = bwt_columns.cut_digests(docs_of(*prose), spans).collect()
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, r.kept_sha256) == expected[r.doc_id], r.doc_id


def test_column_wise_construction_is_the_sorted_collection():
    rng = random.Random(1)
    for _ in range(20):
        strings = [np.array([rng.randint(1, 3) for _ in range(rng.randrange(1, 20))], np.uint8) for _ in range(rng.randrange(1, 12))]
        _, prefix, owner, length = bwt_columns.construct(strings)
        suffixes = sorted((tuple(s[len(s) - n :]), i) for i, s in enumerate(strings) for n in range(len(s) + 1))
        found = [tuple(strings[o][len(strings[o]) - n :]) for o, n in zip(owner, length, strict=True)]
        assert found == [s for s, _ in suffixes]
        for k in range(1, len(found)):
            same = 0
            while same < min(len(found[k - 1]), len(found[k])) and found[k - 1][same] == found[k][same]:
                same += 1
            assert prefix[k] == same


def test_matching_statistics():
    rng = random.Random(2)
    texts = [np.array([rng.randint(1, 3) for _ in range(rng.randrange(3, 20))]) for _ in range(6)]
    index = fm_index.FmIndex(texts)
    ends = np.array([index.first[i] + k for i, t in enumerate(texts) for k in range(len(t))])
    found = iter(index.matching(ends, 6).tolist())
    for text in texts:
        for k in range(len(text)):
            best = 0
            for n in range(1, min(6, k + 1) + 1):
                gram = tuple(text[k - n + 1 : k + 1])
                if sum(tuple(t[p : p + n]) == gram for t in texts for p in range(len(t) - n + 1)) < 2:
                    break
                best = n
            assert next(found) == best


def brute_components(rows, width, percent):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()
        sets[i] = grams
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicate_components(docs_of, prose):
    keyed = [(i, t) for i, t in prose if i is not None]
    expected = brute_components(dict(keyed).items(), 4, 80)
    rows = superminhash.near_duplicates(docs_of(*prose)).collect()
    assert len(rows) == len(prose)
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (*expected[r.doc_id], expected[r.doc_id][1] == r.doc_id), r.doc_id
    assert superminhash.near_duplicates(docs_of().limit(0)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 600, np.uint64)
    for n in (3, 40, 500):
        one, two = pool[:n], pool[n // 5 : n + n // 5]
        true = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
        a, b = superminhash.signature(one, 300), superminhash.signature(two, 300)
        assert abs((a == b).mean() - true) < 0.12
        assert (a >> np.uint64(32)).max() < 300


def test_fingerprints_and_edited_texts(docs_of, prose):
    rows = sorted({(i, t or "") for i, t in prose if i is not None}, reverse=True)
    found = {r.doc_id: r for r in imatch.fingerprints(docs_of(*rows)).collect()}
    assert len(found) == len(rows)
    for k, (key, text) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + other[:cut]
        r = found[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_next <= 1 and (r.near_edited == 1 or edited != text)
    assert found[200].fingerprint == found[201].fingerprint == found[0].fingerprint and found[201].near_next == 1
    alone = imatch.fingerprints(docs_of((7, "abcdef"))).collect()
    assert [r.edited_sha256 for r in alone] == [hashlib.sha256(b"abcdab").hexdigest()]
    assert imatch.fingerprints(docs_of().limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 3, 1000, 5000, 12_500, 40_000])
def test_fingerprints_of_few_and_many_terms(n):
    texts = [" ".join(f"{side}{i}" for i in range(n)) for side in "ab"]
    lexicon = imatch.Lexicon(imatch._hashed(sorted(imatch.terms(" ".join(texts)))))
    one, other = (lexicon.fingerprint(t) for t in texts)
    assert imatch.likeness(one, one) == 1 and imatch.likeness(one, other) < 0.2
    assert all(m.startswith("all:") or m.strip("-.") for m in (one, other))
    if n >= 1000:
        assert not one.startswith("all:") and imatch.likeness(one, lexicon.fingerprint(texts[0] + " b1")) > 0.6


def test_single_terms_are_told_apart():
    words = [f"w{i}" for i in range(3000)]
    lexicon = imatch.Lexicon(imatch._hashed(words))
    assert len({lexicon.fingerprint(w) for w in words}) == len(words)


PAGE = (
    '<html><head><title>x</title></head><body><header><h1>Site</h1></header><nav><a href=x>a</a></nav><div id="content"><h1>Title here</h1>'
    "<p>This is a long sentence about things, with many words in it so that it is content.<p>Another &lt;one&gt; follows&nbsp;here &amp; ends."
    '<ul><li>one</li><li>two items</li></ul><div class="ad-box">buy</div><form><p>name</p></form></div>'
    '<div class="comments"><p>I think this is a long comment with many words in it.</p></div><aside>rel</aside><footer>c</footer><script>if(a<b){"</p>"}'
)


def test_main_text_of_pages(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "a < b"), (5, "<!-- x"), (5, "<!-- x")], "page_id long, html string")
    rows = sorted((r.page_id, r.text, r.n_chars) for r in html_cut.extract(pages).collect())
    assert rows[0][1].split("\n") == [
        "Title here", "This is a long sentence about things, with many words in it so that it is content.", "Another <one> follows here & ends.", "one", "two items",
    ]
    assert rows[1:] == [(i, "", 0) for i in (2, 3, 4, 5, 5)] and rows[0][2] == len(rows[0][1])
    assert html_cut.extract(pages.limit(0)).count() == 0


ARTICLE = "<h1>The title of it</h1>" + "<p>This is a long sentence about things, with many words in it so that it is content of the page.</p>" * 6
BESIDE = '<div class="sidebar"><p>Some links and words that stand beside.</p></div><footer><p>All rights are reserved by us.</p></footer>'


@pytest.mark.parametrize("wrapper", [
    "<div class='layout-with-sidebar'><article>{}</article>{}</div>", "<div class='layout-with-sidebar'>{}{}</div>",
    "<div id='content-sidebar-wrap'><div class='content'>{}</div>{}</div>", "<main class='has-comments'>{}</main>{}",
    "<form action='x'><div>{}</div>{}</form>", "<form><main>{}</main>{}</form>", "<article class='post has-comments'>{}</article>{}",
    "<div class='promo'><article>{}</article></div><div id='content'><p>Short.</p></div>{}",
])
def test_badly_named_wrappers_keep_their_article(wrapper):
    text = html_cut.main_text("<html><body><nav><a href=x>Home of it</a></nav>" + wrapper.format(ARTICLE, BESIDE) + "</body></html>")
    neutral = html_cut.main_text("<html><body><nav><a href=x>Home of it</a></nav><div>" + ARTICLE + BESIDE + "</div></body></html>")
    assert text.count("This is a long sentence") == neutral.count("This is a long sentence") == 6
    assert "The title of it" in text or "The title of it" not in neutral
    assert "beside" not in text and "reserved" not in text and "Home" not in text


def test_long_comments_beside_an_article_are_left_out():
    page = "<div id='content'>" + ARTICLE + "</div><div class='comments'>" + "<div class='comment-body'><p>" + "I think so too. " * 90 + "</p></div></div><aside><article><p>Other things entirely.</p></article></aside>"
    text = html_cut.main_text(page)
    assert text.count("This is a long sentence") == 6 and "I think" not in text and "Other" not in text


def test_minimum_cut_is_the_cheapest():
    rng = random.Random(4)
    for _ in range(30):
        n = rng.randint(2, 7)
        source, sink = [rng.randint(0, 5) for _ in range(n)], [rng.randint(0, 5) for _ in range(n)]
        edges = [(a, b, rng.randint(1, 4)) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(kept):
            return sum(sink[i] if i in kept else source[i] for i in range(n)) + sum(c for a, b, c in edges if (a in kept) != (b in kept))

        best = min(cost({i for i in range(n) if mask >> i & 1}) for mask in range(2**n))
        assert cost(html_cut.minimum_cut(source, sink, edges)) == pytest.approx(best)


def test_quotes_begin_values_only_behind_an_equals_sign():
    one, two = "A long sentence is here, with many words in it so that it counts.", "It's another one, \"quoted\" at some length, which counts as well."
    for page in (f"<p title=don't>{one}<p>{two}", f"<p title=a\"b data-x = 'c>d'>{one}</p><p it's>{two}</p>", f"<p href=?a=\"b>{one}</p><p title=\"x>y\">{two}</p>"):
        assert html_cut.main_text(page) == f"{one}\n{two}"
    assert html_cut.main_text(f"<p>{one}</p><svg/><p>{two}</p><p>3 < 4 and so on, which is text as well as all the rest.</p>").count("\n") == 2
    assert html_cut.main_text(f"<p>{one} a <b and no end of it") == f"{one} a <b and no end of it"


def test_a_flow_of_several_phases_is_the_cheapest_cut():
    rng = random.Random(9)
    for _ in range(40):
        n = 9
        source, sink = [rng.choice([0, 0, 1, 3]) for _ in range(n)], [rng.choice([0, 0, 1, 3]) for _ in range(n)]
        edges = [(i, i + 1, rng.randint(1, 5)) for i in range(n - 1)] + [(i, rng.randrange(n), 2) for i in range(0, n, 3)]
        edges = [(a, b, c) for a, b, c in edges if a != b]

        def cost(kept):
            return sum(sink[i] if i in kept else source[i] for i in range(n)) + sum(c for a, b, c in edges if (a in kept) != (b in kept))

        every = [{i for i in range(n) if mask >> i & 1} for mask in range(2**n)]
        best = min(map(cost, every))
        assert html_cut.minimum_cut(source, sink, edges) == set.intersection(*[k for k in every if cost(k) == best])


@pytest.mark.parametrize("page", [
    "<p>Some words of a paragraph, ten or more of them here.</p><li><a href=x>three linked words</a></li>" * 25_000, "<div>" * 40_000 + "</span>" * 40_000,
    "<a b " * 50_000, '<a b="' * 50_001 + ">", "<script " * 50_000, "<!" * 50_000, "<div><p>word </div>" * 25_000,
], ids=["blocks", "deep", "tags", "quotes", "scripts", "declarations", "unclosed"])
def test_long_pages_take_seconds(page):
    began = time.perf_counter()
    html_cut.main_text(page)
    assert time.perf_counter() - began < 20
