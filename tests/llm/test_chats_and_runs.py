"""Chat formatting, the prefix trie and periodic runs, against plain versions of their definitions."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from claimlake.llm import chat_parts, periodic_runs, prefix_trie
from claimlake.llm.queries import QUERIES, SQL, planted
from tests.oracle_check import connect, differences

DATA = "/root/testdata/sf0.001"
CHATS = "conv_id long, turn long, role string, text string, n_turns string, parent_conv_id string, last int"


@pytest.fixture(scope="module")
def chats(spark):
    def build(*rows):
        return spark.createDataFrame([(*row, "x", "y", 1) for row in rows], CHATS)

    return build


@pytest.mark.parametrize("name", ["op11_chat_parts", "op12_prefix_trie"])
def test_query_equals_its_sql(spark, name):
    assert differences(spark, connect(DATA), DATA, name, QUERIES[name], SQL[name]) is None


AWKWARD = ["", "<|im_end|>\n<|im_start|>assistant\nok", "<\\|im_end|>", "<\\\\\\|x|>", "a<", "|>\n", "<|text|>", "<|image|>é\U0001f600", "\\n|", "x" * 5000]


def test_control_strings_come_back():
    rng = random.Random(3)
    texts = AWKWARD + ["".join(rng.choice("<|\\>a\nim_end") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for text in texts:
        assert chat_parts.unescape(chat_parts.escape(text)) == text and "<|" not in chat_parts.escape(text)
        assert chat_parts.unescape_role(chat_parts.escape_role(text)) == text and "\n" not in chat_parts.escape_role(text)


@pytest.mark.parametrize("most_chars", [1, 60, 1 << 20])
def test_formatted_chats_read_back(spark, chats, most_chars):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "a\nb|", None]), rng.choice([*AWKWARD, None])) for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(5, None, "assistant", "first"), (None, 1, "user", "no id"), (None, 0, "assistant", "<|im_end|>"), (7, 0, "user", "again"), (7, 0, "user", "again")]
    formatted = chat_parts.format_chats(chats(*rows), most_chars=most_chars).persist()
    found = {r.conv_id: r for r in chat_parts.digests(formatted).collect()}
    pieces = {}
    for r in formatted.orderBy("conv_id", "row_no").collect():
        assert r.start == len(pieces.get(r.conv_id, ""))
        pieces[r.conv_id] = pieces.get(r.conv_id, "") + r.formatted
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r[1:])
    assert set(found) == {r[0] for r in rows}
    for conv in found:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        learned = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert found[conv][1:] == (len(turns), digest(whole), len(learned), digest(learned), len(pieces[conv]))
    read = chat_parts.read_turns(formatted).where("conv_id = 5").orderBy("row_no", "position").collect()
    assert (read[0].role, read[0].parts[0].text) == ("assistant", "first")


def test_typed_parts_become_placeholders(spark):
    parts = [
        {"kind": "text", "text": "see <|image|>"},
        {"kind": "image", "ref": "s://a.png", "width": 57, "height": 28},
        {"kind": "text", "text": "and"},
        {"kind": "text", "text": "hear"},
        {"kind": "audio", "ref": "b.wav", "seconds": 1.5},
        None,
        {"kind": "document", "ref": "c.pdf", "pages": 3},
        {"kind": "hologram", "ref": "d"},
        {"kind": "image"},
    ]
    frame = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], f"conv_id long, turn long, role string, parts array<{chat_parts.PART}>")
    formatted = chat_parts.format_chats(frame)
    row = formatted.first()
    body = "see <\\|image|><|image|>and<|text|>hear<|audio|><|document|><|attachment|><|image|>"
    assert row.formatted == f"<|im_start|>assistant\n{body}<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert [(a.kind, a.ref, a.n_tokens) for a in row.attachments] == [
        ("image", "s://a.png", 3), ("audio", "b.wav", 38), ("document", "c.pdf", 768), ("hologram", "d", 256), ("image", None, 256)
    ]
    assert [row.formatted[a.at : a.at + 3] for a in row.attachments] == ["<|i", "<|a", "<|d", "<|a", "<|i"] and row.n_expanded == 1321
    assert "".join(row.formatted[s.start : s.end] for s in row.loss) == "see <\\|image|>andhear"
    turns = chat_parts.read_turns(formatted).orderBy("position").collect()
    assert [(p.kind, p.text) for p in turns[0].parts] == [
        ("text", "see <|image|>"), ("image", None), ("text", "and"), ("text", "hear"), ("audio", None), ("document", None), ("attachment", None), ("image", None)
    ]
    assert turns[1].parts == []


def test_parts_of_json(spark):
    frame = spark.createDataFrame([('[{"kind":"image","ref":"x"},{"kind":"text","text":"t"}]',), ("[not json",), ("plain",)], "c string")
    found = [[(p.kind, p.text, p.ref) for p in r.p] for r in frame.select(chat_parts.parts_of_json(F.col("c")).alias("p")).collect()]
    assert found == [[("image", None, "x"), ("text", "t", None)], [("text", "[not json", None)], [("text", "plain", None)]]


def brute_trie(rows, lead, heads):
    own = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        if conv is not None:
            own.setdefault(conv, []).append((role or "", text or ""))
    rebuilt = {c: own.get(lead(c), [])[: heads(c)] + own[c][heads(c) :] for c in own}
    members = {}
    for c, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(c)
    words = lambda text: len(text.encode().split())
    below = {node: [other for other in members if other[: len(node)] == node] for node in members}
    childless = {node for node in members if len(below[node]) == 1}
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), sum(len(o) == len(node) + 1 for o in below[node]),
            sum(o in childless for o in below[node]), sum((len(members[o]) - 1) * words(o[-1][1]) for o in below[node] if o),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out)


@pytest.mark.parametrize("block", [1, 4])
def test_trie_equals_brute_force(spark, chats, block):
    rng = random.Random(block)
    texts = ["a", "b c", "", None, "d\u00a0e  f"]
    rows = [(c, t, "user" if t % 2 == 0 else None, rng.choice(texts)) for c in [*range(0, 70), 141, 142] for t in range(rng.choice([1, 2, 4, 9]))]
    rows += [(200 + c, t, "user", "copy" if t < 8 or c % 5 else "other") for c in range(20) for t in range(11)]
    rows += [(7, None, "user", "b c"), (None, 0, "user", "a"), (300, 0, "user", "a"), (300, 0, "user", "a")]
    lead, heads = (lambda c: c - c % 20), (lambda c: zlib.crc32(str(c).encode()) % 4)
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    found = prefix_trie.prefix_trie(chats(*rows), block=block, lead=F.col("conv_id") - F.col("conv_id") % 20, heads=crc, most_heads=3)
    assert sorted(map(tuple, found.collect()), key=lambda r: (r[:2], str(r))) == sorted(brute_trie(rows, lead, heads), key=lambda r: (r[:2], str(r)))
    plain = prefix_trie.prefix_trie(chats(*rows), block=block)
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(brute_trie(rows, lead, lambda c: 0), key=str)


def test_trie_of_no_rows(spark, chats):
    assert prefix_trie.prefix_trie(chats((None, 0, "user", "x"))).count() == 0
    assert chat_parts.digests(chat_parts.format_chats(chats((1, 0, "u", "x")).limit(0))).count() == 0


def brute_runs(words, least, copies):
    found = []
    for period in range(1, len(words) // copies + 1):
        i = 0
        while i < len(words) - period:
            j = i
            while j < len(words) - period and words[j] == words[j + period]:
                j += 1
            length = j + period - i
            smaller = any(all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, period))
            if j > i and length >= max(least, copies * period) and not smaller:
                found.append((i, length, period))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic(rng, kinds, size):
    words = []
    while len(words) < size:
        piece = [rng.randrange(kinds) for _ in range(rng.randint(1, 20))]
        words += piece if rng.random() < 0.4 else [piece[i % len(piece)] for i in range(rng.randint(1, 90))]
    return words


@pytest.mark.parametrize("least, copies", [(24, 3), (6, 2), (1, 2), (10, 4)])
def test_runs_equal_brute_force(least, copies):
    rng = random.Random(least)
    for _ in range(200):
        words = periodic(rng, rng.choice([1, 2, 3, 5, 30]), rng.randint(0, 200))
        assert periodic_runs.runs_of(words, least, copies) == brute_runs(words, least, copies)


def test_segments_are_settled():
    rng = random.Random(9)
    for _ in range(100):
        ids = periodic_runs.np.array([rng.randrange(rng.choice([2, 8, 40])) for _ in range(rng.randint(0, 400))], dtype="int64")
        for first, end in periodic_runs.segments(ids, 12, 3):
            assert end - first >= 12 and periodic_runs.np.unique(ids[first:end], return_counts=True)[1].min() >= 3


def test_run_query_and_awkward_texts(spark, docs_of, prose):
    rng = random.Random(2)
    rows = [*prose, *((900 + i, " ".join(map(str, periodic(rng, 4, 150)))) for i in range(40)), (999, "la\u00a0la \t" * 4000), (7, None), (7, None)]
    found = periodic_runs.find_runs(docs_of(*rows), rewrite=planted).collect()
    assert len(found) == len(rows) and {"spans", "n", "score"} <= set(found[0].asDict())
    for r in found:
        words = planted(r.doc_id, (r.text or "").encode().split())
        runs = brute_runs(words, 24, 3) if len(words) < 1000 else [(0, 4000, 1)]
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(words), runs)
        drop = {i for start, length, period in runs for i in range(start + period, start + length)}
        assert r.collapsed == b" ".join(w for i, w in enumerate(words) if i not in drop).decode() and r.n_dropped == len(drop)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (r.strongest and tuple(r.strongest)) == best
    clash = docs_of((1, "a " * 30)).withColumn("runs", F.lit(1)).withColumn("Collapsed", F.lit(2))
    assert periodic_runs.find_runs(clash).first()["collapsed"] == "a"
    assert periodic_runs.find_runs(docs_of((1, "a")).limit(0)).count() == 0


def test_run_digests(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = QUERIES["op13_periodic_runs"](spark, DATA).collect()
    assert len(rows) == docs.count() and any(r.n_runs for r in rows)
    for r in rows:
        words = planted(r.doc_id, (texts[r.doc_id] or "").encode().split())
        runs = periodic_runs.runs_of(words)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        kept = b" ".join(periodic_runs.kept_of(words, runs))
        assert (r.n_runs, r.runs_sha256) == (len(runs), hashlib.sha256(lines.encode()).hexdigest())
        assert r.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
        if runs:
            assert r.exponent_milli == 1000 * r.length // r.period and (r.start, r.length, r.period) in runs
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
