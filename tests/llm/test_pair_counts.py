"""How many pairs of near copies are compared text by text."""

import random

import numpy as np

from claimlake.llm import superminhash


def test_parity_bits_never_exceed_the_difference():
    draw = np.random.default_rng(3)
    for size, own in ((0, 1), (1, 0), (150, 20), (3000, 900), (20000, 9000)):
        shared = draw.integers(0, 2**63, size, np.uint64)
        one, two = (np.concatenate([shared, draw.integers(0, 2**63, own, np.uint64)]) for _ in range(2))
        differing = sum(int(x).bit_count() for x in (superminhash.parity_bits(one, 64) ^ superminhash.parity_bits(two, 64)).view(np.uint64).tolist())
        assert differing <= 2 * own and (differing >= 1.9 * own or own > 20)


def test_copies_mutually_below_the_threshold_make_few_pairs(spark, monkeypatch):
    draw = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in draw.sample(range(0, 300, 4), 7):
            words[at] = f"other{at}"  # several copies have it, so no copy has many shingles of its own
        rows.append((i, " ".join(words)))
    rows.append((60, rows[59][1] + " end"))
    asked = []
    confirm = superminhash.confirm

    def counted(pairs, *args):
        asked.append(pairs.count())
        return confirm(pairs, *args)

    monkeypatch.setattr(superminhash, "confirm", counted)
    found = {r.doc_id: r.component_id for r in superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [superminhash.shingle_sets([text], 4)[0] for _, text in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                links.append((a, b))
    lowest = list(range(len(rows)))
    for _ in rows:
        for a, b in links:
            lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    assert found == dict(enumerate(lowest)) and 10 < len(set(lowest)) < 60
    assert sum(asked[1:]) < 100  # beside those with a bucket's smallest member
