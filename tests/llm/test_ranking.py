"""Ranked search against scoring every document for every item, and on odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from cliplake.llm import ranking
from test_llm_operators import ODD

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    held = [(i, Counter(cut(t)), len(cut(t))) for i, t in docs if cut(t)]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(w for _, c, _ in held for w in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i] |= set(cut(t))
    out = {}
    for item, words in asked.items():
        scored = []
        for i, c, size in held:
            m = 100 - 90 + (90 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m)) for w in words if c[w])
            if s > 0:
                scored.append((-s, i is not None, i, s))
        out |= {(item, r + 1): (x[2], x[3]) for r, x in enumerate(sorted(scored)[:k])}
    return out


def rows(df):
    got = df.collect()
    out = {(x["item_id"], x["rank"]): (x["doc_id"], x["score"]) for x in got}
    assert len(out) == len(got)
    return out


@pytest.fixture
def bench(spark):
    return lambda items: spark.createDataFrame(items, "item_id long, text string, rank string, doc_id string, word string, n string")


def test_matches_brute_force(docs, bench):
    r = random.Random(4)
    # frequent to rare, so that lists are of all lengths
    vocabulary = [f"{a}{b}" for a in "abcdéß漢x" for b in "klmnoprstu"]
    say = lambda n: r.choice([" ", ", ", "-", "\x7f", "_"]).join(vocabulary[min(int(r.paretovariate(0.45)) - 1, len(vocabulary) - 1)].upper() for _ in range(n))
    texts = [(i, say(int(min(400, r.paretovariate(0.5))))) for i in range(700)]
    texts += [(1000 + i, texts[i][1]) for i in range(40)] + texts[:15]  # ties and repeated rows
    texts += [(i, texts[3][1]) for i in range(2000, 2030)]
    items = [(k, say(r.randint(1, 40)), *"xxxx") for k in range(25)] + [(30, "", *"xxxx"), (31, None, *"xxxx"), (32, "never heard of", *"xxxx"), (None, say(9), *"xxxx"), (1, say(5), *"xxxx"), (33, texts[3][1], *"xxxx")]
    df = docs(texts + ODD)
    want = brute(texts + ODD, [x[:2] for x in items])
    assert rows(ranking.search(df, bench(items))) == want and len(want) > 200
    assert rows(ranking.search(df, bench(items), head=1, pairs=60)) == want


def test_bounds_prune_and_lose_nothing(docs, bench, monkeypatch):
    r = random.Random(5)
    common, rare = [f"c{i}" for i in range(5)], [f"r{i}" for i in range(150)]
    texts = [(i, " ".join(r.sample(common, 4) + rare[3 * (i % 50) : 3 * (i % 50) + 3])) for i in range(1500)]
    items = [(k, " ".join(common + rare[3 * k : 3 * k + 3]), *"xxxx") for k in range(12)]
    made = {}
    real = ranking.cut
    monkeypatch.setattr(ranking, "cut", lambda df, name: made.setdefault(name, real(df, name)))
    monkeypatch.setattr(ranking, "sweep", lambda *a: None)
    monkeypatch.setattr(ranking, "SHARE", 0.6)
    got = rows(ranking.search(docs(texts), bench(items), head=10))
    assert got == brute(texts, [x[:2] for x in items])
    # the lists that nearly all documents stand in are not fetched, and few documents are looked up
    assert made["thresholds"].where("most > cap").count() == 12 * 3 and made["candidates"].count() == 12 * 30
    assert made["postings"].count() == 1500 * 4 + 12 * 30 * 3


def test_score_uses_whole_long_texts(docs, bench):
    long = "needle " + "hay " * 30_000 + "x" * 60_000 + " needle"
    texts = [(1, long), (2, "hay needle"), (3, "hay"), (None, "needle"), (4, None)]
    items = [(7, "Needle!", *"xxxx"), (8, "hay X", *"xxxx")]
    before = ranking.PART
    assert rows(ranking.search(docs(texts), bench(items))) == brute(texts, [x[:2] for x in items])
    for part in (7, 1000, 50_000):
        ranking.PART = part
        try:
            assert [w for p in ranking.terms(long) for w in p] == [w.encode() for w in cut(long)]
        finally:
            ranking.PART = before


def test_empty_tables(docs, bench):
    texts, items = docs([(1, "a b"), (2, "c")]), bench([(1, "a", *"xxxx")])
    assert ranking.search(texts.limit(0), items).count() == 0 and ranking.search(texts, items.limit(0)).count() == 0
    assert ranking.search(docs([(1, None), (2, "!?")]), items).count() == 0
    assert ranking.search(texts, items).columns == ["item_id", "rank", "doc_id", "score"]
