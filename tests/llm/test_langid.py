"""Language filters against exact sets, on held-out texts of made languages, and on odd rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cliplake.llm import langid
from test_llm_operators import ODD


def speaker(seed, letters, syllables=60):
    r = random.Random(seed)
    parts = ["".join(r.choice(letters) for _ in range(r.randint(2, 3))) for _ in range(syllables)]
    return lambda n: " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(n))


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


@pytest.fixture
def table(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        return df.withColumns({c: F.lit("x") for c in ("held_out", "score", "lang_pred", "n", "gram", "length", "source", "total", "k")})

    return make


def slow_grams(text):
    """Every n-gram that counts, from the description."""
    words = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text).split()
    out = []
    for w in words:
        s = " " + w + " "
        out += [s[i : i + n] for n in langid.LENGTHS for i in range(len(s) - n + 1)]
    return [g for g in out if g.strip()]


def slow_levels(texts):
    counts = Counter(g for t in texts for g in slow_grams(t))
    total = Counter()
    for g, c in counts.items():
        total[len(g)] += c
    return {g: sum(c >= s * total[len(g)] for s in langid.SHARES) for g, c in counts.items()}


def test_filters_match_exact_sets(table):
    alphabets = ["abcdefgh", "abcdijkl", "abefmnop", "öéabcñß", "абвгд", "abcxyz", "ghijk", "lmnop", "qrstu", "aeiou"]  # more than a word of the table
    speak = {f"l{k}": speaker(k, a) for k, a in enumerate(alphabets)}
    r = random.Random(2)
    rows = [(i, f(r.randint(1, 120)), k) for i, (k, f) in enumerate((r.choice(list(speak.items()))) for _ in range(500))]
    df = table(rows)
    got = {x["doc_id"]: x for x in langid.identify(df).collect()}
    levels = {k: slow_levels([t for i, t, lang in rows if lang == k and not held_out(i)]) for k in speak}
    model = langid.learn(df.where((F.crc32(F.col("doc_id").cast("string")) % 5) != 0))
    assert sorted(model.languages) == sorted(speak) and model.table.shape[1] == 2
    texts = [t for _, t, _ in rows[:200]]
    sums = model.scores([langid.codes(t) for t in texts]) / langid.UNIT
    close = 0
    for t, here in zip(texts, sums):
        grams = slow_grams(t)
        exact = [sum(levels[k].get(g, 0) for g in grams) for k in model.languages]
        close += max(abs(a - b) for a, b in zip(exact, here)) <= 0.02 * 4 * len(grams) + 4
    assert close == len(texts)
    for i, t, _ in rows:
        exact = {k: sum(levels[k].get(g, 0) for g in slow_grams(t)) for k in speak}
        first, second = sorted(exact.values())[-2:][::-1]
        assert got[i]["held_out"] == held_out(i) and 0 <= got[i]["score"] <= 1
        if first - second > 0.05 * 4 * len(slow_grams(t)):
            assert exact[got[i]["lang_pred"]] == first
    held = [x for x in rows if held_out(x[0])]
    assert sum(got[i]["lang_pred"] == k for i, _, k in held) >= 0.97 * len(held) and len(held) > 60


def test_no_gram_is_missed_and_false_ones_are_few(table):
    speak = speaker(4, "abcdefghijklmnop", 200)
    texts = [speak(300) for _ in range(20)]  # of fewer n-grams than 1 / SHARES[-1]: all are in the filter
    model = langid.learn(table([(i, t, "x") for i, t in enumerate(texts)]))
    bits, low = len(model.table).bit_length() - 1, len(model.table) - 1
    assert 2**bits == len(model.table)
    planes = model.table.view(np.uint8)[:, 0]

    def levels(texts, length):
        x = np.concatenate([langid.codes(t) for t in texts])
        h, ok = langid.grams(x, length, len(x))
        h = h[ok]
        return planes[h & np.uint64(low)] & planes[h >> np.uint64(bits) & np.uint64(low)]

    assert all((levels(texts, n) & 8 > 0).all() for n in langid.LENGTHS)
    other = "".join(chr(0x4E00 + i) for i in range(8000))
    fill = np.count_nonzero(planes & 8) / len(planes)
    seen = (levels([other], 4) & 8 > 0).mean()
    assert abs(seen - fill**2) < 0.01 and fill < 0.2


def test_odd_rows(table):
    a, b = speaker(1, "abcde"), speaker(2, "vwxyz")
    rows = [(100 + i, a(20), "aa") for i in range(40)] + [(200 + i, b(20), "bb") for i in range(30)] + [(300 + i, b(20), None) for i in range(20)]
    odd = [(i, t, "aa") for i, t in ODD] + [(60, "12 34 !?", "bb"), (61, "漢字", "bb"), (62, "\x00\x00", None), (63, a(1) + "1" * 10, "bb")]
    got = langid.identify(table(rows + odd)).collect()
    assert len(got) == len(rows) + len(odd)
    by = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in got}
    assert {by[i] for i in (1, 2, 4, 60, 62)} == {("und", 0.0)}
    assert all(by[300 + i][0] == "bb" for i in range(20)) and by[63][0] == "aa"
    assert sorted(x["held_out"] for x in got if x["doc_id"] is None) == [True]
    none = langid.identify(table([(i, a(5), None) for i in range(9)])).collect()
    assert {(x["lang_pred"], x["score"]) for x in none} == {("und", 0.0)} and len(none) == 9
    assert langid.identify(table([])).count() == 0


def test_letters_unknown_to_all_go_to_the_language_with_most_text(table):
    rows = [(i, "abc " * 30, "b") for i in range(20)] + [(50 + i, "xyz " * 10, "a") for i in range(20)] + [(100, "漢字漢字", None)]
    got = {x["doc_id"]: x for x in langid.identify(table(rows)).collect()}
    assert got[100]["lang_pred"] == "b" and abs(got[100]["score"] - 0.5) < 0.05


def test_long_texts_are_read_in_parts(table):
    a, b = speaker(1, "abcdefgh", 40), speaker(2, "stuvwxyz", 40)
    model = langid.learn(table([(1, a(500), "a"), (2, b(400), "b")]))
    parts = [a(30_000), b(40_000), "a", a(20_000), "stu" * 400_000]
    whole = model.scores([langid.codes(t) for t in parts])
    assert (whole == np.array([model.scores([langid.codes(t)])[0] for t in parts])).all()
    once = model.scores([langid.codes(" ".join(parts))])[0]
    assert (once == whole.sum(axis=0)).all() and sum(map(len, parts)) > 2 * langid.CHUNK
    got = {x["doc_id"]: x["lang_pred"] for x in langid.identify(table([(i, t, "ab"[i % 2]) for i, t in enumerate(parts * 3)])).collect()}
    assert len(got) == 15
