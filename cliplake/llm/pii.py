"""Personal data by a semi-Markov conditional random field.

Texts are chunks between blanks; an at or a dot in brackets is one chunk even with
blanks inside. A segment is a run of at most LONGEST chunks in a region, a stretch
of chunks that could belong to an entity: they have a digit, an @ or an at in
brackets, or are signs between two such, or the words around an at or a dot in
brackets. Features of the whole segment (shape of its digit
groups, check sum, separators, length, the word before it) score it for each
type, and dynamic programming over a region chooses boundaries and types
together. Weights are fitted by maximum likelihood on generated sentences with
known entities, once on the driver (seeded, about a second).

The patterns of the contract are applied beside it: their spans stay, and the
field adds spans that overlap none of them.

Scale: one pass over the text, no shuffle. The dynamic program is linear in the
text as segments are bounded. The model is a fixed number of weights.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
#: A segment with a letter is none of these, so that no digest or id is one.
NO_LETTERS = ("card", "ip")
LONGEST = 6
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_SIGNS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# ---- the field

_CHUNK = re.compile(r"[\[(]\s?(?:at|dot)\s?[\])]\S*|\S+", re.IGNORECASE)
_SEED = re.compile(r"[0-9]|@|[\[(]\s?at\s?[\])]", re.IGNORECASE)
_DIGITS = re.compile(r"[0-9]+")
_AT = re.compile(r"[\[(]\s?at\s?[\])]", re.IGNORECASE)
_MARK_LAST = re.compile(r"[\[(]\s?(?:at|dot)\s?[\])]\Z", re.IGNORECASE)
_DOT_FIRST = re.compile(r"[\[(]\s?dot\s?[\])]", re.IGNORECASE)
_JOINT = re.compile(r"[-–./()]{1,2}\Z")
_SPACE = re.compile(r"\s*")
_TRIM = ".,;:!?\"'«»“”"
#: Words that announce an entity.
CUES = {
    "phone": "phone", "tel": "phone", "call": "phone", "fax": "phone", "mobile": "phone", "telephone": "phone", "cell": "phone",
    "card": "card", "visa": "card", "mastercard": "card", "credit": "card",
    "ip": "ip", "host": "ip", "server": "ip", "address": "ip",
    "mail": "email", "email": "email", "e-mail": "email", "contact": "email", "write": "email",
}


def features(chunks: list[str], before: str) -> list[str]:
    """Names of the features of a whole segment; `before` is the word in front of it."""
    raw = " ".join(chunks)
    text = raw.strip(_TRIM)
    groups = _DIGITS.findall(text)
    digits = "".join(groups)
    n = len(digits)
    out = [f"len{len(chunks)}", "digits" + str(0 if not n else 1 if n < 7 else 2 if n < 9 else 3 if n < 12 else 4 if n < 16 else 5 if n < 20 else 6)]
    out.append("cue_" + CUES.get(before.strip(_TRIM).lower(), "none"))
    if groups and len(groups) <= 6:
        out.append("shape" + "-".join(str(len(g)) for g in groups))
    letters = any(c.isalpha() for c in text)
    out.append("letters" if letters else "signs" if len(text) > n + text.count(" ") else "plain")
    if text.startswith("+") or text.startswith("("):
        out.append("starts" + text[0])
    if "@" in text or _AT.search(text):
        tail = re.split(r"@|[\[(]\s?at\s?[\])]", text, flags=re.IGNORECASE)[-1]
        out.append("mail" if re.search(r"\w(?:\.| ?[\[(] ?dot ?[\])] ?)\w", tail, re.IGNORECASE) and text[0] not in "@[(" else "at")
    if 16 <= n <= 19:
        out.append("sum_ok" if luhn(digits) else "sum_bad")
    if len(groups) == 4 and not letters and text.count(".") == 3:
        out.append("octets" if all(len(g) <= 3 and int(g) <= 255 for g in groups) else "no_octets")
    if "/" in text or ":" in text or "," in text or "$" in text or "€" in text:
        out.append("price_date")
    if raw != text and len(chunks) > 1 and any(c[-1:] in ".,;:!?" for c in chunks[:-1]):
        out.append("broken")
    return out


class Field:
    """Weights by (feature, label); scores are per segment, regions are independent."""

    def __init__(self) -> None:
        self.weight: dict[tuple[str, str], float] = {}

    def scores(self, names: list[str], size: int) -> list[float]:
        get = self.weight.get
        none = [lab == "other" and size > 1 or lab in NO_LETTERS and "letters" in names for lab in LABELS]
        return [float("-inf") if x else sum(get((f, lab), 0.0) for f in names) for lab, x in zip(LABELS, none)]

    def _lattice(self, chunks: list[str], before: str) -> list[tuple[int, int, list[str], list[float]]]:
        out = []
        for j in range(1, len(chunks) + 1):
            for i in range(max(0, j - LONGEST), j):
                names = features(chunks[i:j], chunks[i - 1] if i else before)
                out.append((i, j, names, self.scores(names, j - i)))
        return out

    def best(self, chunks: list[str], before: str) -> list[tuple[int, int, str]]:
        """Segments (first chunk, end, label) of the best segmentation, `other` left out."""
        top: list[tuple[float, int, str]] = [(0.0, 0, "")] + [(float("-inf"), 0, "")] * len(chunks)
        for i, j, _, s in self._lattice(chunks, before):
            for lab, x in zip(LABELS, s):
                if top[i][0] + x > top[j][0]:
                    top[j] = (top[i][0] + x, i, lab)
        out, j = [], len(chunks)
        while j:
            _, i, lab = top[j]
            if lab != "other":
                out.append((i, j, lab))
            j = i
        return out[::-1]

    def learn(self, chunks: list[str], before: str, truth: set[tuple[int, int, str]], rate: float) -> None:
        """A step up the log-likelihood of the true segmentation."""
        n, lattice = len(chunks), self._lattice(chunks, before)
        low = float("-inf")

        def add(a: float, b: float) -> float:
            m = max(a, b)
            return m if m == low else m + log(exp(a - m) + exp(b - m))

        forward, backward = [0.0] + [low] * n, [low] * n + [0.0]
        for i, j, _, s in lattice:
            for x in s:
                if x > low:
                    forward[j] = add(forward[j], forward[i] + x)
        for i, j, _, s in sorted(lattice, key=lambda t: -t[1]):
            for x in s:
                if x > low:
                    backward[i] = add(backward[i], backward[j] + x)
        covered = {k for i, j, _ in truth for k in range(i, j)}
        for i, j, names, s in lattice:
            for lab, x in zip(LABELS, s):
                if x == low:
                    continue
                true = (i, j, lab) in truth or (lab == "other" and i not in covered)
                step = rate * (true - exp(forward[i] + x + backward[j] - forward[n]))
                for f in names:
                    self.weight[f, lab] = self.weight.get((f, lab), 0.0) * (1 - 1e-5) + step


def _sentences(seed: int, count: int) -> Iterator[tuple[str, list[str], set[tuple[int, int, str]]]]:
    """Generated regions: word before, chunks, entities."""
    r = random.Random(seed)
    num = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def card() -> str:
        while True:
            d = num(16)
            if luhn(d):
                return d

    name = lambda: "".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randint(2, 8)))
    four = lambda d, c: c.join(d[i : i + 4] for i in range(0, 16, 4))
    good = {
        "email": [lambda: f"{name()}.{num(2)}@{name()}.com", lambda: f"{name()}[at]{name()}.org", lambda: f"{name()}@{name()}[dot]net", lambda: f"{name()}(at){name()}.co.uk", lambda: f"{name()}{num(1)}@mail.{name()}.de", lambda: f"{name()} [at] {name()} [dot] org", lambda: f"{name()} (at) {name()}.com", lambda: f"{name()}.{name()} [at] {name()}.{name()}.net", lambda: f"{name()} [ at ] {name()} [ dot ] com"],
        "ip": [lambda: ".".join(str(r.randint(0, 255)) for _ in range(4))],
        "card": [card, lambda: four(card(), " "), lambda: four(card(), "-")],
        "phone": [lambda: f"+{num(2)} {num(3)} {num(7)}", lambda: f"({num(3)}) {num(3)}-{num(4)}", lambda: f"{num(3)}-{num(3)}-{num(4)}", lambda: f"+1 ({num(3)}) {num(3)}-{num(4)}", lambda: f"{num(3)}.{num(3)}.{num(4)}", lambda: f"+{num(11)}", lambda: f"({num(3)}) {num(4)} - {num(4)}", lambda: f"{num(3)} - {num(3)} - {num(4)}"],
    }
    mixed = lambda n, letters: "".join(r.choice("0123456789" + letters) for _ in range(n))
    bad = [lambda: mixed(r.choice([12, 16, 32, 40, 64]), "abcdef"), lambda: f"{mixed(8, 'abcdef')}-{mixed(4, 'abcdef')}-{mixed(4, 'abcdef')}", lambda: mixed(r.randint(9, 20), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), lambda: num(r.randint(1, 6)), lambda: f"{num(4)}-{num(2)}-{num(2)}", lambda: f"{num(2)}/{num(2)}/{num(4)}", lambda: f"${num(3)}.{num(2)}", lambda: f"v{num(1)}.{num(1)}.{num(2)}", lambda: num(16)[:15], lambda: num(r.randint(7, 12)), lambda: f"{num(1)},{num(3)},{num(3)}", lambda: f"@{name()}", lambda: f"{num(2)}:{num(2)}", lambda: name() + num(3), lambda: "300.400.1." + num(3), lambda: num(24), lambda: f"{num(4)} {num(4)}", lambda: f"{num(3)} {num(2)}", lambda: f"{num(2)}.{num(3)}", lambda: f"{num(8)}-{num(4)}-{num(4)}", lambda: f"{num(5)} {num(3)} {num(2)}", lambda: f"{num(2)} - {num(2)}", lambda: f"{name()} [at]", lambda: f"[at] {name()}"]
    cues = {k: [w for w, v in CUES.items() if v == k] for k in KINDS}
    for _ in range(count):
        chunks: list[str] = []
        truth = set()
        before = name()
        for k in range(r.randint(1, 3)):
            kind = r.choice([*KINDS, "other", "other", "other"])
            if kind == "other":
                chunks += _CHUNK.findall(r.choice(bad)() + r.choice(["", "", ",", "."]))
            else:
                if not k and r.random() < 0.3:
                    before = r.choice(cues[kind])
                new = _CHUNK.findall(r.choice(good[kind])())
                truth.add((len(chunks), len(chunks) + len(new), kind))
                new[-1] += r.choice(["", "", ",", "."])
                chunks += new
        while True:
            bad16 = [i for i, c in enumerate(chunks) if len(c.strip(_TRIM)) == 16 and c.strip(_TRIM).isdigit() and not luhn(c.strip(_TRIM))]
            if not bad16:
                break
            chunks[bad16[0]] = card()
        yield before, chunks, truth
        if r.random() < 0.3:  # a number of a card's length whose sum is wrong
            d = num(16)
            if not luhn(d):
                yield name(), [d], set()


def train(seed: int = 11, count: int = 700, rounds: int = 4) -> Field:
    field = Field()
    for k in range(rounds):
        for before, chunks, truth in _sentences(seed, count):
            field.learn(chunks, before, truth, 0.3 / (1 + k))
    return field


def regions(text: str) -> Iterator[tuple[str, list[re.Match]]]:
    """(word before, chunks) of each stretch of chunks that could belong to an entity."""

    def chunk(at: int) -> re.Match | None:
        return _CHUNK.match(text, _SPACE.match(text, at).end())

    def before(at: int, least: int) -> int:
        """Where the chunk in front of a place begins; the place itself if there is none after `least`."""
        end = at
        while end > least and text[end - 1].isspace():
            end -= 1
        start = end
        while start > least and not text[start - 1].isspace():
            start -= 1
        return start if start < end else at

    end = 0
    for m in _SEED.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        if start == m.start() and m.group()[0] in "[(":
            start = before(start, end)  # the name in front of an at
        held: list[re.Match] = []
        c = _CHUNK.match(text, start)
        while c:
            seed = _SEED.search(c.group())
            after = held and _MARK_LAST.search(held[-1].group())
            if seed or after or not held or (_DOT_FIRST.match(c.group()) and _AT.search("".join(x.group() for x in held[-3:]))):
                held.append(c)
            elif _JOINT.match(c.group()) and (d := chunk(c.end())) and _DIGITS.search(d.group()) and _DIGITS.search(held[-1].group()):
                held += [c, d]
            else:
                break
            c = chunk(held[-1].end())
        end = held[-1].end()
        first = before(start, 0)
        yield text[first:start].strip(), held


def find(text: str, field: Field) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) of all spans, by kind as listed, then start: those of the patterns and those that the field adds."""
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    out = [(*x, True) for x in base]
    k = 0
    for before, held in regions(text):
        lo, hi = held[0].start(), held[-1].end()
        while k < len(taken) and taken[k][1] <= lo:
            k += 1
        inside = []
        j = k
        while j < len(taken) and taken[j][0] < hi:
            inside.append(taken[j])
            j += 1
        for i, n, lab in field.best([c.group() for c in held], before):
            part = text[held[i].start() : held[n - 1].end()]
            start = held[i].start() + len(part) - len(part.lstrip(_TRIM))
            end = held[n - 1].end() - (len(part) - len(part.rstrip(_TRIM)))
            if start < end and not any(s < end and start < e for s, e in inside):
                out.append((lab, start, end, False))
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1]))


def scan(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, spans (array of kind, start, end, base): a row per row of docs.

    Offsets are code points of the whole text, end exclusive. Null texts count
    as empty; repeated rows are alike; other columns are not read. Texts of any
    length are read whole; an empty table gives no rows."""
    held = docs.sparkSession.sparkContext.broadcast(field or train())
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = []
            for t in b.column(1):
                spans.append([{"kind": k, "start": s, "end": e, "base": base} for k, s, e, base in find(t.as_py(), held.value)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the contract, and n_spans: how many spans of all kinds there are."""
    said = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
