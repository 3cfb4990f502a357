"""The results of the training-data queries by plain Python loops: slow, and made another way than the operators."""

from __future__ import annotations

import base64
import collections
import fractions
import hashlib
import html
import math
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import tiktoken

from courtside.llm import license_scan, quality_model, secret_scan

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def article(page: str) -> str:
    """The text of the one ``article`` of a page of the given tables."""
    inside = page[page.index("<article>") + 9:page.index("</article>")]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", inside))
    return "\n".join(b for b in blocks if b)


def license_base(text: str) -> tuple:
    words = LICENSE_WORD.findall(lower(text))
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k:k + len(p)] == p:
                starts.append(k)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def shingles(text: str, size: int) -> frozenset:
    words = WORD.findall(lower(text))
    return frozenset(tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()


def classes(texts: list[str], size: int, percent: int) -> list[int]:
    """For each text the first text of its class."""
    sets = [shingles(t, size) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_shingle = collections.defaultdict(list)
    for i, s in enumerate(sets):
        shared = collections.Counter(j for x in s for j in by_shingle[x])
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for x in s:
            by_shingle[x].append(i)
    return [find(i) for i in range(len(texts))]


def word_counts(text: str) -> collections.Counter:
    return collections.Counter(WORD.findall(text.lower()))


def generalised_jaccard(a: str, b: str) -> float:
    x, y = word_counts(a), word_counts(b)
    most = sum((x | y).values())
    return sum((x & y).values()) / most if most else 1.0


def edited(text: str, other: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def quality_base(text: str) -> tuple:
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    covered = {k + d for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def normal_line(line: str) -> str:
    return " ".join(WORD.findall(line)).lower()


def boilerplate(rows: list[tuple[str, str]], documents: int, line_words: int) -> dict[str, set]:
    """Of (host, text), per host the normalised short lines in more than ``documents`` distinct texts."""
    seen = collections.defaultdict(set)
    for host, text in rows:
        for line in text.split("\n"):
            if 0 < len(WORD.findall(line)) <= line_words:
                seen[host, normal_line(line)].add(text)
    out = collections.defaultdict(set)
    for (host, line), texts in seen.items():
        if len(texts) > documents:
            out[host].add(line)
    return out


def shared_lines(rows: set[tuple[str, str]]) -> set[tuple[str, str]]:
    """Of distinct (host, text), the (host, normalised line) that are boilerplate."""
    held = {}
    for host, text in rows:
        held[host, text] = words = collections.Counter()
        for line in text.split("\n"):
            if WORD.search(line):
                words[normal_line(line)] += len(WORD.findall(line))
    count = collections.Counter((host, line) for (host, _), words in held.items() for line in words)
    total = collections.Counter(host for host, _ in rows)
    weight = collections.defaultdict(fractions.Fraction)
    for (host, _), words in held.items():
        everything = sum(words.values())
        up_to = lambda c: sum(w for x, w in words.items() if count[host, x] <= c)
        own = min((c for c in {count[host, x] for x in words} if 5 * up_to(c) >= everything), default=1)
        for line, w in words.items():
            n = count[host, line]
            weight[host, line] += fractions.Fraction(1, min(own, n) if up_to(n - 1) >= w else n)
    return {(host, line) for (host, line), n in weight.items() if n > line_limit(len(line.split(" ")), total[host])}


def line_limit(words: int, documents: int) -> float:
    """Documents of a host that may share a line of so many words."""
    return math.hypot(20, 0.05 / (1 + (words / 12) ** 4) * documents)


def quality_kept(rows: list[tuple[str, str]]) -> list[bool]:
    """Of (host, text), whether the quality rules keep each."""
    shared = shared_lines(set(rows))
    out = []
    for host, text in rows:
        words, *_, failed = quality_base(text)
        lost = sum(len(WORD.findall(x)) for x in text.split("\n") if (host, normal_line(x)) in shared)
        out.append(not failed and not (lost and (5 * (words - lost) < 2 * words or words - lost < 20)))
    return out


def strong_spans(text: str) -> list[tuple]:
    found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def all_spans(text: str) -> list[tuple]:
    """Strong spans, and every weak part with a complement in reach and in its scope, by comparing all of them."""
    strong, weak = secret_scan._finder()(text)
    order = secret_scan.KINDS + secret_scan.WEAK
    gaps = [m.start() for m in re.finditer(secret_scan.GAP, text)]
    scope = lambda s: sum(g < s["start"] for g in gaps)
    parts = [s for s in strong if s["kind"] == "access"] + weak
    linked = [w for w in weak if any(
        p["kind"] in secret_scan.COMPLEMENTS[w["kind"]] and abs(p["start"] - w["start"]) <= secret_scan.REACH and scope(p) == scope(w) for p in parts)]
    return sorted(strong_spans(text) + sorted({(s["start"], order.index(s["kind"]), s["end"], s["kind"]) for s in linked}))


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def encoded(text: str) -> tuple:
    ids = LIBRARY.encode_ordinary(text)
    return len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(text)


def temperature(tokens: list[int], entropy: float, repetition: float) -> float:
    """The exponent by plain bisection."""
    tokens = [t for t in tokens if t]
    if len(set(tokens)) < 2:
        return 1.0
    p = [t / sum(tokens) for t in tokens]
    natural = -sum(x * math.log(x) for x in p)

    def fits(t):
        w = [x**t for x in p]
        w = [x / sum(w) for x in w]
        return (-sum(x * math.log(x) for x in w) <= natural + entropy * (math.log(len(p)) - natural)
                and (max(p) / min(p)) ** (1 - t) <= repetition)

    if fits(0):
        return 0.0
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if fits(mid) else (mid, hi)
    return round(hi, 6)


def uses(rows: list[tuple[int, str, str]], entropy: float = 0.5, repetition: float = 2.0, seed: int = 17) -> dict[int, int]:
    """How often each of (id, source, text) is used, if every row differs from the others."""
    size = {i: len(WORD.findall(t)) for i, _, t in rows}
    total = collections.Counter()
    for i, s, _ in rows:
        total[s] += size[i]
    everything = sum(total.values())
    t = temperature(list(total.values()), entropy, repetition)
    raised = {s: (n / everything) ** t for s, n in total.items() if n}
    budget = max((total[s] / (raised[s] / sum(raised.values())) for s in raised), default=0)
    out = collections.Counter()
    for s in total:
        own = [(i, x) for i, source, x in rows if source == s]
        if not total[s]:
            out.update(i for i, _ in own)
            continue
        quota = round(raised[s] / sum(raised.values()) * budget)
        passes, rest = divmod(quota, total[s])
        for _ in range(passes):
            out.update(i for i, _ in own)
        order = sorted(own, key=lambda r: hashlib.md5(f"{seed}:{passes}:{r[0]}:{hashlib.md5(r[1].encode()).hexdigest()}".encode()).hexdigest())
        filled = 0
        for i, _ in order:
            filled += size[i]
            if filled <= rest:
                out[i] += 1
    return out


SCANNER = license_scan.Scanner()


def licenses(text: str) -> tuple[str, float]:
    """Labels and score with every rule run on every text and all pairs of detections compared."""
    _, line = SCANNER.words(text)
    found = SCANNER.detections(line, text, SCANNER.rules)

    def beaten(k: int) -> bool:
        d = found[k]
        return d.rule.priority < 100 and any(
            e.start <= d.start and e.end >= d.end and (-e.rule.priority, e.start - e.end, j) < (-d.rule.priority, d.start - d.end, k)
            for j, e in enumerate(found))

    kept = [d for k, d in enumerate(found) if not beaten(k)]
    labels = {d.rule.label for d in kept} | {label for phrase, label in PHRASES.items() if f" {phrase} " in line.decode()}
    return ",".join(sorted(labels)), max([d.rule.confidence for d in kept], default=0.0)


def text_statistics(text: str) -> list[float]:
    """The statistics of the quality score, counted character by character and word by word."""
    data = text.encode("utf-8", "replace")
    kinds = [lambda c: 65 <= c <= 90, lambda c: 97 <= c <= 122, lambda c: 48 <= c <= 57, lambda c: c in b" \t\x0b\x0c\r", lambda c: c == 10,
             lambda c: c in b"#*$%&|<>", lambda c: c in b"!?", lambda c: c in b".,;:'\"()-", lambda c: c >= 128]
    shares = [sum(map(kind, data)) / max(len(data), 1) for kind in kinds]
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, counts = len(words), collections.Counter(words)
    return [
        math.log(1 + len(text)), math.log(1 + n), *shares, math.log(1 + sum(len(w) for w in words) / max(n, 1)), len(counts) / max(n, 1) ** 0.8,
        max([0, *counts.values()]) / max(n, 1), len({(a, b) for a, b in zip(words, words[1:])}) / max(n - 1, 1),
        len(set(lines)) / max(len(lines), 1), math.log(1 + n / max(len(lines), 1)), sum(w.isalnum() for w in words) / max(n, 1)]


def quality_scores(texts: dict[int, str], labels: list[tuple[int, int]]) -> dict[int, float]:
    """Scores by a least-squares solution of the whole table and the max-min form of the isotonic fit."""
    q = quality_model
    ids = sorted(texts)
    x = np.array([text_statistics(texts[i]) for i in ids])
    place = {i: k for k, i in enumerate(ids)}
    train = [(place[i], label) for i, label in labels if i in place and zlib.crc32(str(i).encode()) % 5]
    rows, y = np.array([k for k, _ in train]), np.array([float(label) for _, label in train])
    center, scale = x[rows].mean(axis=0), np.maximum(x[rows].std(axis=0), 1e-6)
    z = np.clip((x - center) / scale, -8, 8)
    rng = np.random.default_rng(q.SEED)
    w, b = rng.standard_normal((z.shape[1], q.FEATURES)) / q.WIDTH, rng.uniform(0, 2 * np.pi, q.FEATURES)
    inputs = np.column_stack([math.sqrt(2 / q.FEATURES) * np.cos(z @ w + b), z, np.ones(len(z))])
    ridge = np.sqrt(q.RIDGE * len(rows)) * np.eye(inputs.shape[1])
    ridge[-1, -1] = 0
    weights = np.linalg.lstsq(np.vstack([inputs[rows], ridge]), np.concatenate([y, np.zeros(len(ridge))]), rcond=None)[0]
    raw = inputs @ weights
    steps = collections.defaultdict(list)
    for k, label in train:
        value = max(-1.0, min(2.0, raw[k])) * q.GRID
        steps[math.floor(abs(value) + 0.5) * (1 if value >= 0 else -1)].append(label)
    keys = sorted(steps)
    n, s = [len(steps[k]) for k in keys], [sum(steps[k]) for k in keys]
    cn, cs = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(s)])
    level = [max(min((cs[j + 1] - cs[a]) / (cn[j + 1] - cn[a]) for j in range(i, len(keys))) for a in range(i + 1)) for i in range(len(keys))]
    knots, levels = [], []
    for value in sorted(set(np.round(level, 12))):
        own = [i for i in range(len(keys)) if round(level[i], 12) == value]
        knots.append(sum(keys[i] / q.GRID * n[i] for i in own) / sum(n[i] for i in own))
        levels.append(level[own[0]])

    def between(r: float) -> float:
        if r <= knots[0]:
            return levels[0]
        for a, c, u, v in zip(knots, knots[1:], levels, levels[1:]):
            if r <= c:
                return u + (v - u) * (r - a) / (c - a)
        return levels[-1]

    return {i: 0.98 * between(raw[k]) + 0.02 * min(max((raw[k] + 1) / 3, 0), 1) for i, k in place.items()}
