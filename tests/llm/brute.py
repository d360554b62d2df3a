"""Plain versions of the contracts, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return WORDS.findall(text or "")


def secrets(text: str | None) -> tuple[int, int, int, str]:
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    kinds = ["assign", "access", "hex"]
    count = Counter(k for _, k, _ in spans)
    return count[0], count[1], count[2], sha(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans)))


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Repeated sharing: fix the sources above three times their size, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        share = {s: left * weight[s] / w for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed |= {s: 3.0 * sizes[s] for s in above}


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def decontaminated(docs: list, items: list) -> list[tuple]:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of (doc_id, text) rows."""
    windows = defaultdict(set)
    for item, text in items:
        w = ITEM_WORDS.findall(lower(text or ""))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(item)
    lengths = sorted({len(w) for w in windows})
    rows = []
    for doc, text in docs:
        w = ITEM_WORDS.findall(lower(text or ""))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                owners = windows.get(tuple(w[i : i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= owners
        names = sorted(str(x) for x in found if x is not None)
        rows.append((doc, len(w), len(hit), len(names), sha(",".join(names)), bool(hit)))
    return rows


def fingerprint(text: str | None) -> int:
    w = words(lower(text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(docs: list) -> dict:
    """fingerprint and component by doc_id."""
    prints = {d: fingerprint(t) for d, t in docs}
    by_print = defaultdict(list)
    for d, f in prints.items():
        by_print[f].append(d)
    root = {f: f for f in by_print}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    distinct = sorted(by_print)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least: dict[int, int] = {}
    for f, ids in by_print.items():
        least[find(f)] = min([*ids, *([least[find(f)]] if find(f) in least else [])])
    return {d: (f"{f:016x}", least[find(f)]) for d, f in prints.items()}


def deduplicated(docs: list, window: int = 20) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256) of (doc_id, text) rows with distinct ids."""
    first: dict[tuple, tuple] = {}
    split = {d: words(t) for d, t in docs}
    for d in sorted(split):
        w = split[d]
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), (d, i))
    rows = []
    for d, w in split.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] != (d, i):
                gone.update(range(i, i + window))
        rows.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return rows


def quality_base(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    repeated = set()
    for i in range(len(w) - 2):
        if grams[tuple(w[i : i + 3])] > 1:
            repeated.update((i, i + 1, i + 2))
    lines = Counter(x for x in text.split("\n") if words(x))
    dup = sum(n - 1 for n in lines.values())
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, dup, len(repeated), failed


def without_windows(text: str, items: list) -> str | None:
    """The text without the words of benchmark windows and what stands between them; None where
    nothing else is left."""
    windows = set()
    for _, item in items:
        w = ITEM_WORDS.findall(lower(item or ""))
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9) if w else 0)}
    places = [m.span() for m in ITEM_WORDS.finditer(lower(text))]
    w = [lower(text)[a:b] for a, b in places]
    hit = set()
    for n in {len(x) for x in windows}:
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
    if hit and len(hit) == len(w):
        return None
    out, at, i = [], 0, 0
    while i < len(w):
        if i in hit:
            end = i
            while end + 1 in hit:
                end += 1
            out.append(text[at : places[i][0]])
            at, i = places[end][1], end + 1
        else:
            i += 1
    return "".join(out) + text[at:]


def redacted(text: str) -> str:
    """The text with a mark for each stretch that base secrets cover."""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    covered = [m.span() for m in assign.finditer(text) if len(m.group(2)) >= 6]
    covered += [m.span() for m in re.finditer(r"AKIA[A-Z0-9]{16,}", text)] + [m.span() for m in re.finditer(r"[0-9a-f]{24,}", text)]
    out, at = [], 0
    for a, b in sorted(covered):
        if a < at:
            at = max(at, b)
            continue
        out += [text[at:a], "[redacted]"]
        at = b
    return "".join(out) + text[at:]


def distance(p: list, q: list) -> float:
    """Jensen-Shannon distance, base 2, of two lists of counts."""
    import math

    p = [x / (sum(p) or 1) for x in p]
    q = [x / (sum(q) or 1) for x in q]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    bits = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
    return math.sqrt(max(0.0, (bits(p) + bits(q)) / 2))


class KneserNey:
    """Interpolated modified Kneser-Ney over characters, after its definition."""

    def __init__(self, texts: list[str], order: int):
        self.order = order
        counts = Counter(
            ("\0" * (order - 1) + t)[i : i + order] for t in texts for i in range(len(t))
        )
        self.counts = {order: counts}
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.cuts, self.after = {}, {}
        for n, found in self.counts.items():
            of = Counter(found.values())
            y = of[1] / (of[1] + 2 * of[2]) if of[1] else 0
            self.cuts[n] = [0.0] + [
                min(max(i - (i + 1) * y * of[i + 1] / of[i], 0.0), float(i)) if of[i] and of[1] else i / 2 for i in (1, 2, 3)
            ]
            self.after[n] = defaultdict(list)
            for g, c in found.items():
                self.after[n][g[:-1]].append(c)

    def probability(self, gram: str) -> float:
        n = len(gram)
        lower = self.probability(gram[1:]) if n > 1 else 1 / (len(self.counts[1]) + 1)
        follow = self.after[n].get(gram[:-1])
        if not follow:
            return lower
        cut = lambda c: min(self.cuts[n][min(c, 3)], c)
        own = self.counts[n][gram]
        return ((own - cut(own)) if own else 0) / sum(follow) + sum(map(cut, follow)) / sum(follow) * lower

    def perplexity(self, text: str) -> float:
        import math

        padded = "\0" * (self.order - 1) + text
        total = sum(math.log2(self.probability(padded[i : i + self.order])) for i in range(len(text)))
        return 2 ** (-total / len(text))
